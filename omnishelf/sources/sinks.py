"""Full-refresh sinks and intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from omnishelf.sources.versions import remove, replace

# Steps in between are written and read a few times only, and half of them are digests as hex, which
# Spark's default codec leaves at full length.
CODEC = "zstd"


def overwrite(
    df: DataFrame, path: str, bloom: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> int:
    """Replace a table and return the number of rows, counted in the pass that writes them.

    Readers see the old rows until all new ones are there; a load that fails leaves them in place.
    Columns in ``bloom`` get a filter per row group that tells readers which values it cannot hold.
    """
    seen = Observation()
    filters = {f"parquet.bloom.filter.enabled#{column}": "true" for column in bloom}
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    replace(counted, path, options={**filters, **(options or {})})
    return seen.get["n_rows"]


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in the order of the columns over all files, so that a filter on the first ones reads few
    row groups. A value that many rows share spans files as the later columns divide it."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def count_rows(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n_rows) of all frames, empty ones included, as one plan."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def in_threads(
    spark: SparkSession, work: Mapping[str, Callable[[], object]], threads: int
) -> dict[str, object]:
    """Results of calls that each run Spark jobs, several at a time.

    Where one job's last tasks leave executors idle, the next job's tasks use them; the scheduler's
    FAIR mode shares them evenly, FIFO fills up. Local properties go along with each call.
    """
    with ThreadPoolExecutor(max(1, threads)) as pool:
        start = inheritable_thread_target(spark)
        calls = {name: pool.submit(start(call)) for name, call in work.items()}
        try:
            return {name: call.result() for name, call in calls.items()}
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def land(
    frames: Mapping[str, DataFrame],
    folder: str,
    tables: Iterable[str] | None = None,
    dry_run: bool = False,
    threads: int = 1,
    bloom: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, int]:
    """Replace the chosen tables and return their row counts; with ``dry_run`` only count, all
    tables in one job. ``threads`` tables are written at a time. ``bloom`` as in ``overwrite``, by
    table."""
    chosen = {name: frames[name] for name in (frames if tables is None else tables)}
    if not chosen:
        return {}
    if dry_run:
        return {r["table"]: r["n_rows"] for r in count_rows(chosen).collect()}

    def write(name: str) -> Callable[[], int]:
        return lambda: overwrite(chosen[name], f"{folder}/{name}", (bloom or {}).get(name, ()))

    spark = next(iter(chosen.values())).sparkSession
    return in_threads(spark, {name: write(name) for name in chosen}, threads)


def shared_folder(spark: SparkSession) -> str:
    """Where jobs may leave intermediate tables: the folder the session names for checkpoints."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a relation that several plans read, and read it back.

    Cuts the lineage: a lost executor costs a reread instead of the whole plan. Unlike a
    checkpoint, the table keeps column pruning, pushed filters and size statistics. The table lies
    below ``folder``, or the session's shared folder, and is its owner's to remove; ``scratch`` does
    that for all tables of a scope.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(
    spark: SparkSession, folder: str | None = None
) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A ``store`` for steps in between. All it wrote is removed when the scope ends, whether or not
    the work in it succeeded, so what is read from it must be written elsewhere by then."""
    own = f"{folder or shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        yield lambda df: stored(df, own)
    finally:
        remove(spark, own)
