"""Shared tables, byte-level word hashing and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that one vectorised step looks at; a longer document makes a step of its own.
STEP_BYTES = 1 << 20
# Bytes that Spark hands to a Python worker at a time, where the session names none. Spark's own bound
# is 64 MB, held by the executor and the worker at once, on the way there and on the way back.
BATCH_BYTES, _BATCH_KEY = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, and bound their batches.

    The path reaches workers which see the driver's folder under the same path; elsewhere the package
    must be installed or shipped (``--py-files``).
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}" if known else root
    # One byte stands for unset.
    if spark.conf.get(_BATCH_KEY, "1b") == "1b":
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return spark


_KEPT: dict[str, dict] = {}


def kept_for(operator: str) -> dict:
    """What this worker process keeps between the tasks of an operator. Workers outlive queries, so
    what they kept for another operator goes when one asks."""
    if operator not in _KEPT:
        _KEPT.clear()
        _KEPT[operator] = {}
    return _KEPT[operator]


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` names it.

    Only a local session (tests) that names none gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes in this scope are removed at its end. What is read from them
    must be written elsewhere by then."""
    own = f"{shared_folder(spark)}/llm-scratch-{uuid.uuid4().hex}"
    before = _SCRATCH.set(own)
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(own)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder (or the named one) and read it back: cuts the lineage
    durably. Outside a ``scratch`` scope the table is its owner's to remove."""
    spark = df.sparkSession
    path = f"{folder or _SCRATCH.get() or shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def steps(texts: pa.Array, limit: int = STEP_BYTES):
    """Cut an Arrow text column into slices of about ``limit`` bytes.

    Yields (first row, buffer, offsets): the slice's bytes and its row bounds in them; nulls are
    empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), n)
        yield row, data[bounds[row] : bounds[stop]], bounds[row : stop + 1] - bounds[row]
        row = stop


_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = np.ones(0, np.uint64)
_INVERSES = np.ones(0, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, made once per worker."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, STEP_BYTES + 1)
        with np.errstate(over="ignore"):
            for name, base in (("_POWERS", _BASE), ("_INVERSES", _INVERSE)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                globals()[name] = np.cumprod(table, dtype=np.uint64)
    return _POWERS, _INVERSES


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(data: np.ndarray, lower: bool) -> np.ndarray:
    """Prefix sums from which ``span_hash`` reads the hash of any span."""
    powers, _ = _powers(len(data) + 1)
    terms = (_BYTE_LOWER if lower else _BYTE)[data] * powers[: len(data)]
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, stop); equal bytes give equal hashes."""
    _, inverses = _powers(len(prefix))
    return mix((prefix[stop] - prefix[start]) * inverses[start])


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Starts and stops of the words, runs of bytes marked in the 256-entry table ``inside``.

    Words end at row bounds. Also returns each row's first word as an index, with the total last.
    """
    flags = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = flags[:-1]
    starts = np.flatnonzero(flags & (~before | cut[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = flags[1:]
    stops = np.flatnonzero(flags & (~after | cut[1:])) + 1
    return starts, stops, np.searchsorted(starts, offsets)


NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Smallest id reachable from each vertex of undirected ``edges`` (a, b): columns id, component.

    Large-star and small-star steps alternate until nothing changes. Every step is one aggregation
    and one join; its result is written to the shared folder. No vertex or edge reaches the driver.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b"), F.col("a")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        near = both(e) if large else e.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )
        # The key is an expression, so the join gets exchanges of its own on both sides and Spark
        # can split the edges of a vertex that very many others meet.
        low = near.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select(
            F.when(F.col("n") > 0, F.col("a")).alias("v"), F.least("a", "m").alias("m")
        )
        joined = near.join(low, near["a"] == low["v"])
        if large:
            out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                low.select(F.col("v").alias("a"), F.col("m").alias("b"))
            )
        return out.filter("a <> b").distinct()

    current = stored(edges.filter("a <> b").select("a", "b").distinct())
    sums = None
    for _ in range(rounds):
        current = stored(star(star(current, True), False))
        now = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == sums:
            break
        sums = now
    else:
        raise RuntimeError("components did not settle")
    return current.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
