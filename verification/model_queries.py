"""Registered queries that run the domain plans on derived inputs."""

from __future__ import annotations

import uuid
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omnishelf.plans import build, marts, quality
from omnishelf.plans.staging import STAGES
from omnishelf.session import configure
from omnishelf.sources.readers import read_exports, read_lookups, read_tables
from omnishelf.sources.schemas import LOOKUPS as LOOKUP_TYPES
from omnishelf.sources.sinks import count_rows, in_threads, land, stored
from verification import oracle_models as oracle
from verification.derived import EXPORT_NAMES, LOOKUPS, RAW, Derived, working_folder

LOOKUP_COLUMNS = {
    name: [column.split(" ")[0] for column in ddl.split(", ")] for name, ddl in LOOKUP_TYPES.items()
}
LOOKUP_WIDTH = max(map(len, LOOKUP_COLUMNS.values()))
# Staged sources that two domains read, and tables made at a time.
SHARED = ["bookbuddy", "moviebuddy", "trakt_ratings"]
THREADS = 4
LANDED_FIRST = ["bookbuddy", "trakt_ratings", "bandcamp_wishlist"]


def plain(df: DataFrame) -> DataFrame:
    """Instants as microseconds and dates as text: forms that both engines hand over alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampNTZType):
            column = F.unix_micros(column.cast("timestamp"))
        elif isinstance(field.dataType, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def unified(d: Derived, domain: str, strict: bool = False) -> DataFrame:
    folder = working_folder(d.spark)
    return build.unify(domain, d.tables, d.lookups, strict, lambda df: stored(df, folder))


def collection(d: Derived, domain: str, strict: bool = False) -> DataFrame:
    return build.collect(domain, unified(d, domain, strict), strict)


def layered(spark: SparkSession, sf: str) -> Derived:
    """Staged sources are stored once, as the build does, since several domains read them."""
    return Derived(configure(spark), sf, RAW)


def collections(d: Derived, strict: bool = False) -> dict[str, DataFrame]:
    """Stored collection tables of all domains, made several at a time as in the build."""
    folder = working_folder(d.spark)
    # Sources are stored on first use, so those that the domains share are made before the threads.
    in_threads(d.spark, {name: partial(d.tables.__getitem__, name) for name in SHARED}, THREADS)

    def make(domain: str):
        return lambda: stored(collection(d, domain, strict), folder)

    return in_threads(d.spark, {domain: make(domain) for domain in marts.DOMAINS}, THREADS)


def _staged(name: str):
    return lambda spark, sf: plain(Derived(configure(spark), sf).staged[name])


def _unified(domain: str, strict: bool):
    return lambda spark, sf: plain(unified(Derived(configure(spark), sf), domain, strict))


def _collection(domain: str):
    return lambda spark, sf: plain(collection(Derived(configure(spark), sf), domain))


def media_summary_models(spark: SparkSession, sf: str) -> DataFrame:
    return marts.media_summary(collections(layered(spark, sf)))


def _country_index(strict: bool):
    def run(spark, sf):
        d = layered(spark, sf)
        return marts.country_index(collections(d, strict), d.lookups, strict)

    return run


def genre_coverage(spark: SparkSession, sf: str) -> DataFrame:
    d = Derived(configure(spark), sf)
    return quality.unmapped_genres(d.staged, d.lookups)


def manual_rating_orphans(spark: SparkSession, sf: str) -> DataFrame:
    d = layered(spark, sf)
    items = quality.mart_items(collections(d))
    return quality.orphaned_manual_ratings(items, d.lookups["manual_ratings"])


def duplicate_titles(spark: SparkSession, sf: str) -> DataFrame:
    d = layered(spark, sf)
    return quality.duplicate_items(quality.mart_items(collections(d)))


def _export_scan(name: str):
    """An export written as CSV, in two files of different header order, read back and staged."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw = Derived(configure(spark), sf).raw[name]
        folder = f"{working_folder(spark)}/exports-{uuid.uuid4().hex}"
        halves = F.pmod(F.xxhash64(*raw.columns), F.lit(2))
        for half, columns in enumerate((raw.columns, raw.columns[::-1])):
            raw.filter(halves == half).select(*[F.col(f"`{c}`") for c in columns]).write.mode(
                "append"
            ).csv(f"{folder}/{name}.csv", header=True, quote='"', escape='"')
        return plain(STAGES[name](read_exports(spark, folder)[name]))

    return run


def lookup_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All lookup tables written as CSV and read back typed; every field as text."""
    d = Derived(configure(spark), sf)
    folder = f"{working_folder(spark)}/lookups-{uuid.uuid4().hex}"
    for name in LOOKUPS:
        d.lookups[name].write.csv(f"{folder}/{name}.csv", header=True, quote='"', escape='"')
    parts = []
    for name, df in read_lookups(spark, folder).items():
        fields = [F.col(c).cast("double" if c == "rating" else "string") for c in df.columns]
        texts = [F.when(f.isNotNull(), f.cast("string")) for f in fields]
        texts += [F.lit(None).cast("string")] * (LOOKUP_WIDTH - len(texts))
        parts.append(df.select(F.lit(name).alias("lookup"), *[c.alias(f"f{i}") for i, c in enumerate(texts)]))
    return reduce(DataFrame.unionByName, parts)


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A table written twice holds the second content only."""
    d = Derived(configure(spark), sf)
    folder = f"{working_folder(spark)}/landed-{uuid.uuid4().hex}"
    name = "trakt_ratings"
    land({name: d.raw[name].union(d.raw[name])}, folder)
    land({name: d.raw[name], "not chosen": d.raw["goodreads"]}, folder, tables=[name])
    return plain(STAGES[name](read_tables(spark, folder, [name])[name]))


def land_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a load of all staged sources would write, counted in one job."""
    return count_rows(Derived(configure(spark), sf).staged.all())


def land_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a load of three sources says it wrote, beside those found in the tables."""
    d = Derived(configure(spark), sf)
    folder = f"{working_folder(spark)}/landed-{uuid.uuid4().hex}"
    written = land({name: d.staged[name] for name in LANDED_FIRST}, folder, threads=2)
    claimed = spark.createDataFrame([*written.items()], "table string, n_written long")
    return claimed.join(count_rows(read_tables(spark, folder, written)), "table")


def full_build(spark: SparkSession, sf: str) -> DataFrame:
    """Every layer built and stored, the summary read from the stored mart."""
    d = Derived(configure(spark), sf)
    raw = {name: d.raw[name] for name in RAW}
    lookups = {name: d.lookups[name] for name in LOOKUPS}
    folder = f"{working_folder(spark)}/build-{uuid.uuid4().hex}"
    return build.build(spark, raw, lookups, folder)["mart.media_summary"]


QUERIES = {
    **{f"stage_{name}": _staged(name) for name in RAW},
    **{f"unify_{d}": _unified(d, False) for d in oracle.MODEL_CTES},
    **{f"unify_{d}_strict": _unified(d, True) for d in oracle.MODEL_CTES if d != "manga"},
    **{f"{d}_collection": _collection(d) for d in oracle.MODEL_CTES},
    "media_summary_models": media_summary_models,
    "country_index_models": _country_index(False),
    "country_index_models_strict": _country_index(True),
    "genre_coverage_models": genre_coverage,
    "manual_rating_orphans_models": manual_rating_orphans,
    "duplicate_titles_models": duplicate_titles,
    **{f"export_scan_{name}": _export_scan(name) for name in EXPORT_NAMES},
    "lookup_scan": lookup_scan,
    "full_refresh": full_refresh,
    "land_dry_run": land_dry_run,
    "land_counts": land_counts,
    "full_build": full_build,
}


def _lookup_sql() -> str:
    parts = []
    for name, columns in LOOKUP_COLUMNS.items():
        texts = [f"nullif({c}::varchar, '')" for c in columns]
        texts += ["NULL"] * (LOOKUP_WIDTH - len(columns))
        listed = ", ".join(f"{x} AS f{i}" for i, x in enumerate(texts))
        parts.append(f"SELECT '{name}' AS lookup, {listed} FROM lk_{name}")
    return " UNION ALL ".join(parts)


def _count_sql(names, *columns: str) -> str:
    counts = ", ".join(f"count(*) AS {c}" for c in columns)
    return " UNION ALL ".join(f"SELECT '{n}' AS \"table\", {counts} FROM st_{n}" for n in names)


def oracle_sql() -> dict[str, str]:
    return {
        **{f"stage_{name}": oracle.staged_oracle(name) for name in RAW},
        **{f"unify_{d}": oracle.unified_oracle(d) for d in oracle.MODEL_CTES},
        **{
            f"unify_{d}_strict": oracle.unified_oracle(d, True)
            for d in oracle.MODEL_CTES
            if d != "manga"
        },
        **{f"{d}_collection": oracle.collection_oracle(d) for d in oracle.MODEL_CTES},
        "media_summary_models": oracle.summary_oracle(),
        "country_index_models": oracle.country_index_oracle(False),
        "country_index_models_strict": oracle.country_index_oracle(True),
        "genre_coverage_models": oracle.coverage_oracle(),
        "manual_rating_orphans_models": oracle.orphans_oracle(),
        "duplicate_titles_models": oracle.duplicates_oracle(),
        **{f"export_scan_{name}": oracle.staged_oracle(name) for name in EXPORT_NAMES},
        "lookup_scan": oracle.assemble({}, _lookup_sql()),
        "full_refresh": oracle.staged_oracle("trakt_ratings"),
        "land_dry_run": oracle.assemble({}, _count_sql(RAW, "n_rows")),
        "land_counts": oracle.assemble({}, _count_sql(LANDED_FIRST, "n_rows", "n_written")),
        "full_build": oracle.summary_oracle(),
    }
