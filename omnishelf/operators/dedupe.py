"""One row per key.

Both forms reduce inside each map task before the shuffle, so a key that holds a large share of all
rows sends at most one row per task: ``first_per_key`` through Spark's window group limit (it trims
``row_number() = 1`` on both sides of the exchange), ``latest_with_bounds`` through partial
aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]
) -> DataFrame:
    """The first row of every key in the given order; NULL keys form a key of their own."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_latest(
    df: DataFrame,
    keys: Sequence[str | Column],
    latest: Sequence[str | Column],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the highest ``latest`` values per key (NULL is lowest).

    Equal rows are told apart by ``tie_break``, by default all other columns in their order, so the
    result does not depend on how the input is laid out.
    """
    if tie_break is None:
        named = {c for c in [*keys, *latest] if isinstance(c, str)}
        tie_break = [c for c in df.columns if c not in named]
    order = [F.desc_nulls_last(c) if isinstance(c, str) else c.desc_nulls_last() for c in latest]
    order += [F.asc_nulls_first(c) for c in tie_break]
    return first_per_key(df, keys, order)


def latest_with_bounds(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    attrs: Sequence[str],
    first: str = "first_date",
    last: str = "last_date",
    count: str = "row_count",
) -> DataFrame:
    """First date, last date, row count and the attributes of the latest row, in one aggregation.

    The greatest struct is the latest row itself: the date leads, the attributes break ties.
    """
    latest = F.max(F.struct(F.col(date_col), *[F.col(a) for a in attrs])).alias("_latest")
    rolled = df.groupBy(*keys).agg(
        F.min(date_col).alias(first), F.count(F.lit(1)).alias(count), latest
    )
    return rolled.select(
        *keys,
        first,
        F.col("_latest")[date_col].alias(last),
        count,
        *[F.col("_latest")[a].alias(a) for a in attrs],
    )


def reduce_for_join(
    df: DataFrame, keys: Mapping[str, str], aggregates: Mapping[str, Column]
) -> DataFrame:
    """One row per key as the small side of a join; ``keys`` maps output names to key columns.

    The output keys are expressions over the grouping columns and the count, so Spark does not take
    the result as partitioned by them and shuffles it once more for a join that is too large to
    broadcast. That exchange is wanted: at run time Spark splits the hot partitions of the other
    side only when the join sits directly on two exchanges. The count is what keeps a reduction to
    bare keys a hash aggregation; it is never 0.
    """
    return df.groupBy(*keys.values()).agg(
        F.count(F.lit(1)).alias("_copies"), *[c.alias(name) for name, c in aggregates.items()]
    ).select(
        *[F.when(F.col("_copies") > 0, F.col(c)).alias(out) for out, c in keys.items()], *aggregates
    )
