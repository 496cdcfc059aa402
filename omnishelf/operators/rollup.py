"""Union-and-roll-up: several sources aligned to one row shape, then one row per item."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_sources(
    rows: DataFrame,
    keys: Sequence[str],
    prefer: Sequence[str],
    carry: Sequence[str],
    aggregates: Mapping[str, Column],
) -> DataFrame:
    """One aggregation gives the preferred row, the merged values and the contributing sources.

    The least struct over (``prefer``, ``carry``) is the preferred row. Everything is combined per
    map task first, so a very common key costs one row per task. Rows with a NULL key have no
    identity and are left out, as an equality join would.
    """
    whole = rows.dropna(subset=list(keys))
    best = F.min(F.struct(*prefer, *[c for c in carry if c not in prefer])).alias("_best")
    rolled = whole.groupBy(*keys).agg(best, *[c.alias(name) for name, c in aggregates.items()])
    return rolled.select(
        *keys,
        *[F.col("_best")[c].alias(c) for c in carry],
        *[F.col(f"`{name}`") for name in aggregates],
    )


def joined_set(value: Column | str, separator: str = ", ") -> Column:
    """Ordered distinct values as text. For columns with a small closed set of values: the set is
    the aggregation buffer. NULL when there is no value."""
    values = F.sort_array(F.collect_set(value))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def joined_ranked_set(value: Column | str, rank: Column | str, separator: str = ", ") -> Column:
    """As ``joined_set``, ordered by a rank column."""
    column = F.col(value) if isinstance(value, str) else value
    order = F.col(rank) if isinstance(rank, str) else rank
    pairs = F.sort_array(F.collect_set(F.struct(order.alias("rank"), column.alias("value"))))
    return F.array_join(F.transform(pairs, lambda p: p["value"]), separator)
