"""Joins against hand-kept reference tables.

No join here forces a broadcast. Spark broadcasts a lookup while its size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles it, with hot keys of the fact side
split by the adaptive skew join. ``unique_lookup`` makes every lookup unique on its key, so no join
multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions.keys import norm_key
from omnishelf.operators.dedupe import reduce_for_join


def unique_lookup(
    lookup: DataFrame,
    keys: Mapping[str, Column],
    values: Sequence[str],
    prefer: Sequence[Column] = (),
) -> DataFrame:
    """Lookup with computed keys, one row per key.

    Two spellings of one name would fan out every row that joins; the row with the greatest
    ``prefer``, then the greatest value wins.
    """
    row = F.struct(
        *[c.alias(f"_p{i}") for i, c in enumerate(prefer)], *[F.col(v) for v in values]
    )
    keyed = lookup.select(*[c.alias(f"_k_{name}") for name, c in keys.items()], row.alias("row"))
    one = reduce_for_join(keyed, {name: f"_k_{name}" for name in keys}, {"row": F.max("row")})
    return one.select(*keys, *[f"row.{v}" for v in values])


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, Column | str],
    take: Mapping[str, str],
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Left join: ``on`` maps lookup keys to expressions of ``df``, ``take`` maps new names to
    lookup columns. Keys in ``null_safe`` also pair NULL with NULL and still join by hash."""
    right = lookup.select(
        *[F.col(k).alias(f"_lk_{k}") for k in on],
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    terms = []
    for key, value in on.items():
        left = F.col(value) if isinstance(value, str) else value
        right_key = F.col(f"_lk_{key}")
        terms.append(left.eqNullSafe(right_key) if key in null_safe else left == right_key)
    condition = reduce(lambda a, b: a & b, terms)
    return df.join(right, condition, "left").drop(*[f"_lk_{k}" for k in on])


def attach_creator_country(
    df: DataFrame, creators: DataFrame, creator_col: str, key: Column | str, out: str
) -> DataFrame:
    """Country of a creator from a (creator, country) table, compared on the normalised name."""
    lookup = unique_lookup(creators, {"creator_key": norm_key(creator_col)}, ["country"])
    return attach(df, lookup, {"creator_key": key}, {out: "country"})
