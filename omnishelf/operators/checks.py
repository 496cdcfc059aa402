"""Data-quality checks: each returns the violating rows, none means the check passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions.keys import norm_key
from omnishelf.operators.dedupe import reduce_for_join


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations held by more than one row."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row; NULLs do not count."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def case_insensitive_unique(df: DataFrame, column: str) -> DataFrame:
    """Spellings that fall together once normalised: as a lookup key they would multiply rows."""
    keyed = df.select(norm_key(column).alias(f"{column}_key"))
    return unique(keyed, f"{column}_key")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(
    df: DataFrame, column: str, values: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    scope = df if where is None else df.filter(where)
    return scope.filter(~F.col(column).isin(*values))


def between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows outside the closed interval; NULL passes."""
    return df.filter(~F.col(column).between(low, high))


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value has no parent; NULL passes."""
    keys = reduce_for_join(parent, {"_parent": parent_column}, {})
    child = df.filter(F.col(column).isNotNull())
    return child.join(keys, F.col(column) == F.col("_parent"), "left_anti")


def row_checks(
    df: DataFrame, relation: str, violations: Mapping[tuple[str, str], Column]
) -> DataFrame:
    """Count the violations of many row-level checks in one pass over the relation.

    ``violations`` maps (check, column) to the condition a bad row meets. Gives one row per check.
    """
    counts = df.agg(
        *[F.count(F.when(bad, 1)).alias(f"n{i}") for i, bad in enumerate(violations.values())]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column"),
                F.col(f"n{i}").alias("violations"),
            )
            for i, (check, column) in enumerate(violations)
        ]
    )
    return counts.select(F.explode(entries).alias("e")).select(
        "e.check", F.lit(relation).alias("relation"), "e.column", "e.violations"
    )
