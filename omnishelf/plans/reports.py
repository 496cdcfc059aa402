"""Consumer queries over the collection tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions import split_csv, uni_trim


def filter_collection(
    df: DataFrame,
    genre: str | None = None,
    country: str | None = None,
    source: str | None = None,
    rated_only: bool = False,
    watched_only: bool = False,
) -> DataFrame:
    """Items of a collection table that meet all given conditions.

    Collections are written by country, so a country reads the row groups that hold it only.
    """
    if genre is not None:
        column = "genres" if "genres" in df.columns else "genre"
        df = df.filter(F.array_contains(split_csv(column), genre))
    if country is not None:
        df = df.filter(F.col("country") == country)
    if source is not None:
        column = "source_name" if "source_name" in df.columns else "source"
        df = df.filter(F.col(column) == source)
    if rated_only:
        df = df.filter("is_rated")
    if watched_only:
        df = df.filter("is_watched")
    return df


def find_items(df: DataFrame, id_column: str, ids: Sequence[str]) -> DataFrame:
    """The items with the given ids. Collections carry a filter of their ids per row group, so row
    groups without any of them are not read."""
    return df.filter(F.col(id_column).isin(list(ids)))


def counts_by(df: DataFrame, value: Column | str, name: str, n: str = "n_items") -> DataFrame:
    """Items per value; NULL values form a group."""
    column = F.col(value) if isinstance(value, str) else value
    return df.groupBy(column.alias(name)).agg(F.count(F.lit(1)).alias(n))


def counts_by_genre(df: DataFrame, column: str = "genres") -> DataFrame:
    tokens = df.select(F.explode(split_csv(column)).alias("genre"))
    return counts_by(tokens, uni_trim("genre"), "genre")


def decade(year: Column | str) -> Column:
    column = F.col(year) if isinstance(year, str) else year
    return (F.floor(column / 10) * 10).cast("bigint")


def counts_by_decade(df: DataFrame, year: Column | str = "release_year") -> DataFrame:
    return counts_by(df, decade(year), "decade")


def top_k(df: DataFrame, value: Column | str, name: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value. Spark keeps k rows per task, then merges."""
    return top_counted(counts_by(df, value, name), name, k)


def top_counted(counted: DataFrame, name: str, k: int) -> DataFrame:
    known = counted.filter(F.col(name).isNotNull())
    return known.orderBy(F.desc("n_items"), F.asc(name)).limit(k)


def top_creators(
    items: DataFrame, key: str, names: DataFrame, names_key: str, name: str, k: int
) -> DataFrame:
    """The k creators with most items. Items are counted by key first; names join to the counts, not
    to every item. Keys with one name count together."""
    counted = counts_by(items, key, "_key")
    named = counted.join(names, F.col("_key") == F.col(names_key))
    totals = named.groupBy(F.col(name).alias("creator")).agg(F.sum("n_items").alias("n_items"))
    return top_counted(totals, "creator", k)


def counts_per_year(df: DataFrame, date: Column | str = "first_watched_date") -> DataFrame:
    column = F.col(date) if isinstance(date, str) else date
    return counts_by(df.filter(column.isNotNull()), F.year(column).cast("bigint"), "year")


def counts_per_month(df: DataFrame, date: Column | str) -> DataFrame:
    column = F.col(date) if isinstance(date, str) else date
    return counts_by(df.filter(column.isNotNull()), F.date_format(column, "yyyy-MM"), "month")


def genre_ratings(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Average rating and rated items per genre over all collection tables."""
    parts = []
    for df in marts.values():
        column = "genres" if "genres" in df.columns else "genre"
        rows = df.filter("rating IS NOT NULL")
        parts.append(rows.select(F.col(column).alias("genres"), "rating"))
    rated = reduce(DataFrame.unionByName, parts)
    tokens = rated.select(F.explode(split_csv("genres")).alias("genre"), "rating")
    return tokens.groupBy(uni_trim("genre").alias("genre")).agg(
        F.count(F.lit(1)).alias("n_rated"), F.round(F.avg("rating"), 2).alias("avg_rating")
    )


def counts_by_format(music: DataFrame) -> DataFrame:
    return counts_by(music, "media_format", "media_format")
