"""Reference-data steps shared by the domains."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions import norm_key
from omnishelf.operators import attach, unique_lookup

Lookups = Mapping[str, DataFrame]


def genre_labels(lookups: Lookups, domain: str) -> DataFrame:
    """(token_key, label) of one domain; a blank label marks a token to drop."""
    rows = lookups["genre_mapping"].filter(F.col("domain") == domain)
    labels = rows.select("raw_genre", F.nullif("normalized_genre", F.lit("")).alias("label"))
    return unique_lookup(labels, {"token_key": norm_key("raw_genre")}, ["label"])


def country_labels(lookups: Lookups) -> DataFrame:
    keys = {"country_key": norm_key("country_en")}
    return unique_lookup(lookups["country_name_fr"], keys, ["country_fr"])


def translate_country(df: DataFrame, lookups: Lookups, country: str, out: str) -> DataFrame:
    """``out`` is the display label of ``country``, NULL where there is none."""
    labels = country_labels(lookups)
    return attach(df, labels, {"country_key": norm_key(country)}, {out: "country_fr"})


def manual_ratings(lookups: Lookups, domain: str, per_creator: bool = True) -> DataFrame:
    """Latest manual rating per (title, creator) of a domain, or per title alone."""
    rows = lookups["manual_ratings"].filter(F.col("domain") == domain)
    keys = {"title_key": norm_key("title")}
    if per_creator:
        keys["creator_key"] = norm_key("author_or_director_or_artist")
    return unique_lookup(rows, keys, ["rating"], prefer=[F.col("rated_at")])


def attach_manual_rating(
    df: DataFrame,
    lookups: Lookups,
    domain: str,
    title_key: Column | str,
    creator_key: Column | str,
    null_safe_creator: bool = False,
) -> DataFrame:
    return attach(
        df,
        manual_ratings(lookups, domain),
        {"title_key": title_key, "creator_key": creator_key},
        {"manual_rating": "rating"},
        null_safe=["creator_key"] if null_safe_creator else [],
    )
