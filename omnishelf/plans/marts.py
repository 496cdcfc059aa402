"""Collection tables per domain and the two cross-domain tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnishelf.functions import first_token, norm_key, uni_trim, zero_to_null
from omnishelf.operators import attach, unique_lookup
from omnishelf.plans.enrich import Lookups

Marts = Mapping[str, DataFrame]

# Domains in the order of the summary, each with its item id.
DOMAINS = {
    "books": "book_id",
    "movies": "movie_id",
    "music": "album_id",
    "manga": "manga_id",
    "anime": "anime_id",
}


def books_collection(books: DataFrame, strict_reference: bool = False) -> DataFrame:
    """The second app's rating leads; 0 means unrated in both apps. The strict setting takes the
    second app's 0 for a rating."""
    second = F.col("goodreads_rating").cast("double")
    if not strict_reference:
        second = zero_to_null(second)
    rating = F.coalesce(second, zero_to_null("rating"))
    source = (
        F.when(F.col("match_type").isNotNull(), "bookbuddy_and_goodreads")
        .when(F.col("goodreads_id").isNotNull(), "goodreads")
        .otherwise("bookbuddy")
    )
    return books.select(
        *["book_id", "title", "author", "genre", "category", "year_published", "publisher"],
        *["isbn", "tags", "country", "goodreads_id"],
        rating.alias("rating"),
        source.alias("source"),
        rating.isNotNull().alias("is_rated"),
        "country_source",
    )


def movies_collection(movies: DataFrame) -> DataFrame:
    return movies.select(
        *["movie_id", "title", "content_type", "release_year", "first_watched_date"],
        *["last_watched_date", "rating", "directors", "genres", "runtime_minutes", "tmdb_id"],
        *["letterboxd_uri", "country", "source"],
        F.col("first_watched_date").isNotNull().alias("is_watched"),
        F.col("rating").isNotNull().alias("is_rated"),
        "country_source",
    )


def music_collection(music: DataFrame) -> DataFrame:
    rating = zero_to_null("rating")
    return music.select(
        *["album_id", "title"],
        F.col("artist_display").alias("artist"),
        *["genres", "release_year", "discogs_release_id", "spotify_album_id", "total_tracks"],
        *["spotify_added_at", "bandcamp_item_id", "bandcamp_item_url", "bandcamp_added_at"],
        *["bandcamp_origin", "country", "source_name", "media_format"],
        rating.alias("rating"),
        rating.isNotNull().alias("is_rated"),
        "country_source",
    )


def manga_collection(manga: DataFrame) -> DataFrame:
    return manga.select(
        *["manga_id", "title", "author", "genre", "category", "rating", "isbn", "tags"],
        *["country", "source"],
        F.col("rating").isNotNull().alias("is_rated"),
        "country_source",
    )


def anime_collection(anime: DataFrame) -> DataFrame:
    """First watch dates are unknown for shows, so the last one tells whether it was watched."""
    return anime.select(
        *["anime_id", "title", "content_type", "release_year", "first_watched_date"],
        *["last_watched_date", "rating", "directors", "genres", "runtime_minutes", "tmdb_id"],
        *["country", "source"],
        F.col("last_watched_date").isNotNull().alias("is_watched"),
        F.col("rating").isNotNull().alias("is_rated"),
        "country_source",
    )


def summarise(items: DataFrame, domains: list[str], tracked: list[str]) -> DataFrame:
    """One row per domain from (domain, is_consumed, rating, country).

    Domains outside ``tracked`` do not track consumption: their two counts are NULL.
    A domain without items still gives a row of zeros.
    """
    consumed = F.col("is_consumed")
    counts = items.groupBy("domain").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(consumed).alias("consumed"),
        F.count_if(~consumed).alias("pending"),
        F.count("rating").alias("items_rated"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
        F.count("country").alias("items_with_country"),
    )
    return expect_domains(counts, items.sparkSession, domains, tracked)


def expect_domains(
    counts: DataFrame, spark, domains: list[str], tracked: list[str]
) -> DataFrame:
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, domains))).alias("domain"))
    zero = F.lit(0)
    is_tracked = F.col("domain").isin(*tracked)
    return listed.join(counts, "domain", "left").select(
        "domain",
        F.coalesce("total_items", zero).alias("total_items"),
        F.when(is_tracked, F.coalesce("consumed", zero)).alias("items_consumed"),
        F.when(is_tracked, F.coalesce("pending", zero)).alias("items_pending"),
        F.coalesce("items_rated", zero).alias("items_rated"),
        "avg_rating",
        F.coalesce("items_with_country", zero).alias("items_with_country"),
    )


def media_summary(marts: Marts) -> DataFrame:
    """Counts per domain. Every collected book has been read; albums and manga do not say."""
    consumed = {
        "books": F.lit(True),
        "movies": F.col("is_watched"),
        "music": F.lit(None).cast("boolean"),
        "manga": F.lit(None).cast("boolean"),
        "anime": F.col("is_watched"),
    }
    parts = [
        marts[d].select(
            F.lit(d).alias("domain"), consumed[d].alias("is_consumed"), "rating", "country"
        )
        for d in DOMAINS
    ]
    items = reduce(DataFrame.unionByName, parts)
    return summarise(items, list(DOMAINS), ["books", "movies", "anime"])


def creator_column(domain: str) -> tuple[F.Column, str]:
    """The person behind an item and their role."""
    if domain in ("movies", "anime"):
        return first_token("directors"), "director"
    if domain == "music":
        return F.col("artist"), "artist"
    return F.col("author"), "author"


def country_index(marts: Marts, lookups: Lookups, strict_reference: bool = False) -> DataFrame:
    """One row per item with a known country, with its ISO code.

    The code table holds untranslated names, so the join uses ``country_source``. The strict
    setting looks the translated label up and finds only names that are alike in both languages.
    """
    parts = []
    for domain, item_id in DOMAINS.items():
        person, role = creator_column(domain)
        if role == "director":
            person = uni_trim(person)
        parts.append(
            marts[domain].filter(F.col("country").isNotNull()).select(
                "country",
                F.lit(domain).alias("domain"),
                F.col(item_id).alias("item_id"),
                F.col("title").alias("item_title"),
                person.alias("person_name"),
                F.lit(role).alias("person_role"),
                "rating",
                "country_source",
            )
        )
    spine = reduce(DataFrame.unionByName, parts)
    codes = unique_lookup(
        lookups["country_iso_codes"], {"country_key": norm_key("country_name")}, ["iso_alpha3"]
    )
    name = "country" if strict_reference else "country_source"
    coded = attach(spine, codes, {"country_key": norm_key(name)}, {"iso_alpha3": "iso_alpha3"})
    return coded.drop("country_source")
