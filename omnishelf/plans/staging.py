"""Staging: one function per raw table. Rename, type, key, deduplicate; no joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions import (
    blank_to_null,
    key_text,
    safe_date,
    safe_double,
    safe_long,
    safe_timestamp,
    strip_sheet_quotes,
    surrogate_key,
    uni_trim,
    whole_number,
)
from omnishelf.operators import keep_latest
from omnishelf.sources.payloads import AUDIO_FEATURES


def _added_order(raw: str = "_added") -> list[Column]:
    """Latest first by date where the text is one, then by the text itself."""
    return [F.coalesce(safe_timestamp(raw), safe_date(raw).cast("timestamp")), F.col(raw)]


def _keyed(df: DataFrame, name: str, *fields: str) -> DataFrame:
    return df.select(surrogate_key(*fields).alias(name), "*")


def _latest_by_key(
    df: DataFrame, name: str, fields: list[str], latest: list[str | Column], ties: list[str]
) -> DataFrame:
    """The latest row of each id, ``_keyed`` by it.

    The rows are sorted and shuffled by the text under the id, and only those that stay get its
    digest: digests do not compress and put rows in random order, while by the text rows of like
    fields lie together and take far less room on disk.
    """
    return _keyed(keep_latest(df, [key_text(*fields)], latest, ties), name, *fields)


def stage_goodreads(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("Book Id").cast("string").alias("book_id"),
        F.lit("goodreads").alias("source_name"),
        uni_trim("Title").alias("title"),
        uni_trim("Author").alias("author"),
        whole_number("Year Published").alias("year_published"),
        uni_trim("Publisher").alias("publisher"),
        F.nullif(strip_sheet_quotes("ISBN"), F.lit("")).alias("isbn"),
        whole_number("My Rating").alias("rating"),
    )


def stage_bookbuddy(raw: DataFrame) -> DataFrame:
    """Editions of one title differ by ISBN; a repeated entry keeps its latest row."""
    typed = raw.select(
        F.col("Date Added").alias("_added"),
        uni_trim("Title").alias("title"),
        uni_trim("Author").alias("author"),
        blank_to_null("Genre").alias("genre"),
        blank_to_null("Category").alias("category"),
        uni_trim("Status").alias("status"),
        safe_double("Rating").alias("rating"),
        blank_to_null("ISBN").alias("isbn"),
        blank_to_null("Tags").alias("tags"),
    )
    ties = ["genre", "category", "status", "rating", "tags"]
    fields = ["title", "author", "isbn"]
    return _latest_by_key(typed, "book_id", fields, _added_order(), ties).drop("_added")


def stage_letterboxd(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        safe_date("Date").alias("watched_date"),
        uni_trim("Name").alias("film_name"),
        safe_long("Year").alias("release_year"),
        uni_trim("Letterboxd URI").alias("letterboxd_uri"),
        safe_double("Rating").alias("rating"),
    )
    return _keyed(typed, "movie_id", "watched_date", "film_name")


def stage_moviebuddy(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        uni_trim("Title").alias("title"),
        uni_trim("Content Type").alias("content_type"),
        safe_long("Release Year").alias("release_year"),
        safe_double("Rating").alias("rating"),
        blank_to_null("Directors").alias("directors"),
        blank_to_null("Genres").alias("genres"),
        safe_long("Runtime").alias("runtime_minutes"),
        safe_long("TMDB ID").alias("tmdb_id"),
    )
    return _keyed(typed, "movie_id", "title", "release_year")


def stage_musicbuddy(raw: DataFrame) -> DataFrame:
    """Releases of one album differ by catalogue id; a repeated entry keeps its latest row."""
    typed = raw.select(
        F.col("Date Added").alias("_added"),
        uni_trim("Title").alias("title"),
        uni_trim("Artist").alias("artist"),
        blank_to_null("Genres").alias("genres"),
        safe_long("Release Year").alias("release_year"),
        safe_long("discogs Release ID").alias("discogs_release_id"),
        safe_double("Rating").alias("rating"),
    )
    ties = ["genres", "release_year", "rating"]
    fields = ["title", "artist", "discogs_release_id"]
    return _latest_by_key(typed, "album_id", fields, _added_order(), ties).drop("_added")


def stage_bandcamp(raw: DataFrame) -> DataFrame:
    """Collection and wishlist share one shape."""
    text = ["item_type", "tralbum_type", "item_url", "art_url", "token", "added_at", "raw_json"]
    typed = raw.select(
        *[F.col(c).cast("string").alias(c) for c in text],
        F.col("item_id").try_cast("bigint").alias("item_id"),
        F.col("tralbum_id").try_cast("bigint").alias("tralbum_id"),
        blank_to_null("title").alias("title"),
        blank_to_null("artist").alias("artist"),
        safe_timestamp("_extracted_at").alias("_extracted_at"),
    )
    ties = ["item_id", "tralbum_id", *[c for c in text if c != "item_url"]]
    fields = ["title", "artist", "item_url"]
    return _latest_by_key(typed, "album_id", fields, ["_extracted_at"], ties)


def stage_saved_albums(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("album_id").cast("string").alias("album_id"),
        F.col("name").alias("album_name"),
        "artists",
        "artist_ids",
        "release_date",
        "release_date_precision",
        "genres",
        "added_at",
        "_extracted_at",
        F.col("total_tracks").try_cast("bigint").alias("total_tracks"),
    )


def stage_saved_tracks(raw: DataFrame) -> DataFrame:
    return raw.select(
        "track_id",
        F.col("name").alias("track_name"),
        "artists",
        "artist_ids",
        "album_id",
        "album_name",
        "duration_ms",
        "explicit",
        "added_at",
        "_extracted_at",
        F.col("popularity").try_cast("bigint").alias("popularity"),
        *[F.col(c).try_cast("double").alias(c) for c in AUDIO_FEATURES],
    )


def stage_followed_artists(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("artist_id").cast("string").alias("artist_id"),
        F.col("name").alias("artist_name"),
        "genres",
        "_extracted_at",
        F.col("popularity").try_cast("bigint").alias("popularity"),
        F.col("followers").try_cast("bigint").alias("followers"),
    )


def _watched_columns(kind: str) -> list[Column | str]:
    return [
        F.col(f"trakt_{kind}_id").try_cast("bigint").alias(f"trakt_{kind}_id"),
        F.col("tmdb_id").try_cast("bigint").alias("tmdb_id"),
        uni_trim("title").alias("title"),
        F.col("release_year").try_cast("bigint").alias("release_year"),
        F.col("plays").try_cast("bigint").alias("watch_count"),
        safe_timestamp("last_watched_at").alias("last_watched_at"),
        safe_timestamp("last_updated_at").alias("last_updated_at"),
        F.col("runtime_minutes").try_cast("bigint").alias("runtime_minutes"),
        safe_timestamp("_extracted_at").alias("_extracted_at"),
    ]


def stage_watched_movies(raw: DataFrame) -> DataFrame:
    text = ["slug", "imdb_id", "genres", "country"]
    typed = raw.select(*text, *_watched_columns("movie"))
    return _keyed(typed, "movie_id", "title", "release_year")


def stage_watched_shows(raw: DataFrame) -> DataFrame:
    text = ["slug", "imdb_id", "genres", "status", "network", "country"]
    typed = raw.select(*text, *_watched_columns("show"))
    return _keyed(typed, "show_id", "title", "release_year")


def stage_ratings(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        *["media_type", "slug", "imdb_id", "genres", "country"],
        F.col("trakt_id").try_cast("bigint").alias("trakt_id"),
        F.col("tmdb_id").try_cast("bigint").alias("tmdb_id"),
        uni_trim("title").alias("title"),
        F.col("release_year").try_cast("bigint").alias("release_year"),
        F.col("rating_raw").try_cast("bigint").alias("rating_raw"),
        F.col("rating").try_cast("double").alias("rating"),
        safe_timestamp("rated_at").alias("rated_at"),
        F.col("runtime_minutes").try_cast("bigint").alias("runtime_minutes"),
        safe_timestamp("_extracted_at").alias("_extracted_at"),
    )
    return _keyed(typed, "rating_id", "media_type", "title", "release_year")


STAGES = {
    "goodreads": stage_goodreads,
    "bookbuddy": stage_bookbuddy,
    "letterboxd": stage_letterboxd,
    "moviebuddy": stage_moviebuddy,
    "musicbuddy": stage_musicbuddy,
    "bandcamp_collection": stage_bandcamp,
    "bandcamp_wishlist": stage_bandcamp,
    "spotify_saved_albums": stage_saved_albums,
    "spotify_saved_tracks": stage_saved_tracks,
    "spotify_followed_artists": stage_followed_artists,
    "trakt_watched_movies": stage_watched_movies,
    "trakt_watched_shows": stage_watched_shows,
    "trakt_ratings": stage_ratings,
}
