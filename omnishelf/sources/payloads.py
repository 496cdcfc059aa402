"""Flatten landed API payloads into raw tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions import first_nonblank
from omnishelf.operators.dedupe import reduce_for_join
from omnishelf.sources.schemas import FAN_ITEM, LANDED

# The features that the service names.
AUDIO_FEATURES = [
    "danceability", "energy", "valence", "tempo",
    "acousticness", "instrumentalness", "liveness", "speechiness",
]


def _stamp(run_at: datetime | str) -> Column:
    """One instant for all rows of a run; an argument, so a retried task writes the same value."""
    return F.lit(run_at).cast("timestamp")


def _json_list(values: Column | str) -> Column:
    return F.to_json(F.coalesce(values, F.array().cast("array<string>")))


def _names(artists: str) -> Column:
    return F.array_join(F.transform(artists, lambda a: a["name"]), ", ")


def _ids(artists: str) -> Column:
    return F.to_json(F.transform(artists, lambda a: a["id"]))


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of a raw table, in order and typed."""
    return df.to(df.sparkSession.createDataFrame([], LANDED[table]).schema)


def flatten_saved_albums(pages: DataFrame, run_at) -> DataFrame:
    rows = pages.select(F.explode("items").alias("i"))
    flat = rows.select(
        F.col("i.album.id").alias("album_id"),
        F.col("i.album.name").alias("name"),
        _names("i.album.artists").alias("artists"),
        _ids("i.album.artists").alias("artist_ids"),
        "i.album.release_date",
        "i.album.release_date_precision",
        _json_list("i.album.genres").alias("genres"),
        "i.album.total_tracks",
        F.col("i.added_at").try_cast("timestamp").alias("added_at"),
        _stamp(run_at).alias("_extracted_at"),
    )
    return conform(flat, "spotify_saved_albums")


def flatten_saved_tracks(pages: DataFrame, features: DataFrame, run_at) -> DataFrame:
    """Track rows with their audio features; local files have no id and are left out."""
    rows = pages.select(F.explode("items").alias("i")).filter(F.col("i.track.id").isNotNull())
    tracks = rows.select(
        F.col("i.track.id").alias("track_id"),
        F.col("i.track.name").alias("name"),
        _names("i.track.artists").alias("artists"),
        _ids("i.track.artists").alias("artist_ids"),
        F.col("i.track.album.id").alias("album_id"),
        F.col("i.track.album.name").alias("album_name"),
        "i.track.duration_ms",
        F.coalesce("i.track.explicit", F.lit(False)).alias("explicit"),
        "i.track.popularity",
        F.col("i.added_at").try_cast("timestamp").alias("added_at"),
    )
    # The service answers a repeated id with the same features; one row per id keeps the join 1:1.
    one = F.max(F.struct(*AUDIO_FEATURES))
    by_id = reduce_for_join(features.filter("id IS NOT NULL"), {"_id": "id"}, {"f": one})
    flat = tracks.join(by_id, F.col("track_id") == F.col("_id"), "left").select(
        *tracks.columns,
        *[F.col(f"f.{c}").alias(c) for c in AUDIO_FEATURES],
        _stamp(run_at).alias("_extracted_at"),
    )
    return conform(flat, "spotify_saved_tracks")


def flatten_followed_artists(pages: DataFrame, run_at) -> DataFrame:
    rows = pages.select(F.explode("artists.items").alias("a"))
    flat = rows.select(
        F.col("a.id").alias("artist_id"),
        "a.name",
        _json_list("a.genres").alias("genres"),
        "a.popularity",
        F.col("a.followers.total").alias("followers"),
        _stamp(run_at).alias("_extracted_at"),
    )
    return conform(flat, "spotify_followed_artists")


def _media(kind: str) -> dict[str, Column]:
    """The fields shared by everything the watch tracker returns about a movie or a show."""
    return {
        "slug": F.col(f"{kind}.ids.slug"),
        "imdb_id": F.col(f"{kind}.ids.imdb"),
        "tmdb_id": F.col(f"{kind}.ids.tmdb"),
        "title": F.col(f"{kind}.title"),
        "release_year": F.col(f"{kind}.year"),
        "genres": _json_list(f"{kind}.genres"),
        "runtime_minutes": F.col(f"{kind}.runtime"),
        "country": F.col(f"{kind}.country"),
    }


def _flatten_watched(items: DataFrame, kind: str, extra: dict[str, Column], run_at) -> DataFrame:
    columns = {
        f"trakt_{kind}_id": F.col(f"{kind}.ids.trakt"),
        "plays": F.col("plays"),
        "last_watched_at": F.col("last_watched_at").try_cast("timestamp"),
        "last_updated_at": F.col("last_updated_at").try_cast("timestamp"),
        **_media(kind),
        **extra,
        "_extracted_at": _stamp(run_at),
    }
    flat = items.select(*[c.alias(name) for name, c in columns.items()])
    return conform(flat, f"trakt_watched_{kind}s")


def flatten_watched_movies(items: DataFrame, run_at) -> DataFrame:
    return _flatten_watched(items, "movie", {}, run_at)


def flatten_watched_shows(items: DataFrame, run_at) -> DataFrame:
    extra = {"status": F.col("show.status"), "network": F.col("show.network")}
    return _flatten_watched(items, "show", extra, run_at)


def flatten_ratings(movies: DataFrame, shows: DataFrame, run_at) -> DataFrame:
    """Ratings of both media types; 10-point ratings are halved to the common 5-point scale."""

    def one_type(items: DataFrame, kind: str) -> DataFrame:
        columns = {
            "media_type": F.lit(kind),
            "trakt_id": F.col(f"{kind}.ids.trakt"),
            "rating_raw": F.col("rating"),
            "rating": F.col("rating") / F.lit(2.0),
            "rated_at": F.col("rated_at").try_cast("timestamp"),
            **_media(kind),
            "_extracted_at": _stamp(run_at),
        }
        return items.select(*[c.alias(name) for name, c in columns.items()])

    both = one_type(movies, "movie").unionByName(one_type(shows, "show"))
    return conform(both, "trakt_ratings")


def canonical_json(text: Column | str) -> Column:
    """The document without blanks, keys of all its objects in order, so equal documents give equal
    text. What is no JSON, or names a key twice, stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def flatten_fan_items(pages: DataFrame, run_at) -> DataFrame:
    """Collection or wishlist items. The service renames fields without notice, hence the
    alternatives and the kept JSON text, in canonical form."""
    items = pages.select(F.explode("items").alias("raw_json"))
    parsed = items.withColumn("i", F.from_json("raw_json", FAN_ITEM))
    flat = parsed.select(
        "i.item_id",
        "i.item_type",
        "i.tralbum_id",
        "i.tralbum_type",
        first_nonblank("i.album_title", "i.item_title", "i.title").alias("title"),
        first_nonblank("i.band_name", "i.artist", "i.selling_band_name").alias("artist"),
        "i.item_url",
        "i.art_url",
        "i.token",
        first_nonblank("i.added_at", "i.added", "i.purchased", "i.wishlisted").alias("added_at"),
        canonical_json("raw_json").alias("raw_json"),
        _stamp(run_at).alias("_extracted_at"),
    )
    return conform(flat, "bandcamp_collection")
