"""Albums: a record-shelf app, a music shop account and a streaming library on (title, artist)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions import (
    first_token,
    json_first,
    label_from_flags,
    norm_key,
    packed_id,
    safe_long,
    split_csv,
    split_json,
    strip_number_suffix,
    surrogate_key,
    unpacked_id,
    zero_to_null,
)
from omnishelf.operators import (
    attach,
    attach_creator_country,
    label_texts,
    map_tokens,
    reduce_for_join,
    rollup_sources,
)
from omnishelf.plans.enrich import Lookups, attach_manual_rating, genre_labels, translate_country

# Which source describes an album best; formats and shop lists in label order.
SOURCE_RANK = {"musicbuddy": 1, "bandcamp": 2, "spotify": 3}
FORMATS = ["cd", "digital"]
SHOP_LISTS = ["collection", "wishlist"]

MUSIC_COLUMNS = [
    "album_id", "title", "artist", "artist_display", "genres", "release_year",
    "discogs_release_id", "spotify_album_id", "total_tracks", "spotify_added_at",
    "bandcamp_item_id", "bandcamp_item_url", "bandcamp_added_at", "bandcamp_origin", "rating",
    "country", "source_name", "match_type", "media_format", "country_source",
]


def _tag(source: str, media_format: str) -> dict[str, Column]:
    return {
        "source_name": F.lit(source),
        "source_rank": F.lit(SOURCE_RANK[source]),
        "media_format": F.lit(media_format),
    }


def shelf_rows(musicbuddy: DataFrame) -> DataFrame:
    """Genres stay the raw text here, as ``shelf_genres``: see ``unify_music``."""
    return musicbuddy.withColumnsRenamed(
        {"genres": "shelf_genres", "album_id": "source_album_id"}
    ).withColumns(
        {
            "title_key": norm_key("title"),
            "artist_key": norm_key(strip_number_suffix("artist")),
            **_tag("musicbuddy", "cd"),
        }
    )


def shop_rows(collection: DataFrame, wishlist: DataFrame) -> DataFrame:
    tagged = [
        df.withColumn("bandcamp_origin", F.lit(origin))
        for origin, df in (("collection", collection), ("wishlist", wishlist))
    ]
    rows = tagged[0].unionByName(tagged[1])
    return rows.select(
        F.col("album_id").alias("source_album_id"),
        "title",
        "artist",
        norm_key("title").alias("title_key"),
        norm_key("artist").alias("artist_key"),
        F.col("item_id").alias("bandcamp_item_id"),
        F.col("item_url").alias("bandcamp_item_url"),
        F.col("added_at").alias("bandcamp_added_at"),
        "bandcamp_origin",
        *[c.alias(name) for name, c in _tag("bandcamp", "digital").items()],
    )


def streaming_rows(
    albums: DataFrame, followed: DataFrame, labels: DataFrame, **how
) -> DataFrame:
    """Saved albums rarely carry genres; those of the first artist stand in when followed."""
    artists = reduce_for_join(
        followed.filter("artist_id IS NOT NULL"),
        {"_artist_id": "artist_id"},
        {"_artist_genres": F.max("genres")},
    )
    keyed = albums.withColumn("_first_artist", json_first("artist_ids"))
    # Albums without an artist id have nothing to look up and stay out of the shuffle.
    known = keyed.filter("_first_artist IS NOT NULL").join(
        artists, F.col("_first_artist") == F.col("_artist_id"), "left"
    )
    unknown = keyed.filter("_first_artist IS NULL")
    rows = known.unionByName(unknown, allowMissingColumns=True).select(
        surrogate_key("album_name", "artists").alias("source_album_id"),
        F.col("album_name").alias("title"),
        F.col("artists").alias("artist"),
        norm_key("album_name").alias("title_key"),
        norm_key("artists").alias("artist_key"),
        safe_long(first_token("release_date", "-")).alias("release_year"),
        F.col("album_id").alias("spotify_album_id"),
        "total_tracks",
        F.col("added_at").alias("spotify_added_at"),
        F.coalesce(F.nullif("genres", F.lit("[]")), "_artist_genres").alias("_raw"),
        *[c.alias(name) for name, c in _tag("spotify", "digital").items()],
    )
    return map_tokens(
        rows, split_json("_raw"), labels, "genres", ["source_album_id"], **how
    ).drop("_raw")


def _described(albums: DataFrame) -> DataFrame:
    """The artist of an album as shown and as looked up for the country, by the describing source."""

    def best(source: str) -> Column:
        return F.col("source_rank") == SOURCE_RANK[source]

    return albums.withColumns(
        {
            "artist_display": F.when(best("musicbuddy"), strip_number_suffix("artist")).otherwise(
                F.col("artist")
            ),
            "country_key": F.when(best("spotify"), norm_key(first_token("artist"))).otherwise(
                F.col("artist_key")
            ),
        }
    )


def unify_music(
    musicbuddy: DataFrame,
    bandcamp_collection: DataFrame,
    bandcamp_wishlist: DataFrame,
    saved_albums: DataFrame,
    followed_artists: DataFrame,
    lookups: Lookups,
    strict_reference: bool = False,
) -> DataFrame:
    """One row per album: the best source describes it, all sources add ids and formats.

    ``musicbuddy`` has one row per ``album_id``, as staging leaves it, so the labels of a row are
    those of its own text. Texts are labelled once each, and only the rows that describe an album
    take their labels.
    """
    labels = genre_labels(lookups, "music")
    how = {"distinct": not strict_reference}
    parts = [
        shelf_rows(musicbuddy),
        shop_rows(bandcamp_collection, bandcamp_wishlist),
        streaming_rows(saved_albums, followed_artists, labels, **how),
    ]
    # Sources hold many rows of an album in many tasks, so most rows go through the shuffle of the
    # roll-up: ids as half their text, and without what the chosen row tells as well.
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).withColumn(
        "source_album_id", packed_id("source_album_id")
    )

    ids = [
        "discogs_release_id", "spotify_album_id", "total_tracks", "spotify_added_at",
        "bandcamp_item_id", "bandcamp_item_url", "bandcamp_added_at",
    ]
    # Sources, formats and shop lists are closed sets: one flag each keeps the aggregation on plain
    # columns, without collecting values.
    members = {"source_name": SOURCE_RANK, "media_format": FORMATS, "bandcamp_origin": SHOP_LISTS}
    flags = {
        f"{column}={value}": F.bool_or(F.col(column) == value)
        for column, values in members.items()
        for value in values
    }

    def present(column: str) -> dict[str, Column]:
        return {value: F.col(f"`{column}={value}`") for value in members[column]}

    albums = rollup_sources(
        rows,
        ["title_key", "artist_key"],
        prefer=["source_rank", "source_album_id"],
        carry=[
            "source_rank", "source_album_id", "title", "artist", "genres", "release_year", "rating",
            "shelf_genres",
        ],
        aggregates={
            **{c: F.max(c) for c in ids},
            **flags,
        },
    )
    albums = _described(albums)
    texts = label_texts(musicbuddy.select("genres"), split_csv, labels, **how)
    labelled = attach(albums, texts, {"text": "shelf_genres"}, {"_shelf_labels": "label"})
    located = attach_creator_country(
        labelled, lookups["artist_countries"], "artist", "country_key", "country_source"
    )
    translated = translate_country(located, lookups, "country_source", "_label")
    rated = attach_manual_rating(translated, lookups, "music", "title_key", "artist_key")
    own = F.col("rating") if strict_reference else zero_to_null("rating")
    n_sources = sum((f.cast("int") for f in present("source_name").values()), F.lit(0))
    return rated.withColumns(
        {
            "album_id": unpacked_id("source_album_id"),
            "genres": F.coalesce("_shelf_labels", "genres"),
            "rating": F.coalesce(own, "manual_rating"),
            "country": F.coalesce("_label", "country_source"),
            "source_name": label_from_flags(present("source_name")),
            "media_format": label_from_flags(present("media_format"), ", "),
            "bandcamp_origin": F.nullif(
                label_from_flags(present("bandcamp_origin"), ", "), F.lit("")
            ),
            "match_type": F.when(n_sources > 1, F.lit("title_artist")),
        }
    ).select(*MUSIC_COLUMNS)
