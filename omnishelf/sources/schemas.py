"""Declared schemas of every input. Nothing is inferred, so no extra scan and no guessed types."""

from __future__ import annotations

from pyspark.sql import types as T


def text_columns(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# The column names of the CSV exports. All are read as text and cast in staging.
CSV_EXPORTS: dict[str, T.StructType] = {
    "goodreads": text_columns(
        "Book Id", "Title", "Author", "Author l-f", "Additional Authors", "ISBN", "ISBN13",
        "My Rating", "Average Rating", "Publisher", "Binding", "Number of Pages",
        "Year Published", "Original Publication Year", "Date Read", "Date Added", "Bookshelves",
        "Bookshelves with positions", "Exclusive Shelf", "My Review", "Spoiler", "Private Notes",
        "Read Count", "Owned Copies",
    ),
    "bookbuddy": text_columns(
        "Date Added", "Title", "Author", "Genre", "Category", "Status", "Rating", "ISBN", "Tags"
    ),
    "letterboxd": text_columns("Date", "Name", "Year", "Letterboxd URI", "Rating"),
    "moviebuddy": text_columns(
        "Title", "Content Type", "Release Year", "Rating", "Directors", "Genres", "Runtime",
        "TMDB ID",
    ),
    "musicbuddy": text_columns(
        "Date Added", "Title", "Artist", "Genres", "Release Year", "discogs Release ID", "Rating"
    ),
}

# The columns of the tables that the flatten jobs write.
LANDED: dict[str, str] = {
    "spotify_saved_albums": (
        "album_id string, name string, artists string, artist_ids string, release_date string, "
        "release_date_precision string, genres string, total_tracks long, added_at timestamp, "
        "_extracted_at timestamp"
    ),
    "spotify_saved_tracks": (
        "track_id string, name string, artists string, artist_ids string, album_id string, "
        "album_name string, duration_ms long, explicit boolean, popularity long, "
        "added_at timestamp, danceability double, energy double, valence double, tempo double, "
        "acousticness double, instrumentalness double, liveness double, speechiness double, "
        "_extracted_at timestamp"
    ),
    "spotify_followed_artists": (
        "artist_id string, name string, genres string, popularity long, followers long, "
        "_extracted_at timestamp"
    ),
    "trakt_watched_movies": (
        "trakt_movie_id long, slug string, imdb_id string, tmdb_id long, title string, "
        "release_year long, plays long, last_watched_at timestamp, last_updated_at timestamp, "
        "genres string, runtime_minutes long, country string, _extracted_at timestamp"
    ),
    "trakt_watched_shows": (
        "trakt_show_id long, slug string, imdb_id string, tmdb_id long, title string, "
        "release_year long, plays long, last_watched_at timestamp, last_updated_at timestamp, "
        "genres string, runtime_minutes long, status string, network string, country string, "
        "_extracted_at timestamp"
    ),
    "trakt_ratings": (
        "media_type string, trakt_id long, slug string, imdb_id string, tmdb_id long, "
        "title string, release_year long, rating_raw long, rating double, rated_at timestamp, "
        "genres string, runtime_minutes long, country string, _extracted_at timestamp"
    ),
    "bandcamp_collection": (
        "item_id long, item_type string, tralbum_id long, tralbum_type string, title string, "
        "artist string, item_url string, art_url string, token string, added_at string, "
        "raw_json string, _extracted_at timestamp"
    ),
}
LANDED["bandcamp_wishlist"] = LANDED["bandcamp_collection"]

LOOKUPS: dict[str, str] = {
    "author_countries": "author string, country string",
    "manga_author_countries": "author string, country string",
    "director_countries": "director string, country string",
    "anime_director_countries": "director string, country string",
    "artist_countries": "artist string, country string",
    "film_countries": "title string, release_year long, country string",
    "country_iso_codes": "country_name string, iso_alpha3 string",
    "genre_mapping": "domain string, raw_genre string, normalized_genre string",
    "author_name_mapping": "raw_name string, canonical_name string",
    "country_name_fr": "country_en string, country_fr string",
    "manual_ratings": (
        "domain string, title string, author_or_director_or_artist string, rating double, "
        "rated_at date"
    ),
}

# Shapes of the API payloads as they land, one page or one item per JSON document.
_ARTIST_REF = "array<struct<id: string, name: string>>"
_TRAKT_OBJECT = (
    "struct<title: string, year: long, "
    "ids: struct<trakt: long, slug: string, imdb: string, tmdb: long>, "
    "genres: array<string>, runtime: long, country: string, status: string, network: string>"
)
PAYLOADS: dict[str, str] = {
    "saved_albums": (
        "items array<struct<added_at: string, album: struct<id: string, name: string, "
        f"artists: {_ARTIST_REF}, release_date: string, release_date_precision: string, "
        "genres: array<string>, total_tracks: long>>>"
    ),
    "saved_tracks": (
        "items array<struct<added_at: string, track: struct<id: string, name: string, "
        f"artists: {_ARTIST_REF}, album: struct<id: string, name: string>, duration_ms: long, "
        "explicit: boolean, popularity: long>>>"
    ),
    "audio_features": (
        "id string, danceability double, energy double, valence double, tempo double, "
        "acousticness double, instrumentalness double, liveness double, speechiness double"
    ),
    "followed_artists": (
        "artists struct<items: array<struct<id: string, name: string, genres: array<string>, "
        "popularity: long, followers: struct<total: long>>>>"
    ),
    "watched_movies": (
        f"plays long, last_watched_at string, last_updated_at string, movie {_TRAKT_OBJECT}"
    ),
    "watched_shows": (
        f"plays long, last_watched_at string, last_updated_at string, show {_TRAKT_OBJECT}"
    ),
    "movie_ratings": f"rating long, rated_at string, movie {_TRAKT_OBJECT}",
    "show_ratings": f"rating long, rated_at string, show {_TRAKT_OBJECT}",
    # Items stay text: the raw JSON is kept beside the fields taken from it.
    "fan_items": "items array<string>",
}

FAN_ITEM = (
    "item_id long, item_type string, tralbum_id long, tralbum_type string, album_title string, "
    "item_title string, title string, band_name string, artist string, "
    "selling_band_name string, item_url string, art_url string, token string, "
    "added_at string, added string, purchased string, wishlisted string"
)
