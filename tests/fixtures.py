"""Hand-made inputs that hold the edge rows of every source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from omnishelf.sources.schemas import CSV_EXPORTS, LANDED, LOOKUPS

NOW = "2024-05-01 09:30:00"

BOOKBUDDY = [  # added, title, author, genre, category, status, rating, isbn, tags
    ("2024-01-01", "Dune", "Frank Herbert", "Sci-Fi", "Book", "Read", "0", "111", ""),
    ("2024-02-01", "Dune", "Frank Herbert", "Sci-Fi", "Book", "Read", "4", "111", "desert"),
    (None, "Dune", "Frank Herbert", "Sci-Fi", "Book", "Read", "1", "111", ""),
    ("2024-01-01", "\tEmma ", "Jane Austen", "In library", " ", "Read", "0", "", ""),
    ("2024-01-01", "Persuasion", "J. Austen", "Roman", "Book", "Read", "", "333", ""),
    ("2024-01-01", "PERSUASION", "Jane Austen", "Roman", "Book", "Read", "3", "", ""),
    ("2024-01-01", "Akira", "Otomo", "Seinen", "Manga", "Read", "0", "", ""),
    ("2024-01-01", "Nana", "Yazawa", "Unknown", "Manga", "Read", "5", "", ""),
    ("2024-01-01", "Unrated", "Nobody", "Sci-Fi", "Book", "Read", "0", "", ""),
]
GOODREADS = {  # id: title, author, year, publisher, isbn, rating
    "g1": ("Dune (1)", "F. Herbert", "1965", "Ace", '="111"', "5"),
    "g2": ("Dune", "Frank Herbert", "1966.0", "Ace", '="111"', "0"),
    "g3": ("emma", "JANE AUSTEN", "x", " P ", '=""', "0"),
    "g4": ("Solo", "Ann Solo", "2001", "P", "", "4.0"),
    "g5": ("Persuasion", "Jane Austen", "1817", "P", "", "0"),
}
LETTERBOXD = [  # date, name, year, uri, rating
    ("2024-01-01", "Heat", "1995", "u1", "4"),
    ("2024-03-01", "heat ", "1995", "u2", "4.5"),
    ("2024-02-30", "Heat", "1995", "u3", "1"),
    ("2023-01-01", "Diary Only", "2000", "u4", ""),
    ("2023-01-01", "Diary Tracker", "2001", "u5", "3"),
    ("2023-01-01", "Diary Owned", "2002", "u6", "2"),
    ("2023-01-01", "No Year", "", "u7", "2"),
]
MOVIEBUDDY = [  # title, type, year, rating, directors, genres, runtime, tmdb
    ("Heat", "Movie", "1995", "3", "Michael Mann, X", "Action,Crime", "170", "949"),
    ("Owned Only", "Movie", "1990", "0", "Unknown Person", "Noise", "x", ""),
    ("Owned Tracker", "Movie", "1991", "0", "", "Action, Thriller,Mystery", "90", "1"),
    ("Diary Owned", "Movie", "2002", "5", "Bong", "", "90", "1"),
    ("No Year", "Movie", "", "1", "Bong", "", "90", "1"),
    ("Cartoon", "TV Show", "2010", "0", "Ghibli Person", "Animation,Action", "20", "5"),
    ("Unknown Show", "TV Show", "2011", "2", "", "", "20", "5"),
    ("Untyped", None, "2012", "2", "", "Animation", "20", "5"),
]
WATCHED_MOVIES = [  # id, title, year, plays, last watched, genres, country
    (1, "Heat", 1995, 2, "2024-02-01 23:00:00", '["action"]', "us"),
    (2, "Tracker Only", 1980, 1, "2020-05-05 01:00:00", '["mystery","thriller","x"]', "Japan"),
    (3, "Owned Tracker", 1991, 1, None, "bad", "fr"),
    (4, "Diary Tracker", 2001, 3, "2022-01-01 00:00:00", "null", None),
]
WATCHED_SHOWS = [
    (11, "Cartoon", 2010, 4, "2024-02-01 23:00:00", '["animation"]', "Japan"),
    (12, "Anime Two", 2015, 1, None, '["Anime"]', "Japan"),
    (13, "Live Show", 2015, 1, None, '["drama"]', "us"),
]
RATINGS = [  # type, id, title, year, raw, rated at, genres, country
    ("movie", 1, "Heat", 1995, 9, "2024-01-01 00:00:00", "[]", None),
    ("movie", 1, "heat", 1995, 10, "2024-02-01 00:00:00", "[]", None),
    ("movie", 9, "Rated Only", 1970, 6, "2024-01-01 00:00:00", '["action"]', "France"),
    ("show", 14, "Rated Anime", 2016, 8, "2024-01-01 00:00:00", '["animation"]', "us"),
    ("show", 15, "Rated Drama", 2016, 8, "2024-01-01 00:00:00", '["drama"]', "us"),
]
MUSICBUDDY = [  # added, title, artist, genres, year, discogs, rating
    ("2024-01-01", "All Three", "Ayo (2)", "Folk,World", "2006", "1", "0"),
    ("2024-02-01", "All Three", "Ayo (2)", "Folk, World,Rock", "2006", "1", "4"),
    ("2024-01-01", "All Three", "Ayo (2)", "Rock", "2007", "2", "5"),
    ("2024-01-01", "Shelf Only", "Solo", "Non-Music", "1999", "3", "0"),
    ("2024-01-01", "Shelf Shop", "Duo", "", "1999", "4", ""),
    ("2024-01-01", "Shelf Stream", "Trio", "Rock", "1999", "5", "3"),
]
SHOP = {  # list: (item id, title, artist, url)
    "bandcamp_collection": [
        (1, "All Three", "Ayo", "u1"), (2, "Shop Only", "Band", "u2"), (3, "Shelf Shop", "Duo", "u3"),
        (4, "Shop Stream", "Band", "u4"),
    ],
    "bandcamp_wishlist": [(1, "all three ", "AYO", "u1"), (5, "Wish", "Band", "u5")],
}
SAVED_ALBUMS = [  # id, name, artists, artist ids, date, genres
    ("s1", "All Three", "Ayo", '["ar1"]', "2023-06", "[]"),
    ("s2", "Stream Only", "Ayo, Guest", '["ar1","ar2"]', "2023", "[]"),
    ("s3", "Shelf Stream", "Trio", "[]", "2023-06-15", '["folk"]'),
    ("s4", "Shop Stream", "Band", '["ar9"]', None, "[]"),
]
FOLLOWED = [("ar1", "Ayo", '["rock","jazz"]'), ("ar2", "Guest", "[]")]

LOOKUP_ROWS = {
    "author_countries": [
        ("Frank Herbert", "United States"), ("jane austen", "England"), ("Ann Solo", "Atlantis"),
    ],
    "manga_author_countries": [("Otomo", "Japan")],
    "director_countries": [
        ("Michael Mann", "United States"), ("Bong", "Atlantis"),
    ],
    "anime_director_countries": [("ghibli person", "Atlantis")],
    "artist_countries": [("Ayo", "Germany"), ("Band", "France")],
    "film_countries": [("Diary Only", 2000, "France"), ("Diary Owned", 2002, "France")],
    "country_iso_codes": [
        ("United States", "USA"), ("Japan", "JPN"), ("France", "FRA"), ("Germany", "DEU"),
        ("England", "GBR"),
    ],
    "genre_mapping": [
        ("books", "sci-fi", "SF"), ("books", "In library", None), ("books", "Roman", "Roman"),
        ("manga", "Seinen", "Seinen"), ("movies", "Action", "Action"),
        ("movies", "Thriller", "Suspense"), ("movies", "Mystery", "Suspense"),
        ("movies", "Animation", "Animation"), ("music", "Folk", "Folk et monde"),
        ("music", "World", "Folk et monde"), ("music", "Rock", "Rock"), ("music", "Non-Music", None),
    ],
    "author_name_mapping": [("J. Austen", "Jane Austen")],
    "country_name_fr": [
        ("United States", "États-Unis"), ("Japan", "Japon"), ("France", "France"),
        ("Germany", "Allemagne"), ("England", "Angleterre"),
    ],
    "manual_ratings": [
        ("books", "emma", "jane austen", 3.5, "2024-01-01"),
        ("books", "Unrated", "Nobody", 2.5, "2024-01-01"),
        ("manga", "Akira", "Otomo", 4.5, "2024-01-01"),
        ("movies", "Owned Only", "unknown person", 1.5, "2024-01-01"),
        ("movies", "Tracker Only", None, 2.0, "2024-01-01"),
        ("music", "Shelf Only", "Solo", 3.0, "2024-01-01"),
        ("anime", "Cartoon", "Ghibli Person", 4.0, "2024-02-01"),
        ("anime", "Cartoon", "Somebody Else", 1.0, "2024-01-01"),
        ("books", "Wish", "Band", 1.0, "2024-01-01"),
    ],
}


def _frame(spark: SparkSession, rows: list[dict], schema) -> DataFrame:
    """Rows given by column name; columns without a value are NULL."""
    target = spark.createDataFrame([], schema).schema
    text = ", ".join(f"`{f.name}` string" for f in target)
    data = [
        tuple(None if r.get(f.name) is None else str(r[f.name]) for f in target) for r in rows
    ]
    df = spark.createDataFrame(data, text)
    return df.select(*[df[f"`{f.name}`"].try_cast(f.dataType).alias(f.name) for f in target])


def _named(names: str, rows) -> list[dict]:
    return [dict(zip(names.split("|"), row)) for row in rows]


def raw_sources(spark: SparkSession, order=lambda rows: rows) -> dict[str, DataFrame]:
    goodreads = [(i, *row) for i, row in GOODREADS.items()]
    exports = {
        "bookbuddy": _named("Date Added|Title|Author|Genre|Category|Status|Rating|ISBN|Tags", BOOKBUDDY),
        "goodreads": _named(
            "Book Id|Title|Author|Year Published|Publisher|ISBN|My Rating", goodreads
        ),
        "letterboxd": _named("Date|Name|Year|Letterboxd URI|Rating", LETTERBOXD),
        "moviebuddy": _named(
            "Title|Content Type|Release Year|Rating|Directors|Genres|Runtime|TMDB ID", MOVIEBUDDY
        ),
        "musicbuddy": _named(
            "Date Added|Title|Artist|Genres|Release Year|discogs Release ID|Rating", MUSICBUDDY
        ),
    }
    stamp = {"_extracted_at": NOW}
    landed = {
        "trakt_watched_movies": _named(
            "trakt_movie_id|title|release_year|plays|last_watched_at|genres|country", WATCHED_MOVIES
        ),
        "trakt_watched_shows": _named(
            "trakt_show_id|title|release_year|plays|last_watched_at|genres|country", WATCHED_SHOWS
        ),
        "trakt_ratings": [
            {**r, "rating": r["rating_raw"] / 2}
            for r in _named(
                "media_type|trakt_id|title|release_year|rating_raw|rated_at|genres|country", RATINGS
            )
        ],
        **{n: _named("item_id|title|artist|item_url", items) for n, items in SHOP.items()},
        "spotify_saved_albums": _named(
            "album_id|name|artists|artist_ids|release_date|genres", SAVED_ALBUMS
        ),
        "spotify_saved_tracks": [
            {"track_id": "t", "name": "T", "artists": "A", "added_at": NOW, "energy": "0.5"}
        ],
        "spotify_followed_artists": _named("artist_id|name|genres", FOLLOWED),
    }
    for album in landed["spotify_saved_albums"]:
        album["added_at"] = NOW
    frames = {n: _frame(spark, order(r), CSV_EXPORTS[n]) for n, r in exports.items()}
    for name, items in landed.items():
        frames[name] = _frame(spark, order([{**r, **stamp} for r in items]), LANDED[name])
    return frames


def lookups(spark: SparkSession) -> dict[str, DataFrame]:
    frames = {}
    for name, ddl in LOOKUPS.items():
        target = spark.createDataFrame([], ddl).schema
        frames[name] = _frame(spark, _named("|".join(target.names), LOOKUP_ROWS[name]), ddl)
    return frames
