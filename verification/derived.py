"""Media-collection inputs derived from the driver's tables.

Each raw source is one projection over a whole driver table, so it grows with that table. The text
is plain SQL that Spark and DuckDB both read; placeholders in braces name the driver's tables. It
plants what the sources are known for: spelling and white-space variants, blank fields, unparsable
numbers and dates, shared ISBNs, missing years, unmapped genres.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

from omnishelf.plans.staging import STAGES
from omnishelf.sources.sinks import shared_folder, stored

READ_OFTEN = ("bookbuddy", "goodreads")

# The film or series number i came out in this year; every fiftieth has no year.
YEAR = "CASE WHEN {i} % 50 = 0 THEN NULL ELSE 1950 + {i} % 70 END"


def year_of(number: str) -> str:
    return YEAR.replace("{i}", number)


GENRES_BY_SEGMENT = """CASE c_mktsegment
    WHEN 'BUILDING' THEN 'Action, Drama'
    WHEN 'AUTOMOBILE' THEN 'drama,Mystery ,Unheard-of'
    WHEN 'HOUSEHOLD' THEN 'Thriller,Mystery'
    WHEN 'MACHINERY' THEN CASE WHEN c_acctbal < 3000 THEN 'Comedy' ELSE 'Animation, Comedy' END
    ELSE ' ' END"""

TRACKER_GENRES = """CASE {t}
    WHEN 'ECONOMY' THEN '["action","drama"]'
    WHEN 'STANDARD' THEN '["Animation","Comedy"]'
    WHEN 'SMALL' THEN '["anime"]'
    WHEN 'MEDIUM' THEN '[]'
    WHEN 'PROMO' THEN 'not json'
    ELSE NULL END"""


def tracker_genres(column: str) -> str:
    return TRACKER_GENRES.replace("{t}", column)


# Every third part was watched in another year as well, under another spelling.
AGAIN_AT = """timestamp '2000-03-01 22:00:00'
                   + (CASE WHEN p_partkey % 2 = 0 THEN 900 ELSE -900 END) * interval '1' day"""

RAW: dict[str, str] = {
    "goodreads": """
        SELECT cast(c_custkey AS string) AS book_id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'TITLE ' || c_custkey
                    ELSE ' Title ' || c_custkey || chr(160) END AS title,
               'Writer ' || c_nationkey AS author,
               CASE WHEN c_acctbal < 0 THEN 'n/a'
                    ELSE cast(1900 + c_custkey % 120 AS string) || '.0' END AS year_published,
               ' House ' || c_nationkey AS publisher,
               CASE c_mktsegment
                    WHEN 'MACHINERY' THEN '="978N' || c_nationkey || '"'
                    WHEN 'HOUSEHOLD' THEN '=""'
                    ELSE '="978' || c_custkey || '"' END AS isbn,
               cast(c_custkey % 6 AS string) AS my_rating
        FROM {customer}
        UNION ALL
        SELECT 's' || s_suppkey, 'Essay ' || s_suppkey, 'Writer ' || s_nationkey, '19x', 'House',
               '', '4.0'
        FROM {supplier}""",
    "bookbuddy": """
        SELECT cast(cast(o_orderdate AS date) AS string) AS date_added,
               CASE o_orderstatus WHEN 'P' THEN 'TITLE ' ELSE ' Title ' END || o_custkey AS title,
               CASE o_orderstatus WHEN 'F' THEN 'W. ' ELSE 'Writer ' END || c_nationkey AS author,
               CASE WHEN o_orderpriority = '1-URGENT' THEN ' '
                    ELSE chr(9) || c_mktsegment END AS genre,
               CASE o_orderpriority WHEN '5-LOW' THEN 'Manga' WHEN '4-NOT SPECIFIED' THEN ''
                    ELSE 'Book' END AS category,
               'Read' AS status,
               cast(cast(floor(o_totalprice / 100000) AS bigint) % 6 AS string) AS rating,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN '978N' || c_nationkey
                    WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '978' || o_custkey
                    ELSE '' END AS isbn,
               CASE WHEN o_totalprice > 300000 THEN 'shelf' ELSE ' ' END AS tags
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "letterboxd": f"""
        SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a'
                    ELSE cast(cast(o_orderdate AS date) AS string) END AS watched,
               CASE o_orderstatus WHEN 'P' THEN 'FILM ' ELSE 'Film ' END || o_custkey AS name,
               cast({year_of('o_custkey')} AS string) AS year,
               ' https://films.example/' || o_orderkey AS uri,
               cast(floor(o_totalprice / 60000) / cast(2 AS double) AS string) AS rating
        FROM {{orders}}""",
    "moviebuddy": f"""
        SELECT CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'Series '
                    ELSE 'film ' END || c_custkey AS title,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'TV Show' WHEN 'FURNITURE' THEN NULL
                    ELSE 'Movie' END AS content_type,
               cast({year_of('c_custkey')} AS string) AS release_year,
               cast(c_custkey % 6 AS string) AS rating,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ''
                    ELSE 'Director ' || c_nationkey || ', Other' END AS directors,
               {GENRES_BY_SEGMENT} AS genres,
               CASE WHEN c_acctbal < 1000 THEN 'x' ELSE cast(60 + c_custkey % 90 AS string) END
                   AS runtime,
               CASE WHEN c_acctbal < 2000 THEN '' ELSE cast(c_custkey AS string) END AS tmdb_id
        FROM {{customer}}
        UNION ALL
        SELECT CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'Series '
                    ELSE 'film ' END || c_custkey,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'TV Show' WHEN 'FURNITURE' THEN NULL
                    ELSE 'Movie' END,
               cast({year_of('c_custkey')} AS string), '', 'Second ' || c_nationkey,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Animation, Drama, Mystery'
                    ELSE 'Action,Thriller' END, '', ''
        FROM {{customer}} WHERE c_custkey % 5 = 0""",
    "musicbuddy": """
        SELECT cast(cast(l_shipdate AS date) AS string) AS date_added,
               CASE l_linestatus WHEN 'F' THEN 'ALBUM ' ELSE 'Album ' END || l_partkey AS title,
               'Artist ' || p_size || CASE l_returnflag WHEN 'R' THEN ' (2)' ELSE '' END AS artist,
               CASE p_type WHEN 'ECONOMY' THEN 'Folk, World' WHEN 'SMALL' THEN 'Rock,rock,Noise'
                    WHEN 'MEDIUM' THEN '' ELSE 'Rock, Folk' END AS genres,
               cast(1960 + l_partkey % 60 AS string) AS release_year,
               CASE WHEN l_linenumber = 7 THEN 'none' ELSE cast(l_linenumber AS string) END
                   AS discogs_release_id,
               cast(cast(l_quantity AS bigint) % 6 AS string) AS rating
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "bandcamp_collection": """
        SELECT p_partkey AS item_id, 'album' AS item_type, p_partkey AS tralbum_id,
               'a' AS tralbum_type,
               CASE WHEN p_type IN ('LARGE', 'PROMO') THEN 'Solo ' ELSE ' Album ' END || p_partkey
                   AS title,
               'Artist ' || p_size AS artist,
               'https://shop.example/' || p_brand AS item_url,
               'https://shop.example/art' AS art_url, 't' || p_partkey AS token,
               '2023-01-' || lpad(cast(1 + p_size % 28 AS string), 2, '0') AS added_at,
               '[]' AS raw_json, timestamp '2024-05-01 09:30:00' AS _extracted_at
        FROM {part}
        UNION ALL
        SELECT p_partkey + 1, 'album', p_partkey + 1, 'a',
               CASE WHEN p_type IN ('LARGE', 'PROMO') THEN 'Solo ' ELSE 'Album ' END || p_partkey,
               'Artist ' || p_size, 'https://shop.example/' || p_brand,
               'https://shop.example/art2', 'u' || p_partkey, '2023-03-01', '[1]',
               CASE p_partkey % 9 WHEN 0 THEN timestamp '2024-05-02 09:30:00'
                    WHEN 3 THEN timestamp '2024-04-02 09:30:00'
                    ELSE timestamp '2024-05-01 09:30:00' END
        FROM {part} WHERE p_partkey % 3 = 0""",
    "bandcamp_wishlist": """
        SELECT p_partkey AS item_id, 'album' AS item_type, p_partkey AS tralbum_id,
               'a' AS tralbum_type,
               CASE WHEN p_type IN ('LARGE', 'SMALL') THEN 'Album ' ELSE 'Wish ' END || p_partkey
                   AS title,
               'artist ' || p_size AS artist,
               'https://shop.example/wish' AS item_url,
               'https://shop.example/art' AS art_url, 'w' || p_partkey AS token,
               '2023-02-' || lpad(cast(1 + p_size % 28 AS string), 2, '0') AS added_at,
               '[]' AS raw_json, timestamp '2024-05-01 09:30:00' AS _extracted_at
        FROM {part}
        UNION ALL
        SELECT p_partkey, 'album', p_partkey, 'a',
               CASE WHEN p_type IN ('LARGE', 'SMALL') THEN 'Album ' ELSE 'Wish ' END || p_partkey,
               'artist ' || p_size, 'https://shop.example/wish', 'https://shop.example/art',
               'v' || p_partkey, '2023-04-01', '[]',
               CASE p_partkey % 2 WHEN 0 THEN timestamp '2024-05-03 09:30:00'
                    ELSE timestamp '2024-05-01 09:30:00' END
        FROM {part} WHERE p_partkey % 3 = 1""",
    "spotify_saved_albums": """
        SELECT 'sp' || p_partkey AS album_id,
               CASE WHEN p_type IN ('STANDARD', 'LARGE') THEN 'Album ' ELSE 'Mix ' END || p_partkey
                   AS name,
               CASE WHEN p_type = 'PROMO' THEN 'Artist ' || p_size || ', Guest'
                    ELSE 'Artist ' || p_size END AS artists,
               CASE WHEN p_type = 'MEDIUM' THEN '[]'
                    ELSE '["ar' || p_size || '","x"]' END AS artist_ids,
               CASE p_type WHEN 'ECONOMY' THEN '2023' WHEN 'SMALL' THEN '2023-06'
                    WHEN 'MEDIUM' THEN NULL ELSE '2021-06-15' END AS release_date,
               'day' AS release_date_precision,
               CASE WHEN p_type = 'LARGE' THEN '["folk","world"]' ELSE '[]' END AS genres,
               timestamp '2024-01-01 00:00:00' + p_size * interval '1' day AS added_at,
               timestamp '2024-05-01 09:30:00' AS _extracted_at,
               cast(p_size AS bigint) AS total_tracks
        FROM {part}
        UNION ALL
        SELECT 'sq' || p_partkey,
               CASE WHEN p_type IN ('STANDARD', 'LARGE') THEN 'Album ' ELSE 'Mix ' END || p_partkey,
               CASE WHEN p_type = 'PROMO' THEN 'Artist ' || p_size || ', Guest'
                    ELSE 'Artist ' || p_size END,
               CASE WHEN p_type = 'MEDIUM' THEN '[]'
                    ELSE '["ar' || p_size || '","x"]' END,
               CASE p_type WHEN 'ECONOMY' THEN '2023' WHEN 'SMALL' THEN '2023-06'
                    WHEN 'MEDIUM' THEN NULL ELSE '2021-06-15' END,
               'day', '["rock","world"]', timestamp '2024-03-01 00:00:00',
               timestamp '2024-05-01 09:30:00', cast(p_size AS bigint)
        FROM {part} WHERE p_partkey % 3 = 0""",
    "spotify_saved_tracks": """
        SELECT 'tr' || l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey
                   AS track_id,
               'Track ' || l_linenumber AS name, 'Artist ' || l_suppkey AS artists,
               '["ar' || l_suppkey || '"]' AS artist_ids, 'sp' || l_partkey AS album_id,
               'Album ' || l_partkey AS album_name,
               cast(l_quantity AS bigint) * 1000 AS duration_ms, l_returnflag = 'R' AS explicit,
               cast(l_shipdate AS timestamp) AS added_at,
               timestamp '2024-05-01 09:30:00' AS _extracted_at,
               CASE WHEN l_linestatus = 'O' THEN 'x' ELSE cast(l_linenumber AS string) END
                   AS popularity,
               cast(l_discount AS string) AS danceability, cast(NULL AS string) AS energy,
               cast(l_tax AS string) AS valence, '' AS tempo, '0.5' AS acousticness,
               'n/a' AS instrumentalness, cast(l_discount AS string) AS liveness,
               cast(NULL AS string) AS speechiness
        FROM {lineitem}""",
    "spotify_followed_artists": """
        SELECT 'ar' || s_suppkey AS artist_id, 'Artist ' || s_suppkey AS name,
               CASE WHEN s_acctbal < 3000 THEN '["rock","jazz"]' ELSE '["Folk "]' END AS genres,
               timestamp '2024-05-01 09:30:00' AS _extracted_at,
               cast(s_nationkey AS string) AS popularity,
               CASE WHEN s_acctbal < 0 THEN '' ELSE cast(s_suppkey AS string) END AS followers
        FROM {supplier}""",
    "trakt_watched_movies": f"""
        SELECT p_partkey AS trakt_movie_id, 'film-' || p_partkey AS slug,
               'tt' || p_partkey AS imdb_id, p_partkey AS tmdb_id, 'Film ' || p_partkey AS title,
               {year_of('p_partkey')} AS release_year, cast(p_size AS bigint) AS plays,
               timestamp '2000-03-01 22:00:00' + p_size * interval '1' day AS last_watched_at,
               timestamp '2024-01-01 00:00:00' AS last_updated_at,
               {tracker_genres('p_type')} AS genres, 90 + p_partkey % 60 AS runtime_minutes,
               CASE WHEN p_size < 10 THEN NULL ELSE 'NATION_' || p_size % 30 END AS country,
               timestamp '2024-05-01 09:30:00' AS _extracted_at
        FROM {{part}}
        UNION ALL
        SELECT p_partkey, 'film-again-' || p_partkey, NULL, p_partkey, 'FILM ' || p_partkey,
               {year_of('p_partkey')}, cast(p_size + 100 AS bigint), {AGAIN_AT},
               timestamp '2024-01-02 00:00:00', '["mystery","action"]', 91 + p_partkey % 60,
               'NATION_' || p_size % 7, timestamp '2024-05-01 09:30:00'
        FROM {{part}} WHERE p_partkey % 3 = 0""",
    "trakt_watched_shows": f"""
        SELECT p_partkey AS trakt_show_id, 'series-' || p_partkey AS slug,
               'tt' || p_partkey AS imdb_id, p_partkey AS tmdb_id,
               'Series ' || p_partkey AS title,
               {year_of('p_partkey')} AS release_year, cast(p_size AS bigint) AS plays,
               timestamp '2001-03-01 22:00:00' + p_size * interval '1' day AS last_watched_at,
               timestamp '2024-01-01 00:00:00' AS last_updated_at,
               {tracker_genres('p_type')} AS genres, 20 + p_partkey % 20 AS runtime_minutes,
               'ended' AS status, 'Net ' || p_brand AS network,
               CASE WHEN p_size < 10 THEN NULL ELSE 'NATION_' || p_size % 30 END AS country,
               timestamp '2024-05-01 09:30:00' AS _extracted_at
        FROM {{part}}
        UNION ALL
        SELECT p_partkey, 'series-again-' || p_partkey, NULL, p_partkey, 'series ' || p_partkey,
               {year_of('p_partkey')}, cast(p_size + 100 AS bigint), {AGAIN_AT},
               timestamp '2024-01-02 00:00:00', '["anime","drama"]', 21 + p_partkey % 20, 'ended',
               'Other net', 'NATION_' || p_size % 7, timestamp '2024-05-01 09:30:00'
        FROM {{part}} WHERE p_partkey % 3 = 0""",
    # Views rate films by event, clicks rate films again and again by user, the rest rates series.
    "trakt_ratings": f"""
        SELECT CASE WHEN event_type IN ('view', 'click') THEN 'movie' ELSE 'show' END
                   AS media_type,
               n AS trakt_id, 'r-' || n AS slug, 'tt' || n AS imdb_id, n AS tmdb_id,
               CASE WHEN event_type IN ('view', 'click') THEN 'Film ' ELSE 'Series ' END || n
                   AS title,
               {year_of('n')} AS release_year,
               1 + cast(floor(value) AS bigint) % 10 AS rating_raw,
               (1 + cast(floor(value) AS bigint) % 10) / cast(2 AS double) AS rating,
               cast(ts AS timestamp) AS rated_at,
               CASE WHEN event_type = 'signup' THEN '["animation"]' ELSE '["drama"]' END AS genres,
               100 + n % 30 AS runtime_minutes, 'NATION_' || n % 30 AS country,
               timestamp '2024-05-01 09:30:00' AS _extracted_at
        FROM (SELECT *, CASE WHEN event_type IN ('view', 'signup') THEN event_id ELSE user_id END
                  AS n
              FROM {{events}}) e""",
}

LOOKUPS: dict[str, str] = {
    "author_countries": """
        SELECT CASE WHEN n_regionkey = 4 THEN 'Nobody ' ELSE 'writer ' END || n_nationkey AS author,
               n_name AS country
        FROM {nation}""",
    "manga_author_countries": """
        SELECT CASE WHEN n_regionkey = 3 THEN 'Nobody ' ELSE 'Writer ' END || n_nationkey AS author,
               n_name AS country
        FROM {nation}""",
    "director_countries": """
        SELECT CASE WHEN n_regionkey = 2 THEN 'Nobody ' ELSE 'DIRECTOR ' END || n_nationkey
                   AS director,
               n_name AS country
        FROM {nation}""",
    "anime_director_countries": """
        SELECT CASE WHEN n_regionkey = 0 THEN 'Nobody ' ELSE 'Director ' END || n_nationkey
                   AS director,
               n_name AS country
        FROM {nation}""",
    "artist_countries": """
        SELECT 'Artist ' || n_nationkey AS artist, n_name AS country FROM {nation}""",
    "film_countries": f"""
        SELECT 'film ' || s_suppkey AS title, {year_of('s_suppkey')} AS release_year,
               n_name AS country
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey""",
    "country_iso_codes": """
        SELECT n_name AS country_name, 'N' || lpad(cast(n_nationkey AS string), 2, '0')
                   AS iso_alpha3
        FROM {nation}""",
    "author_name_mapping": """
        SELECT 'W. ' || n_nationkey AS raw_name, 'Writer ' || n_nationkey AS canonical_name
        FROM {nation}""",
    "country_name_fr": """
        SELECT CASE WHEN n_regionkey = 1 THEN 'X' ELSE '' END || n_name AS country_en,
               CASE WHEN n_nationkey = 12 THEN n_name ELSE 'Pays ' || n_nationkey END AS country_fr
        FROM {nation}""",
    "genre_mapping": """
        SELECT * FROM (VALUES
            ('books', 'Building', 'Construction'), ('books', 'AUTOMOBILE', 'Voitures'),
            ('books', 'Household', NULL),
            ('manga', 'building', 'Chantier'), ('manga', 'Machinery', 'Robots'),
            ('movies', 'Action', 'Action'), ('movies', 'Drama', 'Drame'),
            ('movies', 'Thriller', 'Suspense'), ('movies', 'Mystery', 'Suspense'),
            ('movies', 'Animation', 'Animation'), ('movies', 'Anime', 'Animation'),
            ('movies', 'Comedy', ''),
            ('music', 'Folk', 'Folk et monde'), ('music', 'World', 'Folk et monde'),
            ('music', 'Rock', 'Rock')
        ) AS t(domain, raw_genre, normalized_genre)""",
    "manual_ratings": """
        SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'books' WHEN 'AUTOMOBILE' THEN 'movies'
                    WHEN 'HOUSEHOLD' THEN 'music' WHEN 'MACHINERY' THEN 'anime'
                    ELSE 'manga' END AS domain,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'title ' WHEN 'AUTOMOBILE' THEN 'Film '
                    WHEN 'HOUSEHOLD' THEN 'Album ' WHEN 'MACHINERY' THEN 'Series '
                    ELSE 'Title ' END || c_custkey AS title,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Director ' WHEN 'HOUSEHOLD' THEN 'Artist '
                    WHEN 'MACHINERY' THEN 'Director ' ELSE 'Writer ' END || c_nationkey
                   AS author_or_director_or_artist,
               c_custkey % 5 + cast(0.5 AS double) AS rating,
               date '2024-02-01' AS rated_at
        FROM {customer}
        UNION ALL
        SELECT 'anime', 'Series ' || c_custkey, 'A second creator', cast(1 AS double),
               date '2023-02-01'
        FROM {customer}
        UNION ALL
        SELECT 'movies', 'Film ' || s_suppkey, NULL, cast(2 AS double), date '2023-02-01'
        FROM {supplier}""",
}

# Column names of the CSV exports in the order of the projections above.
EXPORT_NAMES = {
    "goodreads": [
        "Book Id", "Title", "Author", "Year Published", "Publisher", "ISBN", "My Rating",
    ],
    "bookbuddy": [
        "Date Added", "Title", "Author", "Genre", "Category", "Status", "Rating", "ISBN", "Tags",
    ],
    "letterboxd": ["Date", "Name", "Year", "Letterboxd URI", "Rating"],
    "moviebuddy": [
        "Title", "Content Type", "Release Year", "Rating", "Directors", "Genres", "Runtime",
        "TMDB ID",
    ],
    "musicbuddy": [
        "Date Added", "Title", "Artist", "Genres", "Release Year", "discogs Release ID", "Rating",
    ],
}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def raw_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = run(spark, sf_dir, RAW[name])
    return df.toDF(*EXPORT_NAMES[name]) if name in EXPORT_NAMES else df


def working_folder(spark: SparkSession) -> str:
    """The session's shared folder. A local session that names none gets a temporary one, which
    goes when the process ends."""
    local = spark.sparkContext.master.startswith("local[")
    if local and not spark.conf.get("spark.checkpoint.dir", None):
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="omnishelf-"))
            atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
        return _OWN[0]
    return shared_folder(spark)


_OWN: list[str] = []


class Derived:
    """Raw sources, staged sources and lookups of one data folder, made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, read_often=READ_OFTEN):
        """``read_often`` names the sources that are stored after staging."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.lookups = _Lazy(lambda name: run(spark, sf_dir, LOOKUPS[name]), LOOKUPS)
        self.raw = _Lazy(lambda name: raw_source(spark, sf_dir, name), RAW)
        self.staged = _Lazy(self._stage, RAW)
        # Sources that one plan reads several times are stored first, as the build stores all.
        self.tables = _Lazy(
            lambda name: stored(self.staged[name], working_folder(spark))
            if name in read_often
            else self.staged[name],
            RAW,
        )

    def _stage(self, name: str) -> DataFrame:
        return STAGES[name](self.raw[name])


class _Lazy(dict):
    def __init__(self, make, names):
        super().__init__()
        self._make = make
        self._names = names

    def all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in self._names}

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._make(name)
        return self[name]


def duck(sql: str) -> str:
    """The same projection over DuckDB's views."""
    return sql.format(**{t: t for t in TABLES})
