"""DuckDB SQL for the domain plans, written from the result backwards: every pair of matching rows
is formed and the survivors are picked afterwards. Fit for small data only, which is its purpose."""

from __future__ import annotations

from omnishelf.functions.keys import NULL_FIELD, WHITE_SPACE
from omnishelf.sources.payloads import AUDIO_FEATURES
from verification.derived import LOOKUPS, RAW, duck

SPACES = "||".join(f"chr({ord(c)})" for c in WHITE_SPACE)


def t(x: str) -> str:
    return f"trim({x}, {SPACES})"


def k(x: str) -> str:
    return f"lower({t(x)})"


def tn(x: str) -> str:
    return f"nullif({t(x)}, '')"


def sk(*xs: str) -> str:
    parts = ", ".join(f"coalesce(cast({x} AS varchar), '{NULL_FIELD}')" for x in xs)
    return f"md5(concat_ws('-', {parts}))"


def num(x: str, kind: str = "bigint") -> str:
    """Integers only from integer text: DuckDB alone would round '3.5'."""
    if kind == "bigint":
        return f"CASE WHEN regexp_matches({t(x)}, '^[+-]?[0-9]+$') THEN try_cast({x} AS bigint) END"
    return f"try_cast({x} AS {kind})"


def whole(x: str) -> str:
    d = f"try_cast({t(x)} AS double)"
    return f"CASE WHEN {d} = floor({d}) THEN cast({d} AS bigint) END"


STAGED = {
    "goodreads": f"""
        SELECT book_id, 'goodreads' AS source_name, {t('title')} AS title, {t('author')} AS author,
               {whole('year_published')} AS year_published, {t('publisher')} AS publisher,
               nullif(regexp_replace(isbn, '^="?|"$', '', 'g'), '') AS isbn,
               {whole('my_rating')} AS rating
        FROM raw_goodreads""",
    "bookbuddy": f"""
        SELECT {sk('title', 'author', 'isbn')} AS book_id, * EXCLUDE (added) FROM (
            SELECT date_added AS added, {t('title')} AS title, {t('author')} AS author,
                   {tn('genre')} AS genre, {tn('category')} AS category, {t('status')} AS status,
                   try_cast(rating AS double) AS rating, {tn('isbn')} AS isbn, {tn('tags')} AS tags
            FROM raw_bookbuddy)
        QUALIFY row_number() OVER (
            PARTITION BY title, author, isbn
            ORDER BY added DESC NULLS LAST, genre NULLS FIRST, category NULLS FIRST,
                     status NULLS FIRST, rating NULLS FIRST, tags NULLS FIRST) = 1""",
    "letterboxd": f"""
        SELECT {sk('watched_date', 'film_name')} AS movie_id, * FROM (
            SELECT try_cast(watched AS date) AS watched_date, {t('name')} AS film_name,
                   {num('year')} AS release_year, {t('uri')} AS letterboxd_uri,
                   try_cast(rating AS double) AS rating
            FROM raw_letterboxd)""",
    "moviebuddy": f"""
        SELECT {sk('title', 'release_year')} AS movie_id, * FROM (
            SELECT {t('title')} AS title, {t('content_type')} AS content_type,
                   {num('release_year')} AS release_year, try_cast(rating AS double) AS rating,
                   {tn('directors')} AS directors, {tn('genres')} AS genres,
                   {num('runtime')} AS runtime_minutes, {num('tmdb_id')} AS tmdb_id
            FROM raw_moviebuddy)""",
    "musicbuddy": f"""
        SELECT {sk('title', 'artist', 'discogs_release_id')} AS album_id, * EXCLUDE (added) FROM (
            SELECT date_added AS added, {t('title')} AS title, {t('artist')} AS artist,
                   {tn('genres')} AS genres, {num('release_year')} AS release_year,
                   {num('discogs_release_id')} AS discogs_release_id,
                   try_cast(rating AS double) AS rating
            FROM raw_musicbuddy)
        QUALIFY row_number() OVER (
            PARTITION BY title, artist, discogs_release_id
            ORDER BY added DESC NULLS LAST, genres NULLS FIRST, release_year NULLS FIRST,
                     rating NULLS FIRST) = 1""",
    "spotify_saved_albums": """
        SELECT album_id, name AS album_name, artists, artist_ids, release_date,
               release_date_precision, genres, added_at, _extracted_at, total_tracks
        FROM raw_spotify_saved_albums""",
    "spotify_saved_tracks": f"""
        SELECT track_id, name AS track_name, artists, artist_ids, album_id, album_name,
               duration_ms, explicit, added_at, _extracted_at, {num('popularity')} AS popularity,
               {', '.join(f'try_cast({c} AS double) AS {c}' for c in AUDIO_FEATURES)}
        FROM raw_spotify_saved_tracks""",
    "spotify_followed_artists": f"""
        SELECT artist_id, name AS artist_name, genres, _extracted_at,
               {num('popularity')} AS popularity, {num('followers')} AS followers
        FROM raw_spotify_followed_artists""",
    "trakt_watched_movies": f"""
        SELECT {sk('title', 'release_year')} AS movie_id, slug, imdb_id, genres, country,
               trakt_movie_id, tmdb_id, title, release_year, plays AS watch_count,
               last_watched_at, last_updated_at, runtime_minutes, _extracted_at
        FROM raw_trakt_watched_movies""",
    "trakt_watched_shows": f"""
        SELECT {sk('title', 'release_year')} AS show_id, slug, imdb_id, genres, status, network,
               country, trakt_show_id, tmdb_id, title, release_year, plays AS watch_count,
               last_watched_at, last_updated_at, runtime_minutes, _extracted_at
        FROM raw_trakt_watched_shows""",
    "trakt_ratings": f"""
        SELECT {sk('media_type', 'title', 'release_year')} AS rating_id, media_type, slug,
               imdb_id, genres, country, trakt_id, tmdb_id, title, release_year, rating_raw,
               rating, rated_at, runtime_minutes, _extracted_at
        FROM raw_trakt_ratings""",
}
for _name in ("bandcamp_collection", "bandcamp_wishlist"):
    STAGED[_name] = f"""
        SELECT {sk('title', 'artist', 'item_url')} AS album_id, * FROM (
            SELECT item_type, tralbum_type, item_url, art_url, token, added_at, raw_json, item_id,
                   tralbum_id, {tn('title')} AS title, {tn('artist')} AS artist, _extracted_at
            FROM raw_{_name})
        QUALIFY row_number() OVER (
            PARTITION BY title, artist, item_url
            ORDER BY _extracted_at DESC, item_id, tralbum_id, item_type, tralbum_type, art_url,
                     token, added_at, raw_json) = 1"""

TIMESTAMPS = {"added_at", "_extracted_at", "last_watched_at", "last_updated_at", "rated_at"}


def assemble(ctes: dict[str, str], final: str) -> str:
    """WITH clause from named parts; raw, staged and lookup parts are added as they are used."""
    parts: dict[str, str] = {}

    def need(sql: str) -> None:
        for name, body in LOOKUPS.items():
            if f"lk_{name}" in sql and f"lk_{name}" not in parts:
                parts[f"lk_{name}"] = duck(body)
        for name, body in STAGED.items():
            if f"st_{name}" in sql and f"st_{name}" not in parts:
                parts[f"raw_{name}"] = duck(RAW[name])
                parts[f"st_{name}"] = body

    for body in [*ctes.values(), final]:
        need(body)
    parts |= ctes
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in parts.items()) + "\n" + final


def staged_oracle(name: str) -> str:
    """Instants as microseconds and dates as text, as the registered query gives them."""
    fix = {
        "added_at": "epoch_us(added_at)", "_extracted_at": "epoch_us(_extracted_at)",
        "last_watched_at": "epoch_us(last_watched_at)",
        "last_updated_at": "epoch_us(last_updated_at)", "rated_at": "epoch_us(rated_at)",
        "watched_date": "cast(watched_date AS varchar)",
    }
    sql = STAGED[name]
    used = [c for c in fix if c in sql and not (c == "added_at" and "bandcamp" in name)]
    replace = ", ".join(f"{fix[c]} AS {c}" for c in used)
    star = f"* REPLACE ({replace})" if used else "*"
    return assemble({}, f"SELECT {star} FROM st_{name}")


# Parts shared by the domains. One row per normalised key, as every lookup is unique here.
def country_label(country: str) -> str:
    return f"(SELECT any_value(country_fr) FROM lk_country_name_fr WHERE {k('country_en')} = {k(country)})"


def genre_one(domain: str, genre: str) -> str:
    return f"""(SELECT any_value(nullif(normalized_genre, '')) FROM lk_genre_mapping
        WHERE domain = '{domain}' AND {k('raw_genre')} = {k(genre)})"""


def json_tokens(x: str) -> str:
    return f"CASE WHEN json_valid({x}) THEN json_extract_string({x}, '$[*]') END"


def manual(domain: str, title_key: str, creator: str) -> str:
    return f"""(SELECT any_value(rating) FROM lk_manual_ratings
        WHERE domain = '{domain}' AND {k('title')} = {title_key}
          AND {k('author_or_director_or_artist')} {creator})"""


def books_ctes(strict: bool) -> dict[str, str]:
    zero = "" if strict else "nullif("
    zend = "" if strict else ", 0)"
    keep = "raw_key" if strict else "author_key"
    is_book = "category <> 'Manga'" if strict else "category IS DISTINCT FROM 'Manga'"
    author_key = f"""coalesce((SELECT {k('canonical_name')} FROM lk_author_name_mapping
        WHERE {k('raw_name')} = {k('author')}), {k('author')})"""
    rated = manual("books", "b.title_key", "= b.author_key")
    return {
        "shelf": f"""
            SELECT *, {k('title')} AS title_key, {k('author')} AS raw_key,
                   {author_key} AS author_key
            FROM st_bookbuddy WHERE {is_book}""",
        "log": f"""
            SELECT *, {k('title')} AS title_key, {k('author')} AS raw_key,
                   {author_key} AS author_key
            FROM st_goodreads""",
        "by_isbn": "SELECT s.book_id AS s_id, g.book_id AS g_id FROM shelf s JOIN log g USING (isbn)",
        "by_name": """
            SELECT s.book_id AS s_id, g.book_id AS g_id
            FROM shelf s JOIN log g USING (title_key, author_key)
            WHERE NOT EXISTS (FROM by_isbn m WHERE m.s_id = s.book_id)
              AND NOT EXISTS (FROM by_isbn m WHERE m.g_id = g.book_id)""",
        "pairs": """
            SELECT *, 'isbn' AS match_type FROM by_isbn
            UNION ALL SELECT *, 'title_author' FROM by_name""",
        "all_books": f"""
            SELECT s.book_id, s.title, s.author, s.genre, s.category, s.rating, s.isbn, s.tags,
                   g.book_id AS goodreads_id, g.year_published, g.publisher,
                   g.rating AS goodreads_rating, p.match_type,
                   s.title_key, s.raw_key, s.author_key
            FROM shelf s LEFT JOIN pairs p ON p.s_id = s.book_id
                 LEFT JOIN log g ON g.book_id = p.g_id
            UNION ALL
            SELECT {sk('title', 'author')}, title, author, NULL, NULL, NULL, isbn, NULL, book_id,
                   year_published, publisher, rating, NULL, title_key, raw_key, author_key
            FROM log WHERE book_id NOT IN (SELECT g_id FROM pairs)""",
        "rated_books": f"""
            SELECT b.* REPLACE (coalesce({zero}b.rating{zend}, {rated}) AS rating)
            FROM all_books b""",
        "one_book": f"""
            SELECT * FROM rated_books
            QUALIFY row_number() OVER (
                PARTITION BY title_key, {keep}
                ORDER BY match_type IS NULL, goodreads_id IS NULL, isbn IS NULL, rating IS NULL,
                         book_id, goodreads_id) = 1""",
        "located_books": f"""
            SELECT b.*, (SELECT any_value(country) FROM lk_author_countries a
                         WHERE {k('a.author')} = b.author_key) AS country_source
            FROM one_book b""",
        "books": f"""
            SELECT book_id, title, author, {genre_one('books', 'genre')} AS genre, category,
                   rating, isbn, tags, goodreads_id, year_published, publisher, goodreads_rating,
                   match_type,
                   coalesce({country_label('country_source')}, country_source) AS country,
                   country_source
            FROM located_books""",
    }


def manga_ctes(strict: bool) -> dict[str, str]:
    rated = manual("manga", "m.title_key", "= m.author_key")
    return {
        "volumes": f"""
            SELECT *, {k('title')} AS title_key, {k('author')} AS author_key
            FROM st_bookbuddy WHERE category = 'Manga'""",
        "located_volumes": f"""
            SELECT m.*, (SELECT any_value(country) FROM lk_manga_author_countries a
                         WHERE {k('a.author')} = m.author_key) AS country_source,
                   coalesce(nullif(m.rating, 0), {rated}) AS final_rating
            FROM volumes m""",
        "manga": f"""
            SELECT book_id AS manga_id, title, author, {genre_one('manga', 'genre')} AS genre,
                   category, isbn, tags, 'bookbuddy' AS source, final_rating AS rating,
                   coalesce({country_label('country_source')}, country_source) AS country,
                   country_source
            FROM located_volumes""",
    }


def _tracker(kind: str, only: str, extra: str, strict: bool) -> dict[str, str]:
    """Watched and rated items of the tracker. Ratings have one row per title and year, and so have
    watched items unless ``strict``: then each of them is joined."""
    table = {"movie": "st_trakt_watched_movies", "show": "st_trakt_watched_shows"}[kind]
    watched = f"SELECT *, {k('title')} AS title_key FROM {table} WHERE {only}"
    if not strict:
        watched = f"""
            SELECT * REPLACE (sum(watch_count) OVER (PARTITION BY title_key, release_year)::bigint
                              AS watch_count)
            FROM ({watched})
            QUALIFY row_number() OVER (
                PARTITION BY title_key, release_year
                ORDER BY last_watched_at DESC NULLS LAST, watch_count DESC NULLS LAST,
                         trakt_{kind}_id DESC, title DESC, slug DESC) = 1"""
    pick = [
        "title", "slug", "imdb_id", "tmdb_id", "genres", "runtime_minutes", "country",
    ]
    return {
        f"{kind}_rated": f"""
            SELECT *, {k('title')} AS title_key FROM st_trakt_ratings
            WHERE media_type = '{kind}' AND {only}
            QUALIFY row_number() OVER (PARTITION BY title_key, release_year
                                       ORDER BY rated_at DESC) = 1""",
        f"{kind}_tracked": f"""
            SELECT coalesce(w.title_key, r.title_key) AS title_key,
                   coalesce(w.release_year, r.release_year) AS release_year,
                   coalesce(w.trakt_{kind}_id, r.trakt_id) AS trakt_id,
                   {', '.join(f'coalesce(w.{c}, r.{c}) AS {c}' for c in pick)},
                   w.watch_count, w.last_watched_at, {extra}
                   r.rating AS trakt_rating, r.rating_raw AS trakt_rating_raw,
                   r.rated_at AS trakt_rated_at
            FROM ({watched}) w
            FULL JOIN {kind}_rated r
                 ON w.title_key = r.title_key AND w.release_year = r.release_year""",
        # Labels of all rows of a title and year.
        f"{kind}_labels": f"""
            SELECT title_key AS label_title, release_year AS label_year,
                   string_agg({'' if strict else 'DISTINCT '}normalized_genre, ','
                              ORDER BY normalized_genre) AS tracker_labels
            FROM (SELECT title_key, release_year, unnest({json_tokens('genres')}) AS token
                  FROM {kind}_tracked)
                 JOIN lk_genre_mapping ON domain = 'movies' AND {k('raw_genre')} = {k('token')}
            WHERE normalized_genre <> '' GROUP BY ALL""",
    }


def genres_by_id(domain: str, item: str, tokens: str, rows: str, strict: bool) -> str:
    """Labels of all rows that share an item id: item_id, labels."""
    distinct = "" if strict else "DISTINCT "
    return f"""
        SELECT item_id, string_agg({distinct}normalized_genre, ',' ORDER BY normalized_genre) AS labels
        FROM (SELECT {item} AS item_id, unnest({tokens}) AS token FROM {rows}) JOIN lk_genre_mapping
             ON domain = '{domain}' AND {k('raw_genre')} = {k('token')}
        WHERE normalized_genre <> '' GROUP BY item_id"""


COLLECTION = f"""
    SELECT *, {k('title')} AS title_key, {k("split_part(directors, ',', 1)")} AS director_key
    FROM st_moviebuddy"""


def _director_country(table: str) -> str:
    return f"""(SELECT any_value(country) FROM lk_{table}
        WHERE {k('director')} = u.director_key)"""


def movies_ctes(strict: bool) -> dict[str, str]:
    series = "content_type = 'TV Show' AND lower(genres) LIKE '%animation%'"
    keep = f"NOT ({series})" if strict else f"({series}) IS NOT TRUE"
    if strict:
        dl, fl = country_label("director_country"), country_label("film_country")
        first_origin = f"""CASE WHEN {dl} IS NOT NULL THEN director_country
            WHEN {fl} IS NOT NULL THEN film_country END"""
        country = f"coalesce({dl}, {fl}, director_country, film_country, tracker_country)"
        origin = f"coalesce({first_origin}, director_country, film_country, tracker_country)"
    else:
        origin = "coalesce(director_country, film_country, tracker_country)"
        country = f"coalesce({country_label('origin')}, origin)"
    return {
        "owned_labels": genres_by_id(
            "movies", "movie_id", "string_split(genres, ',')", f"st_moviebuddy WHERE {keep}", strict
        ),
        "owned": COLLECTION + f" LEFT JOIN owned_labels ON item_id = movie_id WHERE {keep}",
        "diary": f"""
            SELECT *, {k('film_name')} AS title_key,
                   min(watched_date) OVER w AS first_date, count(*) OVER w AS views
            FROM st_letterboxd
            WINDOW w AS (PARTITION BY {k('film_name')}, release_year)
            QUALIFY row_number() OVER (
                PARTITION BY {k('film_name')}, release_year
                ORDER BY watched_date DESC NULLS LAST, film_name DESC NULLS LAST,
                         rating DESC NULLS LAST, letterboxd_uri DESC NULLS LAST) = 1""",
        **_tracker("movie", "true", "", strict),
        "two": """
            SELECT coalesce(o.title_key, d.title_key) AS title_key,
                   coalesce(o.release_year, d.release_year) AS release_year,
                   o.title_key IS NOT NULL AS has_owned, d.title_key IS NOT NULL AS has_diary,
                   o.title AS owned_title, d.film_name AS diary_title, o.content_type,
                   o.directors, o.director_key, o.rating AS owned_rating, o.labels AS owned_labels,
                   o.runtime_minutes, o.tmdb_id, d.rating AS letterboxd_rating, d.letterboxd_uri,
                   d.first_date, d.watched_date AS last_date, d.views
            FROM owned o FULL JOIN diary d
                 ON o.title_key = d.title_key AND o.release_year = d.release_year""",
        "united": f"""
            SELECT coalesce(u.title_key, m.title_key) AS title_key,
                   coalesce(u.release_year, m.release_year) AS release_year,
                   u.* EXCLUDE (title_key, release_year), m.title_key IS NOT NULL AS has_trakt,
                   m.* EXCLUDE (title_key, release_year, runtime_minutes, tmdb_id, title),
                   m.title AS trakt_title, m.runtime_minutes AS trakt_runtime,
                   m.tmdb_id AS trakt_tmdb
            FROM two u FULL JOIN movie_tracked m
                 ON u.title_key = m.title_key AND u.release_year = m.release_year""",
        "located": f"""
            SELECT u.*, country AS tracker_country,
                   {_director_country('director_countries')} AS director_country,
                   (SELECT any_value(f.country) FROM lk_film_countries f
                    WHERE {k('f.title')} = u.title_key AND f.release_year = u.release_year)
                       AS film_country,
                   {manual('movies', 'u.title_key', 'IS NOT DISTINCT FROM u.director_key')}
                       AS manual_rating,
                   coalesce(u.owned_labels, tracker_labels) AS labels,
                   coalesce(has_owned, false) AS o, coalesce(has_diary, false) AS d,
                   has_trakt AS w
            FROM united u LEFT JOIN movie_labels
                 ON u.title_key = label_title AND u.release_year = label_year""",
        "sourced": f"SELECT *, {origin} AS origin FROM located",
        "movies": f"""
            SELECT {sk('title', 'release_year')} AS movie_id, * FROM (
            SELECT content_type, release_year, directors, trakt_rating, trakt_rating_raw,
                   epoch_us(trakt_rated_at) AS trakt_rated_at, trakt_id AS trakt_movie_id,
                   slug AS trakt_slug, imdb_id AS trakt_imdb_id, letterboxd_rating,
                   letterboxd_uri,
                   CASE WHEN w AND d AND o THEN 'trakt_and_letterboxd_and_moviebuddy'
                        WHEN w AND d THEN 'trakt_and_letterboxd'
                        WHEN w AND o THEN 'trakt_and_moviebuddy'
                        WHEN d AND o THEN 'letterboxd_and_moviebuddy'
                        WHEN w THEN 'trakt' WHEN d THEN 'letterboxd' ELSE 'moviebuddy' END
                       AS source,
                   coalesce(owned_title, trakt_title, diary_title) AS title,
                   coalesce(trakt_rating, letterboxd_rating, nullif(owned_rating, 0),
                            manual_rating) AS rating,
                   labels AS genres, coalesce(runtime_minutes, trakt_runtime) AS runtime_minutes,
                   coalesce(tmdb_id, trakt_tmdb) AS tmdb_id,
                   cast(coalesce(first_date, cast(last_watched_at AS date)) AS varchar)
                       AS first_watched_date,
                   cast(greatest(last_date, cast(last_watched_at AS date)) AS varchar)
                       AS last_watched_date,
                   coalesce(views, 0) + coalesce(watch_count, 0) AS watch_count,
                   CASE WHEN w::int + d::int + o::int > 1 THEN 'title_year' END AS match_type,
                   {country} AS country, origin AS country_source
            FROM sourced)""",
    }


def anime_ctes(strict: bool) -> dict[str, str]:
    series = "content_type = 'TV Show' AND lower(genres) LIKE '%animation%'"
    animated = "(lower(genres) LIKE '%animation%' OR lower(genres) LIKE '%anime%')"
    if strict:
        dl, tl = country_label("director_country"), country_label("tracker_country")
        origin = f"""coalesce(CASE WHEN {dl} IS NOT NULL THEN director_country
            WHEN {tl} IS NOT NULL THEN tracker_country END, director_country, tracker_country)"""
        country = f"coalesce({dl}, {tl}, director_country, tracker_country)"
        ratings = f"""SELECT {k('title')} AS rated_key, rating FROM lk_manual_ratings
            WHERE domain = 'anime'"""
    else:
        origin = "coalesce(director_country, tracker_country)"
        country = f"coalesce({country_label('origin')}, origin)"
        ratings = f"""SELECT {k('title')} AS rated_key, rating FROM lk_manual_ratings
            WHERE domain = 'anime'
            QUALIFY row_number() OVER (PARTITION BY rated_key
                                       ORDER BY rated_at DESC NULLS LAST, rating DESC) = 1"""
    return {
        "series_labels": genres_by_id(
            "movies", "movie_id", "string_split(genres, ',')", f"st_moviebuddy WHERE {series}", strict
        ),
        "series": COLLECTION + f" LEFT JOIN series_labels ON item_id = movie_id WHERE {series}",
        **_tracker("show", animated, "w.status, w.network,", strict),
        "shows": f"""
            SELECT coalesce(o.title_key, s.title_key) AS title_key,
                   coalesce(o.release_year, s.release_year) AS release_year,
                   o.title_key IS NOT NULL AS o, s.title_key IS NOT NULL AS w,
                   coalesce(o.title, s.title) AS title, o.directors, o.director_key,
                   o.rating AS owned_rating, o.labels AS owned_labels, s.genres,
                   coalesce(o.runtime_minutes, s.runtime_minutes) AS runtime_minutes,
                   coalesce(o.tmdb_id, s.tmdb_id) AS tmdb_id, s.country AS tracker_country,
                   s.* EXCLUDE (title_key, release_year, title, genres, runtime_minutes, tmdb_id,
                                country)
            FROM series o FULL JOIN show_tracked s
                 ON o.title_key = s.title_key AND o.release_year = s.release_year""",
        "located_shows": f"""
            SELECT u.*, {_director_country('anime_director_countries')} AS director_country,
                   coalesce(u.owned_labels, tracker_labels) AS labels
            FROM shows u LEFT JOIN show_labels
                 ON u.title_key = label_title AND u.release_year = label_year""",
        "sourced_shows": f"SELECT *, {origin} AS origin FROM located_shows",
        "anime_manual": ratings,
        "anime": f"""
            SELECT {sk('title', 'release_year')} AS anime_id, 'TV Show' AS content_type,
                   release_year, directors, cast(NULL AS varchar) AS first_watched_date,
                   watch_count, trakt_rating, trakt_rating_raw,
                   epoch_us(trakt_rated_at) AS trakt_rated_at, trakt_id AS trakt_show_id,
                   slug AS trakt_slug, imdb_id AS trakt_imdb_id, status, network, title,
                   coalesce(trakt_rating, nullif(owned_rating, 0), a.rating) AS rating,
                   labels AS genres, runtime_minutes, tmdb_id,
                   cast(cast(last_watched_at AS date) AS varchar) AS last_watched_date,
                   CASE WHEN w AND o THEN 'trakt_and_moviebuddy' WHEN w THEN 'trakt'
                        ELSE 'moviebuddy' END AS source,
                   CASE WHEN w AND o THEN 'title_year' END AS match_type,
                   {country} AS country, origin AS country_source
            FROM sourced_shows s LEFT JOIN anime_manual a ON a.rated_key = s.title_key""",
    }


def music_ctes(strict: bool) -> dict[str, str]:
    zero = "best.rating" if strict else "nullif(best.rating, 0)"
    display = "regexp_replace(artist, ' \\(\\d+\\)$', '')"
    return {
        "streamed": """
            SELECT a.*, coalesce(nullif(a.genres, '[]'), f.genres) AS all_genres
            FROM st_spotify_saved_albums a LEFT JOIN st_spotify_followed_artists f
                 ON f.artist_id = json_extract_string(a.artist_ids, '$[0]')""",
        "shelf_labels": genres_by_id(
            "music", "album_id", "string_split(genres, ',')", "st_musicbuddy", strict
        ),
        "streamed_labels": genres_by_id(
            "music", sk("album_name", "artists"), json_tokens("all_genres"), "streamed", strict
        ),
        "listened": f"""
            SELECT 1 AS rank, 'musicbuddy' AS app, 'cd' AS format, album_id, title, artist,
                   {display} AS artist_display, {k('title')} AS title_key,
                   {k(display)} AS artist_key, {k(display)} AS country_key, l.labels AS genres,
                   release_year, rating, discogs_release_id, NULL AS spotify_album_id,
                   NULL AS total_tracks, NULL AS spotify_added_at, NULL AS bandcamp_item_id,
                   NULL AS bandcamp_item_url, NULL AS bandcamp_added_at, NULL AS origin
            FROM st_musicbuddy m LEFT JOIN shelf_labels l ON l.item_id = m.album_id
            UNION ALL
            SELECT 2, 'bandcamp', 'digital', album_id, title, artist, artist, {k('title')},
                   {k('artist')}, {k('artist')}, NULL, NULL, NULL, NULL, NULL, NULL, NULL, item_id,
                   item_url, added_at, origin
            FROM (SELECT *, 'collection' AS origin FROM st_bandcamp_collection
                  UNION ALL SELECT *, 'wishlist' FROM st_bandcamp_wishlist)
            UNION ALL
            SELECT 3, 'spotify', 'digital', {sk('album_name', 'artists')}, album_name, artists,
                   artists, {k('album_name')}, {k('artists')}, {k("split_part(artists, ',', 1)")},
                   l.labels, {num("split_part(release_date, '-', 1)")}, NULL, NULL, album_id,
                   total_tracks, added_at, NULL, NULL, NULL, NULL
            FROM streamed s
                 LEFT JOIN streamed_labels l ON l.item_id = {sk('album_name', 'artists')}""",
        "best": """
            SELECT * FROM listened WHERE title_key IS NOT NULL AND artist_key IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY title_key, artist_key
                                       ORDER BY rank, album_id) = 1""",
        "merged": """
            SELECT title_key, artist_key, max(discogs_release_id) AS discogs_release_id,
                   max(spotify_album_id) AS spotify_album_id, max(total_tracks) AS total_tracks,
                   epoch_us(max(spotify_added_at)) AS spotify_added_at,
                   max(bandcamp_item_id) AS bandcamp_item_id,
                   max(bandcamp_item_url) AS bandcamp_item_url,
                   max(bandcamp_added_at) AS bandcamp_added_at,
                   string_agg(DISTINCT origin, ', ' ORDER BY origin) AS bandcamp_origin,
                   string_agg(DISTINCT format, ', ' ORDER BY format) AS media_format,
                   (SELECT string_agg(name, '_and_' ORDER BY r)
                    FROM (VALUES (1, 'musicbuddy'), (2, 'bandcamp'), (3, 'spotify')) n(r, name)
                    WHERE list_contains(list(rank), r)) AS source_name,
                   CASE WHEN count(DISTINCT app) > 1 THEN 'title_artist' END AS match_type
            FROM listened GROUP BY title_key, artist_key""",
        "located_albums": f"""
            SELECT best.album_id, best.title, best.artist, best.artist_display, best.genres,
                   best.release_year, merged.* EXCLUDE (title_key, artist_key),
                   coalesce({zero}, {manual('music', 'best.title_key', '= best.artist_key')})
                       AS rating,
                   (SELECT any_value(country) FROM lk_artist_countries c
                    WHERE {k('c.artist')} = best.country_key) AS country_source
            FROM best JOIN merged USING (title_key, artist_key)""",
        "music": f"""
            SELECT *, coalesce({country_label('country_source')}, country_source) AS country
            FROM located_albums""",
    }


MODEL_CTES = {
    "books": books_ctes,
    "movies": movies_ctes,
    "music": music_ctes,
    "manga": manga_ctes,
    "anime": anime_ctes,
}


def unified_oracle(domain: str, strict: bool = False) -> str:
    return assemble(MODEL_CTES[domain](strict), f"SELECT * FROM {domain}")


def mart_ctes(strict: bool) -> dict[str, str]:
    """All five collection tables, cut to what the cross-domain tables and checks read."""
    ctes: dict[str, str] = {}
    for make in MODEL_CTES.values():
        ctes |= make(strict)
    ctes["items"] = f"""
        SELECT 'books' AS domain, book_id AS item_id, title, author AS creator, 'author' AS role,
               {book_rating(strict)} AS rating, country, country_source, true AS consumed
        FROM books
        UNION ALL
        SELECT 'movies', movie_id, title, nullif(split_part(directors, ',', 1), ''), 'director',
               rating, country, country_source, first_watched_date IS NOT NULL FROM movies
        UNION ALL
        SELECT 'music', album_id, title, artist_display, 'artist', nullif(rating, 0), country,
               country_source, NULL FROM music
        UNION ALL
        SELECT 'manga', manga_id, title, author, 'author', rating, country, country_source, NULL
        FROM manga
        UNION ALL
        SELECT 'anime', anime_id, title, nullif(split_part(directors, ',', 1), ''), 'director',
               rating, country, country_source, last_watched_date IS NOT NULL FROM anime"""
    return ctes


def book_rating(strict: bool) -> str:
    second = "goodreads_rating" if strict else "nullif(goodreads_rating, 0)"
    return f"coalesce(cast({second} AS double), nullif(rating, 0))"


def collection_oracle(domain: str) -> str:
    ctes = MODEL_CTES[domain](False)
    final = {
        "books": f"""
            SELECT book_id, title, author, genre, category, year_published, publisher, isbn, tags,
                   country, goodreads_id, {book_rating(False)} AS rating,
                   CASE WHEN match_type IS NOT NULL THEN 'bookbuddy_and_goodreads'
                        WHEN goodreads_id IS NOT NULL THEN 'goodreads' ELSE 'bookbuddy' END
                       AS source,
                   {book_rating(False)} IS NOT NULL AS is_rated, country_source
            FROM books""",
        "movies": """
            SELECT movie_id, title, content_type, release_year, first_watched_date,
                   last_watched_date, rating, directors, genres, runtime_minutes, tmdb_id,
                   letterboxd_uri, country, source, first_watched_date IS NOT NULL AS is_watched,
                   rating IS NOT NULL AS is_rated, country_source
            FROM movies""",
        "music": """
            SELECT * EXCLUDE (artist, artist_display, match_type, rating),
                   artist_display AS artist, nullif(rating, 0) AS rating,
                   nullif(rating, 0) IS NOT NULL AS is_rated
            FROM music""",
        "manga": "SELECT *, rating IS NOT NULL AS is_rated FROM manga",
        "anime": """
            SELECT anime_id, title, content_type, release_year, first_watched_date,
                   last_watched_date, rating, directors, genres, runtime_minutes, tmdb_id, country,
                   source, last_watched_date IS NOT NULL AS is_watched,
                   rating IS NOT NULL AS is_rated, country_source
            FROM anime""",
    }[domain]
    return assemble(ctes, final)


def summary_oracle() -> str:
    return assemble(
        mart_ctes(False),
        """
        SELECT domain, count(*) AS total_items,
               CASE WHEN domain NOT IN ('music', 'manga') THEN count(*) FILTER (consumed) END
                   AS items_consumed,
               CASE WHEN domain NOT IN ('music', 'manga') THEN count(*) FILTER (NOT consumed) END
                   AS items_pending,
               count(rating) AS items_rated, round(avg(rating), 2) AS avg_rating,
               count(country) AS items_with_country
        FROM items GROUP BY domain""",
    )


def country_index_oracle(strict: bool) -> str:
    name = "country" if strict else "country_source"
    return assemble(
        mart_ctes(strict),
        f"""
        SELECT i.country, i.domain, i.item_id, i.title AS item_title,
               CASE WHEN role = 'director' THEN {t('creator')} ELSE creator END AS person_name,
               role AS person_role, i.rating, c.iso_alpha3
        FROM items i LEFT JOIN lk_country_iso_codes c ON {k('c.country_name')} = {k('i.' + name)}
        WHERE i.country IS NOT NULL""",
    )


def coverage_oracle() -> str:
    return assemble(
        {
            "seen": """
                SELECT 'books' AS domain, genre AS raw FROM st_bookbuddy
                UNION ALL SELECT 'movies', unnest(string_split(genres, ',')) FROM st_moviebuddy
                UNION ALL SELECT 'music', unnest(string_split(genres, ',')) FROM st_musicbuddy
                UNION ALL SELECT 'music', unnest({a}) FROM st_spotify_followed_artists
                UNION ALL SELECT 'movies', unnest({a}) FROM st_trakt_watched_movies
                UNION ALL SELECT 'movies', unnest({a}) FROM st_trakt_watched_shows
                UNION ALL SELECT 'movies', unnest({a}) FROM st_trakt_ratings""".replace(
                "{a}", json_tokens("genres")
            ),
        },
        f"""
        SELECT DISTINCT domain, {t('raw')} AS raw_genre FROM seen s
        WHERE {t('raw')} <> '' AND NOT EXISTS (
            FROM lk_genre_mapping m WHERE m.domain = s.domain AND {k('m.raw_genre')} = {k('s.raw')})
        """,
    )


def orphans_oracle() -> str:
    return assemble(
        mart_ctes(False),
        f"""
        SELECT domain, title, author_or_director_or_artist AS creator FROM lk_manual_ratings r
        WHERE NOT EXISTS (
            FROM items i WHERE i.domain = r.domain AND {k('i.title')} = {k('r.title')}
            AND {k('i.creator')} = {k('r.author_or_director_or_artist')})""",
    )


def duplicates_oracle() -> str:
    return assemble(
        mart_ctes(False),
        f"""
        SELECT domain, {k('title')} AS title_key, {k('creator')} AS creator_key,
               count(*) AS duplicate_count,
               string_agg(DISTINCT title, ' | ' ORDER BY title) AS duplicate_titles,
               string_agg(DISTINCT creator, ' | ' ORDER BY creator) AS duplicate_creators
        FROM items WHERE title IS NOT NULL AND creator IS NOT NULL
        GROUP BY ALL HAVING count(*) > 1""",
    )
