"""Films and animated series: a collection app, a diary and a watch tracker on (title, year)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions import (
    first_token,
    has_text,
    label_from_flags,
    norm_key,
    split_csv,
    split_json,
    surrogate_key,
    zero_to_null,
)
from omnishelf.operators import (
    attach,
    attach_creator_country,
    attach_repeats,
    fold_histories,
    label_texts,
    map_tokens,
    numbered,
    outer_unify,
    unique_lookup,
)
from omnishelf.plans.enrich import (
    Lookups,
    attach_manual_rating,
    genre_labels,
    manual_ratings,
    translate_country,
)

KEYS = ["title_key", "release_year"]

MOVIE_COLUMNS = [
    "movie_id", "content_type", "release_year", "directors", "trakt_rating", "trakt_rating_raw",
    "trakt_rated_at", "trakt_movie_id", "trakt_slug", "trakt_imdb_id", "letterboxd_rating",
    "letterboxd_uri", "source", "title", "rating", "genres", "runtime_minutes", "tmdb_id",
    "first_watched_date", "last_watched_date", "watch_count", "match_type", "country",
    "country_source",
]
ANIME_COLUMNS = [
    "anime_id", "content_type", "release_year", "directors", "first_watched_date", "watch_count",
    "trakt_rating", "trakt_rating_raw", "trakt_rated_at", "trakt_show_id", "trakt_slug",
    "trakt_imdb_id", "status", "network", "title", "rating", "genres", "runtime_minutes",
    "tmdb_id", "last_watched_date", "source", "match_type", "country", "country_source",
]


def is_animated_series() -> Column:
    return (F.col("content_type") == "TV Show") & has_text("genres", "animation")


def films_only(moviebuddy: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Everything that is not known to be an animated series. The strict setting loses the rows
    whose type or genres leave the question open."""
    series = is_animated_series()
    if not strict_reference:
        series = F.coalesce(series, F.lit(False))
    return moviebuddy.filter(~series)


def animated_series(df: DataFrame) -> DataFrame:
    return df.filter(is_animated_series())


def animated_shows(df: DataFrame) -> DataFrame:
    return df.filter(has_text("genres", "animation", "anime"))


def _collection(df: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Collection rows with their match key and genre labels."""
    rows = df.select(
        *["movie_id", "title", "content_type", "release_year", "rating", "directors", "genres"],
        *["runtime_minutes", "tmdb_id"],
        norm_key("title").alias("title_key"),
        norm_key(first_token("directors")).alias("director_key"),
    )
    return map_tokens(
        rows, split_csv("genres"), labels, "genre_labels", ["movie_id"], **how
    ).drop("genres")


def _ratings(ratings: DataFrame, media_type: str) -> DataFrame:
    return ratings.filter(F.col("media_type") == media_type)


def _tracked(watched: DataFrame, ratings: DataFrame, id_col: str) -> dict[str, DataFrame]:
    """Watch and rating histories, narrowed to what is kept per key."""
    shared = ["title", "slug", "imdb_id", "tmdb_id", "genres", "runtime_minutes", "country"]
    extra = [c for c in ("status", "network") if c in watched.columns]
    key = norm_key("title").alias("title_key")
    return {
        "watched": watched.select(
            key, "release_year", "last_watched_at", "watch_count",
            F.col(id_col).alias("trakt_id"), *shared, *extra,
        ),
        "rated": ratings.select(
            key, "release_year", "rated_at", "rating", "rating_raw", "trakt_id", *shared
        ),
    }


def _either(field: str) -> Column:
    return F.coalesce(f"watched.{field}", f"rated.{field}")


def _tracker_text() -> Column:
    """The tracker's genres. Without a complete match key there is nothing to attach labels to, so
    such rows have none."""
    complete = F.col("title_key").isNotNull() & F.col("release_year").isNotNull()
    return F.when(complete, _either("genres"))


def _merged(
    base: DataFrame,
    histories: dict[str, DataFrame],
    latest: dict[str, str],
    totals: dict[str, dict[str, Column]],
    labels: DataFrame,
    strict_reference: bool,
    store: Callable[[DataFrame], DataFrame] | None,
) -> DataFrame:
    """The collection joined with the histories of its keys, as ``owned`` and a struct each.

    Watch histories are rolled up, ``plays`` over all their rows. In strict mode each of their rows
    pairs with each collection row of its key, with its own plays, and the genres of a key are those
    of all its rows.
    """
    kept = store or (lambda df: df)
    latest = {"rated": "rated_at", **latest}
    fold = {"keys": KEYS, "base_name": "owned"}
    if not strict_reference:
        base = kept(base)
        spine = fold_histories(
            histories,
            latest={"watched": "last_watched_at", **latest},
            totals={"watched": {"plays": F.sum("watched.watch_count")}, **totals},
            base=base,
            **fold,
        )
        # A spine row is a key of its own, so its labels are those of its text.
        genres = [histories[name].select("genres") for name in ("watched", "rated")]
        texts = label_texts(genres[0].union(genres[1]), split_json, labels)
        spine = kept(attach(spine, texts, {"text": _tracker_text()}, {"tracker_labels": "label"}))
        return outer_unify(base, "owned", spine, KEYS)
    base = numbered(base, store)
    watched = histories["watched"]
    folded = {name: df for name, df in histories.items() if name != "watched"}
    spine = fold_histories(
        folded, latest=latest, totals=totals, base=base, repeats={"watched": watched}, **fold
    )
    spine = attach_repeats(kept(spine), watched, "watched", KEYS)
    spine = map_tokens(
        spine, split_json(_tracker_text()), labels, "tracker_labels", ["match_key"], distinct=False
    )
    spine = numbered(spine.withColumn("plays", F.col("watched.watch_count")), store)
    return outer_unify(base, "owned", spine, KEYS, repeats="watched")


def unify_movies(
    moviebuddy: DataFrame,
    letterboxd: DataFrame,
    trakt_watched: DataFrame,
    trakt_ratings: DataFrame,
    lookups: Lookups,
    strict_reference: bool = False,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per film over all three apps, or with ``strict_reference`` one per pair of repeated
    rows. ``store`` writes the collection and the folded histories, which are read twice each."""
    labels = genre_labels(lookups, "movies")
    how = {"distinct": not strict_reference}
    base = _collection(films_only(moviebuddy, strict_reference), labels, **how)
    diary = letterboxd.select(
        norm_key("film_name").alias("title_key"),
        *["release_year", "watched_date", "film_name", "rating", "letterboxd_uri"],
    )
    histories = {
        **_tracked(trakt_watched, _ratings(trakt_ratings, "movie"), "trakt_movie_id"),
        "diary": diary,
    }
    totals = {
        "diary": {"diary_first": F.min("diary.watched_date"), "diary_count": F.count("diary")}
    }
    latest = {"diary": "watched_date"}
    merged = _merged(base, histories, latest, totals, labels, strict_reference, store)

    has_trakt = F.col("watched").isNotNull() | F.col("rated").isNotNull()
    flags = {
        "trakt": has_trakt,
        "letterboxd": F.col("diary").isNotNull(),
        "moviebuddy": F.col("owned").isNotNull(),
    }
    n_sources = sum((f.cast("int") for f in flags.values()), F.lit(0))
    last_tracked = F.to_date("watched.last_watched_at")
    rows = merged.select(
        *KEYS,
        F.col("owned.director_key").alias("director_key"),
        "owned.content_type",
        "owned.directors",
        F.col("rated.rating").alias("trakt_rating"),
        F.col("rated.rating_raw").alias("trakt_rating_raw"),
        F.col("rated.rated_at").alias("trakt_rated_at"),
        _either("trakt_id").alias("trakt_movie_id"),
        _either("slug").alias("trakt_slug"),
        _either("imdb_id").alias("trakt_imdb_id"),
        F.col("diary.rating").alias("letterboxd_rating"),
        "diary.letterboxd_uri",
        label_from_flags(flags).alias("source"),
        F.when(n_sources > 1, F.lit("title_year")).alias("match_type"),
        F.coalesce("owned.title", _either("title"), "diary.film_name").alias("title"),
        F.coalesce("rated.rating", "diary.rating", zero_to_null("owned.rating")).alias("rating"),
        F.coalesce("owned.genre_labels", "tracker_labels").alias("genres"),
        F.coalesce("owned.runtime_minutes", _either("runtime_minutes")).alias("runtime_minutes"),
        F.coalesce("owned.tmdb_id", _either("tmdb_id")).alias("tmdb_id"),
        F.coalesce("diary_first", last_tracked).alias("first_watched_date"),
        F.greatest("diary.watched_date", last_tracked).alias("last_watched_date"),
        (
            F.coalesce("diary_count", F.lit(0)) + F.coalesce("plays", F.lit(0))
        ).alias("watch_count"),
        _either("country").alias("tracker_country"),
    )
    rows = attach_creator_country(
        rows, lookups["director_countries"], "director", "director_key", "director_country"
    )
    films = unique_lookup(
        lookups["film_countries"],
        {"film_key": norm_key("title"), "film_year": F.col("release_year")},
        ["country"],
    )
    rows = attach(
        rows, films, {"film_key": "title_key", "film_year": "release_year"},
        {"film_country": "country"},
    )
    rows = _resolve_country(
        rows, lookups, ["director_country", "film_country", "tracker_country"],
        translated=["director_country", "film_country"] if strict_reference else None,
    )
    rows = attach_manual_rating(
        rows, lookups, "movies", "title_key", "director_key", null_safe_creator=True
    )
    return rows.withColumns(
        {
            "rating": F.coalesce("rating", "manual_rating"),
            "movie_id": surrogate_key("title", "release_year"),
        }
    ).select(*MOVIE_COLUMNS)


def unify_anime(
    moviebuddy: DataFrame,
    trakt_watched: DataFrame,
    trakt_ratings: DataFrame,
    lookups: Lookups,
    strict_reference: bool = False,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per animated series, or with ``strict_reference`` one per pair of repeated rows. The
    tracker uses the film genres for shows as well. ``store`` as in ``unify_movies``."""
    labels = genre_labels(lookups, "movies")
    how = {"distinct": not strict_reference}
    base = _collection(animated_series(moviebuddy), labels, **how)
    histories = _tracked(
        animated_shows(trakt_watched),
        animated_shows(_ratings(trakt_ratings, "show")),
        "trakt_show_id",
    )
    merged = _merged(base, histories, {}, {}, labels, strict_reference, store)

    has_trakt = F.col("watched").isNotNull() | F.col("rated").isNotNull()
    flags = {"trakt": has_trakt, "moviebuddy": F.col("owned").isNotNull()}
    rows = merged.select(
        *KEYS,
        F.col("owned.director_key").alias("director_key"),
        F.lit("TV Show").alias("content_type"),
        "owned.directors",
        F.lit(None).cast("date").alias("first_watched_date"),
        F.col("plays").alias("watch_count"),
        F.col("rated.rating").alias("trakt_rating"),
        F.col("rated.rating_raw").alias("trakt_rating_raw"),
        F.col("rated.rated_at").alias("trakt_rated_at"),
        _either("trakt_id").alias("trakt_show_id"),
        _either("slug").alias("trakt_slug"),
        _either("imdb_id").alias("trakt_imdb_id"),
        "watched.status",
        "watched.network",
        F.coalesce("owned.title", _either("title")).alias("title"),
        F.coalesce("rated.rating", zero_to_null("owned.rating")).alias("rating"),
        F.coalesce("owned.genre_labels", "tracker_labels").alias("genres"),
        F.coalesce("owned.runtime_minutes", _either("runtime_minutes")).alias("runtime_minutes"),
        F.coalesce("owned.tmdb_id", _either("tmdb_id")).alias("tmdb_id"),
        F.to_date("watched.last_watched_at").alias("last_watched_date"),
        label_from_flags(flags).alias("source"),
        F.when(flags["trakt"] & flags["moviebuddy"], F.lit("title_year")).alias("match_type"),
        _either("country").alias("tracker_country"),
    )
    rows = attach_creator_country(
        rows, lookups["anime_director_countries"], "director", "director_key", "director_country"
    )
    rows = _resolve_country(
        rows, lookups, ["director_country", "tracker_country"],
        translated=["director_country", "tracker_country"] if strict_reference else None,
    )
    # The join is on the title alone. Two creators of one title would double the row, so by default
    # the latest rating of the title is taken.
    ratings = manual_ratings(lookups, "anime", per_creator=strict_reference)
    rows = attach(rows, ratings, {"title_key": "title_key"}, {"manual_rating": "rating"})
    return rows.withColumns(
        {
            "rating": F.coalesce("rating", "manual_rating"),
            "anime_id": surrogate_key("title", "release_year"),
        }
    ).select(*ANIME_COLUMNS)


def _resolve_country(
    df: DataFrame, lookups: Lookups, sources: list[str], translated: list[str] | None
) -> DataFrame:
    """``country`` and its untranslated form from country columns of falling priority.

    By default the first country present wins and is then translated. With ``translated`` the
    labels of those columns come first, in order, and any untranslated country only after them.
    """
    source = F.coalesce(*sources)
    if translated is None:
        df = df.withColumn("country_source", source)
        df = translate_country(df, lookups, "country_source", "_label")
        return df.withColumn("country", F.coalesce("_label", "country_source"))
    for column in translated:
        df = translate_country(df, lookups, column, f"_label_{column}")
    labels = [F.col(f"_label_{c}") for c in translated]
    origin = [F.when(F.col(f"_label_{c}").isNotNull(), F.col(c)) for c in translated]
    return df.withColumns(
        {
            "country": F.coalesce(*labels, *sources),
            "country_source": F.coalesce(*origin, *sources),
        }
    )
