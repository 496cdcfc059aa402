"""The declared data-quality rules and the three cross-table assertions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions import norm_key, split_csv, split_json, uni_trim
from omnishelf.plans.enrich import Lookups
from omnishelf.plans.marts import DOMAINS, Marts, creator_column

RATING = (0, 5)

# The closed value lists of the relations.
DOMAIN_NAMES = list(DOMAINS)
MOVIE_SOURCES = [
    "trakt_and_letterboxd_and_moviebuddy", "trakt_and_letterboxd", "trakt_and_moviebuddy",
    "letterboxd_and_moviebuddy", "trakt", "letterboxd", "moviebuddy",
]
MUSIC_SOURCES = [
    "musicbuddy_and_bandcamp_and_spotify", "musicbuddy_and_bandcamp", "musicbuddy_and_spotify",
    "bandcamp_and_spotify", "musicbuddy", "bandcamp", "spotify",
]
ANIME_SOURCES = ["trakt_and_moviebuddy", "trakt", "moviebuddy"]
BOOK_SOURCES = ["bookbuddy_and_goodreads", "goodreads", "bookbuddy"]
MEDIA_FORMATS = [
    "cd", "vinyl", "digital", "cd, digital", "cd, vinyl", "vinyl, digital", "cd, vinyl, digital",
]
READING_STATES = ["Read", "Unread", "Reading", "Did Not Finish"]
CONTENT_TYPES = ["Movie", "TV Show"]


@dataclass(frozen=True)
class Rules:
    """What must hold for one relation."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    between: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    accepted: Mapping[str, list[str]] = field(default_factory=dict)
    parent: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    unique_combination: tuple[tuple[str, ...], ...] = ()
    case_insensitive_unique: tuple[str, ...] = ()


def _item(key: str, *required: str, **more) -> Rules:
    return Rules(unique=(key,), not_null=(key, *required), **more)


def _rated(key: str, *required: str, **more) -> Rules:
    return _item(key, *required, between={"rating": RATING}, **more)


def _names(key: str) -> Rules:
    return Rules(
        unique=(key,), not_null=(key, "country"), case_insensitive_unique=(key,)
    )


STAGING_RULES: dict[str, Rules] = {
    "goodreads": _rated("book_id", "title"),
    "bookbuddy": _rated("book_id", "title", accepted={"status": READING_STATES}),
    "letterboxd": _rated("movie_id", "watched_date", "film_name"),
    "moviebuddy": _rated("movie_id", "title", accepted={"content_type": CONTENT_TYPES}),
    "musicbuddy": _rated("album_id", "title", "artist"),
    "bandcamp_collection": _item("album_id", "title", "artist"),
    "bandcamp_wishlist": _item("album_id", "title", "artist"),
    "spotify_saved_albums": _item(
        "album_id", "album_name", "artists", "added_at", "_extracted_at"
    ),
    "spotify_saved_tracks": _item(
        "track_id", "track_name", "artists", "added_at", "_extracted_at"
    ),
    "spotify_followed_artists": _item("artist_id", "artist_name", "_extracted_at"),
    "trakt_watched_movies": _item("movie_id", "title", "_extracted_at"),
    "trakt_watched_shows": _item("show_id", "title", "_extracted_at"),
    "trakt_ratings": Rules(
        unique=("rating_id",),
        not_null=("rating_id", "media_type", "title", "_extracted_at"),
        between={"rating_raw": (1, 10), "rating": RATING},
        accepted={"media_type": ["movie", "show"]},
    ),
}

UNIFIED_RULES: dict[str, Rules] = {
    "books": _rated("book_id", "title"),
    "movies": _rated("movie_id", "title", "source", accepted={"source": MOVIE_SOURCES}),
    "anime": _rated(
        "anime_id", "title", "source",
        accepted={"content_type": ["TV Show"], "source": ANIME_SOURCES},
    ),
    "manga": _rated(
        "manga_id", "title", "source",
        accepted={"category": ["Manga"], "source": ["bookbuddy"]},
    ),
    "music": _rated(
        "album_id", "title", "artist", "source_name", "media_format",
        accepted={"source_name": MUSIC_SOURCES, "media_format": MEDIA_FORMATS},
    ),
}

MART_RULES: dict[str, Rules] = {
    "books_collection": _rated(
        "book_id", "title", accepted={"source": BOOK_SOURCES},
        parent={"book_id": ("books", "book_id")},
    ),
    "movies_collection": _rated(
        "movie_id", "title",
        accepted={"content_type": CONTENT_TYPES, "source": MOVIE_SOURCES},
        parent={"movie_id": ("movies", "movie_id")},
    ),
    "music_collection": _rated(
        "album_id", "title", "artist", "media_format",
        accepted={"source_name": MUSIC_SOURCES, "media_format": MEDIA_FORMATS},
        parent={"album_id": ("music", "album_id")},
    ),
    "manga_collection": _rated(
        "manga_id", "title", accepted={"source": ["bookbuddy"]},
        parent={"manga_id": ("manga", "manga_id")},
    ),
    "anime_collection": _rated(
        "anime_id", "title", accepted={"source": ANIME_SOURCES},
        parent={"anime_id": ("anime", "anime_id")},
    ),
    "country_index": Rules(
        not_null=("country", "domain", "item_id", "item_title"),
        between={"rating": RATING},
        accepted={"domain": DOMAIN_NAMES, "person_role": ["author", "director", "artist"]},
        unique_combination=(("country", "domain", "item_id"),),
    ),
    "media_summary": _item("domain", "total_items", accepted={"domain": DOMAIN_NAMES}),
}

LOOKUP_RULES: dict[str, Rules] = {
    "author_countries": _names("author"),
    "manga_author_countries": _names("author"),
    "director_countries": _names("director"),
    "anime_director_countries": _names("director"),
    "artist_countries": _names("artist"),
    "film_countries": Rules(
        not_null=("title", "release_year", "country"),
        unique_combination=(("title", "release_year"),),
    ),
    "country_iso_codes": Rules(
        unique=("country_name", "iso_alpha3"), not_null=("country_name", "iso_alpha3"),
        case_insensitive_unique=("country_name",),
    ),
    "genre_mapping": Rules(
        not_null=("domain", "raw_genre"), accepted={"domain": DOMAIN_NAMES},
        unique_combination=(("domain", "raw_genre"),),
    ),
    "author_name_mapping": Rules(
        unique=("raw_name",), not_null=("raw_name", "canonical_name"),
        case_insensitive_unique=("raw_name",),
    ),
    "country_name_fr": Rules(
        unique=("country_en",), not_null=("country_en", "country_fr"),
        case_insensitive_unique=("country_en",),
    ),
    "manual_ratings": Rules(
        not_null=("domain", "title", "author_or_director_or_artist", "rating", "rated_at"),
        between={"rating": RATING},
        accepted={"domain": [*DOMAIN_NAMES, "series"]},
        unique_combination=(("domain", "title", "author_or_director_or_artist"),),
    ),
}

ALL_RULES = {**STAGING_RULES, **UNIFIED_RULES, **MART_RULES, **LOOKUP_RULES}


def _bad_rows(rules: Rules) -> dict[tuple[str, str], Column]:
    """Conditions of the rules that look at one row only."""
    bad = {("not_null", c): F.col(c).isNull() for c in rules.not_null}
    bad |= {("between", c): ~F.col(c).between(*ends) for c, ends in rules.between.items()}
    bad |= {("accepted_values", c): ~F.col(c).isin(*v) for c, v in rules.accepted.items()}
    return bad


def _check_relation(
    relation: str, frames: Mapping[str, DataFrame], rules: Rules
) -> DataFrame | None:
    """The report of one relation; None if it has no rules."""
    df = frames[relation]
    names: dict[tuple[str, str], str] = {}

    def key(column: str, kind: str = "value") -> str:
        return names.setdefault((column, kind), f"k{len(names)}")

    # What each rule finds in the group of one key: (check, column, key columns, violations).
    repeats = (F.col("n_rows") > 1).cast("long")
    grouped: list[tuple[str, str, list[str], Column]] = []
    for column in rules.unique:
        k = key(column)
        grouped.append(("unique", column, [k], F.when(F.col(k).isNotNull(), repeats)))
    for column in rules.case_insensitive_unique:
        k = key(column, "spelling")
        found = F.when(F.col(k).isNotNull(), repeats)
        grouped.append(("case_insensitive_unique", column, [k], found))
    for columns in rules.unique_combination:
        ks = [key(column) for column in columns]
        grouped.append(("unique_combination", ", ".join(columns), ks, repeats))
    parents = []
    for column, (parent, parent_column) in rules.parent.items():
        if parent in frames:
            k, n = key(column), len(parents)
            value = F.col(parent_column).cast(df.schema[column].dataType)
            parents.append(frames[parent].select(value.alias(k), F.lit(n).alias("parent_of")))
            orphan = F.col(k).isNotNull() & ~F.col(f"parent_{n}")
            grouped.append(("relationship", column, [k], F.when(orphan, F.col("n_rows"))))
    bad = _bad_rows(rules)
    grouped += [(check, c, [], F.col(f"bad_{i}")) for i, (check, c) in enumerate(bad)]
    if not grouped:
        return None

    rows = df.select(
        *[
            (norm_key(column) if kind == "spelling" else F.col(column)).alias(name)
            for (column, kind), name in names.items()
        ],
        *[F.when(breaks, True).alias(f"bad_{i}") for i, breaks in enumerate(bad.values())],
        F.lit(-1).alias("parent_of"),
    )
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rows, *parents])
    sets = [list(ks) for ks in dict.fromkeys(tuple(ks) for _, _, ks, _ in grouped)]
    every = list(names.values())
    by_key = rows.groupingSets(sets, *every) if every else rows.groupBy()
    groups = by_key.agg(
        F.count(F.when(F.col("parent_of") < 0, True)).alias("n_rows"),
        *[F.count(f"bad_{i}").alias(f"bad_{i}") for i in range(len(bad))],
        *[
            F.max(F.col("parent_of") == n).alias(f"parent_{n}") for n in range(len(parents))
        ],
        (F.grouping_id() if every else F.lit(0)).alias("grouped_by"),
    )

    def of(ks: list[str]) -> Column:
        """Groups by these columns: the grouping id has a bit per column, the first one highest,
        which is set where the column is left out."""
        return F.col("grouped_by") == int("0" + "".join("01"[k not in ks] for k in every), 2)

    totals = groups.agg(
        *[F.sum(F.when(of(ks), found)).alias(f"v{i}") for i, (*_, ks, found) in enumerate(grouped)]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column"),
                F.coalesce(f"v{i}", F.lit(0).cast("long")).alias("violations"),
            )
            for i, (check, column, _, _) in enumerate(grouped)
        ]
    )
    return totals.select(F.explode(entries).alias("e")).select(
        "e.check", F.lit(relation).alias("relation"), "e.column", "e.violations"
    )


def run_checks(
    frames: Mapping[str, DataFrame], rules: Mapping[str, Rules] = ALL_RULES
) -> DataFrame:
    """(check, relation, column, violations) for every rule of the given relations.

    A relation is read once and shuffled once: all its rules are sets of one grouping, uniqueness
    rules by their columns, row rules over all rows, and parent rules by the child's column, with
    the parent's keys as rows that only this set counts. Groups are counted in each task first, so a
    key that repeats millions of times sends one row per task and rule. A parent check is skipped
    when its parent relation is not among ``frames``.
    """
    reports = [_check_relation(r, frames, rules.get(r, Rules())) for r in frames]
    return reduce(DataFrame.unionByName, [report for report in reports if report is not None])


# Where raw genres come from (relation, domain, column, encoding).
GENRE_COLUMNS = [
    ("bookbuddy", "books", "genre", "single"),
    ("moviebuddy", "movies", "genres", "csv"),
    ("musicbuddy", "music", "genres", "csv"),
    ("spotify_followed_artists", "music", "genres", "json"),
    ("trakt_watched_movies", "movies", "genres", "json"),
    ("trakt_watched_shows", "movies", "genres", "json"),
    ("trakt_ratings", "movies", "genres", "json"),
]


def unmapped_genres(staged: Mapping[str, DataFrame], lookups: Lookups) -> DataFrame:
    """(domain, raw_genre) seen in a source and absent from the genre mapping."""
    tokens = {
        "single": lambda c: F.array(c),
        "csv": split_csv,
        "json": split_json,
    }
    seen = [
        staged[relation].filter(F.col(column).isNotNull()).select(
            F.lit(domain).alias("domain"), F.explode(tokens[kind](column)).alias("raw_genre")
        )
        for relation, domain, column, kind in GENRE_COLUMNS
    ]
    return unmapped_tokens(
        reduce(DataFrame.unionByName, seen), lookups["genre_mapping"]
    )


def unmapped_tokens(seen: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct (domain, raw_genre) rows without an entry in the mapping, compared by key."""
    trimmed = seen.select("domain", uni_trim("raw_genre").alias("raw_genre"))
    distinct = trimmed.filter("raw_genre <> ''").distinct()
    mapped = mapping.select("domain", norm_key("raw_genre").alias("raw_genre_key"))
    keyed = distinct.withColumn("raw_genre_key", norm_key("raw_genre"))
    return keyed.join(mapped, ["domain", "raw_genre_key"], "left_anti").drop("raw_genre_key")


def mart_items(marts: Marts) -> DataFrame:
    """(domain, title, creator, title_key, creator_key) of all collection tables."""
    parts = []
    for domain in DOMAINS:
        creator, _ = creator_column(domain)
        parts.append(
            marts[domain].select(
                F.lit(domain).alias("domain"),
                "title",
                creator.alias("creator"),
                norm_key("title").alias("title_key"),
                norm_key(creator).alias("creator_key"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def orphaned_manual_ratings(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Manual ratings that name no item of their domain.

    The few ratings are the left side; the items are first cut down to the keys the ratings name,
    which Spark does with a broadcast, so the large side is not shuffled.
    """
    keyed = ratings.select(
        "domain",
        "title",
        F.col("author_or_director_or_artist").alias("creator"),
        norm_key("title").alias("title_key"),
        norm_key("author_or_director_or_artist").alias("creator_key"),
    )
    keys = ["domain", "title_key", "creator_key"]
    named = items.select(*keys).join(keyed.select(*keys), keys, "left_semi").distinct()
    return keyed.join(named, keys, "left_anti").select("domain", "title", "creator")


def duplicate_items(items: DataFrame, repeat_copies: bool = False) -> DataFrame:
    """Keys held by several items, with the spellings that occur.

    Each spelling is listed once and ``duplicate_count`` tells how many items share the key, so the
    lists stay as short as the number of spellings. ``repeat_copies`` lists a spelling once per
    item; its lists grow with the number of copies. Spellings are counted before the lists are
    made, so a key with very many copies is combined in every task first.
    """
    keys = ["domain", "title_key", "creator_key"]
    named = items.dropna(subset=["title_key", "creator_key"])
    spelled = named.groupBy(*keys, "title", "creator").agg(F.count(F.lit(1)).alias("n"))

    def listed(column: str) -> Column:
        if not repeat_copies:
            return F.array_join(F.sort_array(F.collect_set(column)), " | ")
        pairs = F.sort_array(F.collect_list(F.struct(F.col(column), F.col("n"))))
        repeated = F.transform(pairs, lambda p: F.array_repeat(p[column], p["n"].cast("int")))
        return F.array_join(F.flatten(repeated), " | ")

    return (
        spelled.groupBy(*keys)
        .agg(
            F.sum("n").alias("duplicate_count"),
            listed("title").alias("duplicate_titles"),
            listed("creator").alias("duplicate_creators"),
        )
        .filter("duplicate_count > 1")
    )
