"""Books and manga: two reading apps, matched by ISBN and then by title and author."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnishelf.functions import norm_key, surrogate_key, zero_to_null
from omnishelf.operators import attach, attach_creator_country, first_per_key, match_passes
from omnishelf.operators import unique_lookup
from omnishelf.plans.enrich import (
    Lookups,
    attach_manual_rating,
    genre_labels,
    translate_country,
)

BOOK_COLUMNS = [
    "book_id", "title", "author", "genre", "category", "rating", "isbn", "tags", "goodreads_id",
    "year_published", "publisher", "goodreads_rating", "match_type", "country", "country_source",
]
MANGA_COLUMNS = [
    "manga_id", "title", "author", "genre", "category", "isbn", "tags", "source", "rating",
    "country", "country_source",
]


def is_manga() -> F.Column:
    return F.col("category") == "Manga"


def books_only(bookbuddy: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Rows without a category are books; the strict setting loses them, as NULL passes no test."""
    manga = is_manga() if strict_reference else F.coalesce(is_manga(), F.lit(False))
    return bookbuddy.filter(~manga)


def _with_author_key(df: DataFrame, lookups: Lookups) -> DataFrame:
    names = unique_lookup(
        lookups["author_name_mapping"],
        {"raw_key": norm_key("raw_name")},
        ["canonical_name"],
    )
    keyed = df.withColumns({"title_key": norm_key("title"), "raw_author_key": norm_key("author")})
    named = attach(keyed, names, {"raw_key": "raw_author_key"}, {"_canonical": "canonical_name"})
    author_key = F.coalesce(norm_key("_canonical"), "raw_author_key")
    return named.withColumn("author_key", author_key).drop("_canonical")


def unify_books(
    bookbuddy: DataFrame,
    goodreads: DataFrame,
    lookups: Lookups,
    strict_reference: bool = False,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per (title, author), with the columns of both apps where they match.

    The books of both apps get their canonical author and their manual rating in one step, on the
    union. ``store`` writes a relation and reads it back: it is applied to that union and to the
    state after the first match pass, which are read several times.
    """
    keep = "raw_author_key" if strict_reference else "author_key"
    zero_counts = F.lit(strict_reference)
    sides = {"left": books_only(bookbuddy, strict_reference).drop("status"), "right": goodreads}
    rows = [
        df.select("title", "author", F.struct(*df.columns).alias(side))
        for side, df in sides.items()
    ]
    enriched = attach_manual_rating(
        _with_author_key(rows[0].unionByName(rows[1], allowMissingColumns=True), lookups),
        lookups, "books", "title_key", "author_key",
    )
    if store is not None:
        enriched = store(enriched)
    keys = ["title_key", "raw_author_key", "author_key", "manual_rating"]
    left, right = (
        enriched.filter(F.col(side).isNotNull()).select(f"{side}.*", *keys) for side in sides
    )
    # The rating that ranks duplicates is the final one, manual fallback included.
    own = F.when(zero_counts, F.col("rating")).otherwise(zero_to_null("rating"))
    left = left.withColumn("rating", F.coalesce(own, "manual_rating")).drop("manual_rating")

    def missing(column: str) -> F.Column:
        return F.col(column).isNull()

    def squeeze(rows: DataFrame) -> DataFrame:
        """Within one output key and match state only the best row can survive; dropping the rest
        here keeps a very common title from reaching the next join."""
        order = [missing("isbn"), missing("rating"), F.col("book_id")]
        return first_per_key(rows, ["title_key", keep, missing("match_type")], order)

    matched, right_rest = match_passes(
        left,
        right,
        {"isbn": ["isbn"], "title_author": ["title_key", "author_key"]},
        right_id="book_id",
        squeeze=squeeze,
        store=store,
        take=["year_published", "publisher", "rating"],
    )
    keys = ["title_key", "raw_author_key", "author_key"]
    from_left = matched.select(
        *["book_id", "title", "author", "genre", "category", "rating", "isbn", "tags"],
        F.col("right.book_id").alias("goodreads_id"),
        "right.year_published",
        "right.publisher",
        F.col("right.rating").alias("goodreads_rating"),
        "match_type",
        *keys,
    )
    right_rows = right_rest.select(
        surrogate_key("title", "author").alias("book_id"),
        *["title", "author"],
        F.col("manual_rating").alias("rating"),
        "isbn",
        F.col("book_id").alias("goodreads_id"),
        *["year_published", "publisher"],
        F.col("rating").alias("goodreads_rating"),
        *keys,
    )
    both = from_left.unionByName(right_rows, allowMissingColumns=True)
    order = [missing("match_type"), missing("goodreads_id"), missing("isbn"), missing("rating")]
    order += [F.col("book_id"), F.col("goodreads_id")]
    one = first_per_key(both, ["title_key", keep], order)

    labelled = attach(
        one, genre_labels(lookups, "books"), {"token_key": norm_key("genre")}, {"_label": "label"}
    )
    located = attach_creator_country(
        labelled, lookups["author_countries"], "author", "author_key", "country_source"
    )
    translated = translate_country(located, lookups, "country_source", "_country_label")
    return translated.withColumns(
        {
            "genre": F.col("_label"),
            "country": F.coalesce("_country_label", "country_source"),
        }
    ).select(*BOOK_COLUMNS)


def unify_manga(bookbuddy: DataFrame, lookups: Lookups) -> DataFrame:
    keyed = bookbuddy.filter(is_manga()).withColumns(
        {"title_key": norm_key("title"), "author_key": norm_key("author")}
    )
    labelled = attach(
        keyed, genre_labels(lookups, "manga"), {"token_key": norm_key("genre")}, {"_label": "label"}
    )
    located = attach_creator_country(
        labelled, lookups["manga_author_countries"], "author", "author_key", "country_source"
    )
    translated = translate_country(located, lookups, "country_source", "_country_label")
    rated = attach_manual_rating(translated, lookups, "manga", "title_key", "author_key")
    return rated.withColumns(
        {
            "manga_id": F.col("book_id"),
            "genre": F.col("_label"),
            "source": F.lit("bookbuddy"),
            "rating": F.coalesce(zero_to_null("rating"), "manual_rating"),
            "country": F.coalesce("_country_label", "country_source"),
        }
    ).select(*MANGA_COLUMNS)
