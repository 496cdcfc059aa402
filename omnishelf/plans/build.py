"""Build all tables in dependency order, each stage written once and read back."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from omnishelf.plans.books import unify_books, unify_manga
from omnishelf.plans.marts import (
    DOMAINS,
    anime_collection,
    books_collection,
    country_index,
    manga_collection,
    media_summary,
    movies_collection,
    music_collection,
)
from omnishelf.plans.music import unify_music
from omnishelf.plans.screen import unify_anime, unify_movies
from omnishelf.plans.staging import STAGES
from omnishelf.session import configure
from omnishelf.sources.readers import read_tables
from omnishelf.sources.sinks import clustered, in_threads, land, scratch


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: STAGES[name](df) for name, df in raw.items()}


def unify(
    domain: str,
    staged: Mapping[str, DataFrame],
    lookups: Mapping[str, DataFrame],
    strict_reference: bool = False,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The unified table of one domain; only the sources of that domain are looked up. ``store``
    is for the steps in between, see ``unify_books``."""
    if domain == "books":
        return unify_books(
            staged["bookbuddy"], staged["goodreads"], lookups, strict_reference, store
        )
    if domain == "manga":
        return unify_manga(staged["bookbuddy"], lookups)
    if domain == "movies":
        return unify_movies(
            staged["moviebuddy"], staged["letterboxd"], staged["trakt_watched_movies"],
            staged["trakt_ratings"], lookups, strict_reference, store,
        )
    if domain == "anime":
        return unify_anime(
            staged["moviebuddy"], staged["trakt_watched_shows"], staged["trakt_ratings"],
            lookups, strict_reference, store,
        )
    if domain == "music":
        return unify_music(
            staged["musicbuddy"], staged["bandcamp_collection"], staged["bandcamp_wishlist"],
            staged["spotify_saved_albums"], staged["spotify_followed_artists"], lookups,
            strict_reference,
        )
    raise ValueError(f"unknown domain {domain!r}")


def collect(domain: str, unified: DataFrame, strict_reference: bool = False) -> DataFrame:
    """The collection table of one domain."""
    if domain == "books":
        return books_collection(unified, strict_reference)
    plain = {
        "movies": movies_collection,
        "music": music_collection,
        "manga": manga_collection,
        "anime": anime_collection,
    }
    return plain[domain](unified)


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    lookups: Mapping[str, DataFrame],
    out_dir: str,
    strict_reference: bool = False,
    threads: int = 4,
) -> dict[str, DataFrame]:
    """Write staging, unified, collection and cross-domain tables under ``out_dir``.

    ``out_dir`` must be shared storage. Each layer is stored, so several consumers of one staged
    source read columns of a table instead of running its plan again, and the work of a lost
    executor is repeated from the last stored layer only. Within a layer ``threads`` tables are made
    at a time, so that the last tasks of one do not leave the cluster idle. Tables in between are
    removed at the end. Collections are written in the order of country and id, with a filter of
    their ids, for ``reports``.
    """
    configure(spark)
    folders = {layer: f"{out_dir}/{layer}" for layer in ("staging", "unified", "mart")}

    land(stage_all(raw), folders["staging"], threads=threads)
    staged = read_tables(spark, folders["staging"], raw)

    def domain(name: str, store: Callable[[DataFrame], DataFrame]) -> Callable[[], DataFrame]:
        def make() -> DataFrame:
            rows = unify(name, staged, lookups, strict_reference, store)
            land({name: rows}, folders["unified"])
            done = read_tables(spark, folders["unified"], [name])[name]
            rows = collect(name, done, strict_reference)
            table, key = f"{name}_collection", DOMAINS[name]
            rows = clustered(rows, "country", key)
            land({table: rows}, folders["mart"], bloom={table: [key]})
            return done

        return make

    with scratch(spark, out_dir) as store:
        unified = in_threads(spark, {name: domain(name, store) for name in DOMAINS}, threads)
    tables = read_tables(spark, folders["mart"], [f"{name}_collection" for name in DOMAINS])
    by_domain = {name: tables[f"{name}_collection"] for name in DOMAINS}

    cross = {
        "media_summary": media_summary(by_domain),
        "country_index": country_index(by_domain, lookups, strict_reference),
    }
    land(cross, folders["mart"], threads=threads)
    return {
        **{f"staging.{n}": df for n, df in staged.items()},
        **{f"unified.{n}": df for n, df in unified.items()},
        **{f"mart.{n}": df for n, df in tables.items()},
        **{f"mart.{n}": df for n, df in read_tables(spark, folders["mart"], cross).items()},
    }
