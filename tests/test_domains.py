"""The whole build on hand-made inputs, with both settings of ``strict_reference``."""

import hashlib
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from omnishelf.functions.keys import NULL_FIELD
from omnishelf.plans import build as plans
from omnishelf.plans import marts, quality
from omnishelf.sources.readers import read_tables
from omnishelf.sources.sinks import land, scratch
from tests import fixtures
from tests.conftest import plan_of, rows


@pytest.fixture(scope="module")
def lookups(spark):
    return {n: df.cache() for n, df in fixtures.lookups(spark).items()}


def make(spark, lookups, tmp_path_factory, strict, order=lambda r: r):
    raw = fixtures.raw_sources(spark, order)
    out = str(tmp_path_factory.mktemp("build"))
    return plans.build(spark, raw, lookups, out, strict)


@pytest.fixture(scope="module")
def ours(spark, lookups, tmp_path_factory):
    return make(spark, lookups, tmp_path_factory, False)


@pytest.fixture(scope="module")
def strict(spark, lookups, tmp_path_factory):
    return make(spark, lookups, tmp_path_factory, True)


def by_title(frame, *columns):
    """Values per lower-case title; a title that occurs twice keeps a list."""
    out = {}
    for r in frame.orderBy(*frame.columns).collect():
        out.setdefault(r.title.strip().lower(), []).append(tuple(r[c] for c in columns))
    return {t: v[0] if len(v) == 1 else v for t, v in out.items()}


def test_staging(ours):
    books = by_title(ours["staging.bookbuddy"].filter("isbn = '111'"), "rating", "tags")
    assert books == {"dune": (4.0, "desert")}
    years = dict(rows(ours["staging.goodreads"], "book_id", "year_published"))
    assert years == {"g1": 1965, "g2": 1966, "g3": None, "g4": 2001, "g5": 1817}
    isbn = dict(rows(ours["staging.goodreads"], "book_id", "isbn"))
    assert isbn["g1"] == "111" and isbn["g3"] is None and isbn["g4"] is None
    assert ours["staging.letterboxd"].filter("watched_date IS NULL").count() == 1
    assert ours["staging.musicbuddy"].count() == 5


def test_digests_are_made_after_the_shuffle(spark):
    """Ids do not compress: rows are dealt and sorted by the text under the id."""
    for name in ("bookbuddy", "musicbuddy", "bandcamp_collection"):
        staged = plans.STAGES[name](fixtures.raw_sources(spark)[name])
        above, below = plan_of(staged).split("Exchange", 1)
        assert "md5(" in above and "md5(" not in below, name


def test_rows_of_one_id_are_one_row_whatever_their_fields(spark):
    """The text under an id does not tell its fields apart, and a NULL stands as a text."""
    shelf = [("A-B", "C", "1", "2024-01-01"), ("A", "B-C", "1", "2024-01-03")]
    shelf += [("A", None, "x", "2024-01-02"), (None, None, None, None), (None, None, "", None)]
    names = ["Title", "Artist", "discogs Release ID", "Date Added"]
    raw = spark.createDataFrame(shelf, ", ".join(f"`{n}` string" for n in names)).withColumns(
        {c: F.lit(None).cast("string") for c in ("Genres", "Release Year", "Rating")}
    )
    got = plans.STAGES["musicbuddy"](raw)
    assert rows(got, "title", "artist") == [(None, None), ("A", None), ("A", "B-C")]
    assert got.columns[0] == "album_id"
    texts = ["A-B-C-1", "A-%s-%s" % (2 * (NULL_FIELD,)), "-".join(3 * [NULL_FIELD])]
    ids = {hashlib.md5(t.encode()).hexdigest() for t in texts}
    assert {r.album_id for r in got.collect()} == ids


def test_books(ours):
    got = by_title(
        ours["unified.books"], "goodreads_id", "match_type", "rating", "genre", "country"
    )
    assert got == {
        # One ISBN on two rows: the smaller id is taken, the other counts as matched.
        "dune": ("g1", "isbn", 4.0, "SF", "États-Unis"),
        "emma": ("g3", "title_author", 3.5, None, "Angleterre"),
        # The variant spelling of the author joins; of the two entries the one with an ISBN stays.
        "persuasion": ("g5", "title_author", None, "Roman", "Angleterre"),
        "solo": ("g4", None, None, None, "Atlantis"),
        "unrated": (None, None, 2.5, "SF", None),
    }
    mart = by_title(ours["mart.books_collection"], "rating", "source", "is_rated")
    assert mart["dune"] == (5.0, "bookbuddy_and_goodreads", True)
    assert mart["emma"] == (3.5, "bookbuddy_and_goodreads", True)
    assert mart["solo"] == (4.0, "goodreads", True)
    assert mart["unrated"] == (2.5, "bookbuddy", True)


def test_books_strict(strict):
    got = by_title(strict["unified.books"], "goodreads_id", "match_type", "rating", "category")
    # A blank category loses the first app's row; the second app's row remains alone.
    assert got["emma"] == ("g3", None, 3.5, None)
    # Zero is a rating, so no manual rating is taken; raw author spellings stay apart.
    assert got["unrated"] == (None, None, 0.0, "Book")
    assert got["persuasion"] == [
        ("g5", "title_author", None, "Book"), ("g5", "title_author", 3.0, "Book"),
    ]
    mart = by_title(strict["mart.books_collection"], "rating", "is_rated")
    assert mart["emma"] == (0.0, True) and mart["unrated"] == (None, False)


def test_manga(ours):
    got = by_title(ours["unified.manga"], "rating", "genre", "country", "country_source", "source")
    assert got == {
        "akira": (4.5, "Seinen", "Japon", "Japan", "bookbuddy"),
        "nana": (5.0, None, None, None, "bookbuddy"),
    }


def test_movies(ours):
    m = ours["unified.movies"]
    got = by_title(m.filter("release_year IS NOT NULL"), "source", "rating", "match_type")
    assert got == {
        "heat": ("trakt_and_letterboxd_and_moviebuddy", 5.0, "title_year"),
        "owned only": ("moviebuddy", 1.5, None),
        "owned tracker": ("trakt_and_moviebuddy", None, "title_year"),
        "diary owned": ("letterboxd_and_moviebuddy", 2.0, "title_year"),
        "diary only": ("letterboxd", None, None),
        "diary tracker": ("trakt_and_letterboxd", 3.0, "title_year"),
        "tracker only": ("trakt", 2.0, None),
        "rated only": ("trakt", 3.0, None),
        "unknown show": ("moviebuddy", 2.0, None),
        "untyped": ("moviebuddy", 2.0, None),
    }
    # Without a year nothing matches, and both rows have the same id.
    loose = rows(m.filter("release_year IS NULL"), "source", "movie_id")
    assert [s for s, _ in loose] == ["letterboxd", "moviebuddy"] and len({i for _, i in loose}) == 1
    dates = by_title(m, "first_watched_date", "last_watched_date", "watch_count")
    assert dates["heat"] == (date(2024, 1, 1), date(2024, 3, 1), 5)
    assert dates["tracker only"] == (date(2020, 5, 5), date(2020, 5, 5), 1)
    assert dates["owned only"] == (None, None, 0)
    genres = by_title(m, "genres")
    assert genres["owned tracker"] == ("Action,Suspense",)
    assert genres["tracker only"] == ("Suspense",) and genres["owned only"] == (None,)
    country = by_title(m, "country", "country_source")
    assert country["heat"] == ("États-Unis", "United States")
    assert country["tracker only"] == ("Japon", "Japan")
    assert country["diary owned"] == ("Atlantis", "Atlantis")
    assert country["diary only"] == ("France", "France")


def test_movies_strict(strict):
    m = strict["unified.movies"]
    titles = by_title(m, "source")
    assert "unknown show" not in titles and "untyped" not in titles
    assert by_title(m, "genres")["owned tracker"] == ("Action,Suspense,Suspense",)
    country = by_title(m, "country")
    # A translated film country beats the director's untranslated one; tracker names stay as is.
    assert country["diary owned"] == ("France",) and country["tracker only"] == ("Japan",)


def test_anime(ours, strict):
    columns = ("source", "rating", "country", "watch_count", "last_watched_date")
    got = by_title(ours["unified.anime"], *columns)
    assert got == {
        "cartoon": ("trakt_and_moviebuddy", 4.0, "Atlantis", 4, date(2024, 2, 1)),
        "anime two": ("trakt", None, "Japon", 1, None),
        "rated anime": ("trakt", 4.0, "us", None, None),
    }
    watched = by_title(ours["mart.anime_collection"], "is_watched", "is_rated")
    assert watched["cartoon"] == (True, True) and watched["anime two"] == (False, False)
    # The strict join on the title alone gives one row per creator of a manual rating.
    twice = by_title(strict["unified.anime"], "rating", "country")["cartoon"]
    assert sorted(twice) == [(1.0, "Japon"), (4.0, "Japon")]


def test_music(ours):
    got = by_title(
        ours["unified.music"], "source_name", "media_format", "bandcamp_origin", "rating",
        "match_type", "country",
    )
    assert got == {
        "all three": (
            "musicbuddy_and_bandcamp_and_spotify", "cd, digital", "collection, wishlist",
            4.0, "title_artist", "Allemagne",
        ),
        "shelf only": ("musicbuddy", "cd", None, 3.0, None, None),
        "shelf shop": ("musicbuddy_and_bandcamp", "cd, digital", "collection", None,
                       "title_artist", None),
        "shelf stream": ("musicbuddy_and_spotify", "cd, digital", None, 3.0, "title_artist", None),
        "shop only": ("bandcamp", "digital", "collection", None, None, "France"),
        "shop stream": ("bandcamp_and_spotify", "digital", "collection", None, "title_artist",
                        "France"),
        "stream only": ("spotify", "digital", None, None, None, "Allemagne"),
        "wish": ("bandcamp", "digital", "wishlist", None, None, "France"),
    }
    more = by_title(ours["unified.music"], "release_year", "genres", "discogs_release_id", "artist")
    assert more["stream only"] == (2023, "Rock", None, "Ayo, Guest")
    # The smaller key of two releases describes the album; the larger release id is kept.
    assert more["all three"] == (2006, "Folk et monde,Rock", 2, "Ayo (2)")
    assert more["shelf stream"] == (1999, "Rock", 5, "Trio")
    shown = by_title(ours["mart.music_collection"], "artist", "is_rated")
    assert shown["all three"] == ("Ayo", True)


def test_album_rows_are_narrow_in_the_roll_up(spark, ours, lookups):
    """What the chosen row tells is added after the shuffle that all rows take, with ids packed."""
    staged = {n.split(".")[1]: df for n, df in ours.items() if n.startswith("staging.")}
    plan = plan_of(plans.unify("music", staged, lookups))
    above, below = plan.split("Exchange hashpartitioning(title_key", 1)
    assert "artist_display" in above and "artist_display" not in below
    assert "unhex(" in below and "unhex(" not in above


def test_music_strict(strict):
    genres = by_title(strict["unified.music"], "genres", "rating")
    assert genres["all three"] == ("Folk et monde,Folk et monde,Rock", 4.0)
    assert genres["shelf only"] == (None, 0.0)
    assert by_title(strict["mart.music_collection"], "rating")["shelf only"] == (None,)


def test_cross_domain(ours, strict):
    summary = {r.domain: r for r in ours["mart.media_summary"].collect()}
    assert set(summary) == {"books", "movies", "music", "manga", "anime"}
    assert (summary["books"].total_items, summary["books"].items_pending) == (5, 0)
    assert summary["movies"].items_consumed + summary["movies"].items_pending == 12
    assert summary["music"].items_consumed is None and summary["manga"].items_pending is None
    codes = {(r.country, r.iso_alpha3) for r in ours["mart.country_index"].collect()}
    assert ("États-Unis", "USA") in codes and ("Atlantis", None) in codes and ("Japon", "JPN") in codes
    old = {(r.country, r.iso_alpha3) for r in strict["mart.country_index"].collect()}
    assert ("États-Unis", None) in old and ("France", "FRA") in old


def test_summary_of_nothing(spark, ours):
    empty = {d: ours[f"mart.{d}_collection"].filter("false") for d in marts.DOMAINS}
    got = {r.domain: r for r in marts.media_summary(empty).collect()}
    assert len(got) == 5 and got["books"].total_items == 0 and got["books"].avg_rating is None
    assert got["anime"].items_consumed == 0 and got["music"].items_consumed is None


def test_result_does_not_depend_on_row_order(spark, lookups, tmp_path_factory, ours):
    rng = random.Random(3)
    shuffled = make(spark, lookups, tmp_path_factory, False, lambda r: rng.sample(r, len(r)))
    for name, frame in ours.items():
        if not name.startswith("staging."):
            assert rows(frame) == rows(shuffled[name]), name


def test_every_source_row_lands_once(ours):
    books = ours["staging.bookbuddy"]
    assert books.count() == 7
    assert ours["unified.manga"].count() + ours["unified.books"].filter(
        "goodreads_id IS NULL OR match_type IS NOT NULL"
    ).count() == 7 - 1  # two spellings of one book share a row
    movies = ours["staging.moviebuddy"].count()
    kept = sum(
        ours[f"unified.{d}"].filter("source LIKE '%moviebuddy%'").count() for d in ("movies", "anime")
    )
    assert kept == movies


def test_build_leaves_named_tables_only(spark, lookups, tmp_path):
    plans.build(spark, fixtures.raw_sources(spark), lookups, str(tmp_path), threads=3)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["mart", "staging", "unified"]
    tables = {p.parent.name for p in tmp_path.glob("*/*/CURRENT")}
    assert {p.name for p in tmp_path.glob("*/*")} == tables
    assert len(tables) == 13 + 5 + 5 + 2


def test_screen_plans_read_stored_steps(spark, lookups, tmp_path):
    """What is read twice is stored first: the plan that is left reads few tables."""
    raw = fixtures.raw_sources(spark)
    land({n: plans.STAGES[n](df) for n, df in raw.items()}, str(tmp_path))
    staged = read_tables(spark, str(tmp_path), raw)
    with scratch(spark, str(tmp_path)) as store:
        for domain in ("movies", "anime"):
            for strict in (False, True):
                plan = plan_of(plans.unify(domain, staged, lookups, strict, store))
                assert plan.count("FileScan") <= 12, (domain, strict)


def test_rows_of_their_own_are_not_grouped_for_labels(spark, ours, lookups, tmp_path):
    """Shelf rows and keys of the tracker take labels by their text: the shelf is not shuffled by id,
    and the histories are folded once."""
    staged = {n.split(".")[1]: df for n, df in ours.items() if n.startswith("staging.")}
    seen = []
    with scratch(spark, str(tmp_path)) as store:

        def watched(df):
            seen.append(plan_of(df))
            return store(df)

        for domain in ("movies", "anime"):
            plans.unify(domain, staged, lookups, False, watched)
    spines = [plan for plan in seen if "tracker_labels" in plan]
    assert [plan.count("Exchange hashpartitioning(match_key") for plan in spines] == [1, 1]
    assert "hashpartitioning(album_id" not in plan_of(plans.unify("music", staged, lookups))


def test_checks_read_each_relation_once(ours, lookups):
    frames = {"movies": ours["unified.movies"], "movies_collection": ours["mart.movies_collection"]}
    plan = plan_of(quality.run_checks(frames))
    # One scan and one shuffle per relation, and the keys of the one parent that is asked for.
    assert plan.count("FileScan") == 3
    assert plan.count("Exchange hashpartitioning") == 2


def test_checks_on_the_build(spark, ours, lookups):
    frames = {n.split(".", 1)[1]: df for n, df in ours.items()} | lookups
    found = {
        (r.check, r.relation, r.column): r.violations
        for r in quality.run_checks(frames).filter("violations > 0").collect()
    }
    assert found == {
        ("not_null", "letterboxd", "watched_date"): 1,
        ("unique", "movies", "movie_id"): 1,
        ("unique", "movies_collection", "movie_id"): 1,
        ("not_null", "manual_ratings", "author_or_director_or_artist"): 1,
    }


def test_cross_table_assertions(ours, lookups):
    staged = {n.split(".")[1]: df for n, df in ours.items() if n.startswith("staging.")}
    assert set(rows(quality.unmapped_genres(staged, lookups))) == {
        ("books", "Seinen"), ("books", "Unknown"), ("movies", "Anime"), ("movies", "Crime"),
        ("movies", "Noise"), ("movies", "drama"), ("movies", "x"), ("music", "jazz"),
    }
    by_domain = {d: ours[f"mart.{d}_collection"] for d in marts.DOMAINS}
    items = quality.mart_items(by_domain)
    orphans = rows(quality.orphaned_manual_ratings(items, lookups["manual_ratings"]))
    assert orphans == [
        ("anime", "Cartoon", "Somebody Else"), ("books", "Wish", "Band"),
        ("movies", "Tracker Only", None),
    ]


def test_duplicates_list_spellings_or_copies(spark):
    data = [("d", "A", "X")] * 3 + [("d", "a ", "x"), ("d", "B", "Y"), ("d", None, "X")]
    df = spark.createDataFrame(data, "domain string, title string, creator string")
    items = df.withColumns(
        {"title_key": F.lower(F.trim("title")), "creator_key": F.lower(F.trim("creator"))}
    )
    assert rows(quality.duplicate_items(items)) == [("d", "a", "x", 4, "A | a ", "X | x")]
    assert rows(quality.duplicate_items(items, repeat_copies=True)) == [
        ("d", "a", "x", 4, "A | A | A | a ", "X | X | X | x")
    ]


def test_plans_have_no_pairwise_joins(spark, ours, lookups):
    staged = {n.split(".")[1]: df for n, df in ours.items() if n.startswith("staging.")}
    for domain in marts.DOMAINS:
        plan = plan_of(plans.unify(domain, staged, lookups))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, domain
        assert "Python" not in plan, domain
