import json
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from omnishelf.plans.reports import filter_collection, find_items
from omnishelf.sources import payloads, versions
from omnishelf.sources.readers import (
    _files_by_header,
    read_exports,
    read_lookups,
    read_payload,
    read_tables,
)
from omnishelf.sources.schemas import LOOKUPS
from omnishelf.sources.sinks import clustered, land, overwrite, scratch, shared_folder, stored
from tests.conftest import rows

RUN_AT = "2024-05-01 09:30:00"


def landed(spark, tmp_path, kind, *documents):
    path = tmp_path / f"{kind}.json"
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return read_payload(spark, str(path), kind)


def test_exports_by_header_name(spark, tmp_path):
    (tmp_path / "bookbuddy.csv").write_text(
        'Extra,Title,Author,Rating,ISBN,Tags\n'
        'x,"A ""quoted"" title, with comma","Line\nbreak",4.5,0143,\n'
    )
    frames = read_exports(spark, str(tmp_path))
    row = frames["bookbuddy"].first()
    assert row["Title"] == 'A "quoted" title, with comma' and row["Author"] == "Line\nbreak"
    assert row["ISBN"] == "0143" and row["Tags"] is None and row["Date Added"] is None
    assert "Extra" not in frames["bookbuddy"].columns
    assert frames["goodreads"].count() == 0 and len(frames["goodreads"].columns) == 24


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "moviebuddy.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("Title,Content Type,Rating\nA,Movie,4\n")
    (folder / "b.csv").write_text("Title,Rating,Content Type\nB,5,Movie\n")
    (folder / "c.csv").write_text("")
    films = read_exports(spark, str(tmp_path), multi_line=False)["moviebuddy"]
    assert rows(films, "Title", "Content Type", "Rating") == [("A", "Movie", "4"), ("B", "Movie", "5")]


def test_lookups_must_be_there_and_well_formed(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_lookups(spark, str(tmp_path))
    _write_lookups(tmp_path)
    (tmp_path / "film_countries.csv").write_text("title,release_year,country\nMother,soon,\n")
    with pytest.raises(Exception, match="release_year is no bigint: soon"):
        read_lookups(spark, str(tmp_path))["film_countries"].collect()


def _write_lookups(folder):
    for name, ddl in LOOKUPS.items():
        (folder / f"{name}.csv").write_text(",".join(p.split()[0] for p in ddl.split(", ")) + "\n")


def test_lookups_are_typed(spark, tmp_path):
    _write_lookups(tmp_path)
    (tmp_path / "film_countries.csv").write_text("title,release_year,country\nMother,2009,\n")
    (tmp_path / "genre_mapping.csv").write_text(
        'domain,raw_genre,normalized_genre\nmusic,"Folk, World, & Country",Folk\n'
    )
    frames = read_lookups(spark, str(tmp_path))
    assert rows(frames["film_countries"]) == [("Mother", 2009, None)]
    assert frames["genre_mapping"].first().raw_genre == "Folk, World, & Country"
    assert frames["manual_ratings"].count() == 0


def test_saved_albums(spark, tmp_path):
    album = {
        "id": "a1", "name": "N", "artists": [{"id": "i1", "name": "X"}, {"id": "i2", "name": "Y"}],
        "release_date": "2023", "release_date_precision": "year", "total_tracks": 3, "new": {},
    }
    page = {"items": [{"added_at": "2024-01-01T10:00:00Z", "album": album}], "next": None}
    row = payloads.flatten_saved_albums(landed(spark, tmp_path, "saved_albums", page), RUN_AT).first()
    assert (row.artists, row.artist_ids, row.genres) == ("X, Y", '["i1","i2"]', "[]")
    assert str(row.added_at) == "2024-01-01 10:00:00" and str(row._extracted_at) == RUN_AT


def test_saved_tracks_skip_local_files(spark, tmp_path):
    track = {
        "id": "t1", "name": "T", "artists": [{"id": "i", "name": "X"}],
        "album": {"id": "al", "name": "A"}, "duration_ms": 5,
    }
    page = {"items": [{"track": track}, {"track": None}, {"track": {**track, "id": None}}]}
    features = landed(
        spark, tmp_path, "audio_features", {"id": "t1", "energy": 0.5}, {"id": "t1", "energy": 0.5}
    )
    got = payloads.flatten_saved_tracks(landed(spark, tmp_path, "saved_tracks", page), features, RUN_AT)
    assert rows(got, "track_id", "explicit", "energy", "tempo") == [("t1", False, 0.5, None)]


def test_followed_artists(spark, tmp_path):
    page = {
        "artists": {
            "items": [
                {"id": "1", "name": "A", "genres": ["rock"], "followers": {"total": 7}},
                {"id": "2", "name": "B", "followers": None},
            ]
        }
    }
    got = payloads.flatten_followed_artists(
        landed(spark, tmp_path, "followed_artists", page), RUN_AT
    )
    assert rows(got, "artist_id", "genres", "followers") == [("1", '["rock"]', 7), ("2", "[]", None)]


def test_watched_and_ratings(spark, tmp_path):
    movie = {"title": "M", "year": 2000, "ids": {"trakt": 1, "slug": "m"}, "genres": []}
    watched = landed(spark, tmp_path, "watched_movies", {"plays": 2, "movie": movie}, {"plays": 1})
    got = payloads.flatten_watched_movies(watched, RUN_AT)
    assert rows(got, "trakt_movie_id", "slug", "imdb_id", "plays", "genres") == [
        (None, None, None, 1, "[]"), (1, "m", None, 2, "[]"),
    ]
    movies = landed(spark, tmp_path, "movie_ratings", {"rating": 7, "movie": movie})
    shows = landed(spark, tmp_path, "show_ratings", {"rating": None, "show": movie})
    both = payloads.flatten_ratings(movies, shows, RUN_AT)
    assert rows(both, "media_type", "rating_raw", "rating") == [("movie", 7, 3.5), ("show", None, None)]


def test_fan_items_keep_raw_json(spark, tmp_path):
    item = {
        "album_title": "", "item_title": "T", "band_name": None, "artist": "", "odd": [1],
        "selling_band_name": "S", "item_url": "u", "token": "k", "purchased": "p", "tralbum_id": 5,
    }
    page = {"items": [item], "more_available": False}
    row = payloads.flatten_fan_items(landed(spark, tmp_path, "fan_items", page), RUN_AT).first()
    assert (row.title, row.artist, row.added_at, row.tralbum_id) == ("T", "S", "p", 5)
    assert row.raw_json == json.dumps(item, sort_keys=True, separators=(",", ":"))


def test_canonical_json(spark):
    texts = ['{"b": {"z": [3, {"y": 1, "x": null}], "a": "\u00e9\\n"}, "a": true}', "no json", None, '{"a":1,"a":2}']
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(payloads.canonical_json("t"))
    assert [r[0] for r in got.collect()] == [
        '{"a":true,"b":{"a":"é\\n","z":[3,{"x":null,"y":1}]}}', "no json", None, '{"a":1,"a":2}',
    ]


def test_sinks(spark, tmp_path):
    a, b = spark.range(3), spark.range(2)
    none = spark.range(0)
    assert land({"a": a, "b": b, "c": none}, str(tmp_path), dry_run=True) == {"a": 3, "b": 2, "c": 0}
    assert not (tmp_path / "a").exists()
    assert land({"a": a, "b": b}, str(tmp_path), tables=["a"]) == {"a": 3}
    assert not (tmp_path / "b").exists()
    assert land({"a": b, "b": a, "c": none}, str(tmp_path), threads=3) == {"a": 2, "b": 3, "c": 0}
    found = read_tables(spark, str(tmp_path), ["a", "b", "c"])
    assert [found[n].count() for n in "abc"] == [2, 3, 0]


def test_a_failed_load_leaves_the_old_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    overwrite(spark.range(5), table)
    before = versions.read_current(spark, table)
    broken = spark.range(100).selectExpr("IF(id = 77, raise_error('stop'), id) AS id")
    with pytest.raises(Exception, match="stop"):
        overwrite(broken, table)
    assert versions.read_current(spark, table).count() == 5
    assert len(list(tmp_path.glob("t/version-*"))) == 1
    # A table may be made from itself, and a reader of the version before goes on.
    assert overwrite(versions.read_current(spark, table).union(spark.range(2)), table) == 7
    assert versions.read_current(spark, table).count() == 7 and before.count() == 5
    overwrite(spark.range(1), table)
    assert len(list(tmp_path.glob("t/version-*"))) == 2


def test_vacuum_removes_what_no_pointer_names(spark, tmp_path):
    table = str(tmp_path / "t")
    overwrite(spark.range(5), table)
    spark.range(9).write.parquet(f"{table}/version-left-behind")
    assert versions.vacuum(spark, table) == []
    assert versions.vacuum(spark, table, older_than_seconds=-5) == ["version-left-behind"]
    assert versions.read_current(spark, table).count() == 5
    assert versions.vacuum(spark, str(tmp_path / "none")) == []


def test_plain_folders_are_read_as_they_are(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "p"))
    assert read_tables(spark, str(tmp_path), ["p"])["p"].count() == 4


def test_scratch_is_removed(spark, tmp_path):
    with scratch(spark, str(tmp_path)) as store:
        assert store(spark.range(3)).count() == 3
        assert len(list(tmp_path.glob("scratch-*/stored-*"))) == 1
    with pytest.raises(ValueError), scratch(spark, str(tmp_path)) as store:
        store(spark.range(3))
        raise ValueError
    assert not list(tmp_path.iterdir())


def jobs_of(spark, call):
    """Number of Spark jobs that a call starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "count")
    try:
        call()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_take_one_job_however_many_files(spark, tmp_path):
    counts = []
    for n in (2, 30):
        folder = tmp_path / f"{n}" / "letterboxd.csv"
        folder.mkdir(parents=True)
        for i in range(n):
            head = "Date,Name,Year" if i % 2 else "\nName,Year,Date"
            row = "2024-01-01,Film,1999" if i % 2 else "Film,1999,2024-01-01"
            (folder / f"{i:02}.csv").write_text(f"{head}\n" + f"{row}\n" * 300)
        counts.append(jobs_of(spark, lambda f=folder: _files_by_header(spark, str(f))))
        films = read_exports(spark, str(tmp_path / f"{n}"), multi_line=False)["letterboxd"]
        assert films.count() == 300 * n
        assert rows(films.distinct(), "Date", "Name", "Year") == [("2024-01-01", "Film", "1999")]
    assert counts == [1, 1]


def test_files_of_any_name_are_read(spark, tmp_path):
    folder = tmp_path / "letterboxd.csv"
    folder.mkdir()
    for i, name in enumerate(("a b.csv", "c%20d.csv", "é+ü.csv")):
        (folder / name).write_text(f"Date,Name\n2024-01-0{i + 1},X\n")
    films = read_exports(spark, str(tmp_path), multi_line=False)["letterboxd"]
    assert rows(films, "Date") == [("2024-01-01",), ("2024-01-02",), ("2024-01-03",)]


def rows_read(df):
    """Rows that a plan of one scan and a filter takes from its files."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_clustered_tables_skip_row_groups(spark, tmp_path):
    table = str(tmp_path / "items")
    items = spark.range(200_000).selectExpr(
        "md5(cast(id AS string)) AS item_id",
        "concat('country ', IF(id % 3 = 0, 0, id % 20)) AS country", "uuid() AS title",
    )
    small = {"parquet.block.size": "200000", "parquet.enable.dictionary": "false"}
    overwrite(clustered(items, "country", "item_id"), table, ["item_id"], small)
    found = versions.read_current(spark, table)
    by_country = filter_collection(found, country="country 7")
    n = by_country.count()
    assert n <= rows_read(by_country) < 30_000
    wanted = [r.item_id for r in by_country.limit(2).collect()] + ["not there"]
    by_id = find_items(found, "item_id", wanted)
    assert by_id.count() == 2 and rows_read(by_id) < 60_000


def test_stored_steps_take_half_of_a_digest(spark, tmp_path):
    ids = spark.range(0, 50_000, 1, 1).select(F.md5(F.col("id").cast("string")).alias("id"))
    found = stored(ids, str(tmp_path))
    assert found.exceptAll(ids).isEmpty() and found.count() == 50_000
    assert sum(f.stat().st_size for f in tmp_path.glob("stored-*/part-*")) < 22 * 50_000


def test_stored_uses_the_named_folder(spark):
    df = stored(spark.range(5))
    assert df.count() == 5
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_folder(spark) in f for f in df.inputFiles())
