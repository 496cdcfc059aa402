"""How the registered queries read, land and store what they share, on hand-made tables."""

import threading
from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F

from verification import model_queries, operator_queries
from verification.derived import working_folder


def test_collections_are_made_several_at_a_time(spark, monkeypatch):
    running, met = [], threading.Event()

    def collection(d, domain, strict):
        running.append(domain)
        if len(running) > 1:
            met.set()
        assert met.wait(5), "the others wait for this one"
        return domain

    monkeypatch.setattr(model_queries, "collection", collection)
    monkeypatch.setattr(model_queries, "stored", lambda df, folder: df)
    d = SimpleNamespace(spark=spark, tables={name: None for name in model_queries.SHARED})
    made = model_queries.collections(d)
    assert made == {name: name for name in model_queries.marts.DOMAINS}


def test_landed_payloads_are_small_compressed_files(spark, monkeypatch):
    monkeypatch.setattr(operator_queries, "PAYLOAD_ROWS", 10)
    before = set(_landed(spark))
    rows = spark.range(0, 95, 1, 1).select(F.concat(F.lit("n"), "id").alias("name"))
    artist = F.struct(F.array(F.struct("name")).alias("items"))
    pages = operator_queries._payload(rows, "followed_artists", artists=artist)
    names = pages.select(F.explode("artists.items").alias("a")).select("a.name")
    assert {r[0] for r in names.collect()} == {f"n{i}" for i in range(95)}
    files = [f for f in set(_landed(spark)) - before if f.name.startswith("part-")]
    assert len(files) == 10 and {f.suffix for f in files} == {".lz4"}


def _landed(spark):
    return Path(working_folder(spark).removeprefix("file:")).glob("landed-*/*")
