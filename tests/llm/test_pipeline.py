"""The pipeline's stages against brute force, on a corpus with every awkward kind of row."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from omnishelf.llm import encoding, quality
from omnishelf.llm.common import BATCH_BYTES, kept_for, ready, stored
from omnishelf.llm.decontamination import EDIT_SHARE, edit_search

LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def fold(text):
    return " ".join((text or "").translate(LOWER).split()).encode()


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    few = {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or few


CLASH = ["gone", "leaked", "_marks", "score", "predicted", "spans", "row", "print", "n_units", "text.x"]


def test_stages_keep_columns_of_any_name(spark, docs, rows, tmp_path_factory):
    """The user's own columns pass unchanged, whatever they are called; ids may be null or repeat."""
    folder = str(tmp_path_factory.mktemp("clash"))
    labels = [(i, int(i % 3 > 0), 0) for i in range(64)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    item = " ".join(dict(rows)[2].split()[3:30])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    more = [(None, f"before it {item} behind it"), (7001, f"and {item} too"), (7001, "clean under one id")]
    mine = spark.createDataFrame(more, "doc_id long, text string")
    mine = docs.select("doc_id", "text").union(mine)
    for i, name in enumerate(CLASH):
        mine = mine.withColumn(name, F.concat_ws("|", F.lit(i), F.coalesce("doc_id", F.lit(0)), "text"))
    mine = stored(mine)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, mine, folder))
        assert out.columns == mine.columns
        found, given = out.collect(), Counter(map(tuple, mine.collect()))
        for r in found:
            for i, c in enumerate(CLASH):
                assert r[c].startswith(f"{i}|{r.doc_id or 0}")
        if name != "substring_dedup":
            assert not Counter(map(tuple, found)) - given
        texts = Counter((r.doc_id, r.text) for r in found)
        if name == "decontamination":
            assert texts[7001, "clean under one id"] == 1
            assert not [t for _, t in texts if item in (t or "")]
        none = stage(spark, mine.limit(0), folder)
        assert none.columns == mine.columns and none.count() == 0


def test_run_removes_its_tables(spark, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("whole"))
    docs.select(*COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.iterdir()}
    result = corpus_pipeline.run(spark, folder)
    assert len({p.name for p in shared.iterdir()} - before) == 1
    assert result.count() > 0


def test_stages(spark, docs, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    unique = docs.select(*COLUMNS).dropDuplicates(["doc_id", "text"])
    unique.write.parquet(f"{folder}/documents.parquet")
    junk = [i for i in range(0, 40, 3)]
    labels = [(i, int(i not in junk), 0) for i in range(64)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    texts = [t for i, t in rows if i is not None and i < 40 and i not in junk and len(t.split()) > 40]
    items = [" ".join(t.split()[5:35]) for t in texts]
    spark.createDataFrame([*enumerate(items), (99, None)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder))
        kept.append(docs.collect())
        if name != "packing":
            assert docs.columns == COLUMNS
    good, near, cut, clean, pieces = kept

    ids = lambda rows: Counter(r.doc_id for r in rows)
    sets = {r.doc_id: shingles(r.text) for r in good if r.doc_id is not None}
    root = {i: i for i in sets}
    def find(x):
        return x if root[x] == x else find(root[x])
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    alone = Counter(r.doc_id for r in good if r.doc_id is None or find(r.doc_id) == r.doc_id)
    assert ids(near) == alone == ids(cut)
    before = {(r.doc_id, len(r.text or "")): r for r in near}
    assert len(before) == len(near)
    for r in cut:
        assert r.n_chars == len(r.text) if r.text is not None else r.n_chars is None
    leaks = [
        r.doc_id
        for r in cut
        if any(edit_search(fold(x), fold(r.text))[0] <= int(EDIT_SHARE * len(fold(x))) for x in items)
    ]
    assert len(leaks) > 3
    assert ids(clean) == Counter(r.doc_id for r in cut if r.doc_id not in leaks)
    tok, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for r in clean:
        x = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(x), 2048):
            want[(r.doc_id, s, zlib.crc32(x[s : s + 2048].tobytes()))] += 1
    assert Counter((p.doc_id, p.start, p.ids_crc32) for p in pieces) == want


def test_workers_get_batches_of_bounded_bytes(spark):
    """Rows of 8 KB: 10,000 of them, Spark's bound, would be one batch of 64 MB."""
    long = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 1600).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["b", "n"])

    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(bound, "1b")
    try:
        spark.conf.unset(bound)
        ready(spark)
        got = long.mapInArrow(sizes, "b long, n long").collect()
        assert max(r.b for r in got) <= BATCH_BYTES * 1.1 and sum(r.n for r in got) == 3000
        spark.conf.set(bound, "3m")
        ready(spark)
        assert spark.conf.get(bound) in ("3m", "3145728", "3145728b")
    finally:
        spark.conf.set(bound, was) if was != "1b" else spark.conf.unset(bound)


def test_a_worker_drops_what_it_kept_for_another_operator():
    path = public_tokenizers.path("byte_bpe_50k.json")
    first = encoding.encoder(path, True)
    assert encoding.encoder(path, True) is first
    assert list(quality._collect(iter([]))) == []
    assert not kept_for("quality") and encoding.encoder(path, True) is not first
