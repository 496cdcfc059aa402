"""Periodic runs against a search of every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from omnishelf.llm import periodic_runs, registry

SF = "/root/testdata/sf0.001"


def all_runs(words):
    """(start, stop, period) of every run, by trying each period at each place."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def report(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = (None,) * 4
    if runs:
        s, e, q = max(runs, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]))
        best = (s, e - s, q, 1000 * (e - s) // q)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, digest(lines), digest(kept))


def words_of(rng):
    """Words of few kinds with stretches that repeat, nest and touch."""
    kinds, words = rng.choice([1, 2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 6)):
        what = rng.random()
        if what < 0.5:
            unit = [rng.randint(1, kinds) for _ in range(rng.randint(1, 14))]
            words += (unit * 90)[: rng.randint(1, 90)]
        elif what < 0.8:
            words += [rng.randint(1, kinds) for _ in range(rng.randint(1, 40))]
        else:
            words += words[-rng.randint(1, 60) :]
    return words


def test_runs_of_many_texts_match_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        texts = [words_of(rng) for _ in range(rng.randint(1, 6))]
        words = np.array([w for t in texts for w in t], np.uint64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        got = list(zip(*(x.tolist() for x in periodic_runs.find_runs(words, owner)), strict=True))
        want, at = [], 0
        for t in texts:
            want += [(s + at, e + at, q) for s, e, q in all_runs(t)]
            at += len(t)
        assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_grammar_spells_every_text():
    rng = random.Random(5)
    for _ in range(30):
        ids = np.array(words_of(rng) + [1, 2] * 20, np.int64)
        grammar = periodic_runs.re_pair(ids, np.zeros(len(ids), np.int64))
        first, middle, last, rule, place = grammar.arrays()
        for r, at in zip(rule, place, strict=True):
            length = last[r] - first[r]
            assert (ids[at : at + length] == ids[first[r] : last[r]]).all()
            assert first[r] < middle[r] < last[r]
        assert (0, len(ids)) in set(zip(first.tolist(), last.tolist(), strict=True))


@pytest.mark.parametrize("plant", [False, True])
def test_reports_match_brute_force(spark, docs, rows, plant):
    got = periodic_runs.periodic_runs(docs, plant=plant, keep_text=False)
    key = lambda r: tuple((v is not None, v) for v in r)
    want = sorted((report(i, t, plant) for i, t in rows), key=key)
    assert sorted(map(tuple, got.collect()), key=key) == want


def test_query_matches_brute_force(spark):
    got = {r[0]: tuple(r) for r in registry.op11_periodic_runs(spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in texts if len(r[1] or "") < 6000]
    assert len(got) == len(texts) and len(short) > 100
    assert all(got[i] == report(i, t, True) for i, t in short)
    assert any(r[1] for r in got.values())


def test_long_text_and_texts_of_one_word(spark):
    words = [str(i) for i in range(40_000)]
    texts = [(1, " ".join(words * 3)), (2, "a " * 100_000), (3, "a\n" * 23), (4, "a\n" * 24)]
    found = periodic_runs.periodic_runs(spark.createDataFrame(texts, "doc_id long, text string"))
    got = {r.doc_id: r for r in found.collect()}
    assert (got[1].start, got[1].length, got[1].period) == (0, 120_000, 40_000)
    assert got[1].collapsed.decode() == " ".join(words)
    assert (got[2].n_runs, got[2].length, got[2].period, got[2].collapsed) == (1, 100_000, 1, b"a")
    assert (got[3].n_runs, got[4].n_runs) == (0, 1)


def test_empty_table(none):
    assert periodic_runs.periodic_runs(none).count() == 0
