"""Operators on texts against brute force, with nulls, empty, long, repeated and periodic texts."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from omnishelf.llm import (
    decontamination,
    licenses,
    near_dedup,
    packing,
    registry,
    substring_dedup,
    suffix_dedup,
    token_files,
)
from omnishelf.llm.encoding import WordEncoder

LOWER = {c: c + 32 for c in range(65, 91)}
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def brute_removed(rows, length):
    """Counts of every string; rows of equal id and text count each."""
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        mask = np.cumsum(gone)[: len(b)] > 0
        edges = np.diff(np.concatenate([[0], mask.astype(int), [0]]))
        kept = bytes(np.frombuffer(b, np.uint8)[~mask])
        out.append((i, len(b), int(mask.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize(("length", "gram", "shard"), [(400, 128, 512), (60, 20, 3)])
def test_suffix_dedup(docs, rows, length, gram, shard):
    got = suffix_dedup.remove_repeats(docs, length=length, gram=gram, shard_regions=shard)
    found = got.collect()
    assert Counter(tuple(r)[:5] for r in found) == brute_removed(rows, length)
    texts = Counter((i, t or "") for i, t in rows)
    for r in found:
        whole = [t for i, t in texts if i == r.doc_id and len(t.encode()) == r.n_bytes]
        kept = [_without(t, r.spans).decode(errors="ignore") for t in whole]
        assert r.text in kept


def test_suffix_dedup_query_returns_the_columns_of_its_sql(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["op1_suffix_array_dedup"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _without(text, spans):
    body, out, last = text.encode(), b"", 0
    for s in spans:
        out, last = out + body[last : s.start], s.stop
    return out + body[last:]


@pytest.mark.parametrize("length", [500, 700])
def test_suffix_dedup_of_longer_strings(docs, rows, length):
    got = suffix_dedup.remove_repeats(docs, length=length, gram=128, shard_regions=2).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute_removed(rows, length)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 99, n).astype(np.uint8) for n in (300, 1, 57, 300)]
    data = np.concatenate(texts)
    ends = np.repeat(np.cumsum([len(t) for t in texts]), [len(t) for t in texts])
    order, place = suffix_dedup.suffix_array(data, ends, 400)
    suffixes = [bytes(data[i : ends[i]]) for i in order]
    assert suffixes == sorted(suffixes) and (order[place] == np.arange(len(data))).all()
    first = np.cumsum([0, *[len(t) for t in texts[:-1]]])
    shared = suffix_dedup.common_prefixes(data, order, place, first, np.array([len(t) for t in texts]), ends, 9)
    for i in range(len(data)):
        a, b = bytes(data[i : ends[i]]), b""
        if place[i]:
            j = order[place[i] - 1]
            b = bytes(data[j : ends[j]])
        want = next((k for k in range(10) if k == 9 or k >= min(len(a), len(b)) or a[k] != b[k]), 0)
        assert shared[i] == want


def _passages(rng, alphabet, size, length):
    """Texts that share passages longer than ``length``, each going on differently behind them."""
    pool = ["".join(rng.choices(alphabet, k=rng.randint(length, 3 * length))) for _ in range(4)]
    def piece():
        p = rng.choice(pool)
        a = rng.randrange(len(p) // 2)
        return p[a : rng.randint(a + 1, len(p))]
    glue = lambda: "".join(rng.choices(alphabet, k=rng.randint(0, length)))
    return ["".join(piece() + glue() for _ in range(rng.randint(1, 4))) for _ in range(size)]


@pytest.mark.parametrize("length", [9, 20, 400])
def test_repeated_strings_of_passages_that_go_on_differently(length):
    rng = random.Random(length)
    for _ in range(60 if length < 400 else 6):
        texts = [t.encode() for t in _passages(rng, "ab" if length < 400 else "abc", 12, length)]
        count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
        want = [[count[t[i : i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]
        got = suffix_dedup.repeated_strings([np.frombuffer(t, np.uint8) for t in texts], length)
        assert [g.tolist() for g in got] == want


def test_suffix_dedup_of_passages_that_go_on_differently(spark):
    rows = list(enumerate(_passages(random.Random(3), "ab", 150, 400)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(frame).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute_removed(rows, 400)


def test_licenses(spark, docs, rows):
    lines = ["Under the MIT-License", "under the mit license under the mit license", "apache license version 20",
             "Licenced under the Apache License, Version 2.0", "CC BY NC 4.0", "licensed under CC BY 4.0", "cc by  nc"]
    more = rows + [(2000 + i, t) for i, t in enumerate(lines)]
    frame = spark.createDataFrame(more, "doc_id long, text string")
    got = {(r.doc_id, r.n_words): r for r in licenses.scan_licenses(frame).collect()}
    for i, t in more:
        words = licenses.WORD.findall((t or "").translate(LOWER))
        places, labels = [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            found = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        r = got[i, len(words)]
        assert (r.n_base, r.first_word, r.last_word) == (len(places), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted(labels)) and labels <= {*r.labels.split(",")} and 0 <= r.score <= 1
    assert got[2003, 8].labels == "apache-2" and got[2003, 8].notices[0].edits == 1
    assert got[2005, 6].labels == "cc-by"


def test_adjacent_notices_are_all_found():
    scan = licenses.Scanner().fuzzy
    names = lambda line: sorted((lo, licenses.NOTICES[n], e) for n, lo, e in
                                ((list(licenses.NOTICES)[i], lo, e) for i, lo, _, e in scan(line)))
    two = names("licenced under the mit license licensed under the mit license")
    assert two == [(0, "mit", 1), (31, "mit", 0)]
    text = "the gnu general public {} version"
    line = f"licenced under {text.format('licence')} 3 licensed under {text.format('license')} 2"
    assert {label for _, label, _ in names(line)} == {"gpl-2", "gpl-3"}


def least_edits(notice, text):
    """Least edits between the notice and any stretch of words of the text that starts at each
    word: (start, stop, edits)."""
    cuts = [0, *[m.end() for m in re.finditer(" ", text)]]
    ends = [*[c - 1 for c in cuts[1:]], len(text)]
    out = []
    for n, lo in enumerate(cuts):
        row = list(range(len(notice) + 1))
        best = (len(notice), lo)
        for j, c in enumerate(text[lo : lo + len(notice) + 12]):
            last, row[0] = row[0], j + 1
            for k, d in enumerate(notice):
                last, row[k + 1] = row[k + 1], min(row[k + 1] + 1, row[k] + 1, last + (c != d))
            if lo + j + 1 in ends[n:]:
                best = min(best, (row[-1], lo + j + 1))
        out.append((lo, best[1], best[0]))
    return out


def test_fuzzy_notices_match_a_scan_of_all_windows():
    """A notice is found wherever some window is within the edits and agrees in its marks."""
    rng = random.Random(12)
    scanner = licenses.Scanner()
    letters = "aeinrst"
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            text = list(rng.choice([*licenses.NOTICES]))
            for _ in range(rng.randint(0, 6)):
                at = rng.randrange(len(text))
                if text[at] not in " 0123456789":
                    text[at] = rng.choice(["", rng.choice(letters), text[at] + rng.choice(letters)])
            parts += ["".join(text), *rng.choices(["word", "by", "license", "public", "3"], k=rng.randint(0, 3))]
        line = " ".join(" ".join(parts).split())
        hits = scanner.fuzzy(line)
        for i, (notice, _) in enumerate(scanner.notices):
            marks = licenses._MARK.findall(notice)
            mine = [(lo, hi) for n, lo, hi, e in hits if n == i]
            for n, lo, hi, e in hits:
                assert n != i or e <= scanner.edits[i]
            for lo, hi, edits in least_edits(notice, line):
                if edits <= scanner.edits[i] and marks == licenses._MARK.findall(line[lo:hi]):
                    assert any(a < hi and lo < b for a, b in mine), (line, notice, line[lo:hi])


def test_long_text_of_edited_notices_takes_linear_time():
    scanner = licenses.Scanner()
    took = []
    for n in (2_000, 16_000):
        text = "licenced under the mit licence " * n
        start = time.process_time()
        found = scanner.scan(text)
        took.append(time.process_time() - start)
        assert len(found[-1]) == n and found[-1][-1]["first_word"] == 5 * (n - 1)
    assert took[1] < 16 * took[0]


def test_substring_dedup(docs, rows):
    out = substring_dedup.dedup_units(docs)
    assert out.columns[:6] == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r)
    texts = dict(reversed(rows))
    seen, last = set(), {}
    for i in sorted(k for k in texts if k is not None):
        r = got[i][0]
        body = (texts[i] or "").encode()
        kept, at = b"", 0
        for s in r.spans:
            kept += body[at : s.start]
            at = s.stop
            # What goes stands in an earlier document, or earlier in this one, word for word.
            gone = " ".join(body[s.start : s.stop].decode().translate(LOWER).split())
            before = " ".join(" ".join(last.values()).split())
            own = " ".join(body[: s.start].decode().translate(LOWER).split())
            pieces = re.split(r"(?<=[.!?]) ", gone)
            assert all(p in before or p in own or p in gone for p in pieces)
        assert (r.text or "").encode() == kept + body[at:]
        assert r.n_removed == len(body) - len(kept + body[at:])
        last[i] = (texts[i] or "").translate(LOWER)
        seen.add(i)
    assert got[40][0].n_removed == 0
    assert all(got[i][0].text == "" for i in range(41, 52))
    firsts = [i for i in range(64, 69) if got[i][0].n_removed == 0]
    assert firsts == [64] and all(got[i][0].n_removed > 300 for i in range(65, 69))
    assert all(r.n_removed == 0 for r in got[None])
    assert got[75][0].n_removed > 700


def test_substring_dedup_removes_every_later_line(spark):
    rng = random.Random(6)
    few = ["Yes.", "It is. No.", "same nine words of a line that comes often", "a  B", "one two. three four. five"]
    texts = []
    for i in range(60):
        lines = [rng.choice(few) if rng.random() < 0.5 else f"only here {i} {k}" for k in range(8)]
        texts.append("\n".join(x.upper() if rng.random() < 0.2 else x for x in lines))
    out = substring_dedup.dedup_units(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"))
    got, seen = {r.doc_id: r for r in out.collect()}, set()
    fold = lambda t: " ".join(t.lower().split())
    for i, text in enumerate(texts):
        want = []
        for x in map(fold, text.split("\n")):
            want += [] if x in seen else [x]
            seen.add(x)
        assert [fold(x) for x in got[i].text.split("\n") if x.strip()] == want


def test_passages_are_cut_alike_in_any_line(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, least = [], {}
    for i in range(300):
        words = [word() for _ in range(51)]
        for k in range(0, 51, 20) if i % 3 == 1 else range(0, 51, 10) if i % 3 == 2 else ():
            words[k] += "."
        rows += [(2 * i, f"{text(rng.randint(0, 40))} {' '.join(words)} {text(rng.randint(0, 40))}"),
                 (2 * i + 1, f"{text(rng.randint(1, 40))} {' '.join(words)} {text(rng.randint(1, 40))}")]
        # All but less than a window of words at either end is removed.
        inner = " ".join(words[16:-16])
        least[2 * i + 1] = len(inner) if i % 3 == 0 else 40
    for k, stop in enumerate(["\u3002", "\u0964", ".\u201d", "\u061f"]):
        wide = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(30)) if k == 0 else text(12)
        for j in (0, 1):
            rows.append((1000 + 2 * k + j, f"{text(3)}{stop}{' ' * (k > 1)}{wide}{stop} {text(4)}"))
        least[1001 + 2 * k] = len(wide.encode())
    out = substring_dedup.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.n_removed for r in out.collect()}
    assert all(got[i] >= n for i, n in least.items())
    assert all(n == 0 for i, n in got.items() if i not in least)


def test_packing(docs, rows):
    got = packing.pack(docs, BYTE_BPE, window=64, group_pieces=50).toPandas()
    tok = Tokenizer.from_file(BYTE_BPE)
    want = Counter()
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(ids), 64):
            piece = ids[s : s + 64]
            want[(i, s, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    cells = got[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].astype(object)
    cells = cells.where(cells.notna(), None)
    assert Counter(map(tuple, cells.values.tolist())) == want
    filled = got.groupby("sequence_id")["length"].sum()
    assert filled.max() <= 64
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g["offset"].to_numpy() == np.concatenate([[0], np.cumsum(g["length"])[:-1]])).all()


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 101, 500))[::-1]
    where, offset = packing.best_fit(lengths, 100)
    room = {}
    for n, w, o in zip(lengths, where, offset, strict=True):
        fits = [r for r in room.values() if r >= n]
        assert (room.get(w, 100) == min(fits)) if fits else w not in room
        assert o == 100 - room.get(w, 100)
        room[w] = room.get(w, 100) - n


@pytest.mark.parametrize(("path", "blanks"), [(BYTE_BPE, True), (WORD_BPE, False)])
def test_encoder_equals_library(rows, path, blanks):
    tok, mine = Tokenizer.from_file(path), WordEncoder(path, blanks, entries=50)
    odd = ["a  b", " a", "b\n", "x\n\ny z", "it's <|endoftext|> so", "İ| Σ ς", "é é", "\x1c a\x85b", "12 3.4,"]
    for t in [t for _, t in rows if t] + odd:
        want = np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert mine.encode(t) == want and mine.encode(t) == want


def test_token_files(docs, rows):
    files = token_files.write_files(docs, WORD_BPE, end_id=2, keeps_blanks=False)
    got = token_files.read_files(files).collect()
    tok, start = Tokenizer.from_file(WORD_BPE), 0
    assert len(got) == len(rows)
    ids = Counter()
    for i, t in rows:
        x = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        ids[(i, len(x), zlib.crc32(x.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == ids
    got.sort(key=lambda r: r.start)
    for r in got:
        assert r.start == start
        start += r.n_tokens
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_simple8b_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        for top in (1, 2, 300, 1 << 16, 1 << 31, 1 << 60):
            ids = rng.integers(0, top, n).astype(np.uint64) >> rng.integers(0, 30, n).astype(np.uint64)
            words, first = token_files.encode_ids(ids)
            assert (token_files.decode_ids(words, first, n) == ids).all()
    with pytest.raises(ValueError, match="60 bits"):
        token_files.encode_ids(np.array([1 << 60], np.uint64))


def test_decontamination(spark, docs, rows):
    texts = dict(rows)
    def item(i, a, b):
        return " ".join(texts[i].split()[a:b])
    edited = item(5, 0, 30).replace("ka", "kq", 2)
    items = [(1, item(2, 0, 25)), (2, edited), (3, "nowhere to be found in any of these texts at all"),
             (4, None), (5, ""), (6, "two words"), (6, "two words"), (7, item(40, 100, 140).upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(docs, bench).collect()
    pairs = {(r.doc_id, r.item_id): r for r in got}
    want = set()
    fold = lambda t: " ".join((t or "").translate(LOWER).split()).encode()
    for i, t in rows:
        for k, x in items:
            body = fold(x)
            if body:
                edits = int(decontamination.EDIT_SHARE * len(body)) if len(body) >= 32 else 0
                if decontamination.edit_search(body, fold(t))[0] <= edits:
                    want.add((i, k))
    assert {*pairs} == want and (5, 2) in want and (2, 1) in want and (40, 7) in want
    r = pairs[2, 1]
    assert fold(texts[2].encode()[r.start : r.stop].decode()) == fold(items[0][1]) and r.edits == 0


@pytest.mark.parametrize("kind", ["insert", "delete", "replace", "mixed", "front"])
def test_decontamination_finds_edits_up_to_the_bound(spark, kind):
    rng = random.Random(kind)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items, rows = [], []
    for i in range(60):
        body = text(rng.randint(6, 60)).ljust(decontamination.LEAST_BYTES, "k")
        items.append((i, body))
        body, edits = list(body), int(decontamination.EDIT_SHARE * len(body))
        # "front": as dense as the edits can stand over the first half.
        places = sorted(rng.sample(range(len(body)), edits), reverse=True)
        if kind == "front":
            places = range(6 * edits - 6, -1, -6)
        for k in places:
            how = rng.choice(["insert", "delete", "replace"]) if kind in ("mixed", "front") else kind
            body[k : k + (how != "insert")] = [] if how == "delete" else ["z"]
        rows.append((i, f"{text(20)} {''.join(body)} {text(20)}"))
    got = decontamination.contaminated(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    fold = lambda t: " ".join(t.split()).encode()
    # Where blanks meet, the text may be beyond the bound.
    want = {(i, i) for i in range(60) if decontamination.edit_search(fold(items[i][1]), fold(rows[i][1]))[0]
            <= int(decontamination.EDIT_SHARE * len(fold(items[i][1])))}
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) > 50


def test_decontamination_with_repeated_and_null_item_ids(spark):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(20 + 9 * i)) for i in range(4)]
    items = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (None, "few words"), (1, "y z")]
    rows = [(i, f"before {t} behind") for i, t in enumerate(texts)] + [(9, "few words, y z, " + " ".join(texts))]
    got = decontamination.contaminated(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    want = Counter({(0, 1): 1, (1, 1): 1, (2, None): 1, (3, None): 1, (9, 1): 3, (9, None): 3})
    assert Counter((r.doc_id, r.item_id) for r in got.collect() if r.edits == 0) == want


def test_near_duplicates(docs, rows):
    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        few = {tuple(words)} if words else set()
        sets[i, t] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or few
    ids = {i: s for (i, _), s in sets.items() if i is not None}
    root = {i: i for i in ids}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in ids:
        for b in ids:
            both = len(ids[a] & ids[b])
            if a < b and both and 100 * both >= 75 * len(ids[a] | ids[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(ids[r.doc_id]), find(r.doc_id))
            assert r.kept == (r.doc_id == r.component_id)


def test_empty_tables(spark, none):
    bench = spark.createDataFrame([(1, "x")], "item_id long, text string")
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert licenses.scan_licenses(none).count() == 0
    assert substring_dedup.dedup_units(none).count() == 0
    assert packing.pack(none, BYTE_BPE).count() == 0
    assert token_files.read_files(token_files.write_files(none, WORD_BPE, 2, False)).count() == 0
    assert decontamination.contaminated(none, bench).count() == 0
    assert decontamination.contaminated(none, bench.limit(0)).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0


def test_unrelated_documents_share_no_band():
    """Bands of unrelated sets never meet, so candidates do not grow with the square of the corpus."""
    rng = np.random.default_rng(9)
    seen = [set() for _ in range(near_dedup.BANDS)]
    with np.errstate(over="ignore"):
        for _ in range(20_000):
            sketch = near_dedup.sketch(np.unique(rng.integers(0, 1 << 63, 60, np.uint64) * np.uint64(2)))
            bands = sketch[near_dedup.REGISTERS :].reshape(near_dedup.BANDS, -1)
            for known, band in zip(seen, bands, strict=True):
                band = band.tobytes()
                assert band not in known
                known.add(band)


@pytest.mark.parametrize("kind", ["insert", "delete", "replace", "mixed"])
def test_tables_alone_reach_the_target_recall(spark, kind):
    """Items of the benchmark with as many scattered edits as are allowed, by the tables' keys only."""
    rng = random.Random(kind)
    table = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    items = [(i, t) for i, t in table.select("item_id", "text").orderBy("item_id").collect()]
    bench = decontamination.Benchmark(items)
    found = total = 0
    for embedding, _, mine, keys, order in bench.classes:
        texts = []
        for _, body in mine:
            text, edits = [*body], int(decontamination.EDIT_SHARE * len(body))
            for at in sorted(rng.sample(range(len(text)), edits), reverse=True):
                how = rng.choice(["insert", "delete", "replace"]) if kind == "mixed" else kind
                text[at : at + (how != "insert")] = [] if how == "delete" else [rng.randint(97, 122)]
            texts.append(bytes(text) + b" and other words behind" + bytes(embedding.steps))
        sizes = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        got = embedding.keys(data, np.cumsum(sizes) - sizes)
        own = np.empty_like(keys)
        np.put_along_axis(own, order, keys, axis=1)
        found, total = found + int((got == own).any(axis=0).sum()), total + len(mine)
    print(f"{kind}: the tables alone propose {found / total:.3f}")
    assert total > 150 and found >= 0.95 * total


def test_key_search_finds_what_each_table_finds():
    """One search over the keys of all tables against a comparison table by table."""
    rng = np.random.default_rng(9)
    keys = rng.integers(0, 40, (decontamination.TABLES, 30)).astype(np.int64) - 20
    asked = rng.integers(0, 400, (decontamination.TABLES, 50)).astype(np.int64) - 20
    items = rng.permutation(30) + 7
    window, item = decontamination.Keys(keys, items).matches(asked)
    table, w, k = np.nonzero(asked[:, :, None] == keys[:, None, :])
    assert len(table) and {*zip(window.tolist(), item.tolist())} == {*zip(w.tolist(), items[k].tolist())}
    assert len(window) == len(table)


def test_walks_taken_together_give_the_keys_of_each():
    """Keys from the definition, walk by walk and window by window."""
    rng = np.random.default_rng(10)
    embedding = decontamination.Embedding(40, 3)
    data = rng.integers(97, 123, 200).astype(np.uint8)
    starts = np.array([0, 5, 5, 90])
    got = embedding.keys(data, starts)
    for t in range(decontamination.TABLES):
        for n, at in enumerate(starts.tolist()):
            key = 0
            for step in range(embedding.steps):
                byte = int(data[at])
                if t in embedding.picks[step]:
                    key = (key * int(embedding.weights[t]) + byte + 1) % (1 << 64)
                at += int(embedding.moves[t % decontamination.WALKS, step, byte])
            assert int(got[t, n]) % (1 << 64) == key


def test_candidates_take_no_step_per_proposal(monkeypatch):
    """Proposals of the tables are sorted out by arrays, not one search of the bounds each."""
    item = "a question about rivers of the north, their length and the cities near them"
    bench = decontamination.Benchmark([(1, item)])
    rows = [f"{item} and row {i} has other words behind".encode() for i in range(100)]
    ends = np.cumsum([0, *map(len, rows)])
    data, bounds, _ = decontamination.normalise(np.frombuffer(b"".join(rows), np.uint8), ends)
    starts = np.flatnonzero(np.append(True, data[:-1] == 32))
    padded = np.append(data, np.zeros(500, np.uint8))
    calls, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **k: calls.append(1) or search(*a, **k))
    found = bench.candidates(data, bounds, starts, padded)
    assert {r for r, *_ in found} == {*range(100)} and len(calls) < 30
    monkeypatch.undo()
    for none in (b"", b"nothing of the kind"):
        data, ends = np.frombuffer(none, np.uint8), np.array([0, len(none)])
        padded = np.append(data, np.zeros(500, np.uint8))
        for items in ([(1, item)], [(2, "short")], []):
            some = decontamination.Benchmark(items)
            assert some.candidates(data, ends, np.arange(min(1, len(none))), padded) == []
