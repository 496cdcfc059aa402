"""Runs of repeating words, found over a grammar of the text.

Re-Pair replaces frequent pairs of word ids by nonterminals until no pair repeats; what is left of a
text is paired up to one root. Every run lies across the boundary of the lowest nonterminal that
holds it, so the runs across each nonterminal's boundary are computed once, at its first place,
carried to all its places in the text and merged: a run that a nonterminal's ends cut short lies
inside the whole one and goes.

Only zones are parsed, the stretches of a text whose strings of eight words stand more than once in
it. A run of 24 words with three periods is made of nothing else, so no run is lost; texts without a
zone have none.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnishelf.llm.common import NOT_SPACE, mix, prefix_hash, ready, span_hash, steps, word_spans

LEAST = 24  # words of a run
TIMES = 3  # periods of a run
GRAM = 8  # words whose string stands twice wherever a run is: at most LEAST - 2 * GRAM + 1 apart
SEED = 4  # words that a run repeats on one side of any boundary inside it
# Words that one parse takes; a longer text makes a parse of its own.
STEP_BYTES = 1 << 20


def _joined(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, stop), one range after the other."""
    sizes = stops - starts
    total = int(sizes.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return np.arange(total, dtype=np.int64) + shift


def zones(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the zones; ``text`` numbers each word's text, in order."""
    n = len(words)
    if n < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        grams = mix(text[: n - GRAM + 1].astype(np.uint64))
        for t in range(GRAM):
            grams = mix(grams) * np.uint64(3) + words[t : n - GRAM + 1 + t]
    grams = mix(grams)
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    again = np.zeros(n - GRAM + 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    again[:-1] &= text[: n - GRAM + 1] == text[GRAM - 1 :]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], again)).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    # Stretches of neighbouring texts must not run into one another.
    cut = np.flatnonzero(text[1:] != text[:-1]) + 1
    cut = cut[np.searchsorted(starts, cut, side="right") > np.searchsorted(stops, cut, side="left")]
    cut = np.setdiff1d(cut, starts)
    starts, stops = np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((stops, cut)))
    long = stops - starts + GRAM - 1 >= LEAST
    return starts[long], stops[long] + GRAM - 1


class Grammar:
    """Rules with the place, boundary and end of their first occurrence, and all their places."""

    def __init__(self):
        self.first: list[np.ndarray] = []
        self.middle: list[np.ndarray] = []
        self.last: list[np.ndarray] = []
        self.rule: list[np.ndarray] = []
        self.place: list[np.ndarray] = []
        self.n = 0

    def add(self, rule: np.ndarray, start: np.ndarray, middle: np.ndarray, stop: np.ndarray):
        """New rules, numbered from 0 in ``rule``, with all the places where they stand."""
        _, at = np.unique(rule, return_index=True)
        self.first.append(start[at])
        self.middle.append(middle[at])
        self.last.append(stop[at])
        self.rule.append(rule + self.n)
        self.place.append(start)
        self.n += len(at)

    def arrays(self):
        return [np.concatenate(x) if x else np.zeros(0, np.int64)
                for x in (self.first, self.middle, self.last, self.rule, self.place)]


def re_pair(ids: np.ndarray, zone: np.ndarray) -> Grammar:
    """The grammar of all zones at once; no id stands in two zones.

    A round replaces every pair that repeats and is more frequent than all pairs that share a symbol
    with it somewhere (equal counts are told apart by a hash), which is what replacing one pair after
    the other would come to, in few rounds. Of equal symbols in a row every second pair counts. Then
    the rest of each zone is paired up, neighbour by neighbour, to its root.
    """
    grammar = Grammar()
    n = len(ids)
    symbols, starts = ids.astype(np.int64), np.arange(n, dtype=np.int64)
    stops, owner = starts + 1, zone
    fresh = int(ids.max()) + 1 if n else 0

    def replace(at: np.ndarray, rule: np.ndarray):
        nonlocal symbols, starts, stops, owner, fresh
        grammar.add(rule, starts[at], starts[at + 1], stops[at + 1])
        symbols[at] = fresh + rule
        fresh += int(rule.max()) + 1
        stops[at] = stops[at + 1]
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        symbols, starts, stops, owner = (x[stays] for x in (symbols, starts, stops, owner))

    while len(symbols) > 1:
        left, right = symbols[:-1], symbols[1:]
        keys = left * fresh + right
        alike = left == right
        counted = np.ones(len(keys), bool)
        if alike.any():
            # The place of each pair in its row of equal symbols; odd places overlap even ones.
            begins = alike & ~np.concatenate(([False], alike[:-1]))
            since = np.arange(len(keys)) - np.maximum.accumulate(
                np.where(begins, np.arange(len(keys)), 0)
            )
            counted = ~alike | (since % 2 == 0)
        pairs, pair = np.unique(keys, return_inverse=True)
        counts = np.bincount(pair, weights=counted, minlength=len(pairs)).astype(np.int64)
        if counts.max() < 2:
            break
        order = np.lexsort((mix(pairs.astype(np.uint64)), counts))
        rank = np.empty(len(pairs), np.int64)
        rank[order] = np.arange(len(pairs))
        rank[counts < 2] = -1
        mine = rank[pair]
        beaten = np.zeros(len(pairs), bool)
        beaten[pair[:-1][mine[:-1] < mine[1:]]] = True
        beaten[pair[1:][mine[1:] < mine[:-1]]] = True
        chosen = (counts >= 2) & ~beaten
        at = np.flatnonzero(chosen[pair] & counted)
        replace(at, (np.cumsum(chosen) - 1)[pair[at]])
    while len(symbols) > 1:
        begins = np.concatenate(([True], owner[1:] != owner[:-1]))
        place = np.arange(len(owner)) - np.maximum.accumulate(
            np.where(begins, np.arange(len(owner)), 0)
        )
        at = np.flatnonzero((place[:-1] % 2 == 0) & (owner[:-1] == owner[1:]))
        if not len(at):
            break
        replace(at, np.arange(len(at)))
    return grammar


class Extensions:
    """How far equal words go on from two places, forwards and backwards.

    names[k] numbers the strings of 2**k words, equal numbers for equal strings, so the answers are
    exact.
    """

    def __init__(self, ids: np.ndarray, longest: int):
        self.n = len(ids)
        self.names = [ids.astype(np.int64)]
        while 2 << (len(self.names) - 1) <= longest:
            names, half = self.names[-1], 1 << (len(self.names) - 1)
            keys = names[: self.n - 2 * half + 1] * (int(names.max()) + 1) + names[half : self.n - half + 1]
            self.names.append(np.unique(keys, return_inverse=True)[1].astype(np.int64))

    def forwards(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words from a (the later place) on that equal those from b on."""
        length = np.zeros(len(a), np.int64)
        for k in [*range(len(self.names) - 1, -1, -1)]:
            names = self.names[k]
            while True:
                i = a + length
                fits = i < len(names)
                same = np.zeros(len(a), bool)
                same[fits] = names[i[fits]] == names[(b + length)[fits]]
                if not same.any():
                    break
                length[same] += 1 << k
                if k < len(self.names) - 1:
                    break
        return length

    def backwards(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words before a (the later place) that equal those before b."""
        length = np.zeros(len(a), np.int64)
        for k in [*range(len(self.names) - 1, -1, -1)]:
            names = self.names[k]
            while True:
                j = b - length - (1 << k)
                fits = j >= 0
                same = np.zeros(len(a), bool)
                same[fits] = names[(a - length - (1 << k))[fits]] == names[j[fits]]
                if not same.any():
                    break
                length[same] += 1 << k
                if k < len(self.names) - 1:
                    break
        return length


def crossing(first, middle, last, extend: Extensions):
    """Runs across the boundaries of rules: (rule, start, stop, period) at the rules' first places.

    On one side of the boundary a run has half its length, so the SEED words next to the boundary
    stand one period further on that side as well: those places give the periods to try.
    """
    grams = extend.names[SEED.bit_length() - 1]
    big = np.flatnonzero(last - first >= LEAST)
    if not len(big) or not len(grams):
        return [np.zeros(0, np.int64)] * 4
    lo, mid, hi = first[big], middle[big], last[big]
    most = (hi - lo) // TIMES
    n = len(grams)
    order = np.lexsort((np.arange(n), grams))
    listed = grams[order] * (n + 1) + order  # places by string, then in order

    def tried(seed, low, high):
        """(rule, place) of the seeds' other places in [low, high)."""
        ok = (seed >= 0) & (seed < n) & (low < high)
        rules = np.flatnonzero(ok)
        key = grams[seed[ok]] * (n + 1)
        a = np.searchsorted(listed, key + np.maximum(low[ok], 0))
        b = np.searchsorted(listed, key + np.minimum(high[ok], n))
        b = np.maximum(a, b)
        return np.repeat(rules, b - a), order[_joined(a, b)]

    before = mid - SEED
    left, place = tried(before, np.maximum(lo, before - most), np.where(before >= lo, before, 0))
    right, place_r = tried(np.where(mid + SEED <= hi, mid, -1), mid + 1,
                           np.minimum(hi - SEED, mid + most) + 1)
    rule = np.concatenate((left, right))
    period = np.concatenate((before[left] - place, place_r - mid[right]))
    anchor = np.concatenate((mid[left], place_r))
    start = np.maximum(anchor - extend.backwards(anchor, anchor - period) - period, lo[rule])
    stop = np.minimum(anchor + extend.forwards(anchor, anchor - period), hi[rule])
    ok = stop - start >= np.maximum(LEAST, TIMES * period)
    rule, start, stop, period = rule[ok], start[ok], stop[ok], period[ok]
    # Of equal stretches the least period stays.
    order = np.lexsort((period, stop, start, rule))
    rule, start, stop, period = (x[order] for x in (rule, start, stop, period))
    same = (rule[1:] == rule[:-1]) & (start[1:] == start[:-1]) & (stop[1:] == stop[:-1])
    stays = np.concatenate(([True], ~same))[: len(rule)]
    return big[rule[stays]], start[stays], stop[stays], period[stays]


def merged(zone, start, stop, period):
    """Stretches that lie in no other one of their zone and period, ordered by zone, start, period."""
    order = np.lexsort((-stop, start, period, zone))
    zone, start, stop, period = (x[order] for x in (zone, start, stop, period))
    group = np.concatenate(([0], np.cumsum((zone[1:] != zone[:-1]) | (period[1:] != period[:-1]))))
    group = group[: len(zone)]
    span = int(stop.max()) + 1 if len(stop) else 1
    reach = np.maximum.accumulate(group * span + stop)
    inside = np.zeros(len(zone), bool)
    inside[1:] = reach[:-1] >= (group * span + stop)[1:]
    zone, start, stop, period = (x[~inside] for x in (zone, start, stop, period))
    order = np.lexsort((period, stop, start, zone))
    zone, start, stop, period = (x[order] for x in (zone, start, stop, period))
    same = (zone[1:] == zone[:-1]) & (start[1:] == start[:-1]) & (stop[1:] == stop[:-1])
    stays = np.concatenate(([True], ~same))[: len(zone)]
    return zone[stays], start[stays], stop[stays], period[stays]


def find_runs(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs as (start, stop, period) in words of the whole array, ordered by start and period.

    ``words`` are hashes of words, ``text`` numbers their texts from 0, in order; no run goes beyond
    its text.
    """
    lows, highs = zones(words, text)
    none = np.zeros(0, np.int64)
    if not len(lows):
        return none, none, none
    at = _joined(lows, highs)
    zone = np.repeat(np.arange(len(lows), dtype=np.int64), highs - lows)
    order = np.lexsort((words[at], zone))
    new = np.ones(len(at), bool)
    new[1:] = (words[at][order][1:] != words[at][order][:-1]) | (zone[order][1:] != zone[order][:-1])
    ids = np.empty(len(at), np.int64)
    ids[order] = np.cumsum(new) - 1
    first, middle, last, rule, place = re_pair(ids, zone).arrays()
    extend = Extensions(ids, int((highs - lows).max()))
    crossed, start, stop, period = crossing(first, middle, last, extend)
    if not len(crossed):
        return none, none, none
    # Carry the runs of each rule to all its places.
    order = np.argsort(rule, kind="stable")
    rule, place = rule[order], place[order]
    a = np.searchsorted(rule, crossed)
    b = np.searchsorted(rule, crossed, side="right")
    places = place[_joined(a, b)]
    times = b - a
    start, stop, period, origin = (
        np.repeat(x, times) for x in (start, stop, period, first[crossed])
    )
    start, stop = start - origin + places, stop - origin + places
    _, start, stop, period = merged(zone[start], start, stop, period)
    shift = at[start] - start
    start, stop = start + shift, stop + shift
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


# ---- texts -----------------------------------------------------------------------------------


def planted(doc_ids: list[int | None], bounds: np.ndarray) -> np.ndarray:
    """For each word the word that stands there once a tenth of the texts is made periodic.

    With h the checksum of the id, texts with h % 10 = 0 repeat from word a on with a period p, both
    taken from h. Texts without an id stay as they are.
    """
    source = np.arange(bounds[-1], dtype=np.int64)
    for i, doc in enumerate(doc_ids):
        lo, n = int(bounds[i]), int(bounds[i + 1] - bounds[i])
        if doc is None or not n:
            continue
        h = zlib.crc32(str(doc).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        source[lo + a : lo + n] = lo + a + np.arange(n - a) % p
    return source


def _assemble(data: np.ndarray, starts, stops, words: np.ndarray, bounds: np.ndarray):
    """The bytes of the texts whose words are ``words``, joined by blanks, and each text's bounds."""
    sizes = stops[words] - starts[words] + 1
    ends = np.concatenate(([0], np.cumsum(sizes)))
    out = np.full(int(ends[-1]), 0x20, np.uint8)
    into = np.ones(len(out), bool)
    into[ends[1:] - 1] = False
    out[into] = data[_joined(starts[words], stops[words])]
    lows = ends[bounds[:-1]]
    highs = np.where(bounds[1:] > bounds[:-1], ends[bounds[1:]] - 1, lows)
    return out, lows, highs


def _report(data: np.ndarray, offsets: np.ndarray, doc_ids: list, plant: bool) -> list[tuple]:
    starts, stops, bounds = word_spans(data, offsets, NOT_SPACE)
    hashes = span_hash(prefix_hash(data, lower=False), starts, stops)
    source = planted(doc_ids, bounds) if plant else np.arange(len(starts))
    n_docs = len(doc_ids)
    text = np.repeat(np.arange(n_docs), np.diff(bounds))
    lo, hi, period = find_runs(hashes[source], text)
    # Words inside a run after its first period: +1 where they begin, -1 behind the run.
    depth = np.zeros(len(source) + 1, np.int64)
    np.add.at(depth, lo + period, 1)
    np.add.at(depth, hi, -1)
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    kept_bounds = np.searchsorted(kept, bounds)
    clean, lows, highs = _assemble(data, starts, stops, source[kept], kept_bounds)
    run_bounds = np.searchsorted(lo, bounds)
    out = []
    for i in range(n_docs):
        runs = slice(run_bounds[i], run_bounds[i + 1])
        found = [(int(s), int(e - s), int(q)) for s, e, q in
                 zip(lo[runs] - bounds[i], hi[runs] - bounds[i], period[runs], strict=True)]
        best = (None,) * 4
        if found:
            s, length, q = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
            best = (s, length, q, 1000 * length // q)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        out.append((
            doc_ids[i], len(found), *best, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(clean[lows[i] : highs[i]]).hexdigest(),
            [dict(zip(("start", "length", "period"), r, strict=True)) for r in found],
            clean[lows[i] : highs[i]].tobytes(),
        ))
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
    ("collapsed_sha256", pa.string()), ("runs", pa.list_(_RUN)), ("collapsed", pa.binary()),
])
FOUND = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, "
    "runs array<struct<start:long,length:long,period:long>>, collapsed binary"
)


def periodic_runs(docs: DataFrame, plant: bool = False, keep_text: bool = True) -> DataFrame:
    """Per row all runs of its whole text, the strongest of them, and the text without repeats.

    Words are what stands between blanks (space, tab to carriage return). A run is a stretch of at
    least 24 words and three times its least period that no neighbour extends. The strongest has the
    greatest length over period, then the least start and period; without runs its columns are null.
    ``collapsed`` drops the words that a run holds after its first period and joins the rest by one
    blank (UTF-8). Equal words are told by a 64-bit hash within one text. A null or empty text has
    no words and no run; repeated rows and ids are answered row by row; no shuffle, other columns
    are not read, an empty table gives an empty result. ``plant`` makes a tenth of the texts
    periodic first, by a checksum of doc_id. ``keep_text`` adds the columns runs and collapsed.
    """

    def scan(batches: Iterator[pa.RecordBatch]):
        width = len(_FOUND) if keep_text else len(_FOUND) - 2
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            done = False
            for row, data, offsets in steps(batch.column(1), STEP_BYTES):
                found = _report(data, offsets, doc_ids[row : row + len(offsets) - 1], plant)
                columns = list(zip(*found, strict=True))[:width]
                done = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, list(_FOUND)[:width], strict=True)],
                    [f.name for f in list(_FOUND)[:width]],
                )
            if not done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([], f.type) for f in list(_FOUND)[:width]],
                    [f.name for f in list(_FOUND)[:width]],
                )

    ready(docs.sparkSession)
    kept = FOUND if keep_text else FOUND.split(", runs array")[0]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, kept)
