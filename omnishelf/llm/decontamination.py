"""Find benchmark items inside documents: CGK embedding, bit-sampling LSH, exact edit checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omnishelf.llm.common import kept_for, ready, steps

# Edits allowed, as a share of the item's bytes.
EDIT_SHARE = 0.08
# An item within that many edits shares at least length - q + 1 - edits * q grams with its window.
GRAM = 8
# Tables of sampled positions, walks they are dealt over, positions a table samples. With items edited
# up to the bound 44 to 59 % of the sampled positions differ (replaced bytes least, inserted and deleted
# ones most), so keys are short and tables many: at the bound the tables propose 96 to 100 % of the
# items. For the few they miss stands a net: an item with room for e edits is cut into e + 1 parts, one
# of which any stretch within the edits holds unchanged. Parts have nine bytes or more.
TABLES, WALKS, SAMPLES = 96, 8, 4
# Items of one class have nearly one length; their windows are sampled alike.
CLASS_WIDTH = 1.25
# Shorter items (bytes, normalised) are found only where they occur verbatim.
LEAST_BYTES = 32
# Bytes of benchmark text that one pass over the documents looks for.
BLOCK_BYTES = 8 << 20
_FILTER_BITS = 22
# Windows whose keys are made and looked up at a time, and slots that sort out keys of no item.
WINDOWS, _KEY_BITS = 2048, 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


def normalise(data: np.ndarray, offsets: np.ndarray):
    """Lower case (A-Z) with each run of blanks as one: bytes, row bounds, place in the input."""
    folded = _FOLD[data]
    keep = np.ones(len(folded), bool)
    keep[1:] = ~((folded[1:] == 32) & (folded[:-1] == 32))
    if len(folded):
        keep[offsets[:-1][offsets[:-1] < len(folded)]] = True
    at = np.flatnonzero(keep)
    return folded[at], np.searchsorted(at, offsets), at


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number."""
    n = max(0, len(data) - GRAM + 1)
    return np.ndarray((n,), "<u8", np.ascontiguousarray(data).tobytes(), 0, (1,))


def _slots(words: np.ndarray) -> np.ndarray:
    return ((words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def _grams(data: np.ndarray) -> np.ndarray:
    """Filter slot of the eight bytes from each position on."""
    return _slots(_words(data))


def edit_search(pattern: bytes, text: bytes) -> tuple[int, int]:
    """Least edits between ``pattern`` and any substring of ``text``, and where that ends.

    Myers' bit-vector algorithm; the earliest end wins a tie.
    """
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        plus = (down | ~(d0 | up)) & full
        minus = up & d0
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        # No carry into the first row: the match may start anywhere.
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = (minus | ~(d0 | plus)) & full, d0 & plus
        if score < best:
            best, end = score, j + 1
    return best, end


class Embedding:
    """Walks of one class: at each step the byte under the pointer is put out, and a random bit for
    (step, byte) decides whether the pointer moves. Nearby strings meet again after an edit, so
    their outputs differ in few places. Sampled places of the output make the table keys."""

    def __init__(self, length: int, seed: int):
        rng = np.random.default_rng(seed)
        self.length, self.steps = length, int(1.7 * length)
        self.moves = rng.integers(0, 2, (WALKS, self.steps, 256)).astype(np.uint8)
        self.weights = rng.integers(1, 1 << 62, TABLES, dtype=np.int64) | 1
        picks = rng.integers(0, self.steps, (TABLES, SAMPLES))
        self.picks: list[list[int]] = [[] for _ in range(self.steps)]
        for t in range(TABLES):
            for step in {*picks[t].tolist()}:
                self.picks[step].append(t)
        # All walks take a step at once: the moves of a step, one walk's bytes after the other's.
        self.turns = np.ascontiguousarray(self.moves.transpose(1, 0, 2)).reshape(self.steps, -1)

    def keys(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Table keys (tables x starts). ``data`` must reach ``steps`` bytes behind each start."""
        out = np.zeros((TABLES, len(starts)), np.int64)
        walk = np.arange(0, WALKS * 256, 256)[:, None]
        for a in range(0, len(starts), WINDOWS):
            at = np.repeat(starts[None, a : a + WINDOWS], WALKS, axis=0)
            for step in range(self.steps):
                byte = data[at]
                for t in self.picks[step]:
                    key = out[t, a : a + WINDOWS]
                    key *= self.weights[t]
                    key += byte[t % WALKS]
                    key += 1
                at += self.turns[step][byte + walk]
        return out


class Keys:
    """The keys of one class's items in all tables, in one order for one search."""

    _ODD, _SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

    def __init__(self, keys: np.ndarray, items: np.ndarray):
        """``keys`` (tables x items) and the numbers of the items."""
        spread = self._spread(keys).ravel()
        order = np.argsort(spread, kind="stable")
        self.spread = spread[order]
        self.table = np.repeat(np.arange(len(keys)), len(items))[order]
        self.item, self.key = np.tile(items, len(keys))[order], keys.ravel()[order]
        self.filter = np.zeros(1 << _KEY_BITS, bool)
        self.filter[self._slots(self.spread)] = True

    def _spread(self, keys: np.ndarray) -> np.ndarray:
        salt = np.arange(1, len(keys) + 1, dtype=np.uint64) * self._SALT
        return (keys.astype(np.uint64) + salt[:, None]) * self._ODD

    @staticmethod
    def _slots(spread: np.ndarray) -> np.ndarray:
        return (spread >> np.uint64(64 - _KEY_BITS)).astype(np.int64)

    def matches(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) whose keys agree in some table, for keys (tables x windows); may repeat."""
        spread = self._spread(keys)
        table, window = np.nonzero(self.filter[self._slots(spread)])
        wanted = spread[table, window]
        low = np.searchsorted(self.spread, wanted, "left")
        count = np.searchsorted(self.spread, wanted, "right") - low
        first = np.cumsum(count) - count
        at = np.arange(int(count.sum())) - np.repeat(first - low, count)
        table, window = np.repeat(table, count), np.repeat(window, count)
        same = (self.table[at] == table) & (self.key[at] == keys[table, window])
        return window[same], self.item[at[same]]


class Benchmark:
    """One block of items, made ready for the search."""

    def __init__(self, items: list[tuple[int | None, str]]):
        # Inside, an item goes by its place in the block: ids may repeat or be null.
        self.ids = [item_id for item_id, _ in items]
        self.classes, self.keys, self.short, self.grams = [], [], [], []
        parts: list[tuple[int, int, int, int, int]] = []
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        long = []
        for place, (_, text) in enumerate(items):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            data, _, _ = normalise(raw, np.array([0, len(raw)]))
            body = data.tobytes().strip()
            if len(body) >= LEAST_BYTES:
                long.append((place, body))
                data = np.frombuffer(body, np.uint8)
                self.grams.append(np.unique(_grams(data)))
                self.filter[self.grams[-1]] = True
                words, m = _words(data), len(body)
                edits = int(EDIT_SHARE * m)
                size = m // (edits + 1)
                for at in range(0, size * (edits + 1), size):
                    parts.append((int(words[at]), int(words[at + size - GRAM]), at, size, len(long) - 1))
            elif body:
                self.short.append((place, body))
        self.long = list(long)
        heads = np.array([x[0] for x in parts], np.uint64)
        order = np.argsort(heads, kind="stable")
        self.heads = heads[order]
        self.tails = np.array([x[1] for x in parts], np.uint64)[order]
        self.parts = np.array([x[2:] for x in parts], np.int64).reshape(-1, 3)[order]
        self.head_filter = np.zeros(1 << _FILTER_BITS, bool)
        self.head_filter[_slots(self.heads)] = True
        self.lengths = np.array([len(b) for _, b in long], np.int64)
        self.edits = (EDIT_SHARE * self.lengths).astype(np.int64)
        self.needs = np.array([self.least(len(b)) for _, b in long], np.int64)
        number = {place: k for k, (place, _) in enumerate(long)}
        long.sort(key=lambda x: (len(x[1]), x[0]))
        while long:
            length = len(long[0][1])
            mine = [x for x in long if len(x[1]) < CLASS_WIDTH * length]
            long = long[len(mine) :]
            embedding = Embedding(length, 1000 + length)
            bodies = [b.ljust(len(b) + embedding.steps, b"\0") for _, b in mine]
            sizes = np.array([len(b) for b in bodies])
            padded = np.frombuffer(b"".join(bodies), np.uint8)
            keys = embedding.keys(padded, np.cumsum(sizes) - sizes)
            least = self.least(length)
            self.keys.append(Keys(keys, np.array([number[place] for place, _ in mine])))
            order = np.argsort(keys, axis=1, kind="stable")
            self.classes.append(
                (embedding, least, mine, np.take_along_axis(keys, order, axis=1), order)
            )

    @staticmethod
    def least(length: int) -> int:
        """Grams that any stretch within the edits of an item of ``length`` bytes shares with it."""
        return max(1, length - GRAM + 1 - int(EDIT_SHARE * length) * GRAM)

    def candidates(self, data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, padded: np.ndarray):
        """(row, number of the item, bounds of a stretch of the data) for stretches that share grams
        enough with the item; those of one row and item lie apart and in order."""
        words = _words(data)
        slots = _slots(words)
        hit = np.zeros(len(data) + 1, np.int32)
        if len(data) >= GRAM:
            np.cumsum(self.filter[slots], out=hit[1 : len(data) - GRAM + 2])
            hit[len(data) - GRAM + 2 :] = hit[len(data) - GRAM + 1]
        start, item = self.proposed(hit, data, starts, padded)
        row = np.searchsorted(bounds, start, "right") - 1
        found = zip((row, start, item), self.parted(hit, words, slots, bounds), strict=True)
        row, start, item = (np.concatenate(x) for x in found)
        if not len(row):
            return []
        order = np.lexsort((start, row, item))
        row, start, item = row[order], start[order], item[order]
        lo = np.maximum(bounds[row], start - self.edits[item])
        hi = np.minimum(bounds[row + 1], start + self.lengths[item] + self.edits[item])
        # Both bounds rise with the start, so a stretch ends where the next one begins behind it.
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (lo[1:] > hi[:-1])
        first = np.flatnonzero(new)
        row, item, lo, hi = row[first], item[first], lo[first], hi[np.append(first[1:], len(row)) - 1]
        # Grams of any item bound those of this one; what is left is counted with its own grams.
        fine = hit[np.maximum(hi - GRAM + 1, lo)] - hit[lo] >= self.needs[item]
        out, known = [], -1
        mark = np.zeros(1 << _FILTER_BITS, bool) if fine.any() else None
        for r, k, a, b in zip(*(x[fine].tolist() for x in (row, item, lo, hi)), strict=True):
            if k != known:
                if known >= 0:
                    mark[self.grams[known]] = False
                mark[self.grams[k]], known = True, k
            if np.count_nonzero(mark[slots[a : b - GRAM + 1]]) >= self.needs[k]:
                out.append((r, k, a, b))
        return out

    def parted(self, hit: np.ndarray, words: np.ndarray, slots: np.ndarray, bounds: np.ndarray):
        """(row, start, number of the item) where a part of an item stands and there are grams enough."""
        at = np.flatnonzero(self.head_filter[slots])
        low = np.searchsorted(self.heads, words[at], "left")
        count = np.searchsorted(self.heads, words[at], "right") - low
        at, first = np.repeat(at, count), np.cumsum(count) - count
        part = np.arange(len(at)) - np.repeat(first - low, count)
        offset, size, item = self.parts[part].T
        last = np.minimum(at + size - GRAM, len(words) - 1)
        same = words[last] == self.tails[part]
        at, start, item = at[same], (at - offset)[same], item[same]
        row = np.searchsorted(bounds, at, "right") - 1
        m, edits = self.lengths[item], self.edits[item]
        lo = np.maximum(bounds[row], start - edits)
        hi = np.minimum(bounds[row + 1], start + m + edits)
        need = m - GRAM + 1 - edits * GRAM
        fine = hit[np.maximum(hi - GRAM + 1, lo)] - hit[lo] >= need
        return row[fine], start[fine], item[fine]

    def proposed(self, hit: np.ndarray, data: np.ndarray, starts: np.ndarray, padded: np.ndarray):
        """(start, number of the item) whose keys agree in some table, without repeats.

        A class counts grams by its shortest item. Of a longer one all edits may lie in the window,
        which then has too few; such items are left to their parts, which count by the item.
        """
        found = [np.zeros(0, np.int64)]
        for (embedding, least, *_), known in zip(self.classes, self.keys, strict=True):
            stop = np.minimum(starts + embedding.length - GRAM + 1, len(data))
            chosen = starts[hit[stop] - hit[starts] >= least]
            for a in range(0, len(chosen), WINDOWS):
                some = chosen[a : a + WINDOWS]
                window, item = known.matches(embedding.keys(padded, some))
                found.append(np.unique(some[window] * len(self.long) + item))
        return np.divmod(np.concatenate(found), max(1, len(self.long)))


def _prepared(items: list[tuple[int | None, str]]) -> Benchmark:
    """The block of items, made ready; the worker keeps the one it searched last."""
    last, key = kept_for("decontamination"), hash(tuple(items))
    if key not in last:
        last.clear()
        last[key] = Benchmark(items)
    return last[key]


def _find(batches: Iterator[pa.RecordBatch], shared):
    bench = _prepared(shared.value)
    reach = max([e.steps for e, *_ in bench.classes], default=0) + 8
    for batch in batches:
        ids, prints = batch.column(0), batch.column(2)
        out = []
        for row, raw, offsets in steps(batch.column(1)):
            data, bounds, at = normalise(raw, offsets)
            first = np.ones(len(data), bool)
            first[1:] = data[:-1] == 32
            first[bounds[:-1][bounds[:-1] < len(data)]] = True
            starts = np.flatnonzero(first & (data != 32))
            padded = np.append(data, np.zeros(reach, np.uint8))
            best: dict = {}
            for r, k, lo, hi in bench.candidates(data, bounds, starts, padded):
                item, body = bench.long[k]
                known = best.get((r, item))
                text = data[lo:hi].tobytes()
                distance, end = edit_search(body, text)
                if distance <= bench.edits[k] and (known is None or distance < known[0]):
                    back, size = edit_search(body[::-1], text[:end][::-1])
                    best[r, item] = (distance, lo + end - size, lo + end, len(body))
            for item, body in bench.short:
                whole, place = data.tobytes(), -1
                while (place := whole.find(body, place + 1)) >= 0:
                    r = int(np.searchsorted(bounds, place, "right")) - 1
                    if place + len(body) <= bounds[r + 1] and (r, item) not in best:
                        best[r, item] = (0, place, place + len(body), len(body))
            for (r, item), (distance, lo, hi, m) in sorted(best.items()):
                start = int(at[lo]) - int(offsets[r])
                stop = int(at[hi - 1]) + 1 - int(offsets[r])
                out.append((ids[row + r].as_py(), bench.ids[item], start, stop, distance,
                            1 - distance / m, prints[row + r].as_py()))
        columns = zip(*out, strict=True) if out else [[]] * 7
        kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["doc_id", "item_id", "start", "stop", "edits", "similarity", "print"],
        )


def contaminated(docs: DataFrame, benchmark: DataFrame, with_print: bool = False) -> DataFrame:
    """Documents that hold a benchmark item: doc_id, item_id, start, stop, edits, similarity;
    ``with_print`` adds the text's xxhash64.

    A document holds an item if some stretch of it lies within ``EDIT_SHARE`` edits of the item,
    both in lower case with single blanks; edits, start and stop count bytes of the (input) text.
    The best stretch of each item is reported, the earliest on a tie. Items are proposed by the
    tables, for windows that start at words and have grams of the benchmark enough; at the bound
    they miss up to 4 %, which unchanged parts with enough grams around them propose as well. The
    edit distance decides. ``docs`` is read once per ``BLOCK_BYTES`` of benchmark text and never shuffled.

    Null or empty texts and items hold nothing. Rows repeated in ``docs`` are reported each. Equal
    texts under one item_id are one item; different texts under one id, or under null, are an item
    each, reported in rows of their own with that id. Other columns are ignored. An empty table gives no rows.
    """
    spark = ready(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL")
    # Running bytes in id order; one small row per item passes the window.
    running = F.sum(F.octet_length("text")).over(
        Window.orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    )
    items = items.dropDuplicates().withColumn("block", F.floor(running / BLOCK_BYTES))
    blocks = [r[0] for r in items.select("block").distinct().collect()]
    slim = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("print"))
    slim = slim.filter("text IS NOT NULL")
    schema = "doc_id long, item_id long, start long, stop long, edits long, similarity double, print long"
    out = spark.createDataFrame([], schema)
    for block in sorted(blocks):
        rows = items.filter(F.col("block") == block).orderBy("item_id", "text").collect()
        shared = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in rows])
        found = slim.mapInArrow(lambda b, shared=shared: _find(b, shared), schema)
        out = out.union(found) if len(blocks) > 1 else found
    return out if with_print else out.drop("print")
