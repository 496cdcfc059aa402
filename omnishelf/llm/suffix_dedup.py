"""Remove long repeated byte strings, found with suffix arrays of shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnishelf.llm.common import prefix_hash, ready, span_hash, steps, stored

LENGTH = 400
# Bytes whose hashes compete to be the anchor of a string; a longer gram means fewer false meetings.
GRAM = 128
# Regions of one anchor that share a shard. An anchor with more is dealt over several shards.
SHARD_REGIONS = 512
# Bytes that one suffix array covers; a shard is never cut.
BLOCK_BYTES = 1 << 20
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- which strings can meet -----------------------------------------------------------------------


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Anchor hash, first string, number of strings and bytes' hash of each region, and whether its
    anchor stands in it more than once.

    The anchor of a string is the least hash of the grams in it, so equal strings have equal
    anchors wherever they stand. A region is a stretch of neighbouring strings with one anchor.
    """
    strings = len(data) - length + 1
    if strings < 1:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(np.uint64), none.astype(bool)
    n, width = len(data) - gram + 1, length - gram + 1
    prefix = prefix_hash(data, lower=False)
    at = np.arange(n)
    hashes = span_hash(prefix, at, at + gram)
    rows = np.append(hashes, np.full(-n % width, _TOP)).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:strings], ahead[width - 1 : width - 1 + strings])
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    # Periodic text has one anchor over long stretches: cut so that none exceeds ``width`` strings.
    runs = np.diff(np.append(first, strings))
    if runs.max() > width:
        more = -(-runs // width)
        inner = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
        first = np.repeat(first, more) + inner * width
    count = np.diff(np.append(first, strings))
    region = span_hash(prefix, first, first + count - 1 + length)
    several = [
        np.count_nonzero(hashes[a : a + c + width - 1] == v) > 1
        for a, c, v in zip(first.tolist(), count.tolist(), least[first], strict=True)
    ]
    return least[first], first, count, region, np.array(several)


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int):
    for batch in batches:
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        out = []
        with np.errstate(over="ignore"):
            for row, data, offsets in steps(batch.column(2)):
                for r in range(len(offsets) - 1):
                    found = anchors(data[offsets[r] : offsets[r + 1]], length, gram)
                    if len(found[0]):
                        n = len(found[0])
                        out.append((np.full(n, ids[row + r]), np.full(n, keys[row + r]), *found))
        if out:
            of_id, key, anchor, first, count, region, several = (
                np.concatenate(c) for c in zip(*out, strict=True)
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(of_id), pa.array(key), pa.array(anchor.view(np.int64)), pa.array(region.view(np.int64)),
                 pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(several)],
                ["of_id", "key", "anchor", "region", "first", "strings", "several"],
            )


# --- suffix arrays --------------------------------------------------------------------------------


def suffix_array(data: np.ndarray, ends: np.ndarray, depth: int = LENGTH):
    """Suffixes of several texts in one array, sorted by their first ``depth`` bytes: order, rank.

    ``ends`` holds for every position the end of its text; a suffix stops there and sorts before
    its extensions. Larsson and Sadakane: after sorting by the first seven bytes, a group of
    suffixes equal so far is refined by the rank of what follows, with the known depth doubling each
    time; suffixes that stand alone are left out of all later rounds.
    """
    n = len(data)
    at = np.arange(n)
    padded = np.append(data.astype(np.int64) + 1, np.zeros(8, np.int64))
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | np.where(at + k < ends, padded[k : k + n], 0)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    starts = np.append(True, ordered[1:] != ordered[:-1])
    # The rank of a group is the place of its first member.
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(starts, at, 0))
    open_places = np.flatnonzero(~(starts & np.append(starts[1:], True)))
    known = 7
    while known < depth and len(open_places):
        members = order[open_places]
        follower = members + known
        follower = np.where(follower < ends[members], np.minimum(follower, n), n)
        group = rank[members]
        key = group * (n + 1) + rank[follower] + 1
        by = np.argsort(key, kind="stable")
        members, key = members[by], key[by]
        order[open_places] = members
        starts = np.append(True, key[1:] != key[:-1])
        rank[members] = np.maximum.accumulate(np.where(starts, open_places, 0))
        alone = starts & np.append(starts[1:], True)
        open_places = open_places[~alone]
        known *= 2
    place = np.empty(n, np.int64)
    place[order] = at
    return order, place


def common_prefixes(data: np.ndarray, order: np.ndarray, place: np.ndarray, first: np.ndarray,
                    count: np.ndarray, ends: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """For the first ``count`` suffixes of each text the bytes (at most ``depth``) shared with the
    suffix sorted before them.

    Kasai's rule, for all texts at once: going one byte on, the shared prefix shrinks by one at
    most, so it is only extended from there. That holds while the follower of the one sorted before
    stands before the suffix's own. Where two are equal in all bytes that were sorted, it may stand
    behind, and the prefix is compared from its start.
    """
    shared = np.zeros(len(data), np.int64)
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), 0, (1,))
    length, last = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    rows = np.argsort(-count, kind="stable")
    for step in range(int(count.max(initial=0))):
        rows = rows[: int(np.searchsorted(-count[rows], -step, "left"))]
        at = first[rows] + step
        before = order[np.maximum(place[at] - 1, 0)]
        limit = np.minimum(np.minimum(ends[at] - at, ends[before] - before), depth)
        limit[place[at] == 0] = 0
        follows = place[np.minimum(last[rows] + 1, len(data) - 1)] < place[at]
        size = np.minimum(np.where(follows, np.maximum(length[rows] - 1, 0), 0), limit)
        going = np.flatnonzero(size < limit)
        while len(going):
            x = eight[at[going] + size[going]] ^ eight[before[going] + size[going]]
            low = (x & (~x + np.uint64(1))).astype(np.float64)
            same = np.where(x == 0, 8, (np.frexp(low)[1] - 1) >> 3)
            size[going] = np.minimum(size[going] + same, limit[going])
            going = going[(same == 8) & (size[going] < limit[going])]
        length[rows], last[rows] = size, before
        shared[at] = size
    return shared


def repeated_strings(texts: list[np.ndarray], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, which of its strings of ``length`` bytes stand elsewhere in the texts too."""
    sizes = np.array([len(t) for t in texts])
    data, stops = np.concatenate(texts), np.cumsum(sizes)
    first = stops - sizes
    ends = np.repeat(stops, sizes)
    order, place = suffix_array(data, ends, length)
    count = np.maximum(sizes - length + 1, 0)
    shared = common_prefixes(data, order, place, first, count, ends, length)
    at = np.flatnonzero(shared >= length)
    twice = np.zeros(len(data), bool)
    twice[at] = True
    twice[order[place[at] - 1]] = True
    return [twice[a : a + c] for a, c in zip(first.tolist(), count.tolist(), strict=True)]


# --- shards ---------------------------------------------------------------------------------------

_SHARD_OUT = "anchor long, region long, bucket long, strings binary, prints binary, regions binary"


def _slices(batches: Iterator[pa.RecordBatch], length: int):
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column(0), batch.column(1), strict=True):
            body = text.as_py().encode()
            for w in wanted.as_py():
                piece = body[w["first"] : w["first"] + w["strings"] - 1 + length]
                out.append((w["anchor"], w["salt"], w["salts"], w["region"], w["n"], piece))
        kinds = [pa.int64()] * 5 + [pa.binary()]
        columns = zip(*out, strict=True) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["anchor", "salt", "salts", "region", "n", "body"],
        )


def _solved(rows: list[tuple], length: int) -> pa.RecordBatch:
    """One suffix array over some shards. Rows without a bucket give the repeated strings of a
    region, one flag each; rows with one carry sorted string prints of a shard whose anchor has
    several, to be merged with those of the others."""
    texts = [np.frombuffer(r[5], np.uint8) for r in rows]
    flags = repeated_strings(texts, length)
    out = []
    for (anchor, _, _, region, n, _), twice in zip(rows, flags, strict=True):
        if n > 1:
            twice = np.ones_like(twice)
        if twice.any():
            out.append((anchor, region, None, np.packbits(twice).tobytes(), None, None))
    split: dict[tuple, list[int]] = {}
    for i, r in enumerate(rows):
        if r[2] > 1:
            split.setdefault((r[0], r[1], r[2]), []).append(i)
    for (anchor, _, salts), mine in split.items():
        prints, regions = [], []
        with np.errstate(over="ignore"):
            for i in mine:
                at = np.arange(len(flags[i]))
                prints.append(span_hash(prefix_hash(texts[i], lower=False), at, at + length))
                owner = np.zeros(len(at), [("region", "<i8"), ("string", "<i8")])
                owner["region"], owner["string"] = rows[i][3], at
                regions.append(owner)
        prints, regions = np.concatenate(prints), np.concatenate(regions)
        # One of equal strings stands for all: the others are known to be repeated already.
        prints, which = np.unique(prints, return_index=True)
        regions = regions[which]
        bounds = (np.arange(1, salts, dtype=object) * (1 << 64) // salts).astype(np.uint64)
        cuts = [0, *np.searchsorted(prints, bounds).tolist(), len(prints)]
        for b in range(salts):
            lo, hi = cuts[b], cuts[b + 1]
            if hi > lo:
                out.append((anchor, None, b, None, prints[lo:hi].tobytes(), regions[lo:hi].tobytes()))
    kinds = [pa.int64()] * 3 + [pa.binary()] * 3
    columns = zip(*out, strict=True) if out else [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["anchor", "region", "bucket", "strings", "prints", "regions"],
    )


def _solve(batches: Iterator[pa.RecordBatch], length: int):
    held, size, last = [], 0, None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:2] != last and size >= BLOCK_BYTES:
                yield _solved(held, length)
                held, size = [], 0
            last = row[:2]
            held.append(row)
            size += len(row[5])
    if held:
        yield _solved(held, length)


def _merge(part: pd.DataFrame) -> pd.DataFrame:
    """Strings that two shards of an anchor share, by binary search in each other's sorted prints."""
    prints = [np.frombuffer(p, np.uint64) for p in part["prints"]]
    owner = [np.frombuffer(r, [("region", "<i8"), ("string", "<i8")]) for r in part["regions"]]
    every = np.sort(np.concatenate(prints))
    found = []
    for p, o in zip(prints, owner, strict=True):
        hits = np.searchsorted(every, p, "right") - np.searchsorted(every, p, "left")
        found.append(o[hits > 1])
    found = np.concatenate(found)
    return pd.DataFrame(
        {"anchor": part["anchor"].iloc[0], "region": found["region"], "string": found["string"]}
    )


# --- documents ------------------------------------------------------------------------------------


def _spread(batches: Iterator[pa.RecordBatch], length: int):
    """Spans in documents from an occurrence and the flags of its region's strings."""
    for batch in batches:
        out = []
        for of_id, key, first, count, flags in zip(
            *(batch.column(i).to_numpy() for i in range(4)), batch.column(4), strict=True
        ):
            bits = np.unpackbits(np.frombuffer(flags.as_buffer(), np.uint8), count=int(count))
            edge = np.diff(np.concatenate([[0], bits.astype(np.int8), [0]]))
            lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            own = np.full(len(lo), of_id), np.full(len(lo), key)
            out.append((*own, first + lo, first + hi - 1 + length))
        columns = (np.concatenate(c) for c in zip(*out, strict=True)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in columns], ["of_id", "key", "start", "stop"]
        )


def _cut(batches: Iterator[pa.RecordBatch]):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "text"]
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    for batch in batches:
        out = []
        for doc_id, text, marks in zip(*batch.columns, strict=True):
            body = (text.as_py() or "").encode()
            spans: list[list[int]] = []
            for m in sorted((m["start"], m["stop"]) for m in marks.as_py() or []):
                if spans and m[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], m[1])
                else:
                    spans.append(list(m))
            edges = [0, *(edge for span in spans for edge in span), len(body)]
            kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            out.append((doc_id.as_py(), len(body), sum(b - a for a, b in spans), len(spans),
                        hashlib.sha256(kept).hexdigest(),
                        [{"start": a, "stop": b} for a, b in spans], kept.decode(errors="ignore")))
        kinds = [*[pa.int64()] * 4, pa.string(), pa.list_(span), pa.string()]
        columns = zip(*out, strict=True) if out else [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   shard_regions: int = SHARD_REGIONS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, stop in bytes), text.

    Every byte under a string of ``length`` bytes that starts anywhere else in the corpus too is
    removed, in all its places; strings are judged on the input texts and lie within one text.

    1. Each text is cut into regions of strings with one anchor. Regions are counted by (anchor,
       bytes), combined per map task, so any number of copies is one region with a count. Only
       regions whose anchor occurs again, there or elsewhere, can hold a repeated string; this loses none.
    2. Those regions are dealt into shards by anchor, and by salt where an anchor has more than
       ``shard_regions``. Each shard is sorted as a suffix array; strings whose shared prefix with
       a neighbour reaches ``length`` are repeated.
    3. Shards of one salted anchor are merged: each cuts its sorted string prints into ranges by
       binary search, the ranges meet and are searched in each other. A merge task holds about as
       many strings as one shard.
    4. The repeated strings of a region are spread to all its places and gathered per document.

    Equality of anchors, regions and prints is that of 64-bit hashes, always two at a time. A null
    text is empty; a null doc_id is kept as it is. Rows are told apart by their id and a hash of
    their text, so repeated rows lose what they share. ``text`` is what is kept; of a character that
    a span cuts the rest is left out of it, while the digest is that of the exact bytes. Other
    columns are ignored; an empty table gives an empty result.
    """
    ready(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), "text").withColumns({
        "of_id": F.coalesce(F.col("doc_id"), F.lit(-1).cast("long")),
        "key": F.xxhash64(F.col("doc_id").isNull(), "text"),
    })
    own = (F.col("of_id") == F.col("owner_id")) & (F.col("key") == F.col("owner"))
    owner = [F.col("of_id").alias("owner_id"), F.col("key").alias("owner")]
    found = stored(
        slim.filter(F.octet_length("text") >= length).select("of_id", "key", "text").mapInArrow(
            lambda b: _anchor_rows(b, length, gram),
            "of_id long, key long, anchor long, region long, first int, strings int, several boolean",
        )
    )
    place = ("of_id", "key", "first", "strings", "several")
    regions = stored(
        found.groupBy("anchor", "region").agg(
            F.count("*").alias("n"), *[F.first(c).alias(c) for c in place]
        )
    )
    again = regions.groupBy(F.col("anchor").alias("again")).agg(
        F.sum("n").alias("total"), F.count("*").alias("regions"), F.max("several").alias("several")
    ).filter("total > 1 OR several").drop("several")
    salts = F.ceil(F.col("regions") / shard_regions)
    wanted = regions.join(stored(again), F.col("anchor") == F.col("again")).select(
        "of_id",
        "key",
        F.struct(
            "first", "strings", "anchor", "region", "n", salts.alias("salts"),
            F.pmod(F.xxhash64("region"), salts).alias("salt"),
        ).alias("wanted"),
    )
    # Regions of one document: bounded by its length.
    wanted = wanted.groupBy(*owner).agg(F.collect_list("wanted").alias("wanted"))
    texts = slim.join(stored(wanted), own).dropDuplicates(["of_id", "key"])
    pieces = texts.select("text", "wanted").mapInArrow(
        lambda b: _slices(b, length),
        "anchor long, salt long, salts long, region long, n long, body binary",
    )
    solved = stored(
        pieces.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", "region")
        .mapInArrow(lambda b: _solve(b, length), _SHARD_OUT)
    )
    inside = solved.filter("bucket IS NULL").select("anchor", "region", "strings")
    merged = (
        solved.filter("bucket IS NOT NULL").select("anchor", "bucket", "prints", "regions")
        .groupBy("anchor", "bucket").applyInPandas(_merge, "anchor long, region long, string long")
    )
    # A region's strings are bounded by ``length``: one flag each.
    across = merged.groupBy("anchor", "region").agg(F.collect_set("string").alias("at")).mapInArrow(
        lambda b: _flags(b, length), "anchor long, region long, strings binary"
    )
    flags = stored(
        inside.union(across).select(
            F.col("anchor").alias("a"), F.col("region").alias("r"), F.col("strings").alias("flags")
        )
    )
    spans = found.join(flags, (F.col("anchor") == F.col("a")) & (F.col("region") == F.col("r"))).select(
        "of_id", "key", "first", "strings", "flags"
    ).mapInArrow(lambda b: _spread(b, length), "of_id long, key long, start long, stop long")
    marks = spans.groupBy(*owner).agg(F.collect_set(F.struct("start", "stop")).alias("marks"))
    return slim.join(marks, own, "left").select(
        "doc_id", "text", "marks"
    ).mapInArrow(
        _cut,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start:long,stop:long>>, text string",
    )


def _flags(batches: Iterator[pa.RecordBatch], length: int):
    for batch in batches:
        out = []
        for at in batch.column(2):
            bits = np.zeros(length, np.uint8)
            bits[at.as_py()] = 1
            out.append(np.packbits(bits).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.binary())],
            ["anchor", "region", "strings"],
        )
