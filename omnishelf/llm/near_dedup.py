"""Near-duplicate documents by HyperMinHash sketches, banding and checks on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnishelf.llm.common import (
    NOT_SPACE,
    components,
    mix,
    prefix_hash,
    ready,
    span_hash,
    steps,
    stored,
    word_spans,
)

SHINGLE = 5
PERCENT = 75
# The first 128 registers make 32 bands of 4: a pair at similarity 0.75 meets in no band once in
# 200,000. All registers make the estimate.
REGISTERS, BANDS, BAND = 512, 32, 4
# A register of the estimate is a byte: four bits for leading zeros, four for the bits behind them.
# Those of the bands are kept once more with twelve such bits, as two bytes: unequal minima then agree
# in a whole band with chance 4e-17, so unrelated documents do not meet however many there are.
ZEROS, MANTISSA, WIDE = 4, 4, 12
BAND_BYTES = 2 * BAND
SKETCH_BYTES = REGISTERS + BANDS * BAND_BYTES
# Pairs whose estimate lies this far below the threshold are not checked on their sets. Five
# standard deviations of 512 registers at 0.75.
SLACK = 0.1
# Members and strays of a band that one task compares by their sketches.
CELL = 2048

_BITS = np.uint64(64 - REGISTERS.bit_length() + 1)
_BOUNDS = np.arange(REGISTERS, dtype=np.uint64) << _BITS
_MIX = np.array([mix(np.arange(1, 60, dtype=np.uint64))[7 * k] | np.uint64(1) for k in range(8)])
# Which register an empty one copies at each try; the same for all documents.
_PROBES = np.random.default_rng(71).integers(0, REGISTERS, (REGISTERS, 64 * 64))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text, row by row."""
    with np.errstate(over="ignore"):
        for _, data, offsets in steps(texts):
            starts, stops, rows = word_spans(data, offsets, NOT_SPACE)
            words = span_hash(prefix_hash(data, lower=True), starts, stops)
            n = max(0, len(words) - SHINGLE + 1)
            whole = np.zeros(n, np.uint64)
            for k in range(SHINGLE):
                whole += words[k : k + n] * _MIX[k]
            whole = mix(whole)
            for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
                if b - a >= SHINGLE:
                    yield np.unique(whole[a : b - SHINGLE + 1])
                elif b > a:
                    few = words[a:b] * _MIX[: b - a]
                    yield mix(np.array([few.sum() + _MIX[5] * np.uint64(b - a)], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Bytes of a non-empty sorted set's registers, leading zeros and mantissa bits of each bucket's
    minimum: one byte each, then two for those of the bands.

    The high bits of a hash choose the bucket, so the minimum of bucket b is the first hash from
    b << 55 on. An empty register copies the first filled one on its fixed list of tries (optimal
    densification), which keeps the chance that two sets agree in it at their similarity.
    """
    first = np.searchsorted(hashes, _BOUNDS)
    at = np.minimum(first, len(hashes) - 1)
    low = hashes[at]
    filled = (first < len(hashes)) & ((low >> _BITS) == np.arange(REGISTERS, dtype=np.uint64))
    rest = (low << np.uint64(64 - int(_BITS))) | np.uint64(1)
    mantissa, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.minimum(64 - exponent, (1 << ZEROS) - 1)
    out = (zeros << WIDE) + ((mantissa - 0.5) * (2 << WIDE)).astype(np.int64)
    empty = np.flatnonzero(~filled)
    for t in range(0, _PROBES.shape[1], 64):
        if not len(empty):
            break
        tries = _PROBES[empty, t : t + 64]
        hit = filled[tries]
        found = hit.argmax(axis=1)
        done = hit[np.arange(len(empty)), found]
        out[empty[done]] = out[tries[np.arange(len(empty)), found][done]]
        empty = empty[~done]
    if len(empty):
        out[empty] = out[np.flatnonzero(filled)[0]]
    bands = out[: BANDS * BAND].astype("<u2").view("u1")
    return np.concatenate([(out >> (WIDE - MANTISSA)).astype("u1"), bands])


def estimate(agreeing: np.ndarray) -> np.ndarray:
    """Similarity from the number of agreeing registers, less the collisions of unequal minima.

    Two unequal minima have the same number of leading zeros with chance 1/3 and then the same
    mantissa bits with 2**-MANTISSA.
    """
    chance = 2.0**-MANTISSA / 3
    return np.maximum(0.0, (agreeing / REGISTERS - chance) / (1 - chance))


def _describe(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        n, one, two, sketches = [], [], [], []
        with np.errstate(over="ignore"):
            for hashes in shingle_sets(batch.column(1)):
                n.append(len(hashes))
                one.append(int(hashes.sum(dtype=np.uint64).astype(np.int64)))
                two.append(int(mix(hashes ^ _MIX[6]).sum(dtype=np.uint64).astype(np.int64)))
                sketches.append(sketch(hashes).tobytes() if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(one, pa.int64()),
             pa.array(two, pa.int64()), pa.array(sketches, pa.binary())],
            ["doc_id", "print", "n_shingles", "set_one", "set_two", "sketch"],
        )


def _agree(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), "u1").reshape(-1, SKETCH_BYTES)
            for i in (2, 3)
        )
        likely = estimate((left == right)[:, :REGISTERS].sum(axis=1)) >= PERCENT / 100 - SLACK
        keep = pa.array(likely)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"]
        )


def _cell_pairs(ids, parts, sizes, sketches, stray) -> np.ndarray:
    """Likely pairs between the strays of a band's cell and its members in other components.

    Two sketches may agree in several bands; their pair is reported in the first of them only. The
    cell's own band is one of those in which all its members agree.
    """
    x, y = np.flatnonzero(stray), np.flatnonzero(~stray)
    bands, sketches = sketches[:, REGISTERS:], sketches[:, :REGISTERS]
    bands = bands.reshape(-1, BANDS, BAND_BYTES)
    own = (bands == bands[0]).all(axis=(0, 2))
    out = [np.zeros((0, 2), np.int64)]
    for i in x:
        fits = 100 * np.minimum(sizes[i], sizes[y]) >= PERCENT * np.maximum(sizes[i], sizes[y])
        near = y[fits & (parts[y] != parts[i])]
        if len(near):
            likely = estimate((sketches[near] == sketches[i]).sum(axis=1)) >= PERCENT / 100 - SLACK
            near = near[likely]
            first = (bands[near] == bands[i]).all(axis=2).argmax(axis=1)
            other = ids[near[own[first]]]
            out.append(np.stack([np.minimum(ids[i], other), np.maximum(ids[i], other)], axis=1))
    return np.unique(np.concatenate(out), axis=0)


def _across(batches: Iterator[pa.RecordBatch]):
    """Cells one after the other; rows come sorted by cell, so one cell is held at a time."""
    held: list[tuple] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy() for i in range(3)])
        rest = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3, 7)]
        sketches = np.frombuffer(b"".join(batch.column(7).to_pylist()), "u1").reshape(-1, SKETCH_BYTES)
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        found = []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if held and (held[0][0] != key[:, lo]).any():
                found.append(_cell_pairs(*_joined(held)))
                held = []
            held.append((key[:, lo], *[r[lo:hi] for r in rest], sketches[lo:hi]))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
    if held:
        pairs = _cell_pairs(*_joined(held))
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _joined(held: list[tuple]):
    stray, ids, parts, sizes, sketches = (np.concatenate(c) for c in list(zip(*held, strict=True))[1:])
    return ids, parts, sizes, sketches, stray


def _hashes(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        sets = pa.array([h.tobytes() for h in shingle_sets(batch.column(1))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), sets], ["id", "hashes"])


def _confirm(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= PERCENT * (len(both) - common))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"]
        )


def _confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of document ids whose full sets are similar enough."""
    pairs = stored(pairs)
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = stored(
        docs.join(ids.hint("merge"), docs["doc_id"] == ids["id"]).select("doc_id", "text")
        .mapInArrow(_hashes, "id long, hashes binary")
    )
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("right"))
    both = pairs.hint("merge").join(left, "a").join(right.hint("merge"), "b").select("a", "b", "left", "right")
    return stored(both.mapInArrow(_confirm, "a long, b long"))


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of classes whose sizes allow the similarity and whose sketches suggest it."""
    left = classes.select(
        F.col("class_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a")
    )
    right = classes.select(
        F.col("class_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b")
    )
    fits = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    both = pairs.join(left, "a").join(right, "b").filter(fits)
    return both.select("a", "b", "s_a", "s_b").mapInArrow(_agree, "a long, b long")


def near_duplicates(docs: DataFrame, with_print: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept; ``with_print`` adds the text's xxhash64.

    Shingles are five words of the whole text, lower-cased in A-Z; fewer words make one shingle, no
    words or a null text make none and link with nothing. Sets are held as 64-bit hashes. Documents
    of equal sets form a class with one representative, so a group of copies costs one sketch.

    Candidates share a band of their sketches. First every class is checked against the smallest
    class of each of its bands, which settles a group of near copies in as many pairs as it has
    members. Then, in bands that still hold several components, the members outside the band's
    largest component are checked against all members of other components. No pair within a band
    is left out unless its two sides are linked already, their sizes rule the similarity out, or
    the sketch estimate lies ``SLACK`` below it.

    doc_id is a key. Rows that repeat it with one text get one result each, the same; texts under
    one id are one vertex, linked with whatever any of them is near to. A null doc_id takes no part
    (component_id null, kept). Other columns are ignored. An empty table gives an empty result.
    """
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    described = stored(
        docs.select("doc_id", "text", F.xxhash64("text").alias("print")).mapInArrow(
            _describe,
            "doc_id long, print long, n_shingles long, set_one long, set_two long, sketch binary",
        )
    )
    keys = ["n_shingles", "set_one", "set_two"]
    sets = described.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    named = stored(sets.groupBy(*keys).agg(F.min("doc_id").alias("class_id")))
    classes = stored(
        sets.select(F.col("doc_id").alias("class_id"), *keys, "sketch")
        .join(named, ["class_id", *keys], "left_semi")
        .select("class_id", "n_shingles", "sketch")
        .dropDuplicates(["class_id", "n_shingles"])
    )
    bands = F.array(
        *[
            F.xxhash64(F.lit(i), F.substring("sketch", REGISTERS + i * BAND_BYTES + 1, BAND_BYTES))
            for i in range(BANDS)
        ]
    )
    members = classes.select("class_id", "n_shingles", F.explode(bands).alias("band"))
    shared = stored(members.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1"))
    members = stored(members.join(shared, "band"))
    # A text at the middle of a group meets the others in more bands than they meet each other.
    central = members.groupBy("class_id").agg(F.sum("size").alias("meets"))
    members = stored(
        members.join(central, "class_id").select("band", "class_id", "n_shingles", "meets")
    )
    top = F.struct("meets", (-F.col("class_id")).alias("first"), "n_shingles")
    pivots = members.groupBy("band").agg(F.max(top).alias("top"))
    pivots = stored(
        pivots.select("band", (-F.col("top.first")).alias("pivot"), F.col("top.n_shingles").alias("n"))
    )
    # Sizes that rule the similarity out need no sketches.
    fits = 100 * F.least("n", "n_shingles") >= PERCENT * F.greatest("n", "n_shingles")
    starred = members.join(pivots, "band").filter(fits & (F.col("class_id") != F.col("pivot"))).select(
        F.least("pivot", "class_id").alias("a"), F.greatest("pivot", "class_id").alias("b")
    )
    starred = stored(starred.distinct())
    links = _confirmed(docs, _likely(starred, classes))

    placed = members.select("band", "class_id").join(
        components(links), F.col("class_id") == F.col("id"), "left"
    ).select("band", "class_id", F.coalesce("component", "class_id").alias("c"))
    placed = stored(placed)
    split = placed.groupBy("band", "c").agg(F.count("*").alias("n")).groupBy("band").agg(
        F.max(F.struct("n", "c")).alias("main"), F.sum("n").alias("size"), F.count("*").alias("parts")
    ).filter("parts > 1").select(
        F.col("band").alias("b"), F.col("main")["c"].alias("main"),
        F.ceil(F.col("size") / CELL).alias("cells"),
        F.ceil((F.col("size") - F.col("main")["n"]) / CELL).alias("stray_cells"),
    )
    several = placed.join(stored(split), F.col("band") == F.col("b")).join(
        classes.withColumnRenamed("class_id", "id"), F.col("class_id") == F.col("id")
    )
    cell = lambda n: F.pmod(F.xxhash64("class_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    columns = ["class_id", "c", "n_shingles", "sketch", "band"]
    several = stored(several.select(*columns, "main", "cells", "stray_cells"))
    strays = several.filter("c <> main").select(
        *columns, every("cells").alias("cell"), cell("stray_cells").alias("stray_cell"), F.lit(True).alias("stray")
    )
    others = several.select(
        *columns, cell("cells").alias("cell"), every("stray_cells").alias("stray_cell"), F.lit(False).alias("stray")
    )
    cells = ["band", "cell", "stray_cell"]
    across = strays.union(others).select(
        *cells, "stray", "class_id", "c", "n_shingles", "sketch"
    ).repartition(*cells).sortWithinPartitions(*cells).mapInArrow(
        _across, "a long, b long"
    ).distinct().join(starred, ["a", "b"], "left_anti")
    more = _confirmed(docs, across)

    linked = components(links.union(more))
    named = stored(
        named.join(linked, F.col("class_id") == F.col("id"), "left").select(
            *[F.col(k).alias(f"_{k}") for k in keys],
            F.coalesce("component", "class_id").alias("component"),
        )
    )
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    result = described.select("doc_id", "print", *keys).join(named, same, "left")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")
    ).alias("component_id")
    out = result.select("doc_id", "n_shingles", component, "print").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    return out if with_print else out.drop("print")
