"""Token ids in files of Simple-8b words, in document order, and their reader.

A file is little-endian: magic ``S8B1``, then unsigned 64-bit counts of documents, ids and blocks,
then document ids, null flags, first id of each document, first word of each block (one more entry
closes both lists), then the 64-bit words. A block holds ``BLOCK`` ids (the last one fewer).

The four high bits of a word select how many ids of which width fill its other 60 bits. Selector 15
is the escape: one id of up to 60 bits. Selectors 0 and 1 stand for runs of 240 and 120 zeros.
Blocks start at known words, so all blocks of a file are decoded at once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omnishelf.llm.common import ready, steps, stored
from omnishelf.llm.encoding import encoder

# Fixed values of the format: ids per word and bits per id, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

MAGIC = b"S8B1\0\0\0\0"
BLOCK = 1024
# A file is closed when it has so many ids; a document is never cut.
FILE_IDS = 1 << 20
# Bytes of text that are encoded at once, and that one task takes of the sorted documents.
ENCODE_BYTES = 1 << 23
TASK_BYTES = 64 << 20


# Zeros that a block's last word may reach over.
SPARE = 240


def _selectors(ids: np.ndarray) -> np.ndarray:
    """For every id of the rows of ``ids`` (one block each, ``SPARE`` zeros behind it) the selector
    that takes most ids from there; what it takes behind the block are zeros."""
    rows, width = ids.shape
    block = width - SPARE
    best = np.full((rows, block), 15, np.uint8)
    for selector in range(14, -1, -1):
        # fits: whether the next ``reach`` ids have the selector's width, doubled up to its count.
        fits = ids < ids.dtype.type(1 << int(WIDTHS[selector]))
        if not fits[:, :block].any():
            break
        reach, count = 1, int(COUNTS[selector])
        while reach < count:
            step = min(reach, count - reach)
            fits = fits[:, : fits.shape[1] - step] & fits[:, step:]
            reach += step
        np.copyto(best, np.uint8(selector), where=fits[:, :block])
    return best


def encode_ids(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of ``ids`` and the first word of each block, closed by the number of words."""
    ids = np.asarray(ids)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64)
    if int(ids.max()) >> 60:
        raise ValueError("ids take at most 60 bits")
    rows = -(-n // block)
    width = block + SPARE
    padded = np.zeros((rows, width), np.uint32 if int(ids.max()) < 1 << 32 else np.uint64)
    whole = np.zeros(rows * block, padded.dtype)
    whole[:n] = ids
    padded[:, :block] = whole.reshape(rows, block)
    best = _selectors(padded).reshape(-1)
    counts = COUNTS.astype(np.int32)
    sizes = np.full(rows, block, np.int32)
    sizes[-1] = n - (rows - 1) * block
    # All blocks walk from word to word at once.
    alive, at, walked = np.arange(rows, dtype=np.int32), np.zeros(rows, np.int32), []
    while len(alive):
        chosen = best[alive * block + at]
        walked.append((alive, at, chosen))
        at = at + counts[chosen]
        going = at < sizes[alive]
        alive, at = alive[going], at[going]
    owner, start, selector = (np.concatenate(parts) for parts in zip(*walked, strict=True))
    order = np.argsort(owner, kind="stable")
    owner, start, selector = owner[order], start[order], selector[order]
    words = selector.astype(np.uint64) << np.uint64(60)
    flat, place = padded.reshape(-1), owner.astype(np.int64) * width + start
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        if not len(mine):
            continue
        from_here, packed = place[mine], np.zeros(len(mine), np.uint64)
        for k in range(COUNTS[s]):
            packed |= flat[from_here + k].astype(np.uint64) << np.uint64(k * WIDTHS[s])
        words[mine] |= packed
    first = np.searchsorted(owner, np.arange(rows + 1))
    return words, first.astype(np.uint64)


def decode_ids(words: np.ndarray, first: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids again; all blocks at once, selector by selector."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    before = np.cumsum(counts) - counts
    heads = first[:-1].astype(np.int64)
    owner = np.repeat(np.arange(len(heads)), np.diff(first.astype(np.int64)))
    place = owner * block + before - before[heads][owner] if len(heads) else before
    out = np.zeros(len(heads) * block + 240, np.uint64)
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        if not len(mine):
            continue
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        stop = (owner[mine] + 1) * block
        for k in range(COUNTS[s]):
            to = place[mine] + k
            keep = to < stop  # a block's last word may be filled up
            out[to[keep]] = (words[mine][keep] >> np.uint64(k * WIDTHS[s])) & mask
    return out[:n]


def to_file(doc_ids: list[int | None], ids: list[np.ndarray], per_doc: int = 1) -> bytes:
    """A file of documents, each of ``per_doc`` arrays of ids in a row."""
    firsts = np.zeros(len(doc_ids) + 1, "<u8")
    firsts[1:] = np.cumsum([len(x) for x in ids])[per_doc - 1 :: per_doc]
    words, blocks = encode_ids(np.concatenate(ids) if ids else np.zeros(0, np.uint64))
    return b"".join([
        MAGIC,
        struct.pack("<3Q", len(doc_ids), int(firsts[-1]), len(blocks) - 1),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(),
        firsts.tobytes(),
        blocks.astype("<u8").tobytes(),
        words.astype("<u8").tobytes(),
    ])


def from_file(body: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, first id of each document (closed by the total), ids."""
    if body[:8] != MAGIC:
        raise ValueError("not a file of Simple-8b words")
    n_docs, n_ids, n_blocks = struct.unpack("<3Q", body[8:32])
    at = 32

    def part(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(body, kind, n, at)
        at += found.nbytes
        return found

    doc_ids, nulls = part("<i8", n_docs), part("u1", n_docs)
    firsts, blocks = part("<u8", n_docs + 1), part("<u8", n_blocks + 1)
    words = part("<u8", int(blocks[-1]))
    names = [None if z else d for d, z in zip(doc_ids.tolist(), nulls.tolist(), strict=True)]
    return names, firsts, decode_ids(words.astype(np.uint64), blocks, n_ids)


_FILES = "part int, number int, n_ids long, body binary"


def _write(batches: Iterator[pa.RecordBatch], path: str, keeps_blanks: bool, end_id: int):
    encode = encoder(path, keeps_blanks).encode_rows
    end = np.array([end_id], "<u4")
    part, number = TaskContext.get().partitionId(), 0
    doc_ids, ids, held = [], [], 0

    def closed():
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([number], pa.int32()),
             pa.array([held], pa.int64()), pa.array([to_file(doc_ids, ids, 2)], pa.binary())],
            ["part", "number", "n_ids", "body"],
        )

    for batch in batches:
        names, texts = batch.column(0).to_pylist(), batch.column(1)
        for row, _, offsets in steps(texts, ENCODE_BYTES):
            found, bounds = encode(texts.slice(row, len(offsets) - 1))
            for i in range(len(bounds) - 1):
                doc_ids.append(names[row + i])
                ids += [found[bounds[i] : bounds[i + 1]], end]
                held += int(bounds[i + 1] - bounds[i]) + 1
                if held >= FILE_IDS:
                    yield closed()
                    doc_ids, ids, held, number = [], [], 0, number + 1
    if doc_ids:
        yield closed()


def write_files(docs: DataFrame, path: str, end_id: int, keeps_blanks: bool) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the table of files.

    Documents are dealt by range of doc_id (ties: by text hash) and sorted, into as many ranges as
    their bytes ask for; each task encodes its range and closes a file whenever ``FILE_IDS`` ids are held. Files travel as binary rows of a
    table in the shared folder, so that Spark commits them whole or not at all wherever the folder
    lies; (part, number) orders them. A null text is empty, a null doc_id comes first, repeated rows
    are written each. Other columns are not read.
    """
    spark = ready(docs.sparkSession)
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-n_bytes // TASK_BYTES))
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(parts, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    return stored(ordered.mapInArrow(lambda b: _write(b, path, keeps_blanks, end_id), _FILES))


def _read(batches: Iterator[pa.RecordBatch]):
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for first, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            doc_ids, bounds, ids = from_file(body.as_py())
            raw = ids.astype("<u4")
            cuts = bounds.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(cuts[:-1] + first),
                 pa.array(np.diff(cuts)),
                 pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                          pa.int64())],
                names,
            )


def read_files(files: DataFrame) -> DataFrame:
    """One row per document of a table of files, with its place among all ids of all files."""
    heads = files.select("part", "number", "n_ids")
    # One row per part: a window over all of them stays small.
    totals = heads.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = heads.select(
        "part", "number", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("shift")
    ).join(parts, "part").select("part", "number", (F.col("base") + F.col("shift")).alias("first"))
    return files.join(starts, ["part", "number"]).select("first", "body").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
