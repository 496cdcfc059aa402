"""Pack documents into fixed windows: best-fit decreasing over a segment tree of capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnishelf.llm.common import ready, stored
from omnishelf.llm.encoding import encoder

WINDOW = 2048
# Pieces that one packing task handles; groups of this size leave padding well below one percent.
GROUP_PIECES = 8192

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"


class CapacityTree:
    """Which remaining capacities have an open window, with the tightest sufficient one on request.

    Leaf c of the tree counts the open windows with c places left; an inner node adds up its two
    children. ``tightest`` climbs from a leaf until a right sibling holds a window and descends to
    its leftmost one.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.counts[node] += by
            node >>= 1

    def put(self, window_id: int, capacity: int) -> None:
        if capacity:
            self.open[capacity].append(window_id)
            self._add(capacity, 1)

    def tightest(self, needed: int) -> int | None:
        counts, node = self.counts, needed + self.leaves
        if not counts[node]:
            while node & 1 or not counts[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node if counts[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.open[capacity].pop()


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; ``lengths`` descend and lie in 1..window."""
    tree = CapacityTree(window)
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    windows = 0
    for i, length in enumerate(lengths.tolist()):
        capacity = tree.tightest(length)
        if capacity is None:
            capacity, number = window, windows
            windows += 1
        else:
            number = tree.take(capacity)
        where[i], offset[i] = number, window - capacity
        tree.put(number, capacity - length)
    return where, offset


def _cut(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int):
    encode = encoder(path, keeps_blanks=True).encode
    end = int(end_id).to_bytes(4, "little")
    row = 0
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = encode(text.as_py()) + end
            total = len(ids) // 4
            for start in range(0, total, window):
                piece = ids[4 * start : 4 * (start + window)]
                out.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total, row & 1023))
            row += 1
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 6)], names
        )


def _place(pieces: pd.DataFrame, window: int) -> pd.DataFrame:
    pieces = pieces.sort_values(
        ["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True]
    )
    where, offset = best_fit(pieces["length"].to_numpy(), window)
    pieces["sequence_id"] = (pieces.pop("pack_group").to_numpy() << 32) + where
    pieces["offset"] = offset
    return pieces


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = 1,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces of all documents with their place in padded sequences of ``window`` tokens.

    A document is its ids and ``end_id``. It is cut into full windows, which are sequences of their
    own, and a rest. Rests are dealt into groups of about ``group_pieces`` and each group is packed
    by best-fit decreasing, so that no task holds more, whatever the corpus. Ties are broken by
    document and start. A null text is empty, so its document is its end id; a null doc_id is kept.
    Repeated rows are packed once each. No rows give no pieces. Only ``doc_id`` and ``text`` of the
    input are used. Sequence ids are unique but not contiguous: group * 2**32 + number.
    """
    ready(docs.sparkSession)
    pieces = stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            lambda batches: _cut(batches, path, window, end_id), _PIECES
        )
    )
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn(
        "pack_group", F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(groups)).cast("long")
    ).drop("salt")
    return dealt.groupBy("pack_group").applyInPandas(
        lambda group: _place(group, window),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long",
    )
