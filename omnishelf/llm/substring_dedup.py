"""Remove lines and sentences that occur earlier in the corpus, by hashing normalised units."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omnishelf.llm.common import (
    NOT_SPACE,
    _powers,
    mix,
    prefix_hash,
    ready,
    span_hash,
    steps,
    stored,
    word_spans,
)

# Of so many words in a row of one sentence at least one closes a unit: the last of least hash. Equal
# passages of one line are so cut alike but for less than so many words at either end, and of 51
# words at least 20 match.
WINDOW = 16
# Repeated units inside lines go where those in a row, within one line, have so many bytes in their
# words. Shorter repeats, such as "It is.", come about by chance. Whole lines have no such bound.
LEAST_BYTES = 32
# Short lines and lines of several units are compared with lines only.
_LINE = np.uint64(0x5851F42D4C957F2D)

_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[ord(c) for c in ".!?"]] = True
_OTHER_ENDS = [c.encode() for c in "\u0589\u061f\u06d4\u0964\u0965\u0f0d\u104b\u1362\u1367\u17d4\u2026\u203c\u2047\u2048\u2049\u3002\ufe52\uff01\uff0e\uff1f\uff61"]
_CLOSING = [c.encode() for c in "\"')]}\u00bb\u2019\u201d\u300d\u300f\uff09"]
_LEAD = np.zeros(256, bool)
_LEAD[[c[0] for c in _OTHER_ENDS]] = True


def _behind(data: np.ndarray, at: np.ndarray, marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places ``at`` hold one of the marks, and where that ends."""
    held, stop = np.zeros(len(at), bool), at.copy()
    for mark in marks:
        here = at + len(mark) <= len(data)
        for k, byte in enumerate(mark):
            here[here] = data[at[here] + k] == byte
        held |= here
        stop[here] += len(mark)
    return held, stop


def _sentences(data: np.ndarray, offsets: np.ndarray):
    """Where sentences may end (flags), with closing quotes and brackets, and where words end for
    want of blanks: at ideographs and kana, one word each, and at sentence ends beyond ASCII."""
    lead = np.flatnonzero(_LEAD[data])
    held, stop = _behind(data, lead, _OTHER_ENDS)
    others = stop[held]
    ends = np.concatenate([np.flatnonzero(_SENTENCE_END[data]) + 1, others])
    beyond = np.arange(len(ends)) >= len(ends) - len(others)
    for _ in range(2):
        held, stop = _behind(data, ends, _CLOSING)
        held &= ~np.isin(ends, offsets)
        ends = np.where(held, stop, ends)
    flags = np.zeros(len(data) + 1, bool)
    flags[ends] = True
    wide = np.flatnonzero((data >= 0xE3) & (data <= 0xE9))
    return flags, np.unique(np.concatenate([offsets, ends[beyond], wide, wide + 3]))


def _closes(words: np.ndarray, sentence_end: np.ndarray) -> np.ndarray:
    """Which words close a unit: sentence ends, and of each ``WINDOW`` words within a sentence the
    last one of least hash. Nothing else counts, so equal words are cut alike wherever they stand."""
    closes, n = sentence_end.copy(), len(words)
    if n >= WINDOW:
        sentence = np.cumsum(sentence_end) - sentence_end
        least, span = np.arange(n), 1
        while span < WINDOW:
            left, right = least[:-span], least[span:]
            least = np.where(words[right] <= words[left], right, left)
            span *= 2
        closes[least[sentence[: n - WINDOW + 1] == sentence[WINDOW - 1 :]]] = True
    return closes


_SECOND = np.uint64(0xA0761D6478BD642F)


class Units(NamedTuple):
    """Of one text, in order of place: units (sentences or parts of them) and compared digests.

    A digest covers the units ``lo`` to ``hi``: one, or with ``whole`` all of a line. A second hash
    tells digests apart, of which 32 bits are compared as well, since they decide what is deleted.
    """

    digest: np.ndarray
    second: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    whole: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    size: np.ndarray
    line: np.ndarray


def units(texts: pa.Array) -> Iterator[Units]:
    """Per text its units with first and last byte offset (exclusive), bytes in words, and line.

    A unit is a line or, within a line, a sentence or a part of a long one; every byte of a word lies in one unit. A
    digest covers words in lower case (A-Z), so blanks and letter case do not matter. Lines of
    several units have a digest too; lines of less than ``LEAST_BYTES`` have only that.
    """
    with np.errstate(over="ignore"):
        for _, data, offsets in steps(texts):
            sentence_end, bounds = _sentences(data, offsets)
            starts, stops, _ = word_spans(data, bounds, NOT_SPACE)
            rows = np.searchsorted(starts, offsets)
            words = span_hash(prefix_hash(data, lower=True), starts, stops)
            powers, inverses = _powers(len(words) + 1)
            sums = np.zeros((2, len(words) + 1), np.uint64)
            np.cumsum(words * powers[: len(words)], out=sums[0, 1:])
            np.cumsum(mix(words ^ _SECOND) * powers[: len(words)], out=sums[1, 1:])

            def digest(lo, hi, which, sums=sums, inverses=inverses):
                span = sums[which][hi] - sums[which][lo]
                return span * inverses[lo] + (hi - lo).astype(np.uint64)

            lines = np.zeros(len(data) + 1, np.int32)
            np.cumsum(data == 10, out=lines[1:])
            ends_line = np.zeros(len(words), bool)
            ends_line[:-1] = lines[starts[1:]] > lines[stops[:-1]]
            ends_line[rows[1:][rows[1:] > 0] - 1] = True
            hi = np.flatnonzero(_closes(words, sentence_end[stops] | ends_line)) + 1
            lo = np.concatenate([[0], hi])[: len(hi)]
            line_hi = np.flatnonzero(ends_line) + 1
            line_lo = np.concatenate([[0], line_hi])[: len(line_hi)]
            heavy = np.concatenate([[0], np.cumsum(stops - starts)])
            size = heavy[hi] - heavy[lo]
            line = np.searchsorted(line_hi, hi)
            many = np.bincount(line, minlength=len(line_hi)) > 1
            short = heavy[line_hi] - heavy[line_lo] < LEAST_BYTES
            single = np.flatnonzero((many | ~short)[line])
            whole = np.flatnonzero(many | short)
            first = np.concatenate([single, np.searchsorted(lo, line_lo[whole])])
            behind = np.concatenate([single, np.searchsorted(hi, line_hi[whole])]) + 1
            digests, seconds = (
                np.concatenate([
                    mix(digest(lo[single], hi[single], which)),
                    mix(digest(line_lo[whole], line_hi[whole], which) ^ _LINE),
                ])
                for which in (0, 1)
            )
            is_line = np.arange(len(digests)) >= len(single)
            order = np.lexsort((is_line, first))
            first, behind, is_line, digests, seconds = (
                x[order] for x in (first, behind, is_line, digests, seconds)
            )
            at = np.searchsorted(lo, rows)
            of = np.searchsorted(first, at)
            for r in range(len(rows) - 1):
                a, b, c, d = at[r], at[r + 1], of[r], of[r + 1]
                yield Units(
                    digests[c:d], seconds[c:d], first[c:d] - a, behind[c:d] - a, is_line[c:d],
                    starts[lo[a:b]] - offsets[r], stops[hi[a:b] - 1] - offsets[r], size[a:b], line[a:b],
                )


def removable(of: Units, repeated: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which units go: those of repeated lines, and repeated ones of which ``LEAST_BYTES`` stand in
    a row of their line; but not the first of a digest whose earliest document this is."""
    gone = repeated.copy()
    mine = np.flatnonzero(own)
    gone[mine[np.unique(of.digest[mine], return_index=True)[1]]] = False
    one = np.zeros(len(of.size), bool)
    one[of.lo[gone & ~of.whole]] = True
    turns = np.ones(len(one), bool)
    turns[1:] = (one[1:] != one[:-1]) | (of.line[1:] != of.line[:-1])
    row = np.cumsum(turns) - 1
    one &= np.bincount(row, of.size)[row] >= LEAST_BYTES
    lines = np.zeros(len(one) + 1, np.int64)
    lines[of.lo[gone & of.whole]] += 1
    lines[of.hi[gone & of.whole]] -= 1
    return one | (np.cumsum(lines)[:-1] > 0)


# Bits of a text's hash that stand above the unit's number, to tell texts under one id apart.
PRINT_BITS = 30


def _print(text: Column) -> Column:
    return F.shiftleft(F.xxhash64(text).bitwiseAND(F.lit((1 << PRINT_BITS) - 1)), 32)


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        prints = batch.column(2).to_numpy(zero_copy_only=False)
        digests, seconds, counts = [], [], []
        for of in units(batch.column(1)):
            digests.append(of.digest)
            seconds.append((of.second >> np.uint64(32)).astype(np.uint32))
            counts.append(len(of.digest))
        if counts:
            numbers = np.concatenate([np.arange(n, dtype=np.int64) for n in counts])
            numbers += np.repeat(prints, counts).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(digests).view(np.int64)),
                 pa.array(np.concatenate(seconds).view(np.int32)),
                 pa.array(np.repeat(ids, counts).astype(np.int64)), pa.array(numbers)],
                ["digest", "second", "id", "unit"],
            )


def _cut(batches: Iterator[pa.RecordBatch], text_at: int, names: list[str]):
    for batch in batches:
        texts, marks, prints = (batch.column(i) for i in (text_at, len(names), len(names) + 1))
        out = {k: [] for k in ("text", "n_units", "n_removed_units", "n_bytes", "n_removed", "spans")}
        for of, text, marked, own_print in zip(units(texts), texts, marks, prints, strict=True):
            body = b"" if text.as_py() is None else text.as_py().encode()
            start, spans, gone = of.start, [], np.zeros(len(of.start), bool)
            if marked.is_valid:
                repeated = np.zeros(len(of.digest), bool)
                own = repeated.copy()
                at = np.array(marked.as_py(), np.int64)
                # A mark is twice the digest's number, plus one in the digest's earliest document;
                # above both stands the hash of the text it belongs to.
                at = at[at >> 33 == own_print.as_py() >> 32] & ((1 << 33) - 1)
                repeated[at >> 1] = True
                own[at[at & 1 == 1] >> 1] = True
                gone = removable(of, repeated, own)
            kept, last = [], 0
            edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                # A span takes the blanks behind it along.
                lo, hi = int(start[a]), int(start[b]) if b < len(start) else len(body)
                kept.append(body[last:lo])
                spans.append({"start": lo, "stop": hi})
                last = hi
            kept.append(body[last:])
            left = b"".join(kept)
            out["text"].append(left.decode() if spans else text.as_py())
            out["n_units"].append(len(start))
            out["n_removed_units"].append(int(gone.sum()))
            out["n_bytes"].append(len(body))
            out["n_removed"].append(len(body) - len(left))
            out["spans"].append(spans)
        arrays = [
            pa.array(out["text"], pa.string()) if i == text_at else batch.column(i)
            for i in range(len(names))
        ]
        whole = pa.int64()
        arrays += [pa.array(out[k], whole) for k in list(out)[1:5]]
        arrays.append(pa.array(out["spans"], pa.list_(pa.struct([("start", whole), ("stop", whole)]))))
        yield pa.RecordBatch.from_arrays(arrays, [*names, *list(out)[1:]])


_REPORT = "n_units long, n_removed_units long, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>"


def dedup_units(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``, and what was cut.

    Adds n_units, n_removed_units, n_bytes, n_removed (bytes) and spans (offsets in the bytes of the
    input text). Every later copy of a line goes, whatever its length, in the order of doc_id and
    position. Inside a line, later copies of sentences and of parts of long ones go where the repeated ones in a row hold
    ``LEAST_BYTES`` or more in their words; shorter ones stay. Digests
    are counted with partial sums, and their earliest document is joined back on two exchanges, so
    that Spark can split a line which fills a third of the corpus. What one document has of repeated
    units is gathered per document, never per digest.

    A null text has no units and stays null; a null doc_id has no rank, its row stays as it is and
    counts for nothing; rows that repeat a doc_id, with the same text or
    another one, are one document to the ranking and each keep
    their first occurrence. Columns of the input that bear a report column's name are replaced.
    """
    ready(docs.sparkSession)
    report = T.StructType.fromDDL(_REPORT)
    docs = docs.drop(*report.names)
    text = docs.select(F.col("doc_id").cast("long"), "text").filter(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    rows = text.select("doc_id", "text", _print(F.col("text"))).mapInArrow(
        _rows, "digest long, second int, id long, unit long"
    )
    repeated = stored(
        rows.groupBy("digest", "second")
        .agg(F.count("*").alias("n"), F.min("id").alias("first"))
        .filter("n > 1")
        .select(F.col("digest").alias("known"), F.col("second").alias("known_second"), "first")
    )
    same = (F.col("digest") == F.col("known")) & (F.col("second") == F.col("known_second"))
    marks = rows.join(repeated, same).select(
        "id", (2 * F.col("unit") + (F.col("id") == F.col("first")).cast("long")).alias("mark")
    )
    marks = marks.groupBy(F.col("id").alias("marked_id")).agg(F.collect_list("mark").alias("marks"))
    names = docs.columns
    # The row goes through the join in one struct, so that its columns cannot clash.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col("doc_id").cast("long").alias("row_id"),
    )
    joined = rows.join(marks, F.col("row_id") == F.col("marked_id"), "left")
    # Arrow columns go by place: those of the input, then the marks.
    parts = [F.col(f"row.`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    joined = joined.select(*parts, "marks", _print(F.col("row.text")).alias("print"))
    schema = T.StructType([*docs.schema.fields, *report.fields])
    at = names.index("text")
    return joined.mapInArrow(lambda b: _cut(b, at, names), schema)
