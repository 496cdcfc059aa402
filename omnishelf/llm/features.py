"""Bounded hashed term counts of whole texts, for the trained scorers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from omnishelf.llm.common import NOT_SPACE, prefix_hash, span_hash, steps, word_spans

WORDS, SHAPES, ENDINGS, STATS = 1024, 512, 256, 6 * 16
TERMS = WORDS + SHAPES + ENDINGS + STATS

# 0 other, 1 lower, 2 upper, 3 digit, 4 punctuation, 5 beyond ASCII
_KIND = np.zeros(256, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 5
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4


def term_counts(texts: pa.Array) -> Iterator[np.ndarray]:
    """Blocks of rows, in order: rows x TERMS counts as float32.

    Terms are hashed words (lower case in A-Z), word shapes (first and last kind of character,
    length, share of capitals), the last two bytes of words, and six document statistics in 16
    steps each: distinct words per word, mean word length, shares of capitals and punctuation, words
    per line, and the share of words that repeat the one before.
    """
    with np.errstate(over="ignore"):
        for _, data, offsets in steps(texts):
            starts, stops, bounds = word_spans(data, offsets, NOT_SPACE)
            n, sizes = len(offsets) - 1, np.diff(bounds)
            row = np.repeat(np.arange(n), sizes)
            words = span_hash(prefix_hash(data, lower=True), starts, stops)
            length = stops - starts
            kind = _KIND[data]
            capitals = np.concatenate([[0], np.cumsum(kind == 2, dtype=np.int64)])
            marks = np.concatenate([[0], np.cumsum(kind == 4, dtype=np.int64)])
            lines = np.concatenate([[0], np.cumsum(data == 10, dtype=np.int64)])
            caps = capitals[stops] - capitals[starts]
            shape = kind[starts].astype(np.int64) * 6 + kind[stops - 1]
            shape = (shape * 4 + np.minimum(length // 4, 3)) * 3 + (caps * 2 >= length) + (caps == length)
            end = data[stops - 1].astype(np.int64) * 31 + data[np.maximum(stops - 2, starts)]
            word = (words % np.uint64(WORDS)).astype(np.int64)
            flat = np.concatenate([
                row * TERMS + word,
                row * TERMS + WORDS + shape % SHAPES,
                row * TERMS + WORDS + SHAPES + end % ENDINGS,
            ])
            counts = np.bincount(flat, minlength=n * TERMS).astype(np.float32).reshape(n, TERMS)
            # A word met before in its document: 16 bits of row, 48 of hash.
            seen = np.unique((row.astype(np.uint64) << np.uint64(48)) | (words >> np.uint64(16)))
            distinct = np.bincount((seen >> np.uint64(48)).astype(np.int64), minlength=n)
            again = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
            again = np.bincount(row[1:][again], minlength=n)
            of = lambda c: c[offsets[1:]] - c[offsets[:-1]]
            total = np.maximum(sizes, 1)
            letters = np.maximum(np.diff(offsets), 1)
            stats = np.stack([
                distinct / total,
                np.minimum(np.bincount(row, length, n) / total / 16, 1),
                of(capitals) / letters,
                np.minimum(of(marks) / letters * 2, 1),
                np.minimum(np.log2(1 + total / (1 + of(lines))) / 10, 1),
                np.sqrt(again / total),
            ], axis=1)
            steps16 = np.minimum((stats * 16).astype(np.int64), 15) + np.arange(stats.shape[1]) * 16
            place = WORDS + SHAPES + ENDINGS + steps16
            counts[np.arange(n)[:, None], place] = 1 + sizes[:, None] / 8
            yield counts
