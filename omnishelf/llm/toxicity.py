"""Toxicity categories by a classifier chain trained with out-of-fold predictions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnishelf.llm.common import prefix_hash, ready, span_hash, steps, word_spans
from omnishelf.llm.quality import held_out, one_per_id

# A term counts if so many of the fitted rows have it.
TERM_ROWS = 3
# Labelled training rows, toxic and not, that are fitted; chosen by hash of their id.
CLASS_ROWS = 2000
FOLDS = 5
# Standard errors of its log odds from which on a term gets a weight.
TELLING = 3.0
# The chain, in order. Only the first two are labelled columns; the third is derived from them and
# from the training texts, see ``categories``.
CATEGORIES = ("low_quality", "toxic", "severe_toxic")
FLAG_FROM = 0.5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_rows(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct words (lower case in A-Z) of each text, as 32-bit hashes."""
    with np.errstate(over="ignore"):
        for _, data, offsets in steps(texts):
            starts, stops, rows = word_spans(data, offsets, _LETTER)
            n = len(offsets) - 1
            words = span_hash(prefix_hash(data, lower=True), starts, stops)
            row = np.repeat(np.arange(n, dtype=np.int64), np.diff(rows))
            both = np.unique((row.astype(np.uint64) << np.uint64(32)) | (words >> np.uint64(32)))
            cuts = np.searchsorted(both, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
            terms = both.astype(np.uint32)
            for r in range(n):
                yield terms[cuts[r] : cuts[r + 1]]


@dataclass
class Sparse:
    """Rows of distinct terms, flat; terms are places in a vocabulary of ``width``."""

    terms: np.ndarray
    row: np.ndarray
    n: int
    width: int

    @classmethod
    def of(cls, rows: list[np.ndarray], vocabulary: np.ndarray) -> Sparse:
        """Terms outside the sorted vocabulary are left out."""
        terms = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        place = np.minimum(np.searchsorted(vocabulary, terms), max(len(vocabulary) - 1, 0))
        known = vocabulary[place] == terms if len(vocabulary) else np.zeros(len(terms), bool)
        return cls(place[known], row[known], len(rows), len(vocabulary))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.terms], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.terms, g[self.row], self.width)

    def take(self, keep: np.ndarray) -> Sparse:
        inside = keep[self.row]
        number = np.cumsum(keep) - 1
        return Sparse(self.terms[inside], number[self.row[inside]], int(keep.sum()), self.width)


@dataclass
class Link:
    """One linear model: term weights, weights of the earlier categories, bias."""

    terms: np.ndarray
    earlier: np.ndarray
    bias: float

    def predict(self, x: Sparse, earlier: np.ndarray) -> np.ndarray:
        z = x.dot(self.terms) + earlier @ self.earlier + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_link(x: Sparse, earlier: np.ndarray, y: np.ndarray, rounds: int = 150,
             ridge: float = 2e-4, rate: float = 0.05) -> Link:
    """Logistic regression by Adam on the whole sample; classes weigh the same.

    Only terms that tell the classes apart get a weight: ``TERM_ROWS`` rows, and log odds of
    ``TELLING`` standard errors. Terms start from their log odds, which is most of what a few
    dozen labelled rows can teach.
    """
    a, b = x.back((y > 0).astype(float)), x.back((y <= 0).astype(float))
    odds = np.log((a + 0.5) / (y.sum() + 1)) - np.log((b + 0.5) / (len(y) - y.sum() + 1))
    telling = (a + b >= TERM_ROWS) & (np.abs(odds) >= TELLING * np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)))
    inside = telling[x.terms]
    x = Sparse(x.terms[inside], x.row[inside], x.n, x.width)
    size = x.width
    ones = max(y.sum(), 1e-9)
    weight = np.where(y > 0, 0.5 / ones, 0.5 / max(len(y) - ones, 1e-9))
    w = np.zeros(size + earlier.shape[1] + 1)
    w[:size] = np.where(telling, odds, 0)
    w[-1] = -1.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        link = Link(w[:size], w[size:-1], w[-1])
        g = weight * (link.predict(x, earlier) - y)
        grad = np.concatenate([x.back(g) * telling + ridge * w[:size], earlier.T @ g, [g.sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Link(w[:size], w[size:-1], w[-1])


@dataclass
class Chain:
    vocabulary: np.ndarray
    links: list[Link] = field(default_factory=list)

    def predict(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probabilities, category by category; each link sees those before it."""
        x = Sparse.of(rows, self.vocabulary)
        out = np.zeros((x.n, len(self.links)))
        for k, link in enumerate(self.links):
            out[:, k] = link.predict(x, out[:, :k])
        return out


def vocabulary_of(rows: list[np.ndarray]) -> np.ndarray:
    terms, count = np.unique(np.concatenate(rows), return_counts=True)
    return terms[count >= TERM_ROWS]


def fit_chain(x: Sparse, vocabulary: np.ndarray, y: np.ndarray, folds: np.ndarray) -> Chain:
    """Train the links in order. A link is trained on out-of-fold probabilities of the categories
    before it, so that it sees them as wrong as they will be on new texts. Terms without a weight
    in any link are dropped from the vocabulary in the end."""
    chain, earlier = Chain(vocabulary), np.zeros((x.n, 0))
    for k in range(y.shape[1]):
        out_of_fold = np.zeros(x.n)
        for f in range(FOLDS):
            inside = folds != f
            if inside.all() or not inside.any():
                continue
            link = fit_link(x.take(inside), earlier[inside], y[inside, k])
            out_of_fold[~inside] = link.predict(x.take(~inside), earlier[~inside])
        chain.links.append(fit_link(x, earlier, y[:, k]))
        earlier = np.column_stack([earlier, out_of_fold])
    used = np.any([link.terms != 0 for link in chain.links], axis=0)
    chain.vocabulary = vocabulary[used]
    chain.links = [Link(link.terms[used], link.earlier, link.bias) for link in chain.links]
    return chain


def categories(x: Sparse, quality: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Labels of the chain. low_quality: quality is 0. severe_toxic: toxic, and at least as many
    marker terms as the median toxic row; markers are the 50 terms whose presence raises the odds
    of toxic most."""
    t = toxic > 0
    a, b = x.back(t.astype(float)), x.back((~t).astype(float))
    odds = np.log((a + 0.5) / (t.sum() + 1)) - np.log((b + 0.5) / ((~t).sum() + 1))
    marker = np.zeros(x.width)
    marker[np.argsort(-odds * np.sqrt(a), kind="stable")[:50]] = 1
    found = x.dot(marker)
    least = max(2.0, float(np.median(found[t]))) if t.any() else 2.0
    return np.column_stack([quality == 0, t, t & (found >= least)]).astype(float)


def _collect(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        terms = pa.array([r.tobytes() for r in term_rows(batch.column(1))], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), terms, batch.column(2), batch.column(3), batch.column(4)],
            ["doc_id", "terms", "quality", "toxic", "print"],
        )


def train(docs: DataFrame, labels: DataFrame, class_rows: int = CLASS_ROWS) -> Chain | None:
    """Fit on at most ``class_rows`` toxic and as many other rows outside the held-out fifth.

    Null ids and toxic labels are left out, a null quality counts as good; of an id labelled more
    than once the largest labels count, and of texts under one id the one with the least hash is
    fitted. Without both kinds of rows returns None.
    """
    usable = labels.select(
        F.col("doc_id").cast("long"), F.col("quality").cast("int"), F.col("toxic").cast("int")
    ).filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out())
    usable = usable.groupBy("doc_id").agg(
        F.coalesce(F.max("quality"), F.lit(1)).alias("quality"), F.max("toxic").alias("toxic")
    )
    chosen = [
        usable.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(class_rows)
        for k in (0, 1)
    ]
    slim = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL")
    # At most 2 * class_rows ids: a bounded broadcast.
    rows = slim.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select(
        "doc_id", "text", "quality", "toxic", F.xxhash64("text").alias("print")
    ).mapInArrow(_collect, "doc_id long, terms binary, quality int, toxic int, print long")
    rows = one_per_id(rows).toArrow()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    toxic = rows["toxic"].to_numpy()[order]
    if not len(order) or toxic.min() == toxic.max():
        return None
    terms = rows["terms"].to_pylist()
    found = [np.frombuffer(terms[i], np.uint32) for i in order]
    vocabulary = vocabulary_of(found)
    x = Sparse.of(found, vocabulary)
    y = categories(x, rows["quality"].to_numpy()[order], toxic)
    return fit_chain(x, vocabulary, y, np.arange(x.n) % FOLDS)


def _scored(batches: Iterator[pa.RecordBatch], shared):
    chain: Chain | None = shared.value
    for batch in batches:
        found = np.zeros((batch.num_rows, len(CATEGORIES)))
        if chain and batch.num_rows:
            rows = list(term_rows(batch.column(1)))
            for a in range(0, len(rows), 512):
                found[a : a + 512] = chain.predict(rows[a : a + 512])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(found[:, k].copy()) for k in range(len(CATEGORIES))]],
            ["doc_id", *CATEGORIES],
        )


def score_toxicity(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """Per row: doc_id, a probability for each category, and is_toxic (toxic from 0.5 on).

    Only ``text`` is looked at, so repeated rows score alike; a null or empty text is scored without
    words, an empty table gives an empty result. Without a chain all probabilities are 0. No shuffle; the broadcast chain holds the telling terms and three weights each.
    """
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(chain)
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda b: _scored(b, shared), "doc_id long, " + ", ".join(f"{c} double" for c in CATEGORIES)
    )
    return out.withColumn("is_toxic", F.col("toxic") >= FLAG_FROM)
