"""Quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omnishelf.llm.common import kept_for, ready
from omnishelf.llm.features import TERMS, term_counts

# Labelled training rows of each class that are fitted, chosen by hash of their id. This bounds what
# the driver holds (the terms of 6,000 texts, at most 2 KB of them each, and a product of 28 MB) and
# what is broadcast (6,000 latent vectors, 1.2 MB).
CLASS_ROWS = 3000
LATENT = 48
# A vote counts exp(SHARPNESS * cosine): all labelled rows vote, near ones far more.
SHARPNESS = 24.0
REJECT_BELOW = 0.3
# Documents that one blocked product compares with all labelled vectors.
BLOCK = 256


@dataclass
class Neighbours:
    """Fitted model: term weights, projection, labelled unit vectors, their labels and weights."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def embed(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.idf) @ self.basis)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 in the votes, between 0 and 1."""
        out = np.zeros(len(counts))
        for a in range(0, len(counts), BLOCK):
            cosine = self.embed(counts[a : a + BLOCK]) @ self.vectors.T
            votes = np.exp(SHARPNESS * (cosine - cosine.max(axis=1, keepdims=True)))
            votes = votes.astype(np.float64) * self.weights
            good = votes @ self.labels
            out[a : a + BLOCK] = good / votes.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf).astype(np.float32)


@dataclass
class Counts:
    """Term counts of rows without their zeros: flat terms and values, and each row's bounds."""

    terms: np.ndarray
    values: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Counts:
        row, term = np.nonzero(counts)
        bounds = np.searchsorted(row, np.arange(len(counts) + 1))
        return cls(term.astype(np.uint16), counts[row, term], bounds)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def blocks(self) -> Iterator[np.ndarray]:
        """The rows with their zeros, ``BLOCK`` at a time."""
        for a in range(0, len(self), BLOCK):
            bounds = self.bounds[a : a + BLOCK + 1]
            dense = np.zeros((len(bounds) - 1, TERMS), np.float32)
            row = np.repeat(np.arange(len(dense)), np.diff(bounds))
            inside = slice(bounds[0], bounds[-1])
            dense[row, self.terms[inside]] = self.values[inside]
            yield dense


# Vectors that the iteration carries beside the wanted ones, and its rounds.
SPARE, ROUNDS = 16, 40


def leading_vectors(gram: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` leading eigenvectors of a symmetric matrix, largest first, by subspace iteration."""
    width = min(n + SPARE, len(gram))
    v, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((len(gram), width)))
    for _ in range(ROUNDS):
        v, _ = np.linalg.qr(gram @ v)
    values, turned = np.linalg.eigh(v.T @ (gram @ v))
    return (v @ turned)[:, np.argsort(-values, kind="stable")[:n]]


def fit(counts: Counts, labels: np.ndarray, share_of_one: float) -> Neighbours:
    """Latent-semantic basis of the labelled rows, by the eigenvectors of their term products.

    ``share_of_one`` is the share of label 1 among all training labels; votes are weighted so that
    the classes count as often as they occur there, however many rows of each were fitted. Rows
    take their zeros a block at a time, so beside the counts only the product of terms is held.
    """
    present = np.bincount(counts.terms, minlength=TERMS)
    idf = (np.log((1 + len(counts)) / (1 + present)) + 1).astype(np.float32)
    gram = np.zeros((TERMS, TERMS))
    for block in counts.blocks():
        x = _weighted(block, idf)
        gram += x.T @ x
    basis = leading_vectors(gram, LATENT).astype(np.float32)
    del gram
    vectors = np.concatenate([_unit(_weighted(block, idf) @ basis) for block in counts.blocks()])
    ones = labels.mean()
    weight = np.where(labels == 1, share_of_one / max(ones, 1e-9), (1 - share_of_one) / max(1 - ones, 1e-9))
    return Neighbours(idf, basis, vectors, labels.astype(np.float32), weight.astype(np.float32))


def _collect(batches: Iterator[pa.RecordBatch]):
    kept_for("quality")
    for batch in batches:
        terms, values = [], []
        for block in term_counts(batch.column(1)):
            found = Counts.of(block)
            for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True):
                terms.append(found.terms[a:b].tobytes())
                values.append(found.values[a:b].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(terms, pa.binary()), pa.array(values, pa.binary()),
             batch.column(2), batch.column(3)],
            ["doc_id", "terms", "values", "label", "print"],
        )


def one_per_id(rows: DataFrame) -> DataFrame:
    """Of the rows under one doc_id the one with the least ``print``; taken in each task first."""
    others = [c for c in rows.columns if c not in ("doc_id", "print")]
    least = F.min(F.struct("print", *others)).alias("least")
    return rows.groupBy("doc_id").agg(least).select("doc_id", *[f"least.{c}" for c in others])


def _flat(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """All values of a column of packed arrays, one row after the other."""
    parts = [np.frombuffer(cell.as_buffer(), kind) for chunk in column.chunks for cell in chunk]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def held_out(doc_id="doc_id"):
    """The fifth of ids that never trains: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality",
          class_rows: int = CLASS_ROWS) -> Neighbours | None:
    """Fit on at most ``class_rows`` labelled rows of each class outside the held-out fifth.

    Rows are chosen by the hash of their id, so the choice does not depend on partitions. Null
    labels and ids are left out; of an id labelled more than once the largest label counts, and of
    texts under one id the one with the least hash is fitted. Without rows of both classes there is
    nothing to learn: returns None.
    """
    usable = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
    usable = usable.filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(~held_out())
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    n, ones = usable.agg(F.count("*"), F.sum("label")).first()
    if not n or not ones or ones == n:
        return None
    chosen = [
        usable.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(class_rows)
        for k in (0, 1)
    ]
    chosen = chosen[0].union(chosen[1])
    slim = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL")
    # At most 2 * class_rows ids: a bounded broadcast.
    found = slim.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "text", "label", F.xxhash64("text").alias("print")
    )
    counted = found.mapInArrow(
        _collect, "doc_id long, terms binary, values binary, label int, print long"
    )
    rows = one_per_id(counted).toArrow().sort_by("doc_id")
    if not len(rows):
        return None
    terms, values = _flat(rows["terms"], np.uint16), _flat(rows["values"], np.float32)
    sizes = pc.divide(pc.binary_length(rows["terms"]), 2).to_numpy()
    found = rows["label"].to_numpy()
    if found.min() == found.max():
        return None
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return fit(Counts(terms, values, bounds), found, ones / n)


def _scored(batches: Iterator[pa.RecordBatch], shared, names: list[str], text_at: int):
    kept_for("quality")
    model = shared.value
    for batch in batches:
        parts = [model.score(c) for c in term_counts(batch.column(text_at))] if model else []
        scores = np.concatenate(parts) if parts else np.full(batch.num_rows, 1.0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*names, "score"])


def score_quality(docs: DataFrame, model: Neighbours | None) -> DataFrame:
    """``docs`` with score (0 to 1, high: label 1 likelier) and predicted (1 from 0.3 on).

    Only ``text`` is looked at, so repeated rows score alike. A null or empty text is scored as a
    document without words, an empty table gives an empty result. Without a model every score is 1: nothing is rejected on no evidence. No shuffle; the model (about
    1.5 MB, bounded by ``CLASS_ROWS``) is broadcast. Columns named score or predicted are replaced.
    """
    spark = ready(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    shared = spark.sparkContext.broadcast(model)
    names, at = docs.columns, docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    out = docs.mapInArrow(lambda b: _scored(b, shared, names, at), schema)
    return out.withColumn("predicted", (F.col("score") >= REJECT_BELOW).cast("int"))
