"""Trained scorers on held-out labels, and vector search against brute force."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from omnishelf.llm import quality, toxicity, vectors

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    return (rank[label == 1].mean() - rank[label == 0].mean()) / len(order) + 0.5


def test_quality_on_held_out_rows(real):
    docs, labels = real
    out = quality.score_quality(docs, quality.train(docs, labels)).join(labels, "doc_id").toPandas()
    held = out[[zlib.crc32(str(i).encode()) % 5 == 0 for i in out["doc_id"]]]
    assert auc(held["score"].to_numpy(), held["quality"].to_numpy()) > 0.9
    good = held[held["quality"] == 1]
    assert (good["predicted"] == 1).mean() > 0.97


def test_toxicity_on_held_out_rows(real):
    docs, labels = real
    out = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    out = out.join(labels.withColumnRenamed("toxic", "label"), "doc_id").toPandas()
    held = out[[zlib.crc32(str(i).encode()) % 5 == 0 for i in out["doc_id"]]]
    assert auc(held["toxic"].to_numpy(), held["label"].to_numpy()) > 0.75


def test_scorers_without_rows_or_labels(spark, docs, none, rows):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, None), (None, 0, 1), (2, None, 0)], "doc_id long, quality int, toxic int")
    for labels in (empty, one):
        assert quality.train(docs, labels) is None and toxicity.train(docs, labels) is None
    scored = quality.score_quality(docs, None)
    assert scored.count() == len(rows) and scored.filter("predicted = 0").count() == 0
    assert scored.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans", "score", "predicted"]
    assert toxicity.score_toxicity(docs, None).count() == len(rows)
    both = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(40)], "doc_id long, quality int, toxic boolean")
    both = both.selectExpr("doc_id", "quality", "cast(toxic AS int) AS toxic")
    model, chain = quality.train(docs, both), toxicity.train(docs, both)
    for got in (quality.score_quality(docs, model).collect(), toxicity.score_toxicity(docs, chain).collect()):
        assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 for r in quality.score_quality(docs, model).collect())
    assert quality.score_quality(none, model).count() == toxicity.score_toxicity(none, chain).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 12)) * rng.uniform(0.5, 2, (600, 1))
    x[100:140] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(700, None), (720, [0.0] * 12), (740, [float("nan")] * 12), (None, [1.0] * 12),
           (760, [None] * 12), (780, [float("inf")] * 12), (800, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in vectors.nearest(frame).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {*got} == {i for i in range(600) if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        score = x @ x[q]
        assert np.allclose([f[2] for f in found], score[[f[1] for f in found]], rtol=1e-12)
        order = sorted((i for i in range(600) if i != q), key=lambda i: (-score[i], i))[:20]
        hits += len({*order} & {f[1] for f in found})
        keys = [(-f[2], f[1]) for f in found]
        assert keys == sorted(keys)
    assert hits >= 0.9 * 20 * len(got)
    few = vectors.nearest(frame.filter("vec_id < 4 OR vec_id = 20")).collect()
    assert len(few) == 8
    assert vectors.nearest(frame.limit(0)).count() == 0


def clusters(rng, n, dims, centres):
    middle = rng.standard_normal((centres, dims))
    return middle[rng.integers(0, centres, n)] + 0.15 * rng.standard_normal((n, dims))


@pytest.mark.parametrize(("kind", "most"), [("clustered", 0.5), ("registered", 0.95)])
def test_scans_abandon_candidates(spark, kind, most):
    """The share of coordinates that the second pass looks at, and what abandoning loses."""
    if kind == "clustered":
        x = clusters(np.random.default_rng(3), 4000, 64, 40)
    else:
        column = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding")
        x = np.array([r[0] for r in column.collect() if r[0] is not None], float)
    norms = np.sqrt((x**2).sum(axis=1))
    turn, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((x.shape[1] + 1,) * 2))
    index = vectors.Index(float(norms.max()), turn, np.zeros((0, x.shape[1] + 1)))
    cell = vectors.Cell(index, np.arange(len(x)), x)
    asked = np.arange(0, len(x), 20)
    targets = index.place(x[asked], query=True)
    hits = 0
    for q, target in zip(asked, targets, strict=True):
        score = x @ x[q]
        score[q] = -np.inf
        order = np.lexsort((np.arange(len(x)), -score))[:20]
        # The bound that the nearest lists would give: somewhat below the true one.
        least = score[np.argsort(-score)[40]]
        found, _ = cell.scan(q, x[q], target, 20, least)
        hits += len({*order.tolist()} & {*found.tolist()})
    share = cell.looked / (len(asked) * len(x) * cell.width)
    print(f"{kind}: {share:.3f} of the coordinates, recall {hits / (20 * len(asked)):.4f}")
    assert share < most and hits >= 0.97 * 20 * len(asked)


def test_queries_scan_together_as_one_by_one():
    """Blocks compared whole give what pairs give, for scores of any size, with far fewer steps."""
    x = clusters(np.random.default_rng(5), 3000, 32, 25)
    x[100:300] = x[100]
    for size in (1.0, 1e6):
        y = x * size
        turn, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((33, 33)))
        index = vectors.Index(float(np.sqrt((y**2).sum(axis=1).max())), turn, np.zeros((0, 33)))
        cell = vectors.Cell(index, np.arange(len(y)), y)
        asked = np.arange(0, len(y), 10)
        targets = index.place(y[asked], query=True)
        least = np.array([np.sort(y @ y[q])[-60] if q % 30 else -np.inf for q in asked])
        q, ids, scores = cell.scan_all(asked, y[asked], targets, least, 20)
        for n, query in enumerate(asked):
            alone = cell.scan(query, y[query], targets[n], 20, least[n])
            assert np.array_equal(ids[q == n], alone[0]) and np.array_equal(scores[q == n], alone[1])
            assert query not in ids[q == n]


def test_a_cell_does_not_step_query_by_query(monkeypatch):
    """Steps of a cell follow the chunks of its vectors, not its queries times those."""
    x = np.random.default_rng(6).standard_normal((500, 16))
    turn, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((17, 17)))
    index = vectors.Index(float(np.sqrt((x**2).sum(axis=1).max())), turn, np.zeros((0, 17)))
    cell = vectors.Cell(index, np.arange(len(x)), x)
    calls, near = [], vectors.Cell._near
    monkeypatch.setattr(vectors.Cell, "_near", lambda self, *a: calls.append(1) or near(self, *a))
    cell.scan_all(np.arange(500), x, index.place(x, query=True), np.full(500, -np.inf), 20)
    assert len(calls) <= 2 * 4


def test_a_repeated_query_asks_with_its_least_vector(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 6)))]
    rows += [(20, [-9.0, 1.0, 1.0, 1.0, 1.0, 1.0]), (20, [5.0] * 6)]
    got = []
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "vec_id long, embedding array<double>").repartition(3)
        got.append({r.vec_id: r.score for r in vectors.nearest(frame).filter("query_id = 20").collect()})
    assert got[0] == got[1] and len(got[0]) == 20
    query = np.array([-9.0, 1, 1, 1, 1, 1])
    assert all(abs(s - query @ np.array(rows[i][1])) < 1e-9 for i, s in got[0].items())


def test_leading_vectors_are_the_eigenvectors():
    rng = np.random.default_rng(2)
    basis, _ = np.linalg.qr(rng.standard_normal((300, 300)))
    gram = (basis * 0.9 ** np.arange(300)) @ basis.T
    found = quality.leading_vectors(gram, 48)
    same = np.abs((found * basis[:, :48]).sum(axis=0))
    assert (same > 1 - 1e-6).all()


def test_votes_match_a_naive_count():
    """Weights of labelled neighbours, document by document, from the definition."""
    rng = np.random.default_rng(6)
    dense = (rng.random((90, quality.TERMS)) < 0.02) * rng.integers(1, 9, (90, quality.TERMS))
    dense = dense.astype(np.float32)
    dense[7] = 0
    labels = (np.arange(90) % 3 > 0).astype(np.int32)
    counts = quality.Counts.of(dense)
    assert np.array_equal(np.concatenate([*counts.blocks()]), dense)
    model = quality.fit(counts, labels, 0.4)
    idf = np.log(91 / (1 + (dense > 0).sum(axis=0))) + 1
    unit = lambda v: v / max(np.linalg.norm(v), 1e-9)
    embed = lambda row: unit(unit(np.log1p(row) * idf) @ model.basis.astype(float))
    known = [embed(row) for row in dense]
    asked = (rng.random((40, quality.TERMS)) < 0.02).astype(np.float32)
    for row, got in zip(asked, model.score(asked), strict=True):
        near = [embed(row) @ v for v in known]
        weight = [
            np.exp(quality.SHARPNESS * c) * (0.4 / labels.mean() if l else 0.6 / (1 - labels.mean()))
            for c, l in zip(near, labels, strict=True)
        ]
        want = sum(w for w, l in zip(weight, labels, strict=True) if l) / sum(weight)
        assert abs(got - want) < 2e-3


def test_chain_matches_its_links():
    """Probabilities link by link, row by row; links see out-of-fold values of those before them."""
    rng = np.random.default_rng(7)
    rows = [np.unique(rng.integers(0, 60, rng.integers(3, 20))).astype(np.uint32) for _ in range(200)]
    y = np.array([[8 in r, 8 in r and 9 in r] for r in rows], float)
    vocabulary = toxicity.vocabulary_of(rows)
    x = toxicity.Sparse.of(rows, vocabulary)
    folds = np.arange(len(rows)) % toxicity.FOLDS
    chain = toxicity.fit_chain(x, vocabulary, y, folds)
    got = chain.predict(rows)
    for r, row in enumerate(rows):
        before = []
        for k, link in enumerate(chain.links):
            z = link.bias + sum(w * p for w, p in zip(link.earlier, before, strict=True))
            z += sum(w for t, w in zip(chain.vocabulary, link.terms, strict=True) if t in row)
            before.append(1 / (1 + np.exp(-z)))
            assert abs(got[r, k] - before[-1]) < 1e-9
    # The second link, trained anew from out-of-fold values of the first.
    out = np.zeros(len(rows))
    for f in range(toxicity.FOLDS):
        link = toxicity.fit_link(x.take(folds != f), np.zeros(((folds != f).sum(), 0)), y[folds != f, 0])
        out[folds == f] = link.predict(x.take(folds == f), np.zeros(((folds == f).sum(), 0)))
    again = toxicity.fit_link(x, out[:, None], y[:, 1])
    assert np.allclose(again.earlier, chain.links[1].earlier) and np.isclose(again.bias, chain.links[1].bias)
    known = np.isin(vocabulary, chain.vocabulary)
    assert np.allclose(again.terms[known], chain.links[1].terms) and not again.terms[~known].any()


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_on_registered_table(spark, folder):
    frame = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    rows = [(i, v) for i, v in frame.select("vec_id", "embedding").collect() if i is not None and v is not None]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    got = {}
    for r in vectors.nearest(frame).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q, found in got.items():
        score = x @ x[ids == q][0]
        order = [int(ids[k]) for k in np.lexsort((ids, -score)) if ids[k] != q][:20]
        hits, total = hits + len(found & {*order}), total + len(order)
    print(f"recall on {folder}: {hits / total:.4f}")
    assert len(got) == sum(ids % 20 == 0) and hits >= 0.93 * total
