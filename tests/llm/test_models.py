"""Held-out accuracy and edge cases of the two classifiers."""

import random

import numpy as np
import pyarrow as pa
import pytest

from postloom.llm import quality, toxicity
from postloom.llm.labelled import held_out, labels_of
from postloom.llm.queries import op7_quality_qda, op10_toxicity_ftrl

WIDE = "/root/testdata/sf0.1"


def held_rows(spark, query, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{WIDE}/labels.parquet").collect()}
    rows = query(spark, WIDE).collect()
    assert len(rows) == spark.read.parquet(f"{WIDE}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)
    return [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


def test_toxicity_held_out(spark):
    pairs = held_rows(spark, op10_toxicity_ftrl, "toxic")
    assert sum(p == y for p, y in pairs) / len(pairs) > 0.95
    clean = [p for p, y in pairs if not y]
    assert sum(clean) / len(clean) < 0.01


def test_quality_held_out(spark):
    pairs = held_rows(spark, op7_quality_qda, "quality")
    assert sum(p == y for p, y in pairs) / len(pairs) > 0.98
    good = [p for p, y in pairs if y]
    assert sum(good) / len(good) > 0.99


def test_labels(spark):
    rows = [(0, 1), (0, 1), (3, 0), (3, 1), (4, None), (None, 1), (5, 7), *[(i, i % 2) for i in range(10, 40)]]
    labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    ids = spark.range(40).withColumnRenamed("id", "doc_id")
    import zlib

    expected = {i for i in range(40) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert {r.doc_id for r in ids.filter(held_out()).collect()} == expected
    found = {r.id: r.label for r in labels_of(labels, "toxic").collect()}
    assert found == {i: i % 2 for i in range(10, 40) if i not in expected} | ({0: 1} if 0 not in expected else {})


def small(spark, n=400, tail=()):
    r = random.Random(2)
    rows = []
    for i in range(n):
        bad = i % 2
        w = [r.choice(["mild", "calm", "kind", "plain", "open", "warm"]) for _ in range(20)]
        if bad:
            w[3] = r.choice(["vile", "foul"])
        rows.append((i, " ".join(w), "s", 1.0))
    rows += [(n + k, *x) for k, x in enumerate(tail)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, __label double")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(n)], "doc_id bigint, toxic int, quality int")
    return docs, labels


def test_toxicity_cases(spark):
    docs, labels = small(spark, tail=[(None, "s", 0.0), ("", "s", 0.0), ("vile, FOUL! " * 20000, "s", 0.0)])
    model = toxicity.fit(docs, labels, toxicity.Settings(l1=1.0))
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(found) == 403
    assert found[400].score == found[401].score == pytest.approx(toxicity.sigmoid(model.intercept))
    assert found[400].predicted == 0 and found[402].predicted == 1
    assert np.mean([found[i].predicted == i % 2 for i in range(400)]) > 0.95
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.predicted}
    assert toxicity.score(docs.limit(0), model).count() == 0
    nothing = toxicity.fit(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, nothing).collect()} == {0}
    assert toxicity.fit(docs.limit(0), labels).places.size == 0


def test_ftrl_is_sparse_and_learns_pairs():
    r = random.Random(6)
    texts, labels = [], []
    for i in range(600):
        w = [r.choice("abcdefgh") for _ in range(12)]
        w = [x for i, x in enumerate(w) if i == 0 or (w[i - 1], x) != ("a", "b")]
        if i % 2:
            w[4:6] = ["a", "b"]
        texts.append(" ".join(w))
        labels.append(int(" a b" in " " + texts[-1]))
    settings = toxicity.Settings(bits=16, l1=2.0)
    rows = list(toxicity._distinct_rows(pa.array(texts), settings.bits))
    places, weights, intercept = toxicity.fit_rows(rows, labels, settings)
    assert 0 < len(places) < 120
    p = toxicity.score_column(pa.array(texts), toxicity.Model(places, weights, intercept, settings.bits))
    assert np.mean((p > 0.5) == np.array(labels)) > 0.97


def test_quality_cases(spark):
    tail = [(None, "s", 0.0), ("", "s", 0.0), ("word\n" * 50000, "s", 0.0)]
    docs, labels = small(spark, tail=tail)
    stats = quality.stored_statistics(docs)
    model = quality.fit(stats, labels)
    found = {r.id: r for r in quality.score(stats, model).collect()}
    assert len(found) == 403 and all(0 <= r.score <= 1 for r in found.values())
    assert found[400].score == found[401].score
    kept = quality.drop_low(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.predicted}
    unknown = quality.fit(stats, labels.limit(0))
    assert {r.score for r in quality.score(stats, unknown).collect()} == {0.5}
    assert quality.score(stats.limit(0), model).count() == 0


@pytest.mark.parametrize("text", [None, "", "a", "\n\n", "É" * 300000, "x y\nx y\nx y", "!!!"])
def test_statistics_are_finite(text):
    (row,) = quality.statistics_of(pa.array([text]))
    assert row.shape == (len(quality.FEATURES),) and np.isfinite(row).all()


def test_discriminant_is_the_density_ratio():
    r = np.random.default_rng(0)
    d = len(quality.FEATURES)
    sides = {y: r.normal(y, 1 + y, (5000, d)) for y in (0, 1)}
    moments = {y: (float(len(x)), x.sum(0), x.T @ x) for y, x in sides.items()}
    model = quality.discriminant(moments, 0.0, 0.0, 0.0)
    x = r.normal(0.5, 1, (20, d))
    logs = [-0.5 * (((x - y) / (1 + y)) ** 2).sum(1) - d * np.log(1 + y) for y in (0, 1)]
    assert np.allclose(quality.score_rows(x, model), 1 / (1 + np.exp(logs[0] - logs[1])), atol=0.1)


def test_quality_is_the_plain_discriminant(spark):
    """Scores of the whole table against Gaussian log densities from numpy's own moments."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = quality.stored_statistics(docs)
    x = {r.id: np.array(r.stats) for r in stats.collect()}
    known = {r.id: r.label for r in labels_of(labels, "quality").collect() if r.id in x}
    rows = {y: np.array([x[i] for i, label in known.items() if label == y]) for y in (0, 1)}
    covariances = {y: np.cov(rows[y].T, bias=True) for y in (0, 1)}
    pooled = sum(len(rows[y]) * covariances[y] for y in (0, 1)) / len(known)
    logs = []
    for y in (0, 1):
        c = 0.7 * covariances[y] + 0.3 * pooled
        c = 0.95 * c + 0.05 * np.diag(np.diag(c)) + 1e-3 * np.eye(len(c))
        away = np.array(list(x.values())) - rows[y].mean(0)
        distance = (away * np.linalg.solve(c, away.T).T).sum(1)
        logs.append(np.log(len(rows[y]) / len(known)) - 0.5 * (np.linalg.slogdet(c)[1] + distance))
    expected = dict(zip(x, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))))
    found = {r.id: (r.score, r.predicted) for r in quality.score(stats, quality.fit(stats, labels)).collect()}
    assert found.keys() == expected.keys()
    for i, (score, predicted) in found.items():
        assert abs(score - expected[i]) < 1e-6 and (abs(score - 0.5) < 1e-6 or predicted == (expected[i] >= 0.5))


def test_ftrl_is_the_plain_algorithm():
    """Weights against per-coordinate updates in dictionaries, one row at a time."""
    r = random.Random(3)
    settings = toxicity.Settings(bits=8, l1=0.3, epochs=3)
    labels = [r.randint(0, 1) for _ in range(200)]
    rows = [np.array(sorted({r.randrange(120) for _ in range(10)} | ({200} if y else set()))) for y in labels]
    z, n = {}, {}
    ones = sum(labels)
    weight = (len(labels) / (2 * (len(labels) - ones)), len(labels) / (2 * ones))

    def w(i):
        if abs(z.get(i, 0.0)) <= (settings.l1 if i != "bias" else 0.0):
            return 0.0
        sign = 1 if z[i] > 0 else -1
        shrunk = sign * (settings.l1 if i != "bias" else 0.0) - z[i]
        return shrunk / ((settings.beta + n.get(i, 0.0) ** 0.5) / settings.alpha + settings.l2)

    for _ in range(settings.epochs):
        for places, y in zip(rows, labels):
            at = [*places.tolist(), "bias"]
            ws = {i: w(i) for i in at}
            g = (1 / (1 + np.exp(-sum(ws.values()))) - y) * weight[y]
            for i in at:
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / settings.alpha
                z[i] = z.get(i, 0.0) + g - sigma * ws[i]
                n[i] = n.get(i, 0.0) + g * g
    places, weights, intercept = toxicity.fit_rows(rows, labels, settings)
    expected = {i: w(i) for i in range(256) if w(i)}
    assert places.tolist() == sorted(expected) and 0 < len(expected) < 121
    assert np.allclose(weights, [expected[i] for i in places]) and np.isclose(intercept, w("bias"))
