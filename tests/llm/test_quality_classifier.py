import numpy as np

from millrace.llm.quality_classifier import FEATURES, document_features, fit, quality_scores
from millrace.llm.queries import op8_quality_qda


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op8_quality_qda(spark, sf).collect() if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in rows])
    assert auc(np.array([r.score for r in rows]), y) > 0.9
    assert (np.array([r.predicted for r in rows]) == y).mean() > 0.9
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_density_equals_direct_formula():
    rng = np.random.default_rng(1)
    d = len(FEATURES)
    x = [rng.normal(size=(200, d)) @ rng.normal(size=(d, d)) + k for k in (0, 1)]
    n = np.array([200.0, 200.0])
    model = fit(n, np.stack([a.sum(0) for a in x]), np.stack([a.T @ a for a in x]))
    point = x[0][:5]
    logs = []
    for k in (0, 1):
        cov = model.factors[k] @ model.factors[k].T
        diff = point - x[k].mean(0)
        logs.append(-0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)))
    want = 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -30, 30)))
    assert np.allclose(model.score(point), want)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, None), (None, 1), (3, 5)], "doc_id long, quality int")
    got = quality_scores(odd_docs, labels).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert quality_scores(no_docs, labels).count() == 0
    assert quality_scores(odd_docs, labels.limit(0)).count() == 10
    assert document_features(None) == document_features("")
