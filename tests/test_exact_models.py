"""Explicit ALS, principal axes and topic sweeps against numpy and Spark ML."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import als as ALSO
from orrery.operators import topics as TP


@pytest.mark.parametrize("k", [1, 2, 5])
def test_solve_positive(spark, k):
    rng = np.random.default_rng(k)
    rows = []
    for i in range(20):
        m = rng.standard_normal((k, k + 2))
        a, b = m @ m.T + np.eye(k), rng.standard_normal(k)
        rows.append((i, a[np.tril_indices(k)].tolist(), b.tolist(), np.linalg.solve(a, b).tolist()))
    df = spark.createDataFrame(rows, "id int, a array<double>, b array<double>, want array<double>")
    for r in ALSO.solve_positive(df, k).collect():
        assert r.f == pytest.approx(r.want)


def _ratings(spark, users=40, items=30, seed=1):
    rng = np.random.default_rng(seed)
    x, y = rng.random((users, 3)), rng.random((items, 3))
    cells = [(u, i, float(np.round(x[u] @ y[i] * 2) / 2)) for u in range(users) for i in range(items) if rng.random() < .4]
    return spark.createDataFrame(cells, "user_id int, item_id int, rating double")


def test_explicit_als_goes_on_like_spark_ml(spark):
    """Spark ML ends a round with the user factors: from those of its first
    round, a step for items and one for users are its second round."""
    r = _ratings(spark)
    first, second = (ALSO.fit_als(r, 4, n, 0.05, user="user_id", item="item_id") for n in (1, 2))
    users = first.userFactors.select(F.col("id").alias("user_id"), F.col("features").cast("array<double>").alias("f"))
    items = ALSO.explicit_half_step(r, users, "user_id", "item_id", 4, 0.05)
    users = ALSO.explicit_half_step(r, items, "item_id", "user_id", 4, 0.05)
    for got, want, key in ((items, second.itemFactors, "item_id"), (users, second.userFactors, "user_id")):
        got, want = {x[key]: x.f for x in got.collect()}, {x.id: x.features for x in want.collect()}
        assert set(got) == set(want)
        for i in got:
            assert got[i] == pytest.approx(want[i], rel=2e-3, abs=2e-3)
    p = {(x.user_id, x.item_id): x.prediction for x in ALSO.explicit_predict(r, users, items).collect()}
    for x in second.transform(r).collect():
        assert p[x.user_id, x.item_id] == pytest.approx(x.prediction, rel=2e-3, abs=2e-3)


def test_explicit_als_lowers_its_objective(spark):
    r, loss = _ratings(spark, seed=2), []
    for _, users, items in ALSO.explicit_als_path(r, 3, 3, 0.1):
        fit = ALSO.explicit_predict(r, users, items).agg(F.sum(F.pow(F.col("rating") - F.col("prediction"), 2))).first()[0]
        penalty = sum(r.join(f, key).agg(F.sum(ALSO.dot(F.col("f"), F.col("f")))).first()[0] for f, key in ((users, "user_id"), (items, "item_id")))
        loss.append(fit + 0.1 * penalty)
    assert loss[0] >= loss[1] >= loss[2]


def test_principal_axes_are_the_eigenvectors(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 6)) * np.array([5, 3, 1, .5, .2, .1]) @ np.linalg.qr(rng.standard_normal((6, 6)))[0] + 7
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<float>")
    one = TP.covariance_cell(df, "v").first()
    assert np.allclose(one["mean"], x.mean(0), atol=1e-5) and np.allclose(one["cov"], np.cov(x.T), rtol=1e-4, atol=1e-5)
    axes = TP.principal_axes(df, "v", 2, 60)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    for got, want in zip(axes.first()["axes"], vectors.T[::-1], strict=False):
        want = want * np.sign(want[np.abs(want).argmax()])
        assert np.allclose(got, want, atol=1e-4)
    xy = {r.id: r.xy for r in TP.project(df, "v", axes).collect()}
    assert np.allclose([xy[i] for i in range(300)], (x - x.mean(0)) @ np.array(axes.first()["axes"]).T, atol=1e-4)


def test_collapsed_sweeps_by_definition(spark):
    rng = np.random.default_rng(3)
    counts = [(d, f"t{t}", int(rng.integers(1, 6))) for d in range(12) for t in range(8) if rng.random() < .6]
    df = spark.createDataFrame(counts, "doc_id long, term string, tf long")
    start = {(r.doc_id, r.term): np.array(r.g) for r in TP.collapsed_topics(df, 3, 0).collect()}
    g = start
    for _ in range(2):
        def total(of, g=g):
            out = {}
            for d, t, n in counts:
                out[of(d, t)] = out.get(of(d, t), 0) + n * g[d, t]
            return out
        nt, nd, nk = total(lambda d, t: t), total(lambda d, t: d), total(lambda d, t: 0)[0]
        v = len(nt)
        new = {(d, t): (nt[t] - g[d, t] + .01) * (nd[d] - g[d, t] + .1) / (nk - g[d, t] + v * .01) for d, t, _ in counts}
        g = {k: x / x.sum() for k, x in new.items()}
    got = {(r.doc_id, r.term): r.g for r in TP.collapsed_topics(df, 3, 2).collect()}
    assert all(got[k] == pytest.approx(g[k]) for k in g) and set(got) == set(g)


def test_sweeps_are_no_worse_than_the_online_fit(spark):
    from pyspark.ml.clustering import LDA
    rng = np.random.default_rng(8)
    topics = rng.dirichlet(np.full(24, .1), 3)
    counts = []
    for d in range(60):
        p = rng.dirichlet(np.full(3, .2)) @ topics
        counts += [(d, f"t{t:02d}", int(n)) for t, n in enumerate(rng.multinomial(60, p)) if n]
    df = spark.createDataFrame(counts, "doc_id long, term string, tf long")
    rows = TP.collapsed_topics(df, 3, 15)
    mine = TP.perplexity(df, TP.document_topics(rows), TP.topic_terms(rows)).first()[0]
    terms = sorted({t for _, t, _ in counts})
    docs = df.select("doc_id").distinct()
    vectors = TP.term_vectors(df, docs, terms).select("doc_id", F.col("counts").alias("features"))
    model = LDA(k=3, maxIter=100, seed=1, optimizer="online").fit(vectors)
    from pyspark.ml.functions import vector_to_array
    per_topic = spark.createDataFrame([(k, terms[t], float(x)) for k, row in enumerate(
        (model.topicsMatrix().toArray() / model.topicsMatrix().toArray().sum(0)).T) for t, x in enumerate(row)], "topic int, term string, weight double")
    per_doc = model.transform(vectors).select("doc_id", F.posexplode(vector_to_array("topicDistribution")).alias("topic", "weight"))
    online = TP.perplexity(df, per_doc, per_topic).first()[0]
    assert mine <= online * 1.02, (mine, online)
