"""Term vectors, words of terms, the grid of ALS fits and Lloyd steps at sizes that used to fail."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import als as ALSO
from orrery.operators import text as TXT
from orrery.operators import topics as TP


def test_term_vectors_hold_each_term_once(spark):
    """A count of two thousand million is one entry, not as many strings."""
    counts = spark.createDataFrame([(1, "a", 2_000_000_000), (1, "b", 3), (1, "x", 7), (2, "b", 0), (None, "a", 4)], "doc_id long, term string, tf long")
    docs = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "doc_id long")
    got = sorted((str(r.doc_id), r.counts.toArray().tolist()) for r in TP.term_vectors(counts, docs, ["b", "a"]).collect())
    assert got == [("1", [3.0, 2e9]), ("2", [0.0, 0.0]), ("3", [0.0, 0.0]), ("3", [0.0, 0.0]), ("None", [0.0, 0.0])]


def test_term_vectors_are_not_broadcast(spark):
    counts = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a").alias("term"), F.lit(900).alias("tf"))
    out = TP.term_vectors(counts, counts.select("doc_id"), ["a"])
    out.collect()
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_words_of_some_terms(spark):
    """As ``words`` for these terms, with null and repeated ids."""
    rows = [(1, "s", "running dogs ran walks"), (2, "s", "walked runs dog"), (2, "s", "walking runner dogs houses"), (None, "s", "house walks runs"), (3, "s", "dogs walking house")]
    c = TXT.Corpus(TXT.corpus_documents(spark.createDataFrame(rows, "doc_id long, source string, text string")), min_df=0.2, max_df=1.0)
    terms = c.vocab.select("term")
    every = {r.stem: r.word for r in c.words.collect()}
    got = {r.stem: r.word for r in c.words_of(terms).collect()}
    assert got and got == {t.term: every[t.term] for t in terms.collect()}


def test_grid_is_that_of_single_spark_ml_fits(spark):
    """Every fit side by side has the errors of Spark ML's own; pairs of unknown users or items are dropped."""
    rng = np.random.default_rng(5)
    x, y = rng.random((60, 3)), rng.random((40, 3))
    cells = [(u, i, float(np.round(x[u] @ y[i] * 4) / 2), bool(rng.random() < .2)) for u in range(60) for i in range(40) if rng.random() < .3]
    cells += [(900, 3, 2.0, True), (4, 901, 1.0, True)]
    df = spark.createDataFrame(cells, "user_id int, item_id int, rating double, t boolean")
    train, test = df.where("not t").drop("t"), df.where("t").drop("t")
    grid = dict(ranks=[3, 2], iterations=[1, 4], regs=[0.05, 0.3])
    runs, best_model, best = ALSO.grid_search(train, test, **grid)
    got = {(r["rank"], r.iterations, r.reg): (r.mse_train, r.mse_test) for r in runs.collect()}
    assert list(got) == [(rk, it, lam) for it in (1, 4) for rk in (3, 2) for lam in (0.05, 0.3)]
    for (rk, it, lam), mse in got.items():
        m = ALSO.fit_als(train, rk, it, lam)
        assert mse == pytest.approx((ALSO.als_mse(m, train), ALSO.als_mse(m, test)), rel=1e-4)
    assert best == min(got, key=lambda k: (got[k][0], k)) and best_model().rank == best[0]


def test_grid_needs_no_job_for_each_fit(spark):
    """Jobs grow with the iterations of the longest fits, not with the number of fits."""
    df = spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(20) for i in range(10)], "user_id int, item_id int, rating double")
    fits, one = [], ALSO.fit_als
    ALSO.fit_als = lambda train, rank, iterations, *a: fits.append(iterations) or one(train, rank, iterations, *a)
    try:
        ALSO.grid_search(df, df.limit(0), [2, 3], [1, 2], [0.1, 0.2, 0.3])
    finally:
        ALSO.fit_als = one
    assert fits == [0, 0]


def test_rows_of_many_ratings_in_pieces(monkeypatch):
    rng = np.random.default_rng(6)
    first, src = np.array([0, 9, 18, 18, 23]), rng.integers(0, 12, 23)
    table, rating, runs = rng.random((12, 7)).astype(np.float32), rng.random(23), [(2, .1), (2, .3), (3, .2)]
    whole = ALSO.solved_rows(first, src, rating, table, runs)
    monkeypatch.setattr(ALSO, "EXPLICIT_CELLS", 14)
    assert np.allclose(ALSO.solved_rows(first, src, rating, table, runs), whole, rtol=1e-5, atol=1e-6)
    f = table[src[9:18], 4:].astype(float)
    assert np.allclose(whole[1, 4:], np.linalg.solve(f.T @ f + .2 * 9 * np.eye(3), f.T @ rating[9:18]), rtol=1e-5)


def test_half_step_with_a_null_rating(spark):
    """A null rating adds nothing to the right side, as in the SQL; sums of vectors failed on it."""
    r = spark.createDataFrame([(1, 1, 2.0), (1, 2, None), (2, 2, None)], "u int, i int, rating double")
    items = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 1.0])], "i int, f array<double>")
    got = {x.u: x.f for x in ALSO.explicit_half_step(r, items, "i", "u", 2, 0.1).collect()}
    assert got[1] == pytest.approx(np.linalg.solve([[10.2, 5.0], [5.0, 5.2]], [2.0, 4.0]).tolist()) and got[2] == [None, None]


def test_weighted_sums_in_pieces(monkeypatch):
    """Rows of few, many and no terms, whatever number is summed up at once."""
    rng = np.random.default_rng(8)
    to = np.repeat([0, 2, 3, 7], [1, 40, 3, 3])
    of, weight, table = rng.integers(0, 6, len(to)), rng.random(len(to)), rng.random((6, 5))
    want = np.zeros((9, 5))
    np.add.at(want, to, table[of] * weight[:, None])
    for cells in (1, 30, 1 << 16):
        monkeypatch.setattr(ALSO, "SUM_CELLS", cells)
        got = np.zeros((9, 5))
        ALSO.weighted_sums(got, to, of, weight, table)
        ALSO.weighted_sums(got, to[:0], of[:0], weight[:0], table)
        assert np.allclose(got, want)


def test_best_products(monkeypatch):
    rng = np.random.default_rng(9)
    u, v = (rng.integers(-3, 4, (m, 3)).astype(np.float32) for m in (7, 50))  # many ties
    for n in (1, 2, 60):
        want = [(r, int(c), float(s[c])) for r, s in enumerate(u @ v.T) for c in np.argsort(-s, kind="stable")[:n]]
        for step in (1, 8, 1024):
            monkeypatch.setattr(ALSO, "TOP_STEP", step)
            assert [(int(r), int(c), float(s)) for r, c, s in zip(*ALSO.best_products(u, v, n))] == want


def test_top_items_are_those_of_spark_ml(spark, monkeypatch):
    """Also over several blocks; users without factors and repeated ones as there, an item without a name gives null."""
    monkeypatch.setattr(ALSO, "TOP_USERS", 3)
    monkeypatch.setattr(ALSO, "TOP_ITEMS", 5)
    rng = np.random.default_rng(10)
    df = spark.createDataFrame([(u, i, float(rng.integers(1, 11)) / 2) for u in range(20) for i in range(30) if rng.random() < .4], "user_id int, item_id int, rating double")
    m = ALSO.fit_als(df, 3, 4, 0.1)
    asked = spark.createDataFrame([(1,), (5,), (5,), (12,), (99,)], "user_id int")
    want = {r.user_id: [(x.item_id, round(x.rating, 4)) for x in r.recommendations] for r in m.recommendForUserSubset(asked, 4).collect()}
    got = ALSO.top_n(m, 4, asked, "user_id", "item_id").orderBy("user_id", "pos").collect()
    assert {u: [(r.item_id, round(r.rating, 4)) for r in got if r.user_id == u] for u in want} == want and len(got) == 12
    names = df.select("item_id").distinct().where("item_id <> %d" % want[5][0][0]).withColumn("p_name", F.concat(F.lit("n"), "item_id"))
    row = ALSO.top_n_named(m, 2, asked, names, "item_id").where("user_id = 5").first()
    assert (row.recommend_1, row.recommend_2) == (None, f"n{want[5][1][0]}")
