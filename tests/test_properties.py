"""Property tests: distributed operators against brute force on random data,
including forced hot rows / many chunks, and model sanity checks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery.operators import evaluate as E
from orrery.operators.gram import pair_stats
from orrery.operators.ordered import dense_index, running_sums
from orrery.operators.skew import fanout_join


def _brute_pairs(pdf, include_self=False):
    out = {}
    for _, g in pdf.groupby("r"):
        items = list(zip(g["c"], g["v"]))
        for a, x in items:
            for b, y in items:
                if a < b or (include_self and a == b):
                    s = out.setdefault((a, b), [0, 0.0, 0.0, 0.0, 0.0, 0.0])
                    s[0] += 1
                    s[1] += x
                    s[2] += y
                    s[3] += x * y
                    s[4] += x * x
                    s[5] += y * y
    return out


@pytest.mark.parametrize("block", [3, 7, 2048])
@pytest.mark.parametrize("include_self", [False, True])
def test_pair_stats_matches_brute_force(spark, block, include_self):
    rng = np.random.default_rng(1)
    recs = set()
    # one very hot row (user 0 rates almost everything) plus sparse rows
    for c in range(30):
        recs.add((0, c))
    for _ in range(150):
        recs.add((int(rng.integers(1, 40)), int(rng.integers(0, 30))))
    pdf = pd.DataFrame(sorted(recs), columns=["r", "c"])
    pdf["v"] = rng.integers(1, 11, len(pdf)).astype(float)
    df = spark.createDataFrame(pdf)
    got = {(r["c1"], r["c2"]): [r["n"], r["sx"], r["sy"], r["sxy"], r["sxx"], r["syy"]]
           for r in pair_stats(df, "r", "c", "v", include_self=include_self, block=block).collect()}
    want = _brute_pairs(pdf, include_self)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_pair_stats_string_columns(spark):
    df = spark.createDataFrame([(1, "b", 1.0), (1, "a", 2.0), (2, "a", 3.0), (2, "b", 4.0)],
                               "r long, c string, v double")
    got = {(r["c1"], r["c2"]): r["sxy"] for r in pair_stats(df, "r", "c", "v").collect()}
    assert got == {("a", "b"): 2.0 * 1.0 + 3.0 * 4.0}


def test_fanout_join_with_hot_keys_equals_join(spark):
    left = spark.createDataFrame([(k, i) for k in (1, 2) for i in range(12 if k == 1 else 2)],
                                 "k long, a long")
    right = spark.createDataFrame([(k, j) for k in (1, 2, 3) for j in range(9 if k == 1 else 3)],
                                  "k long, b long")
    want = sorted(tuple(r) for r in left.join(right, "k").select("k", "a", "b").collect())
    got = sorted(tuple(r) for r in fanout_join(left, right, "k", block=4)
                 .select("k", "a", "b").collect())
    assert got == want


def test_dense_index_matches_dense_rank(spark):
    vals = [f"k{v:03d}" for v in np.random.default_rng(2).integers(0, 200, 500)]
    df = spark.createDataFrame([(v,) for v in vals], "key string")
    got = {r["key"]: r["idx"] for r in dense_index(df, "key", "idx", ranges=7).collect()}
    want = {k: i for i, k in enumerate(sorted(set(vals)))}
    assert got == want


def test_running_sums_match_cumsum(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"s": rng.permutation(300).astype(float), "a": rng.integers(0, 5, 300).astype(float)})
    got = running_sums(spark.createDataFrame(pdf), "s", ["a"], descending=True, ranges=5).toPandas()
    ref = pdf.sort_values("s", ascending=False)
    ref["cum_a"] = ref["a"].cumsum()
    m = got.merge(ref, on="s")
    assert np.allclose(m["cum_a_x"], m["cum_a_y"])


def test_auc_equals_rank_statistic(spark):
    rng = np.random.default_rng(4)
    lab = rng.integers(0, 2, 400)
    score = np.round(rng.normal(size=400) + lab, 1)
    df = spark.createDataFrame(pd.DataFrame({"label": lab.astype(int), "score": score}))
    auc = E.roc_auc(E.roc_points(df)).first()["auc"]
    pos, neg = score[lab == 1], score[lab == 0]
    mw = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert auc == pytest.approx(mw)


def test_similarity_symmetric_and_bounded(spark):
    import __spark_entry__ as entry
    sim = entry.queries()["item_similarity_full"](spark, "/root/testdata/sf0.001")
    agg = sim.agg(F.min("similarity"), F.max("similarity")).first()
    assert agg[0] >= -1.0 and agg[1] <= 1.0
    a = sim.alias("a").join(sim.alias("b"), (F.col("a.item_1") == F.col("b.item_2"))
                            & (F.col("a.item_2") == F.col("b.item_1")))
    assert a.where(F.col("a.similarity") != F.col("b.similarity")).count() == 0
    assert a.count() == sim.count()


def test_tfidf_rows_have_unit_norm(spark):
    import __spark_entry__ as entry
    w = entry.queries()["tfidf"](spark, "/root/testdata/sf0.001")
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n2")).collect()
    assert norms and all(abs(r["n2"] - 1.0) < 1e-4 for r in norms)


def test_pca_and_lda_shapes(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    xy = q["pca_xy"](spark, "/root/testdata/sf0.001")
    assert xy.count() == 500 and set(xy.columns) >= {"x", "y"}
    topics = q["lda_topics"](spark, "/root/testdata/sf0.001").collect()
    assert len(topics) == 5 * 6
    per = {}
    for r in topics:
        per.setdefault(r["topic"], []).append((r["term_rank"], r["weight"]))
    assert all([w for _, w in sorted(v)] == sorted((w for _, w in v), reverse=True) for v in per.values())


def test_every_document_has_a_cluster_and_a_topic(spark):
    import __spark_entry__ as entry
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    for name, k in (("kmeans_text", "cluster"), ("lda_doc_topic", "topic")):
        got = entry.queries()[name](spark, "/root/testdata/sf0.001").collect()
        assert len(got) == len({r["doc_id"] for r in got}) == n and {r[k] for r in got} <= set(range(5))


def test_als_grid_has_all_runs_and_its_best(spark):
    import __spark_entry__ as entry
    runs = entry.queries()["als_grid"](spark, "/root/testdata/sf0.001").collect()
    assert len(runs) == 48 and len({(r["rank"], r["iterations"], r["reg"]) for r in runs}) == 48
    best = [r for r in runs if r["is_best"]]
    assert len(best) == 1 and best[0]["mse_train"] == min(r["mse_train"] for r in runs)


def test_pivot_of_the_als_grid(spark):
    import __spark_entry__ as entry
    rows = entry.queries()["als_grid_pivot"](spark, "/root/testdata/sf0.001").collect()
    runs = entry.queries()["als_grid"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len({(r["rank"], r["reg"]) for r in rows}) == 24
    got = {(r["rank"], n, r["reg"]): r[f"it{n}"] for r in rows for n in (10, 20)}
    assert got == pytest.approx({(r["rank"], r["iterations"], r["reg"]): r["mse_train"] for r in runs})


def test_dense_grid_and_top_cells(spark):
    from orrery.operators import als as ALSO
    df = spark.createDataFrame([(u, f"i{i}", float(1 + (u * i) % 5)) for u in range(12) for i in range(9) if (u + i) % 3],
                               "user_id long, item_key string, rating double")
    runs = {(r["rank"], r["iterations"], r["reg"]): r["mse"] for r in ALSO.dense_grid(df, [2, 3], [1, 3], [0.1]).collect()}
    assert set(runs) == {(k, i, 0.1) for k in (2, 3) for i in (1, 3)}
    users, items = ALSO.dense_als(df, 3, 3, 0.1)
    scored = ALSO.predict_rated(df, users, items).toPandas()
    assert runs[3, 3, 0.1] == pytest.approx(((scored.rating - scored.prediction) ** 2).mean())
    fu, fi = ({r[0]: np.array(r[1]) for r in x.collect()} for x in (users, items))
    top = ALSO.top_cells(users, items, 2, block=5).collect()
    for u, f in fu.items():
        want = sorted(((-float(f @ v), k) for k, v in fi.items()))[:2]
        assert [(k, pytest.approx(-s)) for s, k in want] == [(r["item_key"], r["prediction"]) for r in sorted(top, key=lambda r: r["rank"]) if r["user_id"] == u]


def test_als_names_and_predictions(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    top = q["als_top2_names"](spark, "/root/testdata/sf0.001").collect()
    assert top and all(r["user_id"] % 20 == 0 and r["recommend_1"] and r["recommend_1"] != r["recommend_2"] for r in top)
    p = q["als_predict"](spark, "/root/testdata/sf0.001")
    assert p.where("prediction is null or isnan(prediction)").count() == 0 and p.count() > 0


def test_dense_als_beats_zero_model(spark):
    import __spark_entry__ as entry
    d = entry.queries()["dense_als"](spark, "/root/testdata/sf0.001")
    mse = d.agg(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).first()[0]
    zero = d.agg(F.avg(F.pow(F.col("rating"), 2))).first()[0]
    assert mse < zero


def test_modelcf_levels_cover_all_test_rows(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    lv = q["modelcf_error_levels"](spark, "/root/testdata/sf0.001").collect()
    rm = q["modelcf_blended_rmse"](spark, "/root/testdata/sf0.001").first()
    assert sum(r["n"] for r in lv) == rm["n_scored"] and len(lv) == 5
    nf = q["modelcf_rmse_no_fallback"](spark, "/root/testdata/sf0.001").first()
    assert nf["n_scored"] <= rm["n_scored"]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 10, 97, 1000, 4099])
def test_random_place_is_a_bijection(spark, n):
    from orrery.operators.ratings import random_place
    df = spark.range(n).withColumn("n", F.lit(n).cast("bigint"))
    places = {}
    for seed in (5, 6):
        got = {r.id: r.p for r in df.select("id", random_place(F.col("id"), F.col("n"), seed).alias("p")).collect()}
        assert sorted(got.values()) == list(range(n))
        places[seed] = [got[i] for i in range(n)]
    if n >= 1000:  # seeds differ, and neighbours do not stay together
        a = np.array(places[5])
        assert places[5] != places[6] and abs(np.corrcoef(a, np.arange(n))[0, 1]) < 0.1
        assert (np.abs(np.diff(a)) <= 2).mean() < 0.02


def test_profile_sketch_within_its_bounds(spark):
    from orrery.operators.olap import profile_sketch
    rng = np.random.default_rng(2)
    n = 40_000
    x, y = rng.integers(0, 30_000, n), rng.choice([1.5, 2.5, 3.5], n, p=[.7, .2, .1])
    rows = [(int(a), None if i % 50 == 0 else float(b), "k" if i % 3 else f"v{a}") for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x long, y double, z string")
    p = profile_sketch(df, ["x", "y"], ["z"])
    got = {r.column_name: r for r in p.collect()}
    s = np.sort(x)
    for q, c in ((.25, "p25"), (.5, "p50"), (.75, "p75")):
        lo, hi = np.searchsorted(s, got["x"][c]), np.searchsorted(s, got["x"][c], "right")
        assert lo - 5 <= q * n <= hi + 5  # a ten-thousandth of the rows
    assert got["x"].n_distinct == pytest.approx(len(set(x.tolist())), rel=0.06) and got["y"].n_distinct == 3
    assert (got["y"].n, got["y"].n_null, got["x"].min_value, got["x"].max_value) == (n - n // 50, n // 50, x.min(), x.max())
    assert [f.value for f in got["y"].frequent if f.value is not None][:3] == ["1.5", "2.5", "3.5"]
    assert got["z"].frequent[0].value == "k" and got["z"].frequent[0].n == sum(r[2] == "k" for r in rows) and got["z"].p50 is None
    assert "Expand" not in p._jdf.queryExecution().executedPlan().toString()
