"""Block forms of dense ALS and document cosines, and relations written once."""

import numpy as np

from orrery.operators import als as ALSO
from orrery.operators import evaluate as E
from orrery.operators import text as TXT
from orrery.plans import q_models, q_ratings
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _ratings(spark, extra=()):
    rng = np.random.default_rng(4)
    cells = [(int(u), f"k{i}", float(rng.integers(1, 11)) / 2) for u in range(40) for i in rng.choice(12, 5, replace=False)]
    return spark.createDataFrame([*cells, *extra], "user_id long, item_key string, rating double"), cells


def _by_definition(cells, start, iterations, lam):
    users, items = sorted({c[0] for c in cells}), sorted({c[1] for c in cells})
    r = np.zeros((len(users), len(items)))
    for u, i, x in cells:
        r[users.index(u), items.index(i)] = x
    y = np.array([start[i] for i in items])
    for _ in range(iterations):
        x = r @ y @ np.linalg.inv(y.T @ y + lam * np.eye(y.shape[1]))
        y = r.T @ x @ np.linalg.inv(x.T @ x + lam * np.eye(x.shape[1]))
    return dict(zip(users, x)), dict(zip(items, y))


def test_dense_als_on_blocks_by_definition(spark):
    df, cells = _ratings(spark)
    start = {r["item_key"]: r["f"] for r in ALSO.init_factors(df.select("item_key").distinct(), "item_key", 3).collect()}
    want_u, want_i = _by_definition(cells, start, 3, 0.1)
    users, items = ALSO.dense_als(df, 3, 3, 0.1)
    got_u, got_i = {r["user_id"]: r["f"] for r in users.collect()}, {r["item_key"]: r["f"] for r in items.collect()}
    assert got_u.keys() == want_u.keys() and got_i.keys() == want_i.keys()
    assert all(np.allclose(got_u[k], want_u[k]) for k in want_u) and all(np.allclose(got_i[k], want_i[k]) for k in want_i)


def test_null_keys_and_ratings_in_blocks(spark):
    """A null user or item gets factors, but meets no other; a null rating adds nothing."""
    df, cells = _ratings(spark, [(None, "k1", 4.0), (3, None, 2.0), (99, None, 1.0), (50, "k2", None)])
    blocks = ALSO.rating_blocks(df.selectExpr("user_id u", "item_key i", "rating")).collect()
    assert sum(len(b["row"]) for b in blocks) == len(cells) + 4
    assert len({u for b in blocks for u in b["users"]}) == sum(len(b["users"]) for b in blocks)
    users, items = ALSO.dense_als(df, 2, 2, 0.1)
    u, i = {r["user_id"]: r["f"] for r in users.collect()}, {r["item_key"]: r["f"] for r in items.collect()}
    assert None in u and None in i and 99 not in u and u[50] == [0.0, 0.0]


def test_no_user_factors_are_shuffled(spark):
    df, _ = _ratings(spark)
    for _, users, _ in ALSO.dense_als_path(df, 2, 2, 0.1):
        break
    plan = _plan(users)
    assert "MapInArrow" in plan and "Aggregate [u" not in plan and "Summarizer" not in plan


def test_best_cells_with_ties_and_itself():
    rng = np.random.default_rng(1)
    cosine = rng.integers(0, 40, (30, 700)) / 40.0
    mine, ids = np.arange(0, 3000, 100), np.arange(0, 7000, 10)
    row, col, key = TXT.best_cells(cosine, mine, ids, 10)
    for r in range(30):
        want = sorted((-round(cosine[r, c] * 1e6), ids[c]) for c in range(700) if ids[c] != mine[r] and cosine[r, c] > 0)[:10]
        assert [(-k, ids[c]) for q, c, k in zip(row, col, key) if q == r] == want


def test_cosines_of_pairs_are_not_written(spark, monkeypatch):
    """Only the weights are written, whatever the number of pairs."""
    names, write = [], TXT.written
    monkeypatch.setattr(TXT, "written", lambda df, name="table": names.append(df.columns) or write(df, name))
    rows = [(d, f"t{(d + k) % 7}", 0.5) for d in range(60) for k in range(4)]
    got = TXT.nearest_documents(spark.createDataFrame(rows, "doc_id long, term string, weight double"), 20, 10, block=16).collect()
    assert len(got) == 30 and not any("doc_2" in c for c in names)


def test_fits_read_written_ratings(spark):
    for df in (*q_models._coded(spark, SF_SMALL), *q_ratings._dense_cf(spark, SF_SMALL)[:2]):
        assert "l_orderkey" not in _plan(df)


def test_item_candidates_go_by_number(spark):
    _, _, cands, _ = q_ratings._dense_cf(spark, SF_SMALL)
    assert {cands.schema[c].dataType.simpleString() for c in ("target", "neighbour")} == {"int"}


def test_roc_points_read_scores_once(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "label int, score double").selectExpr("label", "score + 0 as score")
    points = E.roc_points(df)
    assert "LogicalRDD" not in _plan(points)
    assert sorted((r["fpr"], r["tpr"]) for r in points.collect()) == [(0.0, 0.0), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]
