"""Model fits whose every step has an SQL twin: explicit ALS, principal axes,
topics by collapsed sweeps. Sums are rounded to six places for comparison."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from orrery.operators import als as ALSO
from orrery.operators import topics as TP
from orrery.plans.common import SQL_RATINGS, SQL_SPLIT, Inputs, query, r6
from orrery.plans.q_text import SQL_TEXT, corpus

# ------------------------------------------------------------------ explicit ALS

_ROUNDS, _REG, _SEED = 2, 0.1, 3


def _sql_uniform(key: str, last: str) -> str:
    return f"CAST(CAST(('0x' || substr(md5({key} || '|{last}'), 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0"


def _sql_explicit_als() -> str:
    """Rank 2: each key's 2 x 2 system solved by its determinant."""
    parts = [SQL_RATINGS.strip("\n"), SQL_SPLIT.strip("\n"),
             "y0 AS (SELECT item_id, " + ", ".join(f"{_sql_uniform('CAST(item_id AS VARCHAR)', f'{c}|{_SEED}')} AS f{c}" for c in (0, 1))
             + " FROM (SELECT DISTINCT item_id FROM train) i)"]
    for t in range(1, _ROUNDS + 1):
        for out, fixed, key, other in ((f"x{t}", f"y{t - 1}", "user_id", "item_id"), (f"y{t}", f"x{t}", "item_id", "user_id")):
            parts.append(f"""{out} AS (SELECT {key}, (b0 * a11 - b1 * a01) / (a00 * a11 - a01 * a01) AS f0, (b1 * a00 - b0 * a01) / (a00 * a11 - a01 * a01) AS f1
  FROM (SELECT r.{key}, sum(f.f0 * f.f0) + {_REG} * count(*) AS a00, sum(f.f0 * f.f1) AS a01, sum(f.f1 * f.f1) + {_REG} * count(*) AS a11,
               sum(f.f0 * r.rating) AS b0, sum(f.f1 * r.rating) AS b1
        FROM train r JOIN {fixed} f ON r.{other} = f.{other} GROUP BY r.{key}) q)""")
    return "WITH " + ",\n".join(parts) + "\n"


_EXPLICIT_SQL = _sql_explicit_als()


def _explicit(spark, sf_dir):
    train, test = Inputs(spark, sf_dir).split()
    return train, test, ALSO.explicit_als_path(train, 2, _ROUNDS, _REG, _SEED)


@query("explicit_als_rank2", ops="R9", sql=_EXPLICIT_SQL + f"""
SELECT 'user' AS side, user_id AS id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM x{_ROUNDS}
UNION ALL SELECT 'item', item_id, round(f0, 6), round(f1, 6) FROM y{_ROUNDS}""")
def explicit_als_rank2(spark, sf_dir):
    """Factors after two rounds on the training ratings."""
    *_, (_, users, items) = _explicit(spark, sf_dir)[2]
    sides = [df.select(F.lit(side).alias("side"), F.col(key).alias("id"), r6(F.col("f")[0]).alias("f0"), r6(F.col("f")[1]).alias("f1"))
             for df, side, key in ((users, "user", "user_id"), (items, "item", "item_id"))]
    return sides[0].unionByName(sides[1])


@query("explicit_als_predict", ops="R10", sql=_EXPLICIT_SQL + f"""
SELECT t.user_id, t.item_id, t.rating, round(x.f0 * y.f0 + x.f1 * y.f1, 6) AS prediction
FROM test t JOIN x{_ROUNDS} x ON t.user_id = x.user_id JOIN y{_ROUNDS} y ON t.item_id = y.item_id""")
def explicit_als_predict(spark, sf_dir):
    """Predictions of the test ratings."""
    _, test, path = _explicit(spark, sf_dir)
    *_, (_, users, items) = path
    p = ALSO.explicit_predict(test, users, items)
    return p.select("user_id", "item_id", "rating", r6(F.col("prediction")).alias("prediction"))


@query("explicit_als_curve", ops="R16 A4", sql=_EXPLICIT_SQL + "\nUNION ALL\n".join(f"""
SELECT {t} AS iterations, '{part}' AS part, count(*) AS n, round(avg(pow(r.rating - x.f0 * y.f0 - x.f1 * y.f1, 2)), 6) AS mse
FROM {part} r JOIN x{t} x ON r.user_id = x.user_id JOIN y{t} y ON r.item_id = y.item_id""" for t in range(1, _ROUNDS + 1) for part in ("train", "test")))
def explicit_als_curve(spark, sf_dir):
    """Error on the training and the test ratings after each round."""
    train, test, path = _explicit(spark, sf_dir)
    out = None
    for it, users, items in path:
        for part, cells in (("train", train), ("test", test)):
            mse = ALSO.explicit_predict(cells, users, items).agg(
                F.count(F.lit(1)).alias("n"), r6(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("mse"))
            row = mse.select(F.lit(it).alias("iterations"), F.lit(part).alias("part"), "n", "mse")
            out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ principal axes

_POWER_STEPS = 20


def _sql_axes(k: int = 2, steps: int = _POWER_STEPS) -> str:
    parts = ["""pts AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
mu AS (SELECT d, avg(x) AS m FROM pts GROUP BY d),
c0 AS (SELECT a.d AS i, b.d AS j, (sum(a.x * b.x) - sum(a.x) * sum(b.x) / count(*)) / (count(*) - 1) AS c
       FROM pts a JOIN pts b ON a.vec_id = b.vec_id GROUP BY a.d, b.d)"""]
    for a in range(k):
        parts.append(f"v{a}_0 AS (SELECT d, 1.0 / CAST(d AS DOUBLE) AS x FROM mu)")
        for t in range(1, steps + 1):
            parts.append(f"""v{a}_{t} AS MATERIALIZED (SELECT d, x / sqrt(sum(x * x) OVER ()) AS x FROM (
  SELECT c.i AS d, sum(c.c * v.x) AS x FROM c{a} c JOIN v{a}_{t - 1} v ON c.j = v.d GROUP BY c.i) q)""")
        parts.append(f"""a{a} AS MATERIALIZED (SELECT d, x * (SELECT sign(arg_max(x, abs(x))) FROM v{a}_{steps}) AS x FROM v{a}_{steps}),
e{a} AS (SELECT sum(p.x * c.c * q.x) AS e FROM c{a} c JOIN a{a} p ON p.d = c.i JOIN a{a} q ON q.d = c.j),
c{a + 1} AS MATERIALIZED (SELECT c.i, c.j, c.c - (SELECT e FROM e{a}) * p.x * q.x AS c FROM c{a} c JOIN a{a} p ON p.d = c.i JOIN a{a} q ON q.d = c.j)""")
    return "WITH " + ",\n".join(parts) + "\n"


_AXES_SQL = _sql_axes()


def _axes(spark, sf_dir):
    points = Inputs(spark, sf_dir).t("embeddings")
    return points, TP.principal_axes(points, "embedding", 2, _POWER_STEPS)


@query("pca_axes", ops="M5", sql=_AXES_SQL + """
SELECT 0 AS axis, d - 1 AS dim, round(x, 6) AS weight FROM a0 UNION ALL SELECT 1, d - 1, round(x, 6) FROM a1""")
def pca_axes(spark, sf_dir):
    """The first two principal axes after twenty power steps each."""
    axis = _axes(spark, sf_dir)[1].select(F.posexplode("axes").alias("axis", "a"))
    return axis.select("axis", F.posexplode("a").alias("dim", "x")).select("axis", F.col("dim").cast("bigint").alias("dim"), r6(F.col("x")).alias("weight"))


@query("pca_projection", ops="M5", sql=_AXES_SQL + """
SELECT p.vec_id, any_value(p.label) AS label, round(sum((p.x - mu.m) * a0.x), 6) AS x, round(sum((p.x - mu.m) * a1.x), 6) AS y
FROM pts p JOIN mu ON mu.d = p.d JOIN a0 ON a0.d = p.d JOIN a1 ON a1.d = p.d GROUP BY p.vec_id""")
def pca_projection(spark, sf_dir):
    """Coordinates of all vectors along them."""
    p = TP.project(*(lambda pts, axes: (pts, "embedding", axes))(*_axes(spark, sf_dir)))
    return p.select("vec_id", "label", r6(F.col("xy")[0]).alias("x"), r6(F.col("xy")[1]).alias("y"))


# ------------------------------------------------------------------ topics

_K, _SWEEPS, _ALPHA, _BETA = 5, 2, 0.1, 0.01


def _sql_topics() -> str:
    g0 = ", ".join(f"{_sql_uniform(chr(39).join(['CAST(t.doc_id AS VARCHAR) || ', '|', ' || t.term']), f'{c}|{_SEED}')} + 0.5" for c in range(_K))
    parts = [f"""lt AS (SELECT t.doc_id, t.term, CAST(t.tf AS DOUBLE) AS tf, unnest(range({_K})) AS k, unnest([{g0}]) AS u FROM tf t JOIN vocab v ON t.term = v.term),
g0 AS (SELECT doc_id, term, tf, k, u / sum(u) OVER (PARTITION BY doc_id, term) AS g FROM lt),
nv AS (SELECT CAST(count(DISTINCT term) AS DOUBLE) AS v FROM lt)"""]
    for s in range(_SWEEPS):
        parts.append(f"""nt{s} AS (SELECT term, k, sum(tf * g) AS n FROM g{s} GROUP BY term, k),
nd{s} AS (SELECT doc_id, k, sum(tf * g) AS n FROM g{s} GROUP BY doc_id, k),
nk{s} AS (SELECT k, sum(tf * g) AS n FROM g{s} GROUP BY k),
p{s} AS (SELECT g.doc_id, g.term, g.tf, g.k, (t.n - g.g + {_BETA}) * (d.n - g.g + {_ALPHA}) / (a.n - g.g + (SELECT v FROM nv) * {_BETA}) AS p
         FROM g{s} g JOIN nt{s} t ON t.term = g.term AND t.k = g.k JOIN nd{s} d ON d.doc_id = g.doc_id AND d.k = g.k JOIN nk{s} a ON a.k = g.k),
g{s + 1} AS (SELECT doc_id, term, tf, k, p / sum(p) OVER (PARTITION BY doc_id, term) AS g FROM p{s})""")
    parts.append(f"""wt AS (SELECT term, k, sum(tf * g) AS n FROM g{_SWEEPS} GROUP BY term, k),
tw AS (SELECT k AS topic, term, (n + {_BETA}) / (sum(n) OVER (PARTITION BY k) + (SELECT v FROM nv) * {_BETA}) AS weight FROM wt),
wd AS (SELECT doc_id, k, sum(tf * g) AS n FROM g{_SWEEPS} GROUP BY doc_id, k),
dw AS (SELECT doc_id, k AS topic, (n + {_ALPHA}) / (sum(n) OVER (PARTITION BY doc_id) + {_K} * {_ALPHA}) AS weight FROM wd)""")
    return SQL_TEXT + ", " + ",\n".join(parts) + "\n"


_TOPICS_SQL = _sql_topics()


def _sweeps(spark, sf_dir):
    c = corpus(spark, sf_dir)
    return c, TP.collapsed_topics(c.counts, _K, _SWEEPS, _ALPHA, _BETA, _SEED)


@query("topic_terms", ops="M6 M7 W5", sql=_TOPICS_SQL + """
SELECT topic, term_rank, term, round(weight, 6) AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(weight, 6) DESC, term) AS term_rank FROM tw) x WHERE term_rank <= 6""")
def topic_terms(spark, sf_dir):
    """The six likeliest terms of each topic after two sweeps."""
    w = TP.topic_terms(_sweeps(spark, sf_dir)[1], _BETA).withColumn("weight", r6(F.col("weight")))
    top = TP.top_terms(w, "topic")
    return top.select(F.col("topic").cast("bigint").alias("topic"), F.col("term_rank").cast("bigint").alias("term_rank"), "term", "weight")


@query("topic_of_document", ops="M8 W10", sql=_TOPICS_SQL + """
SELECT doc_id, topic, round(weight, 6) AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 6) DESC, topic) AS nth FROM dw) x WHERE nth = 1""")
def topic_of_document(spark, sf_dir):
    """The likeliest topic of each document that has a term of the vocabulary."""
    d = TP.document_topics(_sweeps(spark, sf_dir)[1], _ALPHA).withColumn("weight", r6(F.col("weight")))
    best = Window.partitionBy("doc_id").orderBy(F.col("weight").desc(), "topic")
    return d.withColumn("nth", F.row_number().over(best)).where("nth = 1").select("doc_id", F.col("topic").cast("bigint").alias("topic"), "weight")
