"""Registered model queries: clustering, PCA, LDA, ALS, dense ALS.

Lloyd k-means from fixed start centres and rank-1 dense ALS are unrolled in
SQL, so they have exact oracles; Spark ML fits (KMeans, PCA, LDA, ALS) are
checked by rows here and by property tests in ``tests/``.
"""

from __future__ import annotations

from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from orrery.operators import als as ALSO
from orrery.operators import evaluate as E
from orrery.operators import itemcf as CF
from orrery.operators import text as TXT
from orrery.operators import topics as TP
from orrery.operators.gram import pair_stats
from orrery.operators.ordered import dense_index, running_sums
from orrery.operators.ratings import hash_split, train_test
from orrery.plans.common import SQL_DENSE, SQL_RATINGS, Inputs, query, r6, with_ctes
from orrery.plans.q_text import SQL_TEXT, corpus
from orrery.session import checkpoint_dir, cut_lineage, written

K = 5
STEPS = 3

# ------------------------------------------------------------------ SQL builders


def _sql_dense_kmeans(k=K, steps=STEPS) -> str:
    parts = [f"""pts AS (SELECT vec_id AS id, generate_subscripts(embedding, 1) AS d,
                        CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
c0 AS (SELECT dense_rank() OVER (ORDER BY id) - 1 AS cluster, d, x AS c FROM pts
       WHERE id IN (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT {k}))"""]
    for s in range(steps + 1):
        parts.append(f"""a{s} AS (SELECT id, cluster FROM (
    SELECT p.id, c.cluster, sum((p.x - c.c) * (p.x - c.c)) AS dist
    FROM pts p JOIN c{s} c ON p.d = c.d GROUP BY p.id, c.cluster) x
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, cluster) = 1)""")
        if s < steps:
            parts.append(f"""c{s + 1} AS (
  SELECT a.cluster, p.d, avg(p.x) AS c FROM pts p JOIN a{s} a ON p.id = a.id GROUP BY a.cluster, p.d
  UNION ALL SELECT cluster, d, c FROM c{s} WHERE cluster NOT IN (SELECT cluster FROM a{s}))""")
    return "WITH " + ",\n".join(parts) + f"\nSELECT id AS vec_id, cluster FROM a{steps}"


def _sql_sparse_kmeans_ctes(k=K, steps=STEPS) -> str:
    parts = [f"""iw AS (SELECT doc_id, term, CAST(round(weight * {TP.SCALE}) AS HUGEINT) AS x FROM w),
s_c0 AS (SELECT CAST(dense_rank() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS cluster, term AS f, x AS s, CAST(1 AS HUGEINT) AS n FROM iw
         WHERE doc_id IN (SELECT DISTINCT doc_id FROM iw ORDER BY doc_id LIMIT {k}))"""]
    for s in range(steps + 1):
        parts.append(f"""s_q{s} AS (SELECT cluster, sum(s * s) AS q, max(n) AS n FROM s_c{s} GROUP BY cluster),
s_d{s} AS (SELECT p.doc_id, c.cluster, sum(p.x * c.s) AS dot
          FROM iw p JOIN s_c{s} c ON p.term = c.f GROUP BY p.doc_id, c.cluster),
s_a{s} AS (SELECT doc_id, cluster FROM (
    SELECT i.doc_id, q.cluster, CAST(q.q - 2 * q.n * coalesce(d.dot, 0) AS DOUBLE) / CAST(q.n * q.n AS DOUBLE) AS score
    FROM docs i CROSS JOIN s_q{s} q
    LEFT JOIN s_d{s} d ON d.doc_id = i.doc_id AND d.cluster = q.cluster) x
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score, cluster) = 1)""")
        if s < steps:
            parts.append(f"""s_n{s} AS (SELECT cluster, CAST(count(*) AS HUGEINT) AS n FROM s_a{s} GROUP BY cluster),
s_w{s} AS (
  SELECT a.cluster, p.term AS f, sum(p.x) AS s, n.n
  FROM iw p JOIN s_a{s} a ON p.doc_id = a.doc_id JOIN s_n{s} n ON a.cluster = n.cluster
  GROUP BY a.cluster, p.term, n.n),
s_c{s + 1} AS (SELECT * FROM s_w{s}
  UNION ALL SELECT cluster, f, s, n FROM s_c{s} WHERE cluster NOT IN (SELECT cluster FROM s_w{s}))""")
    parts.append(f"clusters AS (SELECT doc_id, cluster FROM s_a{steps})")
    parts.append("ranks AS (SELECT doc_id, title, dense_rank() OVER (ORDER BY doc_id) AS rank FROM docs)")
    return ",\n".join(parts)


SQL_CLUSTERS = SQL_TEXT + ", " + _sql_sparse_kmeans_ctes() + "\n"


def _text_clusters(spark, sf_dir):
    c = corpus(spark, sf_dir)
    assign = (TP.kmeans_sparse(c.weights, c.docs, "doc_id", "term", "weight", K, STEPS)
              .withColumn("cluster", F.col("cluster").cast("bigint")))
    assign = cut_lineage(assign)  # read by several branches of a report
    ranks = dense_index(c.docs, "doc_id", "idx").select("doc_id", (F.col("idx") + 1).alias("rank"))
    return c, assign, ranks


# ------------------------------------------------------------------ k-means


@query("kmeans_fixed_start", ops="M1 M2 A17", sql=_sql_dense_kmeans())
def kmeans_fixed_start(spark, sf_dir):
    emb = Inputs(spark, sf_dir).t("embeddings")
    assign, _ = TP.kmeans_dense(emb, "vec_id", "embedding", K, STEPS)
    return assign.withColumn("cluster", F.col("cluster").cast("bigint"))


@query("text_clusters", ops="M1 M2 (sparse Lloyd)", sql=SQL_CLUSTERS + "SELECT doc_id, cluster FROM clusters")
def text_clusters(spark, sf_dir):
    return _text_clusters(spark, sf_dir)[1]


@query("cluster_sizes", ops="A11 M4", sql=SQL_CLUSTERS + """
SELECT cluster, count(*) AS n_docs FROM clusters GROUP BY cluster""")
def cluster_sizes(spark, sf_dir):
    _, assign, _ = _text_clusters(spark, sf_dir)
    return assign.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_docs"))


@query("cluster_mean_rank", ops="A12 M4", sql=SQL_CLUSTERS + """
SELECT c.cluster, round(avg(r.rank), 6) AS mean_rank FROM clusters c JOIN ranks r ON c.doc_id = r.doc_id
GROUP BY c.cluster""")
def cluster_mean_rank(spark, sf_dir):
    _, assign, ranks = _text_clusters(spark, sf_dir)
    s = TP.cluster_summary(assign, ranks)
    return s.select("cluster", r6(F.col("mean_rank")).alias("mean_rank"))


_CLUSTER_TERMS = f""", sz AS (SELECT cluster, count(*) AS n FROM clusters GROUP BY cluster),
cw AS (SELECT c.cluster, p.term, CAST(sum(p.x) AS DOUBLE) / (sz.n * {TP.SCALE}.0) AS weight
       FROM iw p JOIN clusters c ON p.doc_id = c.doc_id JOIN sz ON sz.cluster = c.cluster
       GROUP BY c.cluster, p.term, sz.n),
top AS (SELECT cluster, term, weight,
               row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) AS term_rank FROM cw)
"""


@query("cluster_terms", ops="M3 M4 W5 T5", sql=SQL_CLUSTERS + _CLUSTER_TERMS + """SELECT t.cluster, t.term_rank, t.term, s.word, round(t.weight, 6) AS weight
FROM top t JOIN s2w s ON t.term = s.stem WHERE t.term_rank <= 6""")
def cluster_terms(spark, sf_dir):
    c, assign, _ = _text_clusters(spark, sf_dir)
    cw = TP.centre_weights(c.weights, assign)
    top = written(TP.top_terms(cw, n=6), "top")
    words = c.words_of(top)
    return (top.join(words, top.term == words.stem)
            .select("cluster", F.col("term_rank").cast("bigint").alias("term_rank"), "term", "word",
                    r6(F.col("weight")).alias("weight")))


@query("cluster_titles", ops="A13 M4 J9", sql=SQL_CLUSTERS + """
SELECT c.cluster, r.rank, r.title FROM clusters c JOIN ranks r ON c.doc_id = r.doc_id""")
def cluster_titles(spark, sf_dir):
    c, assign, ranks = _text_clusters(spark, sf_dir)
    titles = c.docs.select("doc_id", "title")
    return (assign.join(ranks, "doc_id").join(titles, "doc_id")
            .select("cluster", "rank", "title").orderBy("cluster", "rank"))


@query("cluster_report", ops="A13 M4", sql=SQL_CLUSTERS + _CLUSTER_TERMS + """
, size AS (SELECT cluster, count(*) AS n_docs FROM clusters GROUP BY cluster)
SELECT c.cluster, size.n_docs, 'title' AS kind, CAST(row_number() OVER (PARTITION BY c.cluster ORDER BY r.rank) AS BIGINT) AS nth, r.title AS entry
FROM clusters c JOIN ranks r ON c.doc_id = r.doc_id JOIN size ON size.cluster = c.cluster
UNION ALL
SELECT t.cluster, size.n_docs, 'term', t.term_rank, s.word
FROM top t JOIN s2w s ON t.term = s.stem JOIN size ON size.cluster = t.cluster WHERE t.term_rank <= 6""")
def cluster_report(spark, sf_dir):
    """Per cluster: its size, its titles in rank order and its top words, as
    numbered rows (a list of all titles would not be bounded)."""
    c, assign, ranks = _text_clusters(spark, sf_dir)
    size = assign.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_docs"))
    starts = ranks.join(assign, "doc_id")
    nth = running_sums(starts.withColumn("one", F.lit(1.0)), "rank", ["one"], descending=False, group="cluster")
    titles = nth.join(c.docs.select("doc_id", "title"), "doc_id").select(
        "cluster", F.lit("title").alias("kind"), F.col("cum_one").cast("bigint").alias("nth"), F.col("title").alias("entry"))
    top = written(TP.top_terms(TP.centre_weights(c.weights, assign), n=6), "top")
    words = c.words_of(top)
    terms = top.join(words, top.term == words.stem).select(
        "cluster", F.lit("term").alias("kind"), F.col("term_rank").cast("bigint").alias("nth"), F.col("word").alias("entry"))
    return titles.unionByName(terms).join(size, "cluster").select("cluster", "n_docs", "kind", "nth", "entry")


@query("label_cluster_summary", ops="A11 A12 (fixed assignment)", sql="""
SELECT label AS cluster, count(*) AS n_vectors, round(avg(vec_id + 1), 6) AS mean_rank
FROM embeddings GROUP BY label""")
def label_cluster_summary(spark, sf_dir):
    emb = Inputs(spark, sf_dir).t("embeddings")
    return (emb.groupBy(F.col("label").alias("cluster"))
            .agg(F.count(F.lit(1)).alias("n_vectors"), r6(F.avg(F.col("vec_id") + 1)).alias("mean_rank")))


@query("kmeans_text", ops="M1 M2 (Spark ML KMeans)")
def kmeans_text(spark, sf_dir):
    c = corpus(spark, sf_dir)
    feats = _tfidf_vectors(c)
    model = KMeans(k=K, seed=1, featuresCol="features", predictionCol="cluster").fit(feats)
    return model.transform(feats).select("doc_id", "cluster")


def _vocab_lists(c: TXT.Corpus):
    idf = TXT.idf_table(c.vocab).orderBy("term").collect()  # bounded by the document frequencies
    return [r["term"] for r in idf], [float(r["idf"]) for r in idf]


def _tfidf_vectors(c: TXT.Corpus):
    terms, idf = _vocab_lists(c)
    return TP.term_vectors(c.counts, c.docs, terms, idf).select("doc_id", "counts", "features")


# ------------------------------------------------------------------ PCA


@query("pca_covariance", ops="M5 A19", sql="""
WITH pts AS (SELECT vec_id AS id, generate_subscripts(embedding, 1) - 1 AS d,
                    CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT a.d AS dim_1, b.d AS dim_2,
       round((sum(a.x * b.x) - sum(a.x) * sum(b.x) / count(*)) / (count(*) - 1), 6) AS cov
FROM pts a JOIN pts b ON a.id = b.id AND a.d <= b.d GROUP BY a.d, b.d""")
def pca_covariance(spark, sf_dir):
    emb = Inputs(spark, sf_dir).t("embeddings")
    long = emb.select("vec_id", F.posexplode("embedding").alias("dim", "x"))
    st = pair_stats(long, row="vec_id", col="dim", value="x", stats=("n", "sx", "sy", "sxy"),
                    include_self=True)
    cov = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / (F.col("n") - 1)
    return st.select(F.col("c1").cast("bigint").alias("dim_1"), F.col("c2").cast("bigint").alias("dim_2"),
                     r6(cov).alias("cov"))


@query("pca_xy", ops="M5")
def pca_xy(spark, sf_dir):
    emb = Inputs(spark, sf_dir).t("embeddings")
    v = emb.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="v", outputCol="c").fit(v).transform(v)
    p = PCA(k=2, inputCol="c", outputCol="xy").fit(centred).transform(centred)
    a = vector_to_array("xy")
    return p.select("vec_id", "label", a[0].alias("x"), a[1].alias("y"))


# ------------------------------------------------------------------ LDA


def _lda(spark, sf_dir, k=K, iters=500, weighting="scaled"):
    """LDA on counts, or on the TF-IDF weights times 1000 cut to whole numbers
    as the original gives them to it (ledger Q24)."""
    c = corpus(spark, sf_dir)
    terms, _ = _vocab_lists(c)
    tf = c.counts if weighting == "counts" else TXT.scaled(c.weights).select("doc_id", "term", F.col("weight_int").alias("tf"))
    # every iteration is a job over all partitions: no more of them than cores
    counts = TP.term_vectors(tf, c.docs, terms).select("doc_id", F.col("counts").alias("features"))
    counts = counts.coalesce(spark.sparkContext.defaultParallelism).cache()
    try:
        model = LDA(k=k, maxIter=iters, seed=1, optimizer="online").fit(counts)
    finally:
        counts.unpersist()
    return c, terms, counts, model


@query("lda_topics", ops="M6 M7 T5")
def lda_topics(spark, sf_dir):
    c, terms, _, model = _lda(spark, sf_dir)
    vocab = spark.createDataFrame(list(enumerate(terms)), "term_index int, term string")
    topics = model.describeTopics(6).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("pos", "tw"))
    words = c.words_of(vocab)
    return (topics.select("topic", (F.col("pos") + 1).alias("term_rank"),
                          F.col("tw.termIndices").alias("term_index"),
                          F.col("tw.termWeights").alias("weight"))
            .join(vocab, "term_index").join(words, F.col("term") == F.col("stem"), "left")
            .select("topic", "term_rank", "term", "word", "weight"))


@query("lda_doc_topic", ops="M8 W10 A13")
def lda_doc_topic(spark, sf_dir):
    """Every document with its topic and its number among the topic's titles."""
    c, _, counts, model = _lda(spark, sf_dir, weighting="counts")
    t = cut_lineage(model.transform(counts).select("doc_id", TP.argmax_index(F.col("topicDistribution")).alias("topic")))
    nth = running_sums(t.withColumn("one", F.lit(1.0)), "doc_id", ["one"], descending=False, group="topic")
    return nth.join(c.docs.select("doc_id", "title"), "doc_id").select("doc_id", "topic", F.col("cum_one").cast("bigint").alias("nth"), "title")


# ------------------------------------------------------------------ Spark ML ALS


def _coded(spark, sf_dir):
    """Train and test with dense integer codes beside the ids (ids may be long)."""
    # every step reads the ratings, the indexes and the coded ratings again: written once each
    ratings = written(Inputs(spark, sf_dir).ratings.select("user_id", "item_id", "rating"), "ratings")
    users = written(dense_index(ratings, "user_id", "user_code").withColumn("user_code", F.col("user_code").cast("int")), "codes")
    items = written(dense_index(ratings, "item_id", "item_code").withColumn("item_code", F.col("item_code").cast("int")), "codes")
    coded = written(hash_split(ratings).join(users, "user_id").join(items, "item_id")
                    .select("user_id", "item_id", "user_code", "item_code", "rating", "is_test"), "coded")
    return coded.where(~F.col("is_test")).drop("is_test"), coded.where("is_test").drop("is_test"), users, items


CODES = dict(user="user_code", item="item_code")


@query("als_predict", ops="R9 R10")
def als_predict(spark, sf_dir):
    train, test, _, _ = _coded(spark, sf_dir)
    m = ALSO.fit_als(train, rank=10, iterations=10, reg=0.1, **CODES)
    return m.transform(test).select("user_id", "item_id", "rating", "prediction")


@query("als_top2_names", ops="R11 R12 J2 O3")
def als_top2_names(spark, sf_dir):
    """Two items for each user whose id is divisible by 20."""
    train, _, users, items = _coded(spark, sf_dir)
    m = ALSO.fit_als(train, rank=10, iterations=10, reg=0.1, **CODES)
    names = items.join(Inputs(spark, sf_dir).t("part").select(F.col("p_partkey").alias("item_id"), "p_name"), "item_id")
    asked = users.where(F.col("user_id") % 20 == 0)
    top = ALSO.top_n_named(m, 2, asked.select("user_code"), names, "item_code", "p_name", "user_code")
    return top.join(asked, "user_code").select("user_id", "recommend_1", "recommend_2").orderBy("user_id")


_GRID = dict(ranks=[5, 8, 10, 15], iterations=[10, 20], regs=[0.01, 0.02, 0.05, 0.1, 0.2, 0.3])
_DENSE_GRID = dict(ranks=[10, 20, 30, 40], iterations=[10, 20], regs=[0.01, 0.1, 0.3])


@query("als_grid", ops="R13 A15")
def als_grid(spark, sf_dir):
    """All 48 fits; the best one (by MSE on the training ratings) is marked."""
    train, test, _, _ = _coded(spark, sf_dir)
    runs, _, best = ALSO.grid_search(train, test, **_GRID, **CODES)
    return runs.withColumn("is_best", F.struct("rank", "iterations", "reg") == F.struct(*[F.lit(x) for x in best]))


@query("als_grid_pivot", ops="R13 W9")
def als_grid_pivot(spark, sf_dir):
    """The 48 fits: a row per rank and λ, the MSE of each number of iterations."""
    its = [F.col(str(i)).alias(f"it{i}") for i in _GRID["iterations"]]
    return ALSO.pivot_runs(als_grid(spark, sf_dir)).select("rank", "reg", *its)


def _run_table(spark, sf_dir):
    """A run table that both engines derive alike, for the reports on it: the
    size bands of parts as ranks, quarters of customers as iterations."""
    d = Inputs(spark, sf_dir)
    j = d.ratings.join(d.t("part").select(F.col("p_partkey").alias("item_id"), "p_size"), "item_id")
    return j.groupBy((F.floor(F.col("p_size") / 10) * 5 + 5).cast("int").alias("rank"), (F.pmod("user_id", F.lit(2)) * 10 + 10).cast("int").alias("iterations"),
                     (F.pmod("item_id", F.lit(3)) / 10.0 + 0.1).alias("reg")) \
        .agg(F.round(F.avg(F.pow(F.col("rating") - 3, 2)), 9).alias("mse_train"))


_RUNS_SQL = with_ctes(SQL_RATINGS) + """
, runs AS (SELECT CAST(floor(p.p_size / 10.0) * 5 + 5 AS INTEGER) AS rank, CAST(user_id % 2 * 10 + 10 AS INTEGER) AS iterations,
           (item_id % 3) / 10.0::DOUBLE + 0.1::DOUBLE AS reg, round(avg(pow(rating - 3, 2)), 9) AS mse_train
           FROM ratings r JOIN part p ON r.item_id = p.p_partkey GROUP BY 1, 2, 3)"""


@query("best_run", ops="A15", sql=_RUNS_SQL + """
SELECT rank, iterations, round(reg, 6) AS reg, mse_train FROM runs ORDER BY mse_train, rank, iterations, reg LIMIT 1""")
def best_run(spark, sf_dir):
    return ALSO.best_run(_run_table(spark, sf_dir)).withColumn("reg", r6(F.col("reg")))


@query("run_curves", ops="R23 W8", sql=_RUNS_SQL + """
SELECT rank, iterations, string_agg(CAST(round(reg, 1) AS VARCHAR) || ':' || CAST(round(mse_train, 6) AS VARCHAR), ',' ORDER BY reg) AS points
FROM runs GROUP BY rank, iterations""")
def run_curves(spark, sf_dir):
    point = lambda p: F.concat_ws(":", F.round(p["x"], 1).cast("string"), r6(p["y"]).cast("string"))
    return ALSO.curves(_run_table(spark, sf_dir)).select("rank", "iterations", F.concat_ws(",", F.transform("points", point)).alias("points"))


@query("run_pivot", ops="W9", sql=_RUNS_SQL + """
SELECT rank, round(reg, 6) AS reg, max(mse_train) FILTER (WHERE iterations = 10) AS it10,
       max(mse_train) FILTER (WHERE iterations = 20) AS it20 FROM runs GROUP BY rank, reg""")
def run_pivot(spark, sf_dir):
    p = ALSO.pivot_runs(_run_table(spark, sf_dir))
    return p.select("rank", r6(F.col("reg")).alias("reg"), F.col("10").alias("it10"), F.col("20").alias("it20"))


@query("als_curves", ops="R23 W8")
def als_curves(spark, sf_dir):
    """Curves over λ and over rank from the 48 fits."""
    train, test, _, _ = _coded(spark, sf_dir)
    runs, _, _ = ALSO.grid_search(train, test, **_GRID, **CODES)
    over_reg = ALSO.curves(runs).select(F.lit("reg").alias("over"), F.col("rank").cast("double").alias("series"), "iterations",
                                        F.to_json("points").alias("points"))
    over_rank = ALSO.curves(runs, series="reg", x="rank").select(F.lit("rank").alias("over"), F.col("reg").alias("series"), "iterations",
                                                                 F.to_json("points").alias("points"))
    return over_reg.unionByName(over_rank)


@query("dense_als_grid", ops="R13 R16 R23")
def dense_als_grid(spark, sf_dir):
    """All 24 settings of the dense factorisation, the best one marked."""
    runs = ALSO.dense_grid(Inputs(spark, sf_dir).dense, **_DENSE_GRID)
    return runs.withColumn("is_best", F.col("mse") == runs.agg(F.min("mse")).scalar())


# ------------------------------------------------------------------ dense ALS

_DALS_ITERS = 2
_DALS_LAMBDA = 0.1


def _sql_hash_uniform(key: str, comp: int, seed: int) -> str:
    return (f"CAST(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{comp}|{seed}'), 1, 8)) AS BIGINT)"
            f" AS DOUBLE) / 4294967296.0")


def _sql_dense_als_rank1(iters=_DALS_ITERS, lam=_DALS_LAMBDA, seed=3) -> str:
    parts = [SQL_RATINGS.strip("\n"), SQL_DENSE.strip("\n"),
             f"y0 AS (SELECT item_key, {_sql_hash_uniform('item_key', 0, seed)} AS f "
             "FROM (SELECT DISTINCT item_key FROM dense) i)"]
    for t in range(1, iters + 1):
        parts.append(f"""x{t} AS (SELECT d.user_id, sum(d.rating * y.f) / ((SELECT sum(f * f) FROM y{t - 1}) + {lam}) AS f
        FROM dense d JOIN y{t - 1} y ON d.item_key = y.item_key GROUP BY d.user_id)""")
        parts.append(f"""y{t} AS (SELECT d.item_key, sum(d.rating * x.f) / ((SELECT sum(f * f) FROM x{t}) + {lam}) AS f
        FROM dense d JOIN x{t} x ON d.user_id = x.user_id GROUP BY d.item_key)""")
    return "WITH " + ",\n".join(parts) + "\n"


_DALS_SQL = _sql_dense_als_rank1()


def _dense_als(spark, sf_dir, rank):
    dense = written(Inputs(spark, sf_dir).dense, "dense")  # fitted, then scored
    return dense, *ALSO.dense_als(dense, rank, _DALS_ITERS, _DALS_LAMBDA, seed=3)


@query("dense_als_rank1", ops="R14", sql=_DALS_SQL + f"""
SELECT 'user' AS side, CAST(user_id AS VARCHAR) AS key, round(f, 6) AS factor FROM x{_DALS_ITERS}
UNION ALL
SELECT 'item', item_key, round(f, 6) FROM y{_DALS_ITERS}""")
def dense_als_rank1(spark, sf_dir):
    _, users, items = _dense_als(spark, sf_dir, 1)
    return (users.select(F.lit("user").alias("side"), F.col("user_id").cast("string").alias("key"),
                         r6(F.col("f")[0]).alias("factor"))
            .unionByName(items.select(F.lit("item").alias("side"), F.col("item_key").alias("key"),
                                      r6(F.col("f")[0]).alias("factor"))))


@query("dense_als_mse_rank1", ops="R15 A4", sql=_DALS_SQL + f"""
SELECT count(*) AS n_rated, round(avg(pow(d.rating - x.f * y.f, 2)), 6) AS mse
FROM dense d JOIN x{_DALS_ITERS} x ON d.user_id = x.user_id JOIN y{_DALS_ITERS} y ON d.item_key = y.item_key""")
def dense_als_mse_rank1(spark, sf_dir):
    dense, users, items = _dense_als(spark, sf_dir, 1)
    p = ALSO.predict_rated(dense, users, items)
    return p.agg(F.count(F.lit(1)).alias("n_rated"),
                 r6(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("mse"))


@query("dense_als", ops="R14 R15")
def dense_als(spark, sf_dir):
    train, test = train_test(written(Inputs(spark, sf_dir).dense, "dense"), "user_id", "item_key")
    users, items = ALSO.dense_als(train, 40, 20, 0.01)
    scored = ALSO.predict_rated(test, users, items)
    return scored.select("user_id", "item_key", "rating", "prediction")


@query("dense_als_curve", ops="R16 A4")
def dense_als_curve(spark, sf_dir):
    """Train and test MSE along one run, recorded at chosen iterations (ledger Q19)."""
    train, test = train_test(written(Inputs(spark, sf_dir).dense, "dense"), "user_id", "item_key")
    rows = []
    for it, users, items in ALSO.dense_als_path(train, 40, 20, 0.01):
        if it not in (1, 2, 5, 10, 20):
            continue
        mse = [ALSO.predict_rated(x, users, items)
               .agg(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).first()[0]
               for x in (train, test)]
        rows.append((it, float(mse[0]), float(mse[1])))
    return spark.createDataFrame(rows, "iterations int, mse_train double, mse_test double")


@query("dense_als_top_cells", ops="J10 R15")
def dense_als_top_cells(spark, sf_dir):
    """The ten best items of each user whose id is divisible by 20."""
    users, items = ALSO.dense_als(Inputs(spark, sf_dir).dense, 10, 10, 0.1)
    return ALSO.top_cells(users.where(F.col("user_id") % 20 == 0), items, 10)


_ROC = _DALS_SQL.rstrip() + f"""
, scored AS (SELECT d.rating, round(x.f * y.f, 6) AS prediction
             FROM dense d JOIN x{_DALS_ITERS} x ON d.user_id = x.user_id JOIN y{_DALS_ITERS} y ON d.item_key = y.item_key),
lab AS (SELECT CAST(rating >= 2.5 AS INTEGER) AS label, prediction AS score, 'continuous' AS kind FROM scored
        UNION ALL
        SELECT CAST(rating >= 2.5 AS INTEGER), CAST(CAST(prediction >= 2.5 AS INTEGER) AS DOUBLE), 'binary' FROM scored),
per AS (SELECT kind, score AS threshold, CAST(sum(label) AS DOUBLE) AS tp,
               CAST(sum(1 - label) AS DOUBLE) AS fp FROM lab GROUP BY kind, score),
cum AS (SELECT kind, threshold, tp, fp,
               sum(tp) OVER (PARTITION BY kind ORDER BY threshold DESC) AS ctp,
               sum(fp) OVER (PARTITION BY kind ORDER BY threshold DESC) AS cfp,
               sum(tp) OVER (PARTITION BY kind) AS P, sum(fp) OVER (PARTITION BY kind) AS N
        FROM per)"""


def _roc(spark, sf_dir):
    """Every rated cell, like if rating >= 2.5, scored by the fitted rank-1
    factors: by the score itself and by the score cut at 2.5."""
    dense, users, items = _dense_als(spark, sf_dir, 1)
    s = ALSO.predict_rated(dense, users, items).withColumn("prediction", r6(F.col("prediction")))
    both = F.explode(F.array(F.struct(F.lit("continuous").alias("kind"), F.col("prediction").alias("score")),
                             F.struct(F.lit("binary").alias("kind"), E.binarise("prediction", 2.5).cast("double").alias("score"))))
    return E.roc_points(s.select(E.binarise("rating", 2.5).alias("label"), both.alias("x")).select("label", "x.*"), group="kind")


@query("roc_points", ops="P7 R20", sql=_ROC + """
SELECT kind, threshold, round(cfp / N, 6) AS fpr, round(ctp / P, 6) AS tpr FROM cum
UNION ALL SELECT DISTINCT kind, NULL, 0.0, 0.0 FROM cum""")
def roc_points(spark, sf_dir):
    return _roc(spark, sf_dir).select("kind", "threshold", r6(F.col("fpr")).alias("fpr"), r6(F.col("tpr")).alias("tpr"))


@query("roc_auc", ops="R21", sql=_ROC + """
SELECT kind, round(sum((cfp / N - (cfp - fp) / N) * (ctp / P + (ctp - tp) / P) / 2), 6) AS auc
FROM cum GROUP BY kind""")
def roc_auc(spark, sf_dir):
    return E.roc_auc(_roc(spark, sf_dir), group="kind").select("kind", r6(F.col("auc")).alias("auc"))


# ------------------------------------------------------------------ model-based CF


def _modelcf(spark, sf_dir):
    """ALS (rank 20, 20 iterations, λ 0.3 as the model-based job) on the
    sparse train split; test pairs get the blend of item average (default
    4.0) and the ALS prediction, or the item average alone (R5, R6, R9, R10)."""
    train, test, _, _ = _coded(spark, sf_dir)
    checkpoint_dir(spark)
    m = ALSO.fit_als(train, rank=20, iterations=20, reg=0.3, **CODES)
    pred = m.transform(test).select("user_id", F.col("item_id").alias("target"), "prediction")
    return train, test, pred, CF.blend(test, train, pred)


@query("modelcf_blended_rmse", ops="R6 R7 A5 J4")
def modelcf_blended_rmse(spark, sf_dir):
    return E.rmse(_modelcf(spark, sf_dir)[3])


@query("modelcf_error_levels", ops="R8 P6 F9")
def modelcf_error_levels(spark, sf_dir):
    return E.error_levels(_modelcf(spark, sf_dir)[3])


@query("modelcf_rmse_no_fallback", ops="R7 J1 (ledger Q10)")
def modelcf_rmse_no_fallback(spark, sf_dir):
    """Inner join of predictions and test rows, divided by all test rows."""
    _, test, pred, _ = _modelcf(spark, sf_dir)
    scored = test.join(pred.withColumnRenamed("target", "item_id"), ["user_id", "item_id"])
    return E.rmse(scored, denominator=test.count())


@query("modelcf_prediction_output", ops="K1 O2 W3 P9")
def modelcf_prediction_output(spark, sf_dir):
    s = _modelcf(spark, sf_dir)[3]
    return (s.select(F.concat_ws(",", F.col("user_id").cast("string"), F.col("item_id").cast("string"),
                                 F.col("prediction").cast("string")).alias("line"),
                     F.col("user_id").cast("string").alias("u"), F.col("item_id").cast("string").alias("i"))
            .orderBy("u", "i").select("line"))
