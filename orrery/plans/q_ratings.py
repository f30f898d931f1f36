"""Registered rating queries: descriptive statistics, item CF, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import evaluate as E
from orrery.operators import itemcf as CF
from orrery.operators import olap as O
from orrery.operators import ratings as R
from orrery.operators.ordered import dense_index
from orrery.plans.common import (SQL_DENSE, SQL_RATINGS, SQL_SPLIT, Inputs, query, r6,
                                 with_ctes)
from orrery.session import written

RD = with_ctes(SQL_RATINGS, SQL_DENSE)
RS = with_ctes(SQL_RATINGS, SQL_SPLIT)

# ---------------------------------------------------------------- phase 0


@query("baseline_rmse", ops="S8 D1 A6 R5 J1 A5", sql=RS + """
, avg_i AS (SELECT item_id, avg(rating) AS item_avg FROM train GROUP BY item_id)
SELECT count(*) AS n_scored,
       round(sqrt(sum(pow(t.rating - coalesce(a.item_avg, 4.0), 2)) / count(*)), 6) AS rmse
FROM test t LEFT JOIN avg_i a ON t.item_id = a.item_id""")
def baseline_rmse(spark, sf_dir):
    d = Inputs(spark, sf_dir)
    train, test = d.split()
    scored = CF.blend(test, train, None)
    return E.rmse(scored).select("n_scored", r6(F.col("rmse")).alias("rmse"))


# ---------------------------------------------------------------- phase 1: OLAP


@query("ratings_per_user", ops="A1 O1", sql=with_ctes(SQL_RATINGS) + """
SELECT user_id, count(*) AS n_ratings FROM ratings GROUP BY user_id ORDER BY user_id""")
def ratings_per_user(spark, sf_dir):
    return O.count_per_key(Inputs(spark, sf_dir).ratings, "user_id").orderBy("user_id")


@query("ratings_per_item", ops="A1 O1", sql=with_ctes(SQL_RATINGS) + """
SELECT item_id, count(*) AS n_ratings FROM ratings GROUP BY item_id ORDER BY item_id""")
def ratings_per_item(spark, sf_dir):
    return O.count_per_key(Inputs(spark, sf_dir).ratings, "item_id").orderBy("item_id")


@query("rated_item_count", ops="A2 A3", sql=with_ctes(SQL_RATINGS) + """
SELECT count(DISTINCT item_id) AS n_items, count(*) AS n_ratings FROM ratings""")
def rated_item_count(spark, sf_dir):
    return O.rating_totals(Inputs(spark, sf_dir).ratings).select("n_items", "n_ratings")


@query("user_count", ops="A2 A17", sql=with_ctes(SQL_RATINGS) + """
SELECT count(DISTINCT user_id) AS n_users FROM ratings""")
def user_count(spark, sf_dir):
    return O.rating_totals(Inputs(spark, sf_dir).ratings).select("n_users")


_UNRATED_SQL = with_ctes(SQL_RATINGS) + """
, rated AS (SELECT item_id FROM ratings)
SELECT p.p_partkey AS item_id, p.p_name AS name FROM part p,
  (SELECT p_partkey AS item_id FROM part EXCEPT SELECT item_id FROM rated) n
WHERE p.p_partkey = n.item_id"""


@query("unrated_items", ops="J* R18 left-anti", sql=_UNRATED_SQL)
def unrated_items(spark, sf_dir):
    d = Inputs(spark, sf_dir)
    return O.unrated_items_anti(d.t("part"), d.ratings)


@query("unrated_items_except", ops="U2 J3 S8 S9 R18", sql=_UNRATED_SQL)
def unrated_items_except(spark, sf_dir):
    d = Inputs(spark, sf_dir)
    d.t("part").createOrReplaceTempView("movies_view")
    d.ratings.createOrReplaceTempView("ratings_view")
    return O.unrated_items_sql(spark, "movies_view", "ratings_view")


@query("genre_counts", ops="F3 A1 R19", sql="""
SELECT genre, count(*) AS n_items
FROM (SELECT unnest(string_split(p_brand || '|' || p_type, '|')) AS genre FROM part) g
GROUP BY genre""")
def genre_counts(spark, sf_dir):
    part = Inputs(spark, sf_dir).t("part").select(
        F.concat_ws("|", "p_brand", "p_type").alias("genres"))
    return O.genre_counts(part, "genres")


@query("id_encoding", ops="W1 W2 U1", sql=with_ctes(SQL_RATINGS, SQL_DENSE) + """
SELECT item_key, dense_rank() OVER (ORDER BY item_key) - 1 AS item_code
FROM (SELECT item_key FROM dtrain UNION SELECT item_key FROM dtest) k""")
def id_encoding(spark, sf_dir):
    train, test = Inputs(spark, sf_dir).split(dense=True)
    keys = train.select("item_key").unionByName(test.select("item_key"))
    return dense_index(keys, "item_key", "item_code")


@query("id_decoding", ops="W2 W3 J6 F7", sql=with_ctes(SQL_RATINGS, SQL_DENSE) + """
, ucode AS (SELECT user_id, dense_rank() OVER (ORDER BY user_id) - 1 AS user_code
            FROM (SELECT DISTINCT user_id FROM dense) u),
icode AS (SELECT item_key, dense_rank() OVER (ORDER BY item_key) - 1 AS item_code
          FROM (SELECT DISTINCT item_key FROM dense) i),
enc AS (SELECT u.user_code, i.item_code, d.rating FROM dense d
        JOIN ucode u ON d.user_id = u.user_id JOIN icode i ON d.item_key = i.item_key)
SELECT u.user_id, i.item_key, e.user_code, e.item_code, e.rating
FROM enc e JOIN ucode u ON e.user_code = u.user_code JOIN icode i ON e.item_code = i.item_code""")
def id_decoding(spark, sf_dir):
    dense = Inputs(spark, sf_dir).dense
    ucode = dense_index(dense, "user_id", "user_code")
    icode = dense_index(dense, "item_key", "item_code")
    enc = (dense.join(ucode, "user_id").join(icode, "item_key")
           .select("user_code", "item_code", "rating"))
    return (enc.join(ucode, "user_code").join(icode, "item_code")
            .select("user_id", "item_key", "user_code", "item_code", "rating"))


@query("item_support", ops="A8", sql=RS + """
SELECT item_id, count(*) AS n_ratings FROM train GROUP BY item_id HAVING count(*) > 25""")
def item_support(spark, sf_dir):
    train, _ = Inputs(spark, sf_dir).split()
    return O.support(train, "item_id", 25)


@query("ratings_profile", ops="A22", sql=with_ctes(SQL_RATINGS) + """
SELECT 'rating' AS column_name, count(rating) AS n, count(*) FILTER (WHERE rating IS NULL) AS n_null,
       count(DISTINCT rating) AS n_distinct, min(rating) AS min_value, max(rating) AS max_value,
       round(avg(rating), 6) AS mean, round(stddev_samp(rating), 6) AS stddev,
       quantile_cont(rating, 0.25) AS p25, quantile_cont(rating, 0.5) AS p50,
       quantile_cont(rating, 0.75) AS p75
FROM ratings
UNION ALL
SELECT 'user_id', count(user_id), count(*) FILTER (WHERE user_id IS NULL), count(DISTINCT user_id),
       min(user_id), max(user_id), round(avg(user_id), 6), round(stddev_samp(user_id), 6),
       NULL, NULL, NULL
FROM ratings
UNION ALL
SELECT 'item_id', count(item_id), count(*) FILTER (WHERE item_id IS NULL), count(DISTINCT item_id),
       min(item_id), max(item_id), round(avg(item_id), 6), round(stddev_samp(item_id), 6),
       NULL, NULL, NULL
FROM ratings""")
def ratings_profile(spark, sf_dir):
    p = O.profile(Inputs(spark, sf_dir).ratings, ["rating", "user_id", "item_id"], ["rating"])
    return p.withColumn("mean", r6(F.col("mean"))).withColumn("stddev", r6(F.col("stddev")))


@query("ratings_correlations", ops="A22", sql=with_ctes(SQL_RATINGS) + """
SELECT 'user_id' AS column_1, 'item_id' AS column_2, round(corr(user_id, item_id), 6) AS corr FROM ratings
UNION ALL SELECT 'user_id', 'rating', round(corr(user_id, rating), 6) FROM ratings
UNION ALL SELECT 'item_id', 'rating', round(corr(item_id, rating), 6) FROM ratings""")
def ratings_correlations(spark, sf_dir):
    c = O.correlations(Inputs(spark, sf_dir).ratings, ["user_id", "item_id", "rating"])
    return c.withColumn("corr", r6(F.col("corr")))


@query("ratings_histogram", ops="A22", sql=with_ctes(SQL_RATINGS) + """
, e AS (SELECT min(rating) AS lo, max(rating) AS hi FROM ratings)
SELECT CAST(least(floor((rating - lo) / (hi - lo) * 10), 9) AS INTEGER) AS bin, count(*) AS n FROM ratings, e GROUP BY 1""")
def ratings_histogram(spark, sf_dir):
    return O.histogram(Inputs(spark, sf_dir).ratings, "rating", 10)


@query("ratings_extremes", ops="A22", sql=with_ctes(SQL_RATINGS) + """
, p AS (SELECT user_id AS value, count(*) AS n FROM ratings GROUP BY user_id)
SELECT * FROM (SELECT 'low' AS side, value, n FROM p ORDER BY value LIMIT 5) a
UNION ALL SELECT * FROM (SELECT 'high', value, n FROM p ORDER BY value DESC LIMIT 5) b""")
def ratings_extremes(spark, sf_dir):
    return O.extremes(Inputs(spark, sf_dir).ratings, "user_id")


@query("safe_casts", ops="P3 P4 F1 F2", sql="""
SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no,
       TRY_CAST(p_type AS INTEGER) AS type_no,
       TRY_CAST(split_part(p_name, ' ', 2) AS INTEGER) AS name_no,
       abs(p_retailprice - 1000.0) AS price_gap
FROM part""")
def safe_casts(spark, sf_dir):
    part = Inputs(spark, sf_dir).t("part")
    return (part.select("p_partkey",
                    F.expr("try_cast(substring(p_brand, 7) AS INT)").alias("brand_no"),
                    F.expr("try_cast(p_type AS INT)").alias("type_no"),
                    F.expr("try_cast(split(p_name, ' ')[1] AS INT)").alias("name_no"),
                    F.abs(F.col("p_retailprice") - F.lit(1000.0)).alias("price_gap")))


@query("large_parts", ops="P4", sql="SELECT p_partkey, p_size FROM part WHERE p_size > 10")
def large_parts(spark, sf_dir):
    return Inputs(spark, sf_dir).t("part").where(F.col("p_size") > 10).select("p_partkey", "p_size")


@query("parts_by_number", ops="O1", sql="""
SELECT p_partkey, substr(p_brand, 7) AS brand_no FROM part ORDER BY CAST(substr(p_brand, 7) AS INTEGER), p_partkey""")
def parts_by_number(spark, sf_dir):
    """Sorted by a string key read as a number."""
    return Inputs(spark, sf_dir).t("part").select("p_partkey", F.substring("p_brand", 7, 100).alias("brand_no")) \
        .orderBy(F.expr("try_cast(brand_no AS INT)"), "p_partkey")


@query("items_per_user_list", ops="A9 J2", sql=with_ctes(SQL_RATINGS, SQL_DENSE) + """
SELECT user_id, count(*) AS n_items, string_agg(item_key, ', ' ORDER BY item_key) AS items
FROM dense GROUP BY user_id""")
def items_per_user_list(spark, sf_dir):
    return O.items_per_user(Inputs(spark, sf_dir).dense, "user_id", "item_key")


# ---------------------------------------------------------------- phase 2: item CF

_SIM_SQL = """
, f AS (SELECT user_id, {item} AS item, CAST(rating * 2 AS BIGINT) AS x FROM {src}
        WHERE {item} IN (SELECT {item} FROM {src} GROUP BY {item} HAVING count(*) > 25)),
st AS (SELECT a.item AS item_1, b.item AS item_2, count(*) AS n, sum(a.x) AS sx, sum(b.x) AS sy,
              sum(a.x * b.x) AS sxy, sum(a.x * a.x) AS sxx, sum(b.x * b.x) AS syy
       FROM f a JOIN f b ON a.user_id = b.user_id AND a.item < b.item
       GROUP BY a.item, b.item),
sim AS (SELECT item_1, item_2, n AS n_common,
               CASE WHEN n * sxy - sx * sy = 0 OR n * sxx - sx * sx = 0 OR n * syy - sy * sy = 0
                    THEN 0.0
                    ELSE CAST(n * sxy - sx * sy AS DOUBLE)
                         / (sqrt(CAST(n * sxx - sx * sx AS DOUBLE)) * sqrt(CAST(n * syy - sy * sy AS DOUBLE)))
               END AS similarity
        FROM st)"""


@query("item_similarity", ops="J5 A7 A10 R1", sql=RS + _SIM_SQL.format(item="item_id", src="train") + """
SELECT item_1, item_2, n_common, round(similarity, 6) AS similarity FROM sim""")
def item_similarity(spark, sf_dir):
    train, _ = Inputs(spark, sf_dir).split()
    return CF.item_similarity(train).withColumn("similarity", r6(F.col("similarity")))


_DENSE_SIM = with_ctes(SQL_RATINGS, SQL_DENSE) + _SIM_SQL.format(item="item_key", src="dtrain") + """
, simf AS (SELECT item_1, item_2, n_common, similarity FROM sim
           UNION ALL SELECT item_2, item_1, n_common, similarity FROM sim)"""


@query("item_similarity_full", ops="R1 R2 U3", sql=_DENSE_SIM + """
SELECT item_1, item_2, n_common, round(similarity, 6) AS similarity FROM simf""")
def item_similarity_full(spark, sf_dir):
    train, _ = Inputs(spark, sf_dir).split(dense=True)
    sim = CF.item_similarity(train, item="item_key")
    return CF.symmetric(sim).withColumn("similarity", r6(F.col("similarity")))


_CANDS = _DENSE_SIM + """
, tr AS (SELECT user_id, item_key AS neighbour, rating AS neighbour_rating FROM dtrain
         WHERE item_key IN (SELECT item_key FROM dtrain GROUP BY item_key HAVING count(*) > 25)),
cands AS (SELECT t.user_id, t.item_key AS target, tr.neighbour, tr.neighbour_rating, s.similarity
          FROM dtest t JOIN tr ON t.user_id = tr.user_id
          JOIN simf s ON s.item_1 = t.item_key AND s.item_2 = tr.neighbour
          WHERE s.similarity > 0)"""


def _dense_cf(spark, sf_dir):
    """Train, test, candidates and the codes of the items (item_key, code).
    Items go by their number in key order, so that ties are the keys' own and a
    pair of them takes little room in the join with the similarities."""
    dense = written(Inputs(spark, sf_dir).dense, "dense")  # read by the codes and by the split
    codes = written(dense_index(dense, "item_key", "code").withColumn("code", F.col("code").cast("int")), "codes")
    coded = written(R.hash_split(dense, "user_id", "item_key").join(codes, "item_key")
                    .select("user_id", F.col("code").alias("item_key"), "rating", "is_test"), "coded")
    train, test = coded.where(~F.col("is_test")).drop("is_test"), coded.where("is_test").drop("is_test")
    sim = CF.item_similarity(train, item="item_key")
    cands = CF.candidates(train, test, sim, item="item_key")
    return train, test, cands, codes


def _named(df, codes, *cols):
    """``df`` with keys in place of the codes in ``cols``."""
    for c in cols:
        df = df.withColumnRenamed(c, "code").join(codes, "code").drop("code").withColumnRenamed("item_key", c)
    return df


@query("candidate_neighbours", ops="J7 J8 J11 R3 P5", sql=_CANDS + """
SELECT user_id, target, neighbour, neighbour_rating, round(similarity, 6) AS similarity FROM cands""")
def candidate_neighbours(spark, sf_dir):
    _, _, cands, codes = _dense_cf(spark, sf_dir)
    return _named(cands, codes, "target", "neighbour").select("user_id", "target", "neighbour", "neighbour_rating",
                        r6(F.col("similarity")).alias("similarity"))


def _pred_sql(order: str) -> str:
    return _CANDS + f"""
, ranked AS (SELECT c.*, row_number() OVER (PARTITION BY user_id, target
                                            ORDER BY similarity {order}, neighbour ASC) AS rn
             FROM cands c),
pred AS (SELECT user_id, target,
                CASE WHEN sum(similarity * neighbour_rating) = 0 OR sum(abs(similarity)) = 0 THEN 0.0
                     ELSE sum(similarity * neighbour_rating) / sum(abs(similarity)) END AS prediction
         FROM ranked WHERE rn <= 5 GROUP BY user_id, target)"""


@query("neighbour_prediction_desc", ops="W4 A21 R4", sql=_pred_sql("DESC") + """
SELECT user_id, target, round(prediction, 6) AS prediction FROM pred WHERE prediction <> 0""")
def neighbour_prediction_desc(spark, sf_dir):
    _, _, cands, codes = _dense_cf(spark, sf_dir)
    p = _named(CF.neighbour_prediction(cands, 5, "desc"), codes, "target")
    return p.select("user_id", "target", r6(F.col("prediction")).alias("prediction"))


@query("neighbour_prediction_asc", ops="W4 A21 R4 (ledger Q6)", sql=_pred_sql("ASC") + """
SELECT user_id, target, round(prediction, 6) AS prediction FROM pred WHERE prediction <> 0""")
def neighbour_prediction_asc(spark, sf_dir):
    _, _, cands, codes = _dense_cf(spark, sf_dir)
    p = _named(CF.neighbour_prediction(cands, 5, "asc"), codes, "target")
    return p.select("user_id", "target", r6(F.col("prediction")).alias("prediction"))


_BLEND = _pred_sql("DESC") + """
, avg_i AS (SELECT item_key, avg(rating) AS item_avg FROM dtrain GROUP BY item_key),
scored AS (
  SELECT t.user_id, t.item_key, t.rating,
         CASE WHEN p.prediction IS NOT NULL AND p.prediction <> 0
              THEN (coalesce(a.item_avg, 4.0) + p.prediction) / 2
              ELSE coalesce(a.item_avg, 4.0) END AS prediction
  FROM dtest t LEFT JOIN avg_i a ON t.item_key = a.item_key
  LEFT JOIN pred p ON p.user_id = t.user_id AND p.target = t.item_key)"""


def _dense_scored(spark, sf_dir):
    train, test, cands, codes = _dense_cf(spark, sf_dir)
    pred = CF.neighbour_prediction(cands, 5, "desc")
    return _named(CF.blend(test, train, pred, item="item_key"), codes, "item_key")


@query("blended_prediction", ops="J4 R5 R6", sql=_BLEND + """
SELECT user_id, item_key, rating, round(prediction, 6) AS prediction FROM scored""")
def blended_prediction(spark, sf_dir):
    s = _dense_scored(spark, sf_dir)
    return s.select("user_id", "item_key", "rating", r6(F.col("prediction")).alias("prediction"))


@query("itemcf_rmse", ops="R7 A5 J1", sql=_BLEND + """
SELECT count(*) AS n_scored, round(sqrt(sum(pow(rating - prediction, 2)) / count(*)), 6) AS rmse
FROM scored""")
def itemcf_rmse(spark, sf_dir):
    r = E.rmse(_dense_scored(spark, sf_dir))
    return r.select("n_scored", r6(F.col("rmse")).alias("rmse"))


@query("itemcf_error_levels", ops="R8 P6 F9 A1", sql=_BLEND + """
, lv AS (SELECT CAST(least(floor(CAST(abs(rating - prediction) AS FLOAT)), 4) AS INTEGER) AS level
         FROM scored),
spine AS (SELECT unnest([0, 1, 2, 3, 4]) AS level)
SELECT s.level, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM spine s
LEFT JOIN (SELECT level, count(*) AS n FROM lv GROUP BY level) c ON s.level = c.level""")
def itemcf_error_levels(spark, sf_dir):
    return E.error_levels(_dense_scored(spark, sf_dir))


@query("prediction_output", ops="O2 O3 W3 P1 P2 P9 F8 K1", sql=_BLEND + """
SELECT CAST(user_id AS VARCHAR) || ',' || item_key || ',' || CAST(round(prediction, 6) AS VARCHAR) AS line
FROM scored ORDER BY CAST(user_id AS VARCHAR), item_key""")
def prediction_output(spark, sf_dir):
    s = _dense_scored(spark, sf_dir)
    return (s.select(F.col("user_id").cast("string").alias("u"), "item_key",
                     F.concat_ws(",", F.col("user_id").cast("string"), "item_key",
                                 r6(F.col("prediction")).cast("string")).alias("line"))
            .orderBy("u", "item_key").select("line"))


@query("copair_counts", ops="J5 A7 A8 R17", sql=RD + """
SELECT a.item_key AS item_1, b.item_key AS item_2, count(*) AS n_common
FROM dense a JOIN dense b ON a.user_id = b.user_id AND a.item_key <= b.item_key
GROUP BY a.item_key, b.item_key HAVING count(*) > 100""")
def copair_counts(spark, sf_dir):
    c = CF.co_rater_counts(Inputs(spark, sf_dir).dense, item="item_key", include_self=True)
    return c.where(F.col("n_common") > 100)


@query("copair_support_total", ops="R17 A3", sql=RD + """
SELECT count(*) AS n_pairs FROM (
  SELECT a.item_key, b.item_key FROM dense a JOIN dense b
    ON a.user_id = b.user_id AND a.item_key <= b.item_key
  GROUP BY a.item_key, b.item_key HAVING count(*) > 100) x""")
def copair_support_total(spark, sf_dir):
    c = CF.co_rater_counts(Inputs(spark, sf_dir).dense, item="item_key", include_self=True)
    return c.where(F.col("n_common") > 100).agg(F.count(F.lit(1)).alias("n_pairs"))


# ---------------------------------------------------------------- phase 4: evaluation


@query("user_holdout", ops="W6", sql=with_ctes(SQL_RATINGS) + """
SELECT user_id, item_id, rating FROM (
  SELECT user_id, item_id, rating,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR) || '|7'),
                                     item_id) AS rn
  FROM ratings) x WHERE rn <= 10""")
def user_holdout(spark, sf_dir):
    _, test = R.user_holdout(Inputs(spark, sf_dir).ratings, 10, 7)
    return test.select("user_id", "item_id", "rating")


@query("split_disjoint", ops="U4 D1 W6", sql=with_ctes(SQL_RATINGS) + """
, ho AS (SELECT user_id, item_id FROM (
  SELECT user_id, item_id,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR) || '|7'),
                                     item_id) AS rn
  FROM ratings) x WHERE rn <= 10)
SELECT (SELECT count(*) FROM ratings) - (SELECT count(*) FROM ho) AS n_train,
       (SELECT count(*) FROM ho) AS n_test,
       (SELECT count(*) FROM ho WHERE (user_id, item_id) IN (
          SELECT r.user_id, r.item_id FROM ratings r ANTI JOIN ho h ON r.user_id = h.user_id AND r.item_id = h.item_id)) AS overlap""")
def split_disjoint(spark, sf_dir):
    train, test = R.user_holdout(Inputs(spark, sf_dir).ratings, 10, 7)
    keys = ["user_id", "item_id"]
    tagged = (train.select(*keys, F.lit(0).alias("side"))
              .unionByName(test.select(*keys, F.lit(1).alias("side"))))
    per_key = tagged.groupBy(*keys).agg(F.max((F.col("side") == 0).cast("int")).alias("tr"),
                                        F.max((F.col("side") == 1).cast("int")).alias("te"))
    return per_key.agg(F.sum("tr").cast("bigint").alias("n_train"),
                       F.sum("te").cast("bigint").alias("n_test"),
                       F.count_if((F.col("tr") == 1) & (F.col("te") == 1)).alias("overlap"))


@query("user_vectors", ops="R22 D2", sql=with_ctes(SQL_RATINGS, SQL_DENSE) + """
SELECT user_id, count(*) AS n_items,
       string_agg(item_key || ':' || CAST(rating AS VARCHAR), ',' ORDER BY item_key) AS vector
FROM dtrain GROUP BY user_id""")
def user_vectors(spark, sf_dir):
    train, _ = Inputs(spark, sf_dir).split(dense=True)
    cell = F.concat_ws(":", "item_key", F.col("rating").cast("string"))
    return (train.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.concat_ws(",", F.sort_array(F.collect_list(cell))).alias("vector")))


@query("vector_width", ops="D3 A16 U1", sql=with_ctes(SQL_RATINGS, SQL_DENSE) + """
, codes AS (SELECT item_key, dense_rank() OVER (ORDER BY item_key) - 1 AS code
            FROM (SELECT item_key FROM dtrain UNION SELECT item_key FROM dtest) k)
SELECT (SELECT count(DISTINCT user_id) FROM dtrain) AS n_train_users,
       (SELECT count(DISTINCT user_id) FROM dtest) AS n_test_users,
       greatest((SELECT max(c.code) FROM dtrain t JOIN codes c ON t.item_key = c.item_key),
                (SELECT max(c.code) FROM dtest t JOIN codes c ON t.item_key = c.item_key)) + 1 AS width""")
def vector_width(spark, sf_dir):
    train, test = Inputs(spark, sf_dir).split(dense=True)
    both = (train.select("user_id", "item_key", F.lit(0).alias("side"))
            .unionByName(test.select("user_id", "item_key", F.lit(1).alias("side"))))
    codes = dense_index(both, "item_key", "code")
    return (both.join(codes, "item_key")
            .agg(F.countDistinct(F.when(F.col("side") == 0, F.col("user_id"))).alias("n_train_users"),
                 F.countDistinct(F.when(F.col("side") == 1, F.col("user_id"))).alias("n_test_users"),
                 (F.max("code") + 1).alias("width")))


@query("item_standardised", ops="A19 D10", sql=with_ctes(SQL_RATINGS, SQL_DENSE) + """
, st AS (SELECT item_key, avg(rating) AS mu, var_pop(rating) AS var FROM dtrain GROUP BY item_key)
SELECT t.user_id, t.item_key, round((t.rating - st.mu) / sqrt(st.var + 0.01), 6) AS z
FROM dtrain t JOIN st ON t.item_key = st.item_key""")
def item_standardised(spark, sf_dir):
    from orrery.operators.ratings import standardise
    train, _ = Inputs(spark, sf_dir).split(dense=True)
    z = standardise(train, "item_key", "rating", eps=0.01)
    return z.select("user_id", "item_key", r6(F.col("z")).alias("z"))


_BASE_SCORED = with_ctes(SQL_RATINGS, SQL_DENSE) + """
, avg_i AS (SELECT item_key, avg(rating) AS item_avg FROM dtrain GROUP BY item_key),
scored AS (SELECT t.user_id, t.item_key, t.rating, coalesce(a.item_avg, 4.0) AS prediction
           FROM dtest t LEFT JOIN avg_i a ON t.item_key = a.item_key)"""


def _base_scored(spark, sf_dir):
    train, test = Inputs(spark, sf_dir).split(dense=True)
    return CF.blend(test, train, None, item="item_key")


@query("masked_mse", ops="A4 A18 D5", sql=_BASE_SCORED + """
SELECT count(*) AS n_rated, round(avg(pow(rating - prediction, 2)), 6) AS mse FROM scored""")
def masked_mse(spark, sf_dir):
    m = E.masked_mse(_base_scored(spark, sf_dir))
    return m.select("n_rated", r6(F.col("mse")).alias("mse"))


@query("mean_user_rmse", ops="A20 D8", sql=_BASE_SCORED + """
SELECT count(*) AS n_users, round(avg(r), 6) AS mean_user_rmse FROM (
  SELECT user_id, sqrt(avg(pow(rating - prediction, 2))) AS r FROM scored GROUP BY user_id) u""")
def mean_user_rmse(spark, sf_dir):
    m = E.mean_user_rmse(_base_scored(spark, sf_dir))
    return m.select("n_users", r6(F.col("mean_user_rmse")).alias("mean_user_rmse"))


# ---------------------------------------------------------------- random order, sketches, items without a test rating


def _sql_place(n: str = "n", seed: int = 5, walks: int = 8) -> str:
    """CTEs ``w0`` .. of (key, i, n, a, b, x): x is the place once below n."""
    out = []
    for w in range(walks):
        src = "(SELECT *, i AS x FROM ix)" if w == 0 else f"(SELECT * FROM w{w - 1})"
        q = f"SELECT *, x % a AS l, x // a AS r FROM {src} s"
        for r in range(R.FEISTEL_ROUNDS):
            q = f"SELECT * REPLACE ((l + CAST(('0x' || substr(md5('{seed}|{r}|' || r), 1, 8)) AS BIGINT)) % a AS l) FROM ({q}) s"
            q = f"SELECT * REPLACE ((r + CAST(('0x' || substr(md5('{seed}|{r}|' || l), 1, 8)) AS BIGINT)) % b AS r) FROM ({q}) s"
        skip = "FALSE" if w == 0 else "x < n"
        out.append(f"w{w} AS (SELECT * EXCLUDE (l, r) REPLACE (CASE WHEN {skip} THEN x ELSE l + r * a END AS x) FROM ({q}) s)")
    return ",\n".join(out)


@query("shuffled_rows", ops="O4", sql=f"""
WITH k AS (SELECT DISTINCT o_orderkey AS key FROM orders),
ix AS (SELECT key, i, n, a, CAST(ceil(n / CAST(a AS DOUBLE)) AS BIGINT) AS b FROM (
  SELECT key, row_number() OVER (ORDER BY key) - 1 AS i, count(*) OVER () AS n, CAST(ceil(sqrt(count(*) OVER ())) AS BIGINT) AS a FROM k) q),
{_sql_place()}
SELECT key AS o_orderkey, x AS place FROM w7""")
def shuffled_rows(spark, sf_dir):
    """The place of every order in a random order of all."""
    keys = dense_index(Inputs(spark, sf_dir).t("orders"), "o_orderkey")
    n = Inputs(spark, sf_dir).t("orders").agg(F.countDistinct("o_orderkey")).scalar()
    return keys.withColumn("_n", n).select("o_orderkey", R.random_place(F.col("idx"), F.col("_n")).alias("place"))


@query("profile_sketch", ops="A22")
def profile_sketch(spark, sf_dir):
    """Profile of the line items by sketches, keys and dates included."""
    return O.profile_sketch(Inputs(spark, sf_dir).t("lineitem"), ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"],
                            ["l_returnflag", "l_linestatus", "l_shipdate"])


_UNTESTED_SQL = RS + """
SELECT p_partkey AS item_id, p_name AS name FROM part WHERE p_partkey NOT IN (SELECT item_id FROM test WHERE rating = 5.0)"""


@query("items_without_top_test_rating", ops="R18", sql=_UNTESTED_SQL)
def items_without_top_test_rating(spark, sf_dir):
    """Items that no test rating gives the highest mark."""
    d = Inputs(spark, sf_dir)
    return O.unrated_items_anti(d.t("part"), d.split()[1].where("rating = 5.0"))


@query("items_without_top_test_rating_except", ops="U2 J3 S9 R18", sql=_UNTESTED_SQL)
def items_without_top_test_rating_except(spark, sf_dir):
    """The same in SQL text with EXCEPT."""
    d = Inputs(spark, sf_dir)
    d.t("part").createOrReplaceTempView("movies_view")
    d.split()[1].where("rating = 5.0").createOrReplaceTempView("top_test_ratings_view")
    return O.unrated_items_sql(spark, "movies_view", "top_test_ratings_view")
