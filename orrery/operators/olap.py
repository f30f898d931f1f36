"""Descriptive queries over ratings and item tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, key: str, out: str = "n_ratings") -> DataFrame:
    """Rows per key (A1); partial counts combine map-side."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def rating_totals(ratings: DataFrame, user="user_id", item="item_id") -> DataFrame:
    """One row: users, rated items and ratings (A2, A3)."""
    return ratings.agg(F.countDistinct(user).alias("n_users"),
                       F.countDistinct(item).alias("n_items"),
                       F.count(F.lit(1)).alias("n_ratings"))


def support(ratings: DataFrame, item="item_id", min_support: int = 25) -> DataFrame:
    """Items with strictly more than ``min_support`` rating rows (A8, ledger Q3)."""
    return (ratings.groupBy(item).agg(F.count(F.lit(1)).alias("n_ratings"))
            .where(F.col("n_ratings") > min_support))


def with_support(ratings: DataFrame, item="item_id", min_support: int = 25) -> DataFrame:
    """Rating rows of supported items (semi-join on the small item side)."""
    return ratings.join(support(ratings, item, min_support).select(item), item, "left_semi")


def unrated_items_anti(items: DataFrame, ratings: DataFrame, item_key="p_partkey",
                       name="p_name", rated_key="item_id") -> DataFrame:
    """Items without a rating, with names (R18 as a left anti-join)."""
    rated = ratings.select(F.col(rated_key).alias(item_key))
    return (items.select(F.col(item_key).alias("item_id"), F.col(name).alias("name"))
            .join(rated.withColumnRenamed(item_key, "item_id"), "item_id", "left_anti"))


def unrated_items_sql(spark, items_view: str, ratings_view: str) -> DataFrame:
    """Same relation in SQL text with EXCEPT and a comma join."""
    spark.sql(f"""SELECT p_partkey AS item_id FROM {items_view}
                  EXCEPT SELECT item_id FROM {ratings_view}""").createOrReplaceTempView("_not_rated_id")
    return spark.sql(f"""SELECT i.p_partkey AS item_id, i.p_name AS name
                         FROM {items_view} i, _not_rated_id n
                         WHERE i.p_partkey = n.item_id""")


def genre_counts(items: DataFrame, genres_col: str, sep_regex: str = "[|]") -> DataFrame:
    """Items per genre from a separator-joined genre string."""
    return (items.select(F.explode(F.split(F.col(genres_col), sep_regex)).alias("genre"))
            .groupBy("genre").agg(F.count(F.lit(1)).alias("n_items")))


def profile(df: DataFrame, numeric_cols: list[str], percentile_cols: list[str] = ()) -> DataFrame:
    """Per-column profile (A22): count, missing, distinct, extremes, moments and
    exact quartiles for low-cardinality columns in ``percentile_cols``; all
    columns in one aggregation."""
    parts, out = [], []
    for i, c in enumerate(numeric_cols):
        x = F.col(c).cast("double")
        found = dict(n=F.count(x), n_null=F.count_if(x.isNull()), n_distinct=F.countDistinct(x), min_value=F.min(x),
                     max_value=F.max(x), mean=F.avg(x), stddev=F.stddev_samp(x))
        for q, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            found[q] = F.percentile(x, p) if c in percentile_cols else F.max(F.lit(None).cast("double"))
        parts += [v.alias(f"_{i}_{k}") for k, v in found.items()]
        out.append(F.struct(F.lit(c).alias("column_name"), *[F.col(f"_{i}_{k}").alias(k) for k in found]))
    return df.agg(*parts).select(F.explode(F.array(*out)).alias("r")).select("r.*")


def profile_sketch(df: DataFrame, numeric_cols: list[str], text_cols: list[str] = (), accuracy: int = 10_000, rsd: float = 0.02,
                   top: int = 5) -> DataFrame:
    """Per-column profile of columns of any cardinality (A22) by mergeable
    sketches, all in one aggregation: approximate quartiles (rank error at most
    1 / ``accuracy`` of the rows), distinct counts (HyperLogLog++, relative
    standard deviation ``rsd``) and the ``top`` most frequent values (exact
    where a column has at most ``10 000`` values). No value list is held."""
    parts, out = [], []
    for i, c in enumerate((*numeric_cols, *text_cols)):
        number = c in numeric_cols
        x = F.col(c).cast("double") if number else F.col(c)
        none = F.max(F.lit(None).cast("double"))
        found = dict(n=F.count(x), n_null=F.count_if(x.isNull()), n_distinct=F.approx_count_distinct(x, rsd),
                     min_value=F.min(x) if number else none, max_value=F.max(x) if number else none, mean=F.avg(x) if number else none)
        quartiles = F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy) if number else F.max(F.lit(None).cast("array<double>"))
        parts += [v.alias(f"_{i}_{k}") for k, v in found.items()] + [quartiles.alias(f"_{i}_q"),
                                                                     F.expr(f"approx_top_k(cast(`{c}` as string), {top}, 10000)").alias(f"_{i}_top")]
        out.append(F.struct(F.lit(c).alias("column_name"), *[F.col(f"_{i}_{k}").alias(k) for k in found],
                            *[F.col(f"_{i}_q")[j].alias(q) for j, q in enumerate(("p25", "p50", "p75"))],
                            F.transform(f"_{i}_top", lambda t: F.struct(t["item"].alias("value"), t["count"].alias("n"))).alias("frequent")))
    return df.agg(*parts).select(F.explode(F.array(*out)).alias("r")).select("r.*")


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of each pair of columns, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("column_1"), F.lit(b).alias("column_2"), F.col(f"`{a}|{b}`").alias("corr"))
                                          for a, b in pairs])).alias("r")).select("r.*")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Rows per equal-width bin between the extremes; empty bins are absent."""
    x = F.col(col).cast("double")
    lo, hi = (df.agg(f(x)).scalar() for f in (F.min, F.max))
    placed = df.where(x.isNotNull()).withColumns({"_lo": lo, "_hi": hi})
    share = F.when(F.col("_hi") > F.col("_lo"), (x - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(F.lit(0.0))
    return placed.groupBy(F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def extremes(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """The ``k`` smallest and largest values with their counts (a top-k report)."""
    per = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    low = per.orderBy("value").limit(k).select(F.lit("low").alias("side"), "value", "n")
    return low.unionByName(per.orderBy(F.col("value").desc()).limit(k).select(F.lit("high").alias("side"), "value", "n"))


def items_per_user(ratings: DataFrame, user="user_id", item="item_key", sep=", ") -> DataFrame:
    """Ordered item list per user (A9). The list is the result, bounded by the item domain."""
    return (ratings.groupBy(user)
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.concat_ws(sep, F.sort_array(F.collect_list(F.col(item).cast("string")))).alias("items")))
