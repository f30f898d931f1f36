"""Sinks of the original programs (K1–K4).

Outputs are written by many tasks in parallel; a sorted output is a range
partitioned sort, so part files are in key order and concatenating them in
name order gives one sorted file (nothing is funnelled through one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.operators.ratings import split_bucket


def write_sorted_lines(df: DataFrame, path: str, sort_cols: list[str], cols: list[str],
                       sep: str = ",") -> None:
    """``a,b,value`` lines without header, globally sorted by ``sort_cols``."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value")
    (df.orderBy(*sort_cols).select(line)
     .write.mode("overwrite").text(path))


def write_vector_shards(df: DataFrame, path: str, per_file: int = 100) -> None:
    """At most ``per_file`` records per file (K2)."""
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).parquet(path)


def write_split(df: DataFrame, path: str, user_col: str, item_col: str, buckets: int = 5,
                fmt: str = "parquet") -> None:
    """Rows to ``split=train`` / ``split=test`` folders in one pass."""
    tagged = df.withColumn("split", F.when(split_bucket(user_col, item_col, buckets) == 0, "test")
                           .otherwise("train"))
    tagged.write.mode("overwrite").partitionBy("split").format(fmt).save(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows (K4, P8); a limit is the feature here."""
    return df.limit(n)
