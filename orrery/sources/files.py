"""File sources of the original programs (S1–S7), as Spark readers with
explicit schemas (no inference pass, no hand-split lines).

Source order (the row number of a record in a folder of files, by path) is
recovered without a single-partition window: within one block of one file the
reader keeps the records' order, so a record's position is its number in its
block plus the counts of the blocks before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType()), T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.LongType())])
MOVIES_SCHEMA = T.StructType([
    T.StructField("movieId", T.IntegerType()), T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType())])
TAGS_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType()), T.StructField("movieId", T.IntegerType()),
    T.StructField("tag", T.StringType()), T.StructField("timestamp", T.LongType())])
LINKS_SCHEMA = T.StructType([
    T.StructField("movieId", T.IntegerType()), T.StructField("imdbId", T.StringType()),
    T.StructField("tmdbId", T.StringType())])
REVIEW_SCHEMA = T.StructType([
    T.StructField("user", T.StringType()), T.StructField("item", T.StringType()),
    T.StructField("rating", T.DoubleType())])
DAT_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType()), T.StructField("movie", T.IntegerType()),
    T.StructField("rating", T.IntegerType()), T.StructField("timestamp", T.LongType())])


def _csv(spark: SparkSession, path: str, schema: T.StructType, header=True) -> DataFrame:
    """Headered CSV with double-quote quoting (a title may hold commas)."""
    return (spark.read.schema(schema)
            .option("header", header).option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("encoding", "UTF-8").csv(path))


def read_ratings_csv(spark, path) -> DataFrame:
    """``userId, movieId, rating, timestamp`` plus ``ts`` as a timestamp."""
    return _csv(spark, path, RATINGS_SCHEMA).withColumn("ts", F.timestamp_seconds("timestamp"))


def read_movies_csv(spark, path) -> DataFrame:
    """``movieId, title, genres`` with ``genre_list`` split on the pipe."""
    return _csv(spark, path, MOVIES_SCHEMA).withColumn("genre_list", F.split("genres", "[|]"))


def read_tags_csv(spark, path) -> DataFrame:
    return _csv(spark, path, TAGS_SCHEMA)


def read_links_csv(spark, path) -> DataFrame:
    return _csv(spark, path, LINKS_SCHEMA)


def read_review_csv(spark, path) -> DataFrame:
    """Train/test review files: ``user, item`` strings and ``rating`` by
    position after a header (S2, S3)."""
    return _csv(spark, path, REVIEW_SCHEMA)


def read_dat(spark, path) -> DataFrame:
    """``user::movie::rating::timestamp`` without header, latin-1."""
    return (spark.read.schema(DAT_SCHEMA).option("sep", "::").option("header", False)
            .option("encoding", "ISO-8859-1").csv(path))


def with_source_order(df: DataFrame, out: str = "rank") -> DataFrame:
    """0-based position of each record of a file source, files in path order
    (W7). Blocks are numbered by a window over the small table of blocks."""
    tagged = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_mid"))
    count = df.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")) \
        .groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = count.select("_file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_mid"))
    return tagged.withColumn("_nth", nth).join(starts, ["_file", "_block"]) \
        .select(*df.columns, (F.col("_start") + F.col("_nth") - 1).cast("bigint").alias(out))


def read_records(spark, path, separator: str = "\n BREAKS HERE", first: int | None = None,
                 out: str = "text") -> DataFrame:
    """Multi-line records split on a text separator, with their position
    (S5); ``first`` keeps the first n records, as the notebook's ``[:100]``."""
    df = spark.read.option("lineSep", separator).option("wholetext", False).text(path)
    df = with_source_order(df, "position").withColumnRenamed("value", out)
    if first is not None:
        df = df.where(F.col("position") < first)
    return df


def read_lines(spark, path, first: int | None = None, out: str = "line") -> DataFrame:
    """One record per line with its position."""
    df = with_source_order(spark.read.text(path), "position").withColumnRenamed("value", out)
    if first is not None:
        df = df.where(F.col("position") < first)
    return df


def read_vector_shards(spark, path, width: int, key: str = "user_id",
                       vec: str = "movie_ratings") -> DataFrame:
    """A folder of fixed-length vector shards (S7); every vector must have
    ``width`` entries (``assert_true`` fails the job otherwise)."""
    df = spark.read.parquet(path)
    # assert_true returns NULL or fails the task; as a filter predicate it
    # cannot be pruned away like an unused column.
    return df.where(F.assert_true(F.size(vec) == width).isNull())
