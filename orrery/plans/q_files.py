"""Round trips: given tables written in the formats of the original programs to
the shared scratch folder, read back by the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import text as TXT
from orrery.plans.common import SQL_RATINGS, SQL_SPLIT, Inputs, query, with_ctes
from orrery.session import scratch_folder
from orrery.sources import files, sinks

_RS = with_ctes(SQL_RATINGS, SQL_SPLIT)


def _ratings(spark, sf_dir):
    return Inputs(spark, sf_dir).ratings


@query("dat_round_trip", ops="S4", sql=with_ctes(SQL_RATINGS) + """
SELECT CAST(user_id AS INTEGER) AS "user", CAST(item_id AS INTEGER) AS movie, CAST(rating * 2 AS INTEGER) AS rating, epoch(ts) :: BIGINT AS timestamp FROM ratings""")
def dat_round_trip(spark, sf_dir):
    """Ratings as ``user::movie::rating::timestamp`` lines in latin-1."""
    path = scratch_folder(spark, "dat")
    line = F.concat_ws("::", "user_id", "item_id", (F.col("rating") * 2).cast("int"), F.unix_timestamp(F.col("ts").cast("timestamp")))
    _ratings(spark, sf_dir).select(line.alias("value")).write.option("encoding", "ISO-8859-1").text(path)
    return files.read_dat(spark, path)


@query("csv_round_trip", ops="S1 S2 S3", sql=with_ctes(SQL_RATINGS) + """
SELECT CAST(user_id AS VARCHAR) AS "user", CAST(item_id AS VARCHAR) AS item, CAST(rating AS DOUBLE) AS rating FROM ratings""")
def csv_round_trip(spark, sf_dir):
    """Ratings as a headered review file."""
    path = scratch_folder(spark, "csv")
    _ratings(spark, sf_dir).select(F.col("user_id").alias("user"), F.col("item_id").alias("item"), "rating").write.option("header", True).csv(path)
    return files.read_review_csv(spark, path)


@query("movies_csv_round_trip", ops="S1 F3", sql="""
SELECT CAST(p_partkey AS INTEGER) AS "movieId", p_name || ', "' || p_brand || '"' AS title, unnest(string_split(p_brand || '|' || p_type, '|')) AS genre FROM part""")
def movies_csv_round_trip(spark, sf_dir):
    """Parts as a movie file, with commas and quotes in titles."""
    path = scratch_folder(spark, "movies")
    Inputs(spark, sf_dir).t("part").select(
        F.col("p_partkey").alias("movieId"), F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("title"),
        F.concat_ws("|", "p_brand", "p_type").alias("genres")).write.option("header", True).option("escape", '"').csv(path)
    return files.read_movies_csv(spark, path).select("movieId", "title", F.explode("genre_list").alias("genre"))


def _written_corpus(spark, sf_dir):
    """Titles, one a line, and the two halves of the texts as records, in order."""
    docs = TXT.corpus_documents(Inputs(spark, sf_dir).t("documents")).orderBy("doc_id")
    half = F.floor(F.length("text") / 2).cast("int")
    paths = [scratch_folder(spark, x) for x in ("titles", "first", "second")]
    docs.select("title").write.text(paths[0])
    docs.select(F.substring("text", F.lit(1), half)).write.option("lineSep", "\n BREAKS HERE").text(paths[1])
    docs.select(F.substring("text", half + 1, F.length("text"))).write.option("lineSep", "\n BREAKS HERE").text(paths[2])
    return files.read_lines(spark, paths[0], out="title"), files.read_records(spark, paths[1]), files.read_records(spark, paths[2])


@query("assembled_corpus", ops="S5 S6 J9 P10 W7", sql="""
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id, row_number() OVER (ORDER BY doc_id) AS rank,
       source || '#' || CAST(doc_id AS VARCHAR) AS title, text FROM documents""")
def assembled_corpus(spark, sf_dir):
    """Titles and both halves of the texts, joined by position."""
    return TXT.assemble_corpus(*_written_corpus(spark, sf_dir))


@query("vector_shards", ops="S7 K2", sql="""
SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, round(CAST(unnest(embedding) AS DOUBLE), 6) AS x FROM embeddings""")
def vector_shards(spark, sf_dir):
    """Embeddings in shards of at most a hundred records."""
    path = scratch_folder(spark, "shards")
    sinks.write_vector_shards(Inputs(spark, sf_dir).t("embeddings").select("vec_id", "embedding"), path)
    got = files.read_vector_shards(spark, path, 64, "vec_id", "embedding")
    return got.select("vec_id", F.posexplode("embedding").alias("dim", "x")).select(
        "vec_id", F.col("dim").cast("bigint").alias("dim"), (F.round(F.col("x").cast("double"), 6) + 0.0).alias("x"))


@query("sorted_lines_file", ops="K1 S6 O2 P9", sql=_RS + """
SELECT row_number() OVER (ORDER BY CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR)) - 1 AS position,
       CAST(user_id AS VARCHAR) || ',' || CAST(item_id AS VARCHAR) || ',' || CAST(CAST(rating AS DOUBLE) AS VARCHAR) AS line FROM test""")
def sorted_lines_file(spark, sf_dir):
    """Test ratings as one sorted list of lines over many files, read back in file order."""
    path = scratch_folder(spark, "lines")
    test = Inputs(spark, sf_dir).split()[1].select(F.col("user_id").cast("string").alias("u"), F.col("item_id").cast("string").alias("i"), "rating")
    sinks.write_sorted_lines(test, path, ["u", "i"], ["u", "i", "rating"])
    return files.read_lines(spark, path).select("position", "line")


@query("split_folders", ops="K3 D1", sql=_RS + """
SELECT 'train' AS split, user_id, item_id, rating FROM train UNION ALL SELECT 'test', user_id, item_id, rating FROM test""")
def split_folders(spark, sf_dir):
    """Both folders of the split writer."""
    path = scratch_folder(spark, "split")
    sinks.write_split(_ratings(spark, sf_dir).select("user_id", "item_id", "rating"), path, "user_id", "item_id")
    return spark.read.parquet(path).select("split", "user_id", "item_id", "rating")


@query("preview_ratings", ops="K4 P8", sql=with_ctes(SQL_RATINGS) + """
SELECT user_id, item_id, rating FROM ratings ORDER BY user_id, item_id LIMIT 20""")
def preview_ratings(spark, sf_dir):
    """The first twenty ratings; the limit is the feature."""
    return sinks.preview(_ratings(spark, sf_dir).select("user_id", "item_id", "rating").orderBy("user_id", "item_id"))
