"""Round trips for the file sources and sinks on own temporary files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from orrery.sources import files as S
from orrery.sources import sinks as K


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_s1_movies_with_quoted_comma(spark, tmpdir_session):
    p = _write(os.path.join(tmpdir_session, "movies.csv"),
               'movieId,title,genres\n1,"American President, The (1995)",Comedy|Drama|Romance\n'
               '2,Amélie (2001),Comedy|Romance\n3,Some Film (2010),(no genres listed)\n')
    m = S.read_movies_csv(spark, p).orderBy("movieId").collect()
    assert m[0]["title"] == "American President, The (1995)"
    assert m[0]["genre_list"] == ["Comedy", "Drama", "Romance"]
    assert m[1]["title"].startswith("Amélie")
    assert m[2]["genre_list"] == ["(no genres listed)"]


def test_s1_ratings_and_s2_reviews(spark, tmpdir_session):
    p = _write(os.path.join(tmpdir_session, "ratings.csv"),
               "userId,movieId,rating,timestamp\n1,31,2.5,1260759144\n1,1029,3.0,1260759179\n")
    r = S.read_ratings_csv(spark, p).collect()
    assert [x["rating"] for x in r] == [2.5, 3.0] and r[0]["ts"] is not None
    q = _write(os.path.join(tmpdir_session, "train_review.csv"), "user_id,business_id,stars\nu1,b1,4.0\n")
    rv = S.read_review_csv(spark, q).first()
    assert (rv["user"], rv["item"], rv["rating"]) == ("u1", "b1", 4.0)


def test_s4_double_colon_latin1(spark, tmpdir_session):
    p = _write(os.path.join(tmpdir_session, "ratings.dat"), "1::1193::5::978300760\n2::661::3::978302109\n",
               encoding="latin-1")
    r = S.read_dat(spark, p).orderBy("user").collect()
    assert [(x["user"], x["movie"], x["rating"]) for x in r] == [(1, 1193, 5), (2, 661, 3)]


def test_s5_breaks_here_records(spark, tmpdir_session):
    body = "first line\nsecond line\n BREAKS HEREother record\n BREAKS HEREthird"
    p = _write(os.path.join(tmpdir_session, "synopses.txt"), body)
    recs = S.read_records(spark, p).orderBy("position").collect()
    assert [r["text"] for r in recs] == ["first line\nsecond line", "other record", "third"]
    assert [r["position"] for r in recs] == [0, 1, 2]
    assert S.read_records(spark, p, first=2).count() == 2


def test_s6_lines_in_order(spark, tmpdir_session):
    p = _write(os.path.join(tmpdir_session, "titles.txt"), "\n".join(f"t{i}" for i in range(50)) + "\n")
    recs = S.read_lines(spark, p, first=10).orderBy("position").collect()
    assert [r["line"] for r in recs] == [f"t{i}" for i in range(10)]


def test_s6_order_over_a_folder(spark, tmpdir_session):
    folder = os.path.join(tmpdir_session, "parts")
    os.makedirs(folder)
    _write(os.path.join(folder, "a.txt"), "a1\na2\n")
    _write(os.path.join(folder, "b.txt"), "".join(f"b{i}\n" for i in range(1, 200)))
    recs = S.read_lines(spark, folder, first=100).orderBy("position").collect()
    assert [r["line"] for r in recs] == ["a1", "a2"] + [f"b{i}" for i in range(1, 99)]


def test_s1_tags_links_and_k4_preview(spark, tmpdir_session):
    t = _write(os.path.join(tmpdir_session, "tags.csv"), 'userId,movieId,tag,timestamp\n1,2,"a, b",3\n1,3,c,4\n')
    li = _write(os.path.join(tmpdir_session, "links.csv"), "movieId,imdbId,tmdbId\n1,0114709,862\n")
    assert S.read_tags_csv(spark, t).first()["tag"] == "a, b" and S.read_links_csv(spark, li).first()["imdbId"] == "0114709"
    assert K.preview(S.read_tags_csv(spark, t), 1).count() == 1


def test_k2_s7_vector_shards(spark, tmpdir_session):
    out = os.path.join(tmpdir_session, "shards")
    df = spark.range(250).select(F.col("id").alias("user_id"),
                                 F.array_repeat(F.lit(0.0).cast("float"), 8).alias("movie_ratings"))
    K.write_vector_shards(df.repartition(1), out, per_file=100)
    assert len(glob.glob(os.path.join(out, "*.parquet"))) == 3
    assert S.read_vector_shards(spark, out, 8).count() == 250
    with pytest.raises(Exception):
        S.read_vector_shards(spark, out, 9).collect()


def test_k1_sorted_lines_and_k3_split(spark, tmpdir_session):
    df = spark.createDataFrame([("b", "x", 1.5), ("a", "y", 2.0), ("a", "x", 3.0)],
                               "user string, item string, value double")
    out = os.path.join(tmpdir_session, "pred")
    K.write_sorted_lines(df, out, ["user", "item"], ["user", "item", "value"])
    lines = []
    for f in sorted(glob.glob(os.path.join(out, "part-*"))):
        lines += open(f).read().split()
    assert lines == ["a,x,3.0", "a,y,2.0", "b,x,1.5"]
    split_out = os.path.join(tmpdir_session, "split")
    r = spark.createDataFrame([(u, i, 3.0) for u in range(20) for i in range(20)],
                              "user_id long, item_id long, rating double")
    K.write_split(r, split_out, "user_id", "item_id")
    back = spark.read.parquet(split_out)
    assert back.count() == 400
    assert set(x["split"] for x in back.select("split").distinct().collect()) == {"train", "test"}


def test_j9_p10_corpus_from_aligned_files(spark, tmpdir_session):
    from orrery.operators.text import assemble_corpus
    tp = _write(os.path.join(tmpdir_session, "title_list.txt"), "Alpha\nBeta\nGamma\n")
    wp = _write(os.path.join(tmpdir_session, "wiki.txt"), "wa\n BREAKS HEREwb\n BREAKS HEREwc")
    ip = _write(os.path.join(tmpdir_session, "imdb.txt"), "ia\n BREAKS HEREib\n BREAKS HEREic")
    docs = assemble_corpus(S.read_lines(spark, tp, first=100), S.read_records(spark, wp, first=100),
                           S.read_records(spark, ip, first=100))
    got = [(r["rank"], r["title"], r["text"]) for r in docs.orderBy("rank").collect()]
    assert got == [(1, "Alpha", "waia"), (2, "Beta", "wbib"), (3, "Gamma", "wcic")]
