"""The registered queries on the smallest data, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from orrery.llm import queries as Q
from orrery.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tests.llm.test_others import W  # noqa: F401
from tests.test_oracle_small import _rows


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    assert _rows(Q.QUERIES[name](spark, SF_SMALL).toPandas()) == _rows(con.execute(Q.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE_SQL)))
def test_one_row_per_document(spark, name):
    got = Q.QUERIES[name](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_held_out_languages(spark):
    got = Q.QUERIES["op8_language_id"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) > 30


def test_register():
    assert set(Q.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in Q.QUERIES} == set(range(1, 14))


def test_pipeline_stages(spark):
    """Each stage against its operator's own rows, then run() as a whole."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kinds, now = docs.dtypes, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in now.collect()}
        now = corpus_pipeline.saved(stage(spark, now, SF_SMALL))
        after = {r.doc_id: r for r in now.collect()}
        assert now.dtypes == kinds and set(after) <= set(before) and len(after) > 0.7 * len(before), name
        if name != "suffix_dedup":
            assert all(after[i] == before[i] for i in after)
        else:
            assert set(after) == set(before) and all(len(after[i].text) == after[i].n_chars <= before[i].n_chars for i in after)
    last = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(last) == set(after) and all(r.round_trip for r in last.values())


def test_pipeline_on_odd_rows(spark):
    text = "plain words of one document that says nothing new " * 3
    rows = [(1, text, "en", "a", 9), (2, text, "en", "a", 9), (2, text, "en", "a", 9), (None, None, None, None, None), (3, "", "en", "a", 0),
            (4, "x" * 300, None, "a", 300), (5, "other text entirely " + text[:70], "de", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for d in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            d = corpus_pipeline.saved(stage(spark, d, SF_SMALL))
        assert "ids" in d.columns
        d.collect()
