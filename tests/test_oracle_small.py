"""Every query with an oracle matches DuckDB on the smallest data set."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from orrery.sources.tables import TABLES
from tests.conftest import SF_SMALL

SQL = entry.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


#: Spark types and the DuckDB types that count as equal.
KINDS = {"bigint": {"BIGINT", "HUGEINT"}, "int": {"INTEGER"}, "string": {"VARCHAR"}, "double": {"DOUBLE"}, "boolean": {"BOOLEAN"}}
#: Results in a stated order.
ORDERED = {"ratings_per_user", "ratings_per_item", "prediction_output", "parts_by_number", "first_titles"}


# the corpus operators' SQL is compared in their own tests
@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("op")))
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = df.toPandas()
    done = con.execute(SQL[name])
    kinds = {d[0]: str(d[1]) for d in done.description}
    want = done.df()
    assert _rows(got) == _rows(want)
    for column, kind in df.dtypes:
        duck = str(con.sql(SQL[name]).types[list(kinds).index(column)])
        assert duck in KINDS.get(kind, {duck}) or duck.startswith("DECIMAL") and kind == "double", (column, kind, duck)
    if name in ORDERED:
        plain = [[_norm(x) for x in r] for r in got[sorted(got.columns)].itertuples(index=False, name=None)]
        assert plain == [[_norm(x) for x in r] for r in want[sorted(want.columns)].itertuples(index=False, name=None)]


def test_every_query_has_builder():
    assert set(SQL) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "prediction" in df.columns
