"""Shared inputs of the registered queries and the matching SQL fragments.

``Inputs`` derives the rating relations from the supplied tables lazily;
``SQL_*`` are the same derivations as DuckDB/ANSI common table expressions
for the oracle side.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators import ratings as R
from orrery.sources.tables import table

ROUND = 6


def r6(col) -> "F.Column":
    """Round for comparison; ``+ 0.0`` turns a rounded -0.0 into 0.0."""
    return F.round(col, ROUND) + F.lit(0.0)


def _zero_safe_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` of the SQL text in ``(... + 0.0)`` so both
    engines print a rounded negative zero as 0.0 (not nested)."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 0, j + len(key) - 1
        while k < len(sql):
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "(" + sql[j:k + 1] + " + 0.0)")
        i = k + 1


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ops: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, _zero_safe_rounds(sql.strip()) if sql else None, ops)
        return fn
    return deco


@dataclass
class Inputs:
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def _memo(self, key, make):
        if key not in self._cache:
            self._cache[key] = make()
        return self._cache[key]

    @property
    def ratings(self) -> DataFrame:
        """Sparse ratings: customer × part, de-duplicated. Not persisted: the
        scan then reads only the columns that a query needs, and Spark reuses
        the exchange where a query reads the relation twice."""
        return self._memo("rs", lambda: R.sparse_ratings(self.t("lineitem"), self.t("orders")))

    @property
    def dense(self) -> DataFrame:
        """Dense ratings: customer × (brand|type)."""
        return self._memo("rd", lambda: R.dense_ratings(self.ratings, self.t("part")))

    def split(self, dense: bool = False):
        if dense:
            return self._memo("rd_split", lambda: R.train_test(self.dense, "user_id", "item_key"))
        return self._memo("rs_split", lambda: R.train_test(self.ratings, "user_id", "item_id"))


# ---- SQL fragments (DuckDB dialect of ANSI SQL) ---------------------------

SQL_RATINGS = """
raw AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         ceil(l.l_quantity / 5) / 2 AS rating, o.o_orderdate AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
ratings AS (
  SELECT user_id, item_id, rating, ts FROM (
    SELECT raw.*, row_number() OVER (PARTITION BY user_id, item_id
                                     ORDER BY ts DESC, rating DESC) AS rn
    FROM raw) x
  WHERE rn = 1)"""


def sql_bucket(u: str, i: str) -> str:
    return (f"(CAST(('0x' || substr(md5(CAST({u} AS VARCHAR) || '|' || CAST({i} AS VARCHAR)), 1, 8))"
            f" AS BIGINT) % 5)")


SQL_SPLIT = f"""
train AS (SELECT user_id, item_id, rating FROM ratings WHERE {sql_bucket('user_id', 'item_id')} <> 0),
test AS (SELECT user_id, item_id, rating FROM ratings WHERE {sql_bucket('user_id', 'item_id')} = 0)"""

SQL_DENSE = f"""
dense AS (
  SELECT r.user_id, p.p_brand || '|' || p.p_type AS item_key,
         ceil(avg(r.rating) * 2) / 2 AS rating
  FROM ratings r JOIN part p ON r.item_id = p.p_partkey
  GROUP BY r.user_id, p.p_brand || '|' || p.p_type),
dtrain AS (SELECT user_id, item_key, rating FROM dense WHERE {sql_bucket('user_id', 'item_key')} <> 0),
dtest AS (SELECT user_id, item_key, rating FROM dense WHERE {sql_bucket('user_id', 'item_key')} = 0)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)
