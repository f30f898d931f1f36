"""Pair statistics of columns over shared rows, as a self-join on the row.

For a long relation ``(row, col, value)``: for every pair of columns
``c1 < c2`` that share at least one row, over the shared rows,

    n   = number of shared rows      sxy = sum x*y
    sx  = sum x     sy = sum y       sxx = sum x*x    syy = sum y*y

where x is the value in c1 and y the value in c2. Item–item similarity and
co-rater counts (rows = users) and the covariance of vector components are
instances. The result has one row per pair of columns, so columns are the
bounded side (items, dimensions), never documents.

Rows are cut into blocks of columns on both sides (``skew``), so that a row
with a third of all entries spreads over many tasks; the pairs of a block are
added up before the shuffle on (c1, c2). Sums of integers (doubled half-star
ratings) are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.operators.skew import BLOCK, blocks, every_block, own_block

STATS = ("n", "sx", "sy", "sxy", "sxx", "syy")


def pair_stats(df: DataFrame, row: str, col: str, value: str | None = None, stats=STATS,
               include_self: bool = False, block: int = BLOCK) -> DataFrame:
    """``c1, c2`` and the asked ``stats`` (``n`` bigint, sums double)."""
    x = F.col(value).cast("double") if value else F.lit(1.0)
    base = df.select(F.col(row).alias("_r"), F.col(col).alias("_c"), x.alias("_v"))
    sizes = base.groupBy("_r").agg(blocks(F.count(F.lit(1)), block).alias("_s"))
    sized = base.join(sizes, "_r").withColumn("_o", own_block(["_c"], F.col("_s")))
    a = sized.select("_r", F.col("_c").alias("c1"), F.col("_v").alias("x"), F.col("_o").alias("_a"),
                     every_block(F.col("_s")).alias("_b"))
    b = sized.select("_r", F.col("_c").alias("c2"), F.col("_v").alias("y"), F.col("_o").alias("_b"),
                     every_block(F.col("_s")).alias("_a"))
    met = a.join(b, ["_r", "_a", "_b"]).where(F.col("c1") <= F.col("c2") if include_self else F.col("c1") < F.col("c2"))
    sums = {"n": F.count(F.lit(1)), "sx": F.sum("x"), "sy": F.sum("y"), "sxy": F.sum(F.col("x") * F.col("y")),
            "sxx": F.sum(F.col("x") * F.col("x")), "syy": F.sum(F.col("y") * F.col("y"))}
    return met.groupBy("c1", "c2").agg(*[sums[s].alias(s) for s in stats])


def pearson(stats_df: DataFrame, exact_integers: bool = True, out: str = "similarity") -> DataFrame:
    """Pearson correlation over shared rows from one-pass sums (ledger Q5):
    (n·Σxy − Σx·Σy) / (√(n·Σx² − (Σx)²) · √(n·Σy² − (Σy)²)), 0 if any factor is 0.

    With integer data the three factors are computed in bigint, so the zero
    tests are exact (ANSI mode raises on overflow instead of wrapping).
    """
    kind = "bigint" if exact_integers else "double"
    n, sx, sy, sxy, sxx, syy = (F.col(c).cast(kind) for c in STATS)
    num = n * sxy - sx * sy
    d1 = n * sxx - sx * sx
    d2 = n * syy - sy * sy
    sim = F.when((num == 0) | (d1 == 0) | (d2 == 0), F.lit(0.0)).otherwise(
        num.cast("double") / (F.sqrt(d1.cast("double")) * F.sqrt(d2.cast("double"))))
    return stats_df.withColumn(out, sim)
