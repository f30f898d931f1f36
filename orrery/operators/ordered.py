"""Operators that need a global order: dense ordered index and running sums.

A window without ``partitionBy`` would pull every row into one task. Here the
order is cut into ranges at fixed bounds, taken once from a bounded sample of
the keys (those of smallest hash), so the range of a row is a function of its
key alone: every evaluation agrees, and nothing is checkpointed. Each range is
a window of its own; the ranges' totals are a table of at most ``RANGES`` rows
whose running sums are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges, and sampled keys from which their bounds are taken.
RANGES, SAMPLE = 256, 4096


def range_bounds(df: DataFrame, key: str, ranges: int = RANGES, sample: int = SAMPLE) -> list:
    """Ascending bounds that cut the distinct keys into about equal ranges."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    got = sorted(r[0] for r in keys.orderBy(F.xxhash64(key), key).limit(sample).collect())
    n = min(ranges, max(1, len(got) // 4))
    return sorted({got[len(got) * i // n] for i in range(1, n)})


def range_of(key: Column, bounds: list, first: int = 0) -> Column:
    """Number of bounds not above the key, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(key < F.lit(bounds[mid]), range_of(key, bounds[:mid], first)) \
        .otherwise(range_of(key, bounds[mid + 1:], first + mid + 1))


def _before(per_range: DataFrame, sums: list[str], descending: bool) -> DataFrame:
    """The sums of the ranges before each (a table of at most RANGES rows)."""
    order = F.col("_range").desc() if descending else F.col("_range").asc()
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select("_range", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_before_{c}") for c in sums])


def dense_index(df: DataFrame, key: str, out: str = "idx", ranges: int = RANGES,
                descending: bool = False) -> DataFrame:
    """Distinct ``key`` values with a 0-based ``out`` index in key order.

    Same result as ``dense_rank() OVER (ORDER BY key) - 1``.
    """
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    placed = keys.withColumn("_range", range_of(F.col(key), range_bounds(keys, key, ranges)))
    before = _before(placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")), ["n"], descending)
    w = Window.partitionBy("_range").orderBy(F.col(key).desc() if descending else F.col(key).asc())
    return placed.withColumn("_nth", F.row_number().over(w)).join(before, "_range") \
        .select(key, (F.col("_before_n") + F.col("_nth") - 1).cast("bigint").alias(out))


def running_sums(df: DataFrame, order_col: str, sum_cols: list[str], descending: bool = True,
                 ranges: int = RANGES, group: str | None = None) -> DataFrame:
    """For each row (one per ``order_col`` value of a ``group`` expected): the
    inclusive running totals ``cum_<c>`` of ``sum_cols`` in that order."""
    placed = df.withColumn("_range", range_of(F.col(order_col), range_bounds(df, order_col, ranges)))
    by = [group] if group else []
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    totals = placed.groupBy(*by, "_range").agg(*[F.sum(c).alias(c) for c in sum_cols])
    # ranges without rows of a group are not in its totals, so the sums before stay right
    across = Window.partitionBy(*by).orderBy(F.col("_range").desc() if descending else F.col("_range").asc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*by, "_range", *[F.coalesce(F.sum(c).over(across), F.lit(0.0)).alias(f"_before_{c}") for c in sum_cols])
    within = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    cum = placed.select("*", *[F.sum(c).over(within).alias(f"_in_{c}") for c in sum_cols]).join(before, [*by, "_range"])
    return cum.select(*df.columns, *[(F.col(f"_in_{c}") + F.col(f"_before_{c}")).cast("double").alias(f"cum_{c}") for c in sum_cols])
