"""Equi-joins that fan out per key, with large keys split on both sides.

``fanout_join(left, right, key)`` is ``left.join(right, key)`` whose output
for one key is |left_k| × |right_k| rows (test pairs × train items of a
user). If one key holds a third of the data that product would land in one
task. Every key is cut into ``ceil(n / block)`` blocks on each side (one block
for small keys); a row goes to its own block and meets every block of the
other side, so a group joins at most about ``block`` × ``block`` rows. The
plan has this one shape whatever the sizes; the key counts are partial sums
joined back, and Spark decides by their measured size how.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 2048


def blocks(n: Column, block: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / F.lit(block))).cast("int")


def own_block(cols: list[str], n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), n_blocks.cast("bigint")).cast("int")


def every_block(n_blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n_blocks - F.lit(1)))


def fanout_join(left: DataFrame, right: DataFrame, keys: list[str] | str, block: int = BLOCK,
                left_tiebreak: str | None = None, right_tiebreak: str | None = None) -> DataFrame:
    """Inner equi-join on ``keys`` with both sides of large keys in blocks.

    ``left_tiebreak`` / ``right_tiebreak`` name a column that spreads a key's
    rows over blocks (hash of it); default is a hash of all columns.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)

    def sizes(df, out):
        return df.groupBy(*keys).agg(blocks(F.count(F.lit(1)), block).alias(out))

    both = sizes(left, "_sl").join(sizes(right, "_sr"), keys)
    a = left.join(both, keys).withColumn("_a", own_block([left_tiebreak] if left_tiebreak else left.columns, F.col("_sl"))) \
        .withColumn("_b", every_block(F.col("_sr"))).drop("_sl", "_sr")
    b = right.join(both, keys).withColumn("_b", own_block([right_tiebreak] if right_tiebreak else right.columns, F.col("_sr"))) \
        .withColumn("_a", every_block(F.col("_sl"))).drop("_sl", "_sr")
    return a.join(b, keys + ["_a", "_b"]).drop("_a", "_b")
