"""Helpers shared by the corpus operators: scratch tables, batches, hashing."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest piece of text that one vectorised step works on.
CHUNK_BYTES = 1 << 20

MIX1, MIX2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
BASE = 0x9E3779B97F4A7C15
_U64 = (1 << 64) - 1


def scratch_path(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``; where that is unset
    (tests), under the warehouse. Both are shared by driver and executors."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def saved(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back:
    lineage ends there, and a lost executor loses nothing."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession)
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text_columns(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (and ``more``), by exact name; other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       *[F.col(c) for c in more])


def in_small_batches(batches, max_bytes: int = 8 << 20, column: str = "text"):
    """Slices of Arrow batches whose text sums to about ``max_bytes``; one
    longer text makes a slice of its own."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for b in batches:
        n = b.num_rows
        if not n:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0).cast(pa.int64()))
        total, at = np.cumsum(size), 0
        while at < n:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + max_bytes, "right")))
            yield b.slice(at, end - at)
            at = end


def utf8(column) -> list:
    """The values of an Arrow string column as bytes or None."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), in place."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(MIX1)
    h ^= h >> np.uint64(27)
    h *= np.uint64(MIX2)
    h ^= h >> np.uint64(31)
    return h


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on need."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int):
        if n >= self.n:
            self.n = max(n + 1, 1 << 16)
            self.up, self.down = (self._row(x) for x in (self.base, self.inverse))
        return self.up, self.down

    def _row(self, x: int) -> np.ndarray:
        row = np.full(self.n, x, np.uint64)
        row[0] = 1
        return np.cumprod(row, dtype=np.uint64)


def prefix_sums(a: np.ndarray, powers: Powers) -> np.ndarray:
    up, _ = powers.upto(len(a))
    out = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:len(a)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end)."""
    _, down = powers.upto(len(sums))
    h = (sums[end] - sums[start]) * down[start]
    h += (end - start).astype(np.uint64) * np.uint64(BASE)
    return mix(h)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than 0x09-0x0D and 0x20."""
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    return edge[::2], edge[1::2]


def sorted_unique(a: np.ndarray) -> np.ndarray:
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a


def find(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each x in sorted ``keys``, -1 where absent (x sorted: fast)."""
    if not len(keys):
        return np.full(len(x), -1)
    at = np.searchsorted(keys, x)
    at[at == len(keys)] = 0
    return np.where(keys[at] == x, at, -1)
