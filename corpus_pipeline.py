"""Corpus cleaning in stages; each reads what its predecessor wrote.

1. quality classifier: documents that it rejects go;
2. SimHash near-duplicates: of each component the document of least id stays;
3. suffix-array deduplication: bytes of long strings of earlier documents go
   (a character cut in two goes whole, n_chars follows the text);
4. benchmark decontamination: documents that hold a benchmark item go;
5. SentencePiece: the ids of what is left, with the decoding check.

All stages but the last return the columns of ``documents``. doc_id is the key:
rows that repeat an id (null is one id) are one document and stay or go
together. Null texts are empty. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import saved
from orrery.llm.cotrain import quality_classifier
from orrery.llm.decontam import decontaminate
from orrery.llm.queries import PIECES
from orrery.llm.simhash import near_duplicates
from orrery.llm.spm import encode_documents
from orrery.llm.suffix_dedup import remove_repeats


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``gone``; null equals null.

    ``gone`` is written first: the join is then planned by its real size, and
    only a list too long to broadcast moves the documents' texts."""
    ids = saved(gone.select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["gone_id"]), "left_anti")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality_classifier(docs, _table(spark, sf_dir, "labels"))
    return _without(docs, scored.where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_duplicates(docs, shingle=3, radius=3)
    return _without(docs, found.where("doc_id <> component_id"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = remove_repeats(docs, 50, carry)
    if "n_chars" in carry:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, decontaminate(docs, _table(spark, sf_dir, "benchmark")).where("contaminated"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, PIECES)


STAGES = [("quality_classifier", classify), ("simhash", near_dedup), ("suffix_dedup", suffix_dedup),
          ("decontamination", decontamination), ("sentencepiece", sentencepiece)]
#: Models, XXH64 fingerprints and the subword search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
