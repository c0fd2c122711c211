"""The corpus pipeline: documents to packed sequences in five stages, each a job of its own.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which :func:`run` writes as
Parquet to the shared folder and reads again for the next. All but the last return the
columns of ``documents``. Null ids and texts, empty texts, repeated rows, extra columns and
an empty table are treated as each operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boughwork.llm import decontaminate, packing, quality_fm, secret_scan, simhash
from boughwork.llm.common import discard, fold, settle, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine rejects (score under 0.7) go."""
    held_out = fold(F.col("doc_id"), 4) == 2
    return quality_fm.drop_low_quality(docs, table(spark, sf_dir, "labels"), held_out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one of the smallest doc_id, those without one last."""
    return simhash.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more repeats benchmark windows go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked and n_chars counts the new text."""
    clean = secret_scan.redact(docs, "source" if "source" in docs.columns else None)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("secret_scan", without_secrets),
    ("retrieval_packing", packed),
]

#: No stage but the third can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
