"""Shared helpers: reading tables, train / held-out folds and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boughwork.sources.scratch import discard, scratch_path, settle

__all__ = ["discard", "fold", "labelled", "low", "one_text", "scratch_path", "settle", "table", "votes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, parts: int) -> Column:
    """``crc32`` of the key as text, modulo ``parts``: a stable train / held-out split; -1 for
    a null key, which so is never held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(-1))


def low(rows: int, total: int, *key: str) -> Column:
    """Whether a row is among about ``rows`` of ``total`` whose key hashes low, so the choice
    doesn't depend on how the rows lie; always, if there are no more."""
    return F.lit(True) if total <= rows else F.pmod(F.xxhash64(F.lit(17), *key), F.lit(1 << 30)) < int((1 << 30) * rows / total)


def votes(labels: DataFrame, label: str, held_out: Column) -> DataFrame:
    """``(doc_id, label 0/1)`` outside the held-out fold, written down: null labels and ids
    don't count, several labels of a document by majority (ties: 0)."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out)
    return settle(own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(label) > 0.5).cast("int").alias("label")), "votes")


def one_text(rows: DataFrame, *keep: str, more: Sequence[str] = ()) -> DataFrame:
    """A row for each doc_id, with its text, of several that of the smallest hash, and ``more``
    of that row; ``keep`` are columns that depend on doc_id alone."""
    row = F.min_by(F.struct("text", *more), F.struct(F.xxhash64("text"), *more)).alias("row")
    return rows.groupBy("doc_id", *keep).agg(row).select("doc_id", *keep, "row.*")


def labelled(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, rows: int, more: Mapping[str, Column] | None = None) -> DataFrame:
    """``(doc_id, text, label 0/1, *more)`` of about ``rows`` documents labelled outside the
    held-out fold. The labels chosen are few, so they are broadcast."""
    more = more or {}
    own = votes(labels, label, held_out)
    own = own.where(low(rows, own.count(), "doc_id"))
    texts = docs.select(F.col("doc_id").cast("long"), "text", *(c.alias(n) for n, c in more.items()))
    return one_text(texts.join(F.broadcast(own), "doc_id"), "label", more=list(more)).select("doc_id", "text", "label", *more)
