"""Comments on entries, and what changed against a documented tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boughwork.functions import paths
from boughwork.operators.layout import numbered


def attach(entries: DataFrame, documented: DataFrame) -> DataFrame:
    """Adds ``comment`` (empty where there is none) and ``found`` (the entry is documented)."""
    own = entries.select(F.struct("*").alias("row"), F.col("relpath").alias("path"))
    known = documented.select(F.col("relpath").alias("known"), F.col("comment").alias("said"))
    others = [F.col(f"row.`{c}`") for c in entries.columns if c.lower() not in ("comment", "found")]
    said = F.coalesce("said", F.array().cast("array<string>"))
    return own.join(known, F.col("path") == F.col("known"), "left").select(*others, said.alias("comment"), F.col("known").isNotNull().alias("found"))


def found(entries: DataFrame, documented: DataFrame) -> DataFrame:
    return entries.join(documented, "relpath", "left_semi")


def added(entries: DataFrame, documented: DataFrame) -> DataFrame:
    return entries.join(documented, "relpath", "left_anti")


def removed(entries: DataFrame, documented: DataFrame) -> DataFrame:
    """Documented keys that aren't shown, whatever the reason."""
    return documented.select("relpath").join(entries, "relpath", "left_anti")


def difference(entries: DataFrame, documented: DataFrame) -> DataFrame:
    """``(path, status, ord)``: found and added in pre-order, removed by code point.

    One outer join tells the three apart, and one sort numbers each for itself.
    """
    shown = entries.select(F.col("relpath").alias("shown"), "is_dir")
    known = documented.select(F.col("relpath").alias("known")).distinct()
    both = shown.join(known, F.col("shown") == F.col("known"), "full")
    status = F.when(F.col("known").isNull(), "added").when(F.col("shown").isNull(), "removed").otherwise("found")
    told = both.select(F.coalesce("shown", "known").alias("path"), "is_dir", status.alias("status"))
    by_name = F.array(F.struct(F.lit(False).alias("f"), F.lit("").alias("l"), F.col("path").alias("n")))
    order = F.when(F.col("status") == "removed", by_name).otherwise(paths.preorder_key(F.col("path"), F.coalesce("is_dir", F.lit(False))))
    return numbered(told, order, within=F.col("status")).select("path", "status", "ord")
