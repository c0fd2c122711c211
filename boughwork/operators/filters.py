"""Which entries of a listing are shown."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from boughwork.functions import ignore, paths
from boughwork.operators.layout import CHUNK_BITS, in_ranges

# Names left out unless the caller says otherwise.
IGNORED_DIRS = (".git", "__pycache__", ".pycache", ".idea", ".vscode", ".ipynb_checkpoints")
IGNORED_FILES = (".gitkeep",)


def depth_limit(entries: DataFrame, max_levels: int) -> DataFrame:
    return entries.where(paths.depth_of(F.col("relpath")) <= max_levels)


def by_extension(entries: DataFrame, extensions: str | Iterable[str] | None) -> DataFrame:
    """Files of these extensions, and all directories; no filter for none."""
    wanted = paths.normal_extensions(extensions)
    if wanted is None:
        return entries
    return entries.where(F.col("is_dir") | paths.suffix_of(paths.name_of(F.col("relpath"))).isin(wanted))


def by_name(entries: DataFrame, ignore_dirs: Iterable[str] | None = None, ignore_files: Iterable[str] = IGNORED_FILES) -> DataFrame:
    """Drop entries by their own exact name; None stands for the usual directories."""
    dirs = list(IGNORED_DIRS if ignore_dirs is None else ignore_dirs)
    name = paths.name_of(F.col("relpath"))
    return entries.where(~(F.col("is_dir") & name.isin(dirs)) & ~(~F.col("is_dir") & name.isin(list(ignore_files))))


def by_rules(entries: DataFrame, rules: list[ignore.Rule], documented: DataFrame | None = None, mode: str = "git") -> DataFrame:
    """Drop what the rules ignore, but keep entries that are documented themselves."""
    drop = ignore.ignored(F.col("relpath"), F.col("is_dir"), rules, mode)
    if documented is None:
        return entries.where(~drop)
    judged = entries.select(F.struct("*").alias("row"), F.col("relpath").alias("path"), drop.alias("drop"))
    known = documented.select(F.col("relpath").alias("known")).distinct()
    return judged.join(known, F.col("path") == F.col("known"), "left").where(~F.col("drop") | F.col("known").isNotNull()).select("row.*")


def _regions(ranged: DataFrame) -> dict[int, str]:
    """For each chunk that begins in an excluded directory, the outermost such."""
    gone = F.when(F.col("gone"), F.struct("place", "path"))
    rows = ranged.groupBy("chunk", paths.depth_of(F.col("path")).alias("depth")).agg(F.max(gone)["path"].alias("gone"), F.min(F.struct("place", "path")).alias("first")).collect()
    out, last = {}, {}
    for chunk, own in groupby(sorted(rows, key=lambda r: (r["chunk"], r["first"])), key=lambda r: r["chunk"]):
        own = list(own)
        over = [path for _, path in sorted(last.items()) if own[0]["first"]["path"].startswith(path + "/")]
        if over:
            out[chunk] = over[0]
        last |= {r["depth"]: r["gone"] for r in own if r["gone"] is not None}
    return out


def prune(entries: DataFrame, kept: DataFrame) -> DataFrame:
    """Those of ``kept`` all of whose directories are kept as well.

    In pre-order what lies in an excluded directory follows it, so one pass over the kept
    entries and the excluded directories drops them; a chunk is handed the excluded directory
    that it begins in.
    """
    listed = kept.select(F.col("relpath").alias("path"), "is_dir", F.lit(False).alias("gone"), F.struct("*").alias("own"))
    gone = entries.where("is_dir").select(F.col("relpath").alias("path")).join(kept.select(F.col("relpath").alias("path")), "path", "left_anti")
    every = listed.unionByName(gone.select("path", F.lit(True).alias("is_dir"), F.lit(True).alias("gone"), F.lit(None).cast(listed.schema["own"].dataType).alias("own")))
    ranged = in_ranges(every, paths.preorder_key(F.col("path"), F.col("is_dir")), path=F.coalesce("path", F.lit("")), gone=F.col("gone"))
    ranged = ranged.select("place", "path", "gone", F.shiftright("place", CHUNK_BITS).alias("chunk"), "row.own")
    begun = ranged.sparkSession.sparkContext.broadcast(_regions(ranged))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, region = None, ""
        for batch in batches:
            keep = []
            for at, path, gone in zip(*(batch.column(c).to_pylist() for c in ("chunk", "path", "gone"))):
                if at != chunk:
                    chunk, region = at, begun.value.get(at, "")
                inside = region and path.startswith(region + "/")
                if gone and not inside:
                    region = path
                keep.append(not gone and not inside)
            yield batch.select(["own"]).filter(pa.array(keep, pa.bool_()))

    dealt = ranged.repartition("chunk").sortWithinPartitions("place").select("chunk", "path", "gone", "own")
    return dealt.mapInArrow(run, StructType([ranged.schema["own"]])).select("own.*")


def visible(entries: DataFrame, max_levels: int = 3, extensions: str | Iterable[str] | None = None, ignore_dirs: Iterable[str] | None = None, rules: list[ignore.Rule] | None = None, documented: DataFrame | None = None, mode: str = "git") -> DataFrame:
    """All filters, and nothing below an excluded directory."""
    kept = by_name(by_extension(depth_limit(entries, max_levels), extensions), ignore_dirs)
    if rules:
        kept = by_rules(kept, rules, documented, mode)
    return prune(depth_limit(entries, max_levels), kept)
