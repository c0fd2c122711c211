"""A directory tree as a table: every name is listed, hidden and empty ones too. Text files by line."""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from boughwork.sources.scratch import settle


class DirectorySource(DataSource):
    """Options: path; max_levels; ignore_dirs, names joined by ``|`` that aren't entered;
    tasks, about how many to deal the directories to."""

    @classmethod
    def name(cls) -> str:
        return "directory"

    def schema(self) -> str:
        return "relpath string, is_dir boolean"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


@dataclass
class _Folders(InputPartition):
    """Directories to list: ``alone`` without and ``whole`` with what lies below them."""

    alone: list[str]
    whole: list[str]


class _Reader(DataSourceReader):
    def __init__(self, options):
        self._root = options["path"]
        self._levels = int(options.get("max_levels", "3"))
        self._tasks = int(options.get("tasks", "64"))
        self._ignored = frozenset(filter(None, options.get("ignore_dirs", "").split("|")))

    def _children(self, folder: str) -> list[tuple[str, bool]]:
        try:
            with os.scandir(os.path.join(self._root, folder)) as found:
                return [(f"{folder}/{e.name}" if folder else e.name, e.is_dir()) for e in found]
        except PermissionError:
            return []

    def _folders(self, folder: str) -> list[str]:
        return [p for p, is_dir in self._children(folder) if is_dir and p.rpartition("/")[2] not in self._ignored]

    def partitions(self) -> list[InputPartition]:
        """Directories are opened level by level until there are enough of them, and then dealt
        out by how many names each holds. The driver opens fewer than ``tasks`` on each level."""
        opened, frontier, level = [], [""], 0
        while frontier and len(frontier) < self._tasks and level < self._levels:
            opened, frontier, level = opened + frontier, [d for f in frontier for d in self._folders(f)], level + 1
        frontier = frontier if level < self._levels else []
        few = len(frontier) <= 16 * self._tasks
        sized = sorted(((1 + (len(self._children(d)) if few else 0), d) for d in frontier), reverse=True)
        parts = [_Folders([], []) for _ in range(max(1, min(self._tasks, len(opened) + len(frontier))))]
        loads = [(0, i) for i in range(len(parts))]
        for size, folder in sized:
            load, least = heapq.heappop(loads)
            parts[least].whole.append(folder)
            heapq.heappush(loads, (load + size, least))
        for folder in opened:
            load, least = heapq.heappop(loads)
            parts[least].alone.append(folder)
            heapq.heappush(loads, (load + 1, least))
        return parts

    def read(self, partition: _Folders) -> Iterator[tuple[str, bool]]:
        for folder in partition.alone:
            yield from self._children(folder)
        todo = [(folder, folder.count("/") + 1 if folder else 0) for folder in partition.whole]
        while todo:
            folder, level = todo.pop()
            if level >= self._levels:
                continue
            for path, is_dir in self._children(folder):
                yield path, is_dir
                if is_dir and path.rpartition("/")[2] not in self._ignored:
                    todo.append((path, level + 1))


def read_directory(spark: SparkSession, root: str, max_levels: int = 3, ignore_dirs: tuple[str, ...] = (), tasks: int | None = None) -> DataFrame:
    """``(relpath, is_dir)`` of all names to ``max_levels`` below ``root``. ``tasks`` is four
    times the session's cores if it isn't given."""
    spark.dataSource.register(DirectorySource)
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    options = {"max_levels": max_levels, "ignore_dirs": "|".join(ignore_dirs), "tasks": tasks}
    return spark.read.format("directory").options(**options).load(os.path.abspath(root))


def expand(children: DataFrame, root: str, max_levels: int | None = None) -> DataFrame:
    """``(id, parent, depth)`` of all below ``root`` in a table of ``(id, parent)``.

    Each level is written, and the next is what lies below it and wasn't seen before, so a loop
    ends, and a plan holds one level. An id is entered at its least depth only; all its parents
    on the level above are rows. Without ``max_levels`` it goes on until nothing new is found.
    """
    edges = children.select(F.col("id").alias("child"), F.col("parent").alias("above"))
    frontier, out, depth = None, None, 0
    while max_levels is None or depth < max_levels:
        depth += 1
        if frontier is None:
            found = edges.where(F.col("above") == root)
        else:
            found = edges.join(frontier.select(F.col("id").alias("at")).distinct(), F.col("above") == F.col("at"), "left_semi")
            found = found.join(out.select(F.col("id").alias("seen")), F.col("child") == F.col("seen"), "left_anti")
        found = found.where((F.col("child") != root) | F.col("child").isNull())
        frontier = settle(found.select(F.col("child").alias("id"), F.col("above").alias("parent"), F.lit(depth).alias("depth")), "level")
        out = frontier if out is None else out.unionByName(frontier)
        if frontier.isEmpty():
            break
    return edges.limit(0).select(F.col("child").alias("id"), F.col("above").alias("parent"), F.lit(0).alias("depth")) if out is None else out


def as_uri(path: str) -> str:
    """A file of this machine as Spark's readers name it, whatever letters its name holds."""
    return re.sub(r"([*?\[\]{}\\,])", r"\\\1", "file:" + os.path.abspath(path))


_OTHER_BREAKS = "[\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, line_no, text)`` of text files; a file of any size is read in splits.

    Spark's reader finds the ends at line feeds, whichever task reads them; the other line ends
    are split off within its rows. Rows are written with where they lay, and a line's number is
    its place in its split and the lines of the file's splits before. A file's last row ends in
    a line feed or not, as its length tells; so does it of a byte order mark, which the reader drops.
    """
    raw = spark.read.text(path, lineSep="\n").select("value", "_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start")
    at = F.monotonically_increasing_id()
    raw = settle(raw.select(F.col("file_path").alias("doc_id"), F.col("file_size").alias("size"), F.col("file_block_start").alias("block"), F.octet_length("value").alias("bytes"), "value", at.alias("at")), "rows")
    row = F.struct("block", "at")
    files = raw.groupBy("doc_id").agg(F.max(row)["at"].alias("last"), F.min(row)["at"].alias("first"), (F.sum(F.col("bytes") + 1) - F.max("size")).alias("over"))
    files = files.select(F.col("doc_id").alias("of"), F.when(F.col("over").isin(1, -2), F.col("last")).alias("open_end"), F.when(F.col("over") < -1, F.col("first")).alias("marked"))
    rows = raw.join(files, F.col("doc_id") == F.col("of"), "left")
    is_open = F.coalesce(F.col("at") == F.col("open_end"), F.lit(False))
    value = F.when(F.col("at") == F.col("marked"), F.concat(F.lit("\ufeff"), "value")).otherwise(F.col("value"))
    pieces = F.split(F.when(is_open, value).otherwise(F.regexp_replace(value, "\r\\z", "")), _OTHER_BREAKS)
    pieces = F.when(is_open & (F.element_at(pieces, -1) == ""), F.slice(pieces, 1, F.size(pieces) - 1)).otherwise(pieces)
    sized = rows.select("doc_id", "block", "at", pieces.alias("pieces"))
    order = Window.partitionBy("doc_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(F.size("pieces")).over(order), F.lit(0))
    blocks = sized.groupBy("doc_id", "block").agg(F.sum(F.size("pieces")).alias("lines"))
    earlier = Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("doc_id").alias("of"), F.col("block").alias("at_block"), F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    placed = sized.withColumn("within", within).join(blocks, (F.col("doc_id") == F.col("of")) & (F.col("block") == F.col("at_block")))
    return placed.select("doc_id", (F.col("before") + F.col("within")).alias("first"), F.posexplode("pieces").alias("place", "text")).select("doc_id", (F.col("first") + F.col("place")).alias("line_no"), "text")
