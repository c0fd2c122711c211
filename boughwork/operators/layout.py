"""Order, indentation and lines of a tree.

Entries are sorted in pre-order once and written. What an entry needs of others (is there a
later sibling, was the one before a directory, which ancestors have later siblings) is then
found in one pass over chunks of consecutive entries: of each depth, a chunk is handed the last
entry before it and the parent of the next one after it, a few rows a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from boughwork.functions import paths
from boughwork.sources.scratch import settle

# The drawing of a tree.
TEE, ELBOW, BAR, BLANK = "├── ", "└── ", "│   ", "    "

#: A chunk is 2 to this power of consecutive rows, which a task holds at once.
CHUNK_BITS = 16


def _others(df: DataFrame, *names: str) -> list[Column]:
    """The columns of a struct ``row`` of ``df``'s, but for those named."""
    return [F.col(f"row.`{c}`") for c in df.columns if c.lower() not in names]


def in_ranges(df: DataFrame, *keys: Column, **more: Column) -> DataFrame:
    """``(row, place, *more)``, sorted by ``keys`` in ranges and written: ``place`` grows with
    the order, by one within a range (its upper 31 bits)."""
    named = {f"key{i}": key for i, key in enumerate(keys)}
    rows = df.select(F.struct("*").alias("row"), *(c.alias(n) for n, c in {**named, **more}.items()))
    ranged = rows.repartitionByRange(*named).sortWithinPartitions(*named).drop(*named)
    return settle(ranged.withColumn("place", F.monotonically_increasing_id()), "ranges")


def numbered(df: DataFrame, *keys: str | Column, name: str = "ord", within: Column | None = None) -> DataFrame:
    """Rows numbered from 0 by ``keys``, which should be unique, as the column ``name``.

    With ``within``, the first of the keys and of few values, the rows of each value are
    numbered for themselves. Rows are sorted in ranges, once, and numbered where they lie; how
    many rows the ranges before hold comes from a broadcast row for each range and value.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    group = F.lit(0) if within is None else within
    ranged = in_ranges(df, *([] if within is None else [within]), *keys, group=group)
    part = F.shiftright("place", 33)
    counts = ranged.groupBy(part.alias("part"), "group").agg(F.min("place").alias("first"), F.count("*").alias("n")).collect()
    before: dict = {}
    offsets = []
    for r in sorted(counts, key=lambda r: r["part"]):
        offsets.append((r["part"], r["group"], before.get(r["group"], 0) - r["first"]))
        before[r["group"]] = before.get(r["group"], 0) + r["n"]
    known = df.sparkSession.createDataFrame(offsets, StructType([StructField("of", LongType()), StructField("in", ranged.schema["group"].dataType), StructField("before", LongType())]))
    placed = ranged.join(F.broadcast(known), (part == F.col("of")) & F.col("group").eqNullSafe(F.col("in")))
    return placed.select(*_others(df, name.lower()), (F.col("place") + F.col("before")).alias(name))


def preorder(entries: DataFrame) -> DataFrame:
    """Adds ``ord``, the place in pre-order."""
    return numbered(entries, paths.preorder_key(F.col("relpath"), F.col("is_dir")))


def _boundaries(ranged: DataFrame) -> dict[int, dict]:
    """For each chunk: ``last``, by depth the (path, parent, is_dir, is_last) of the last entry
    before it; ``next``, by depth the parent of the first entry after it; ``line``, the lines
    before it."""
    marked = ranged.select("place", "chunk", "relpath", "is_dir", "more", "given", paths.parent_of(F.col("relpath")).alias("parent"), paths.depth_of(F.col("relpath")).alias("depth"))
    files = F.count(F.when(~F.col("is_dir"), True))
    folders = F.count(F.when(F.col("is_dir"), True))
    last = F.struct("place", "relpath", "is_dir", "given")
    # of siblings, directories come first: all but the first of them, and the first file behind them, follow one
    by_parent = marked.groupBy("chunk", "depth", "parent").agg(
        F.min("place").alias("first"), F.max_by(last, "place").alias("last"), F.sum("more").alias("more"),
        F.when(folders > 0, folders - 1 + F.least(files, F.lit(1))).otherwise(0).alias("spacers"),
    )
    rows = by_parent.groupBy("chunk", "depth").agg(
        F.min_by("parent", "first").alias("first"), F.max_by(F.struct("parent", "last.*"), "last.place").alias("last"), F.sum(F.col("more") + F.col("spacers")).alias("lines"),
    )
    chunks = [(c, list(own)) for c, own in groupby(sorted(rows.collect(), key=lambda r: (r["chunk"], r["depth"])), key=lambda r: r["chunk"])]
    out, known, line = {}, {}, 0
    for chunk, own in chunks:
        out[chunk] = {"last": dict(known), "line": line}
        for r in own:
            before = known.get(r["depth"])
            line += r["lines"] + (before is not None and before[1] == r["first"] and before[2])
            known[r["depth"]] = (r["last"]["relpath"], r["last"]["parent"], r["last"]["is_dir"], r["last"]["given"])
    after: dict[int, str] = {}
    for chunk, own in reversed(chunks):
        out[chunk]["next"] = dict(after)
        after |= {r["depth"]: r["first"] for r in own}
    return out


def _arranged(relpaths: list[str], dirs: list[bool], given: list[bool | None], bounds: dict) -> tuple[list[bool], list[bool], list[str]]:
    """Of a chunk's entries: is_last, spacer, prefix."""
    parents = [p.rpartition("/")[0] for p in relpaths]
    depths = [p.count("/") + 1 for p in relpaths]
    after, is_last = dict(bounds["next"]), list(given)
    for i in reversed(range(len(relpaths))):
        if given[i] is None:
            is_last[i] = after.get(depths[i]) != parents[i]
        after[depths[i]] = parents[i]
    bar = lambda last: BLANK if last else BAR
    bars = {depth: (path, bar(after.get(depth) != parent if told is None else told)) for depth, (path, parent, _, told) in bounds["last"].items()}
    before = {depth: (parent, is_dir) for depth, (_, parent, is_dir, _) in bounds["last"].items()}
    below: dict[str, str] = {"": ""}  # the prefix of a directory's entries

    def prefix(parent: str) -> str:
        todo = []
        while parent not in below:
            todo.append(parent)
            parent = parent.rpartition("/")[0]
        found = below[parent]
        for path in reversed(todo):
            held, drawn = bars.get(path.count("/") + 1, ("", ""))
            found = below[path] = found + (drawn if held == path else "")
        return found

    spacer, prefixes = [], []
    for path, parent, depth, is_dir, last in zip(relpaths, parents, depths, dirs, is_last):
        spacer.append(before.get(depth) == (parent, True))
        prefixes.append(prefix(parent))
        before[depth], bars[depth] = (parent, is_dir), (path, bar(last))
    return is_last, spacer, prefixes


def _walk(entries: DataFrame, more: Column | None = None, given: Column | None = None) -> DataFrame:
    """``(row, line, is_last, spacer, prefix)``: ``line`` is how many lines come before an
    entry's first, if each takes ``more``, and one for its spacer; ``given`` is an is_last that
    holds already."""
    more = F.lit(1) if more is None else more
    given = F.lit(None).cast("boolean") if given is None else given
    key = paths.preorder_key(F.col("relpath"), F.col("is_dir"))
    ranged = in_ranges(entries, key, relpath=F.coalesce("relpath", F.lit("")), is_dir=F.coalesce("is_dir", F.lit(False)), more=more.cast("long"), given=given)
    ranged = ranged.withColumn("chunk", F.shiftright("place", CHUNK_BITS))
    bounds = ranged.sparkSession.sparkContext.broadcast(_boundaries(ranged))
    out = StructType([ranged.schema["row"], StructField("line", LongType()), StructField("is_last", BooleanType()), StructField("spacer", BooleanType()), StructField("prefix", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def arrange() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            own = bounds.value[table.column("chunk")[0].as_py()]
            is_last, spacer, prefix = _arranged(*(table.column(c).to_pylist() for c in ("relpath", "is_dir", "given")), own)
            line, lines = own["line"], []
            for n, gap in zip(table.column("more").to_pylist(), spacer):
                lines.append(line)
                line += n + gap
            columns = [table.column("row"), pa.array(lines, pa.int64()), pa.array(is_last, pa.bool_()), pa.array(spacer, pa.bool_()), pa.array(prefix, pa.string())]
            yield from pa.Table.from_arrays(columns, ["row", "line", "is_last", "spacer", "prefix"]).to_batches()

        for batch in batches:
            chunk = batch.column("chunk").to_pylist()
            begin = 0
            for end in [i for i in range(1, len(chunk)) if chunk[i] != chunk[i - 1]] + [len(chunk)]:
                if held and held[-1].column("chunk")[0].as_py() != chunk[begin]:
                    yield from arrange()
                    held = []
                held.append(batch.slice(begin, end - begin))
                begin = end
        if held:
            yield from arrange()

    dealt = ranged.select("chunk", "row", "relpath", "is_dir", "given", "more", "place").repartition("chunk").sortWithinPartitions("place")
    return dealt.drop("place").mapInArrow(run, out)


def siblings(entries: DataFrame) -> DataFrame:
    """Adds ``parent``, ``is_last`` and ``spacer`` (the sibling before is a directory)."""
    parent = paths.parent_of(F.col("row.relpath"))
    return _walk(entries).select(*_others(entries, "parent", "is_last", "spacer"), parent.alias("parent"), "is_last", "spacer")


def prefixed(arranged: DataFrame) -> DataFrame:
    """Adds ``prefix``: a bar for each ancestor with a later sibling (not ``is_last``), else a blank."""
    return _walk(arranged, given=F.col("is_last")).select(*_others(arranged, "prefix"), "prefix")


def render(entries: DataFrame, alignment_col: int = 30, key: Column | None = None) -> DataFrame:
    """``(ord, line)`` of a tree of ``entries`` (relpath, is_dir, and ``comment`` if they have one).

    A spacer line stands before an entry that follows a directory. The first comment line is
    aligned; the others follow on lines of their own. ``key``, an expression over an entry's
    columns, is added to its lines as ``key``. A null relpath is an empty name; repeated rows
    are siblings; an empty table has no lines.
    """
    none = F.array().cast("array<string>")
    comment = F.coalesce("comment", none) if "comment" in entries.columns else none
    own = entries.select("relpath", "is_dir", comment.alias("comment"), *([] if key is None else [key.alias("key")]))
    walked = _walk(own, F.greatest(F.size("comment"), F.lit(1))).select("row.*", F.col("line").alias("at"), "is_last", "spacer", "prefix")
    name = F.coalesce(paths.name_of(F.col("relpath")), F.lit(""))
    head = F.concat("prefix", F.when(F.col("is_last"), ELBOW).otherwise(TEE), name)
    first = F.get("comment", F.lit(0))
    pad = F.repeat(F.lit(" "), F.greatest(F.lit(2), F.lit(alignment_col) - F.length(head)))
    line = F.when(F.coalesce(first, F.lit("")) == "", head).otherwise(F.concat(head, pad, F.lit("<- "), first))
    indent = F.concat("prefix", F.when(F.col("is_last"), BLANK).otherwise(BAR))
    fill = F.repeat(F.lit(" "), F.greatest(F.lit(1), F.lit(alignment_col + 3) - F.length(indent)))
    rest = F.transform(F.slice("comment", 2, F.greatest(F.size("comment") - 1, F.lit(0))), lambda c: F.concat(indent, fill, F.coalesce(c, F.lit(""))))
    before = F.when(F.col("spacer"), F.array(F.concat("prefix", F.lit("│")))).otherwise(none)
    more = [] if key is None else ["key"]
    drawn = walked.select(*more, "at", F.posexplode(F.concat(before, F.array(line), rest)).alias("place", "line"))
    return drawn.select((F.col("at") + F.col("place")).alias("ord"), "line", *more)
