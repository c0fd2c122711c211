"""Lines, fenced blocks, and the tree that a block already documents."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from boughwork.operators.layout import BLANK, numbered
from boughwork.sources.scratch import settle

_BREAK = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"
_GROUPS = "^(?:│   |    )*"
_SPACE = "(?U)^\\s+|\\s+$"

#: Lines of a text that are one group at most; longer texts are several, which are handed
#: what the ones before hold.
_LINES = 100_000


def split_lines(text: Column) -> Column:
    """Lines without their ends; no empty line after a final end, none in an empty text."""
    lines = F.split(text, _BREAK)
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def lines_of(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, line_no from 0, text)``."""
    return texts.select(key, F.posexplode(split_lines(F.col(text))).alias("line_no", "text"))


def spacer(line: Column) -> Column:
    return line.rlike("^[│ ]*$")


def _parts(lines: DataFrame, key: str, **more: Column) -> DataFrame:
    """``(k, n, part, *more)``: the key, the line's number, and its part of the text. Lines
    without a number are left out."""
    own = lines.where("line_no is not null").select(F.col(key).alias("k"), F.col("line_no").alias("n"), *(c.alias(name) for name, c in more.items()))
    return own.withColumn("part", F.floor(F.col("n") / _LINES))


def _with(rows: DataFrame, given: DataFrame) -> DataFrame:
    """``rows`` and those of ``given``, whose other columns are null."""
    have = set(given.columns)
    return rows.unionByName(given.select(*rows.columns) if have >= set(rows.columns) else given.select(*(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema)))


def _running(parts: DataFrame, value: str, total: str, itself: bool = True) -> DataFrame:
    """Adds the sum of ``value`` over a text's lines so far, with or without the line itself.

    Sums run within parts, before which stands a row with the sum of the parts before. Rows are
    read for both, so they, which hold no texts, are written once.
    """
    parts = settle(parts, "parts")
    sums = parts.groupBy("k", "part").agg(F.sum(value).alias(value))
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("k", "part", F.sum(value).over(before).alias(value)).where(F.col(value).isNotNull())
    so_far = Window.partitionBy("k", "part").orderBy(F.asc_nulls_first("n")).rowsBetween(Window.unboundedPreceding, 0 if itself else -1)
    return _with(parts, sums).withColumn(total, F.coalesce(F.sum(value).over(so_far), F.lit(0))).where("n is not null")


def collapse_spacers(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Of each run of spacer lines the last stays; those at the end go."""
    rows = _parts(lines, key, blank=F.coalesce(spacer(F.col("text")), F.lit(True)), row=F.struct("*"))
    firsts = rows.groupBy("k", "part").agg(F.min_by("blank", "n").alias("blank"))
    firsts = firsts.select("k", "part", F.lead("blank").over(Window.partitionBy("k").orderBy("part")).alias("blank")).where("blank is not null")
    following = F.lead("blank").over(Window.partitionBy("k", "part").orderBy(F.asc_nulls_last("n")))
    marked = _with(rows, firsts).withColumn("following", following).where("n is not null")
    return marked.where(~F.col("blank") | ~F.coalesce("following", F.lit(True))).select("row.*")


def fenced_blocks(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, start, end, has_tree)``: fences by twos, an odd last one dropped."""
    text = F.col("text")
    tree = F.contains(text, F.lit("├──")) | F.contains(text, F.lit("└──"))
    rows = _running(_parts(lines, key, fence=F.trim(text).startswith("```").cast("long"), tree=tree), "fence", "before")
    fence = F.when(F.col("fence") == 1, F.col("n"))
    blocks = rows.where("before > 0").groupBy("k", F.floor((F.col("before") - 1) / 2).alias("pair")).agg(
        F.min(fence).alias("start"), F.max(fence).alias("end"), F.bool_or((F.col("fence") == 0) & (F.col("before") % 2 == 1) & F.col("tree")).alias("has_tree"),
    )
    return blocks.where("end > start").select(F.col("k").alias(key), "start", "end", "has_tree")


def tree_block(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, start, end)`` of each text's first fenced block with a tree."""
    first = F.min_by(F.struct("start", "end"), "start").alias("b")
    return fenced_blocks(lines, key).where("has_tree").groupBy(key).agg(first).select(key, "b.start", "b.end")


def _entry(text: Column) -> tuple[Column, Column, Column, Column]:
    """Of a line: whether it is an entry (a connector after groups of indentation, and a
    name), how many groups, the name, and what stands behind a gap and ``<-`` or ``#``."""
    indent = F.length(F.regexp_extract(text, _GROUPS, 0))
    rest = F.substring(text, indent + 1, F.length(text))
    is_entry = (rest.startswith("├── ") | rest.startswith("└── ")) & (F.length(rest) > 4)
    halves = F.split(F.substring(rest, 6, F.length(rest)), "(?U)\\s{2,}(?:<-|#)", 2)  # a name has a first character before any gap
    name = F.regexp_replace(F.concat(F.substring(rest, 5, 1), halves[0]), "(?U)\\s+$", "")
    return is_entry, F.floor(indent / 4).cast("int"), F.regexp_replace(name, "/+$", ""), F.coalesce(F.get(halves, F.lit(1)), F.lit(""))


def _continued(text: Column) -> Column:
    """What a line that continues a comment says, empty if it doesn't: behind the groups of
    indentation stands white space, which the last group may lend, then text."""
    indent = F.regexp_extract(text, _GROUPS, 0)
    rest = F.substring(text, F.length(indent) + 1, F.length(text))
    return F.when(rest.rlike("(?U)^\\s") | indent.endswith(BLANK), F.regexp_replace(rest, _SPACE, "")).otherwise("")


def _summed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Of each part of a text, what it does to the directories that are open before it, for
    any number of those: its entries, their lowest level, and those that may be open behind it
    as (how many entries before it, level, name). Levels are as if all levels were open before;
    an entry ``i`` is on level ``i`` at most then if none is."""
    for (k, part), own in groupby(rows, key=lambda r: r[:2]):
        entries, lowest, level, held = 0, None, None, []
        for _, _, is_entry, depth, name in own:
            if not is_entry:
                continue
            level = depth if level is None else min(depth, level + 1)
            lowest = level if lowest is None else min(lowest, level)
            while held and min(held[-1][1], held[-1][0]) >= level:
                held.pop()
            held.append((entries, level, name))
            entries += 1
        yield k, part, entries, lowest, held


def _carried(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Of the parts of a text in order: entries before each, and the path of the last."""
    for k, own in groupby(rows, key=lambda r: r[0]):
        before, stack = 0, []
        for i, (_, part, entries, lowest, held) in enumerate(own):
            if i:
                yield k, part, before, stack
            here, size = [], len(stack)
            for one in held:
                level = min(one["level"], size + one["at"])
                while here and here[-1][0] >= level:
                    here.pop()
                here.append((level, one["name"]))
            if entries:
                stack = stack[: min(lowest, size)] + [name for _, name in here]
            before += entries


def _placed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Entries and what continues their comments, each with its entry's number and path. An
    entry deeper than its place allows hangs on the deepest one open."""
    for (k, _), own in groupby(rows, key=lambda r: r[:2]):
        entries, stack, path = 0, [], ""
        for _, _, n, is_entry, depth, name, said, before, open_dirs in own:
            if n is None:
                entries, stack = before, list(open_dirs)
                path = "/".join(stack)
            elif is_entry:
                del stack[depth:]
                stack.append(name)
                entries, path = entries + 1, "/".join(stack)
                yield k, entries, path, n, said
            elif entries and said:
                yield k, entries, path, n, said


def _over(step, columns: list[str], out: StructType):
    """``step`` over the rows of a partition, as ``mapInArrow`` takes it."""
    fields = to_arrow_schema(out)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = step(rows(batches))
        while some := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), fields)], schema=fields)

    return run


def parse_tree(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, relpath, comment)`` that the lines of each text's block document.

    Spacers count for nothing. A line that continues a comment belongs to the entry before it.
    An entry deeper than its place allows hangs on the deepest one open. Of one path's entries
    the last counts. An empty array is an entry without a comment.

    Texts are read in parts, line after line. A part of a longer text begins with the
    directories that are open there: each part is summed up for itself, and the sums of a text,
    a few names for each part, are put together in order.
    """
    text = F.col("text")
    is_entry, depth, name, said = _entry(text)
    said = F.when(is_entry, F.regexp_replace(said, _SPACE, "")).otherwise(_continued(text))
    rows = _parts(lines.where(~spacer(text)), key, is_entry=is_entry, depth=depth, name=name, said=said)
    kind = rows.schema["k"]
    field = lambda name, of: StructField(name, of)
    long = rows.groupBy("k").agg(F.max("part").alias("parts"), F.min("part").alias("first")).where("parts > first").select(F.col("k").alias("of"))
    several = rows.join(long, F.col("k").eqNullSafe(F.col("of")), "left_semi").select("k", "part", "n", "is_entry", "depth", "name")
    sums = StructType([kind, field("part", LongType()), field("entries", LongType()), field("lowest", LongType()), field("held", ArrayType(StructType([field("at", LongType()), field("level", LongType()), field("name", StringType())])))])
    summed = several.repartition("k", "part").sortWithinPartitions("k", "part", "n").mapInArrow(_over(_summed, ["k", "part", "is_entry", "depth", "name"], sums), sums)
    given = StructType([kind, field("part", LongType()), field("before", LongType()), field("open_dirs", ArrayType(StringType()))])
    carried = summed.repartition("k").sortWithinPartitions("k", "part").mapInArrow(_over(_carried, sums.names, given), given)
    every = _with(rows.withColumns({"before": F.lit(None).cast("long"), "open_dirs": F.lit(None).cast("array<string>")}), carried)
    placed = StructType([kind, field("entry", LongType()), field("relpath", StringType()), field("n", LongType()), field("said", StringType())])
    dealt = every.select("k", "part", F.col("n").cast("long").alias("n"), "is_entry", "depth", "name", "said", "before", "open_dirs")
    dealt = dealt.repartition("k", "part").sortWithinPartitions("k", "part", F.asc_nulls_first("n"))
    found = dealt.mapInArrow(_over(_placed, dealt.columns, placed), placed)
    comment = F.array_sort(F.collect_list(F.when(F.col("said") != "", F.struct("n", "said"))))
    entries = found.groupBy("k", "relpath", "entry").agg(F.transform(comment, lambda c: c["said"]).alias("comment"))
    return entries.groupBy(F.col("k").alias(key), "relpath").agg(F.max_by("comment", "entry").alias("comment"))


def make_help(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, target, description, line)`` of ``## text`` lines and the targets they describe.

    A description (not on a text's first line) belongs to the first target that begins a line
    at least two lines below it, before which there is no other target; of several, the first.
    """
    text = F.col("text")
    # The letters of a target's name.
    target = F.regexp_extract(text, "^([A-Za-z_-]+):", 1)
    said = F.when(text.startswith("## ") & (F.col("line_no") > 0), F.substring(text, 4, F.length(text)))
    rows = _running(_parts(lines, key, target=target, description=said, ends=(target != "").cast("long")), "ends", "earlier", itself=False)
    one = rows.groupBy("k", "earlier").agg(
        F.max("target").alias("target"),
        F.max(F.when(F.col("ends") == 1, F.col("n"))).alias("at"),
        F.min(F.when(F.col("description").isNotNull(), F.struct("n", "description"))).alias("d"),
    )
    one = one.where(F.col("d.description").isNotNull() & (F.col("at") - F.col("d.n") >= 2))
    line = F.concat("target", F.repeat(F.lit(" "), F.greatest(F.lit(0), 25 - F.length("target"))), "d.description")
    return one.select(F.col("k").alias(key), "target", "d.description", line.alias("line"))


def splice(lines: DataFrame, block: tuple[int, int], new_lines: DataFrame) -> DataFrame:
    """``(ord, line)``: lines to the opening fence, ``new_lines`` (ord, line), from the closing fence."""
    start, end = block
    before = lines.where(F.col("line_no") <= start).select(F.lit(0).alias("_part"), F.col("line_no").cast("long").alias("_at"), F.col("text").alias("line"))
    middle = new_lines.select(F.lit(1).alias("_part"), F.col("ord").alias("_at"), "line")
    after = lines.where(F.col("line_no") >= end).select(F.lit(2).alias("_part"), F.col("line_no").cast("long").alias("_at"), F.col("text").alias("line"))
    return numbered(before.unionByName(middle).unionByName(after), "_part", "_at").select("ord", "line")
