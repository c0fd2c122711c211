"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows,
run once over each normalised text, hits mapped back to the original text."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boughwork.llm.common import settle
from boughwork.llm.words import NORMAL, normal_words


def item_windows(text: str | None, size: int) -> set[bytes]:
    """All runs of ``size`` words; of fewer words, but not none, the one run of all."""
    words = normal_words(text)
    span = min(size, len(words))
    return {b" ".join(words[i : i + span]) for i in range(len(words) - span + 1)} if words else set()


_automata: dict[tuple[int, int], object] = {}


def _automaton(patterns: list[tuple[str, tuple[str, ...], int]]):
    """This worker's automaton; patterns end and begin with a space so that they match whole words."""
    import ahocorasick

    key = (len(patterns), zlib.crc32("\n".join(p for p, _, _ in patterns).encode("latin-1")))
    if key not in _automata:
        _automata.clear()
        machine = ahocorasick.Automaton()
        for i, (pattern, _, _) in enumerate(patterns):
            machine.add_word(pattern, i)
        machine.make_automaton()
        _automata[key] = machine
    return _automata[key]


def _spans(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as [start, end) in code points of the original text."""
    data = text.encode("utf-8")
    inside = np.frombuffer(data.translate(NORMAL), np.uint8) != 0x20
    edge = np.diff(np.r_[0, inside.view(np.int8), 0])
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)  # code points up to and with a byte
    runs = np.flatnonzero(np.diff(np.r_[0, hit.view(np.int8), 0]))
    return [{"start": int(points[starts[a]] - 1), "end": int(points[ends[b - 1] - 1])} for a, b in zip(runs[::2], runs[1::2])]


def _matches(machine, patterns: list[tuple[str, tuple[str, ...], int]], words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
    """Which words lie in an occurrence (None if there is none), and the ids of its items."""
    found = list(machine.iter((b" " + b" ".join(words) + b" ").decode("latin-1"))) if machine is not None and words else []
    if not found:
        return None, set()
    own: set[str] = set()
    hit = np.zeros(len(words) + 1, np.int64)
    # the space after word i stands at ends[i]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    for end, i in found:
        last = int(np.searchsorted(ends, end))
        hit[last - patterns[i][2] + 1] += 1
        hit[last + 1] -= 1
        own.update(patterns[i][1])
    return np.cumsum(hit)[:-1] > 0, own


_FOUND = "doc_id long, text_hash long, n_words long, runs array<struct<start:int,end:int>>, spans array<struct<start:int,end:int>>, items array<string>"


def _scan(patterns: list[tuple[str, tuple[str, ...], int]], only_hit: bool):
    """Per text: hit words as runs [start, end) of word numbers, the same in code points, items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(patterns) if patterns else None
        pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            counts, runs, spans, items = [], [], [], []
            for text in batch.column(2).to_pylist():
                words = normal_words(text)
                covered, own = _matches(machine, patterns, words)
                counts.append(len(words))
                if covered is not None:
                    turns = np.flatnonzero(np.diff(np.r_[0, covered.view(np.int8), 0])).tolist()
                    runs.append([{"start": x, "end": y} for x, y in zip(turns[::2], turns[1::2])])
                    spans.append(_spans(text, covered))
                else:
                    runs.append([])
                    spans.append([])
                items.append(sorted(own))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(runs, pairs), pa.array(spans, pairs), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "text_hash", "n_words", "runs", "spans", "items"],
            )
            yield out.filter(pa.array([bool(x) for x in runs], pa.bool_())) if only_hit else out

    return run


def _patterns(benchmark: DataFrame, size: int) -> list[tuple[str, tuple[str, ...], int]]:
    owners: dict[bytes, set[str]] = {}
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        for window in item_windows(row["text"], size):
            owners.setdefault(window, set()).add(row["item_id"] or "")
    return [(f" {w.decode('latin-1')} ", tuple(sorted(ids)), w.count(b" ") + 1) for w, ids in sorted(owners.items())]


def _parts(benchmark: DataFrame, size: int, max_bytes: int) -> int:
    """Parts by the bytes of windows, of which each byte of text gives ``size`` at most."""
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(1, -(-int(total) * size // max_bytes))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, max_bytes: int = 8_000_000) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, spans)`` for each row of ``docs`` (doc_id, text).

    ``n_hit`` counts the words inside any occurrence of a window of ``size`` words of a
    benchmark item; ``items`` are the ids (text, sorted) of items with an occurring window;
    ``spans`` the runs of hit words in code points of the original text. Null and empty texts
    have no words; an empty benchmark hits nothing; repeated rows come back as often as they
    came; an item with a null id counts under the empty id. Overlapping and shared windows count once.

    The automaton goes to every task, so its size is checked: a benchmark whose windows take
    more than ``max_bytes`` (an automaton has about 50 bytes for each) is dealt by item into
    parts of at most about that size, each with an automaton and a pass of its own, and the
    passes' runs of hit words are merged by row. The result is the same for any number of parts.
    """
    return _by_row(docs, benchmark, size, max_bytes).drop("text_hash")


def _by_row(docs: DataFrame, benchmark: DataFrame, size: int, max_bytes: int) -> DataFrame:
    """:func:`contamination` with each text's hash."""
    parts = _parts(benchmark, size, max_bytes)
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    if parts == 1:
        found = rows.mapInArrow(_scan(_patterns(benchmark, size), False), _FOUND)
        n_hit = F.aggregate("runs", F.lit(0), lambda a, r: a + r["end"] - r["start"])
        return found.select("doc_id", "text_hash", "n_words", n_hit.cast("long").alias("n_hit"), "items", "spans")
    base = rows.mapInArrow(_scan([], False), _FOUND).select("doc_id", "text_hash", "n_words")
    hits = None
    for part in range(parts):
        share = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        one = rows.mapInArrow(_scan(_patterns(share, size), True), _FOUND).drop("n_words")
        one = settle(one, "hits").dropDuplicates(["doc_id", "text_hash"])  # equal rows have equal hits
        hits = one if hits is None else hits.unionByName(one)
    row = ("doc_id", "text_hash")
    items = hits.groupBy(*row).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # runs of words and their spans lie alike, so what overlaps or touches among the runs is one span
    runs = hits.select(*row, F.explode(F.arrays_zip("runs", "spans")).alias("r")).select(*row, "r.runs.*", F.col("r.spans.start").alias("span_start"), F.col("r.spans.end").alias("span_end"))
    by_row = Window.partitionBy(*row).orderBy("start")
    upto = F.max("end").over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("_new", (upto.isNull() | (F.col("start") > upto)).cast("long"))
    joined = runs.withColumn("run", F.sum("_new").over(by_row.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*row, "run").agg(
        (F.max("end") - F.min("start")).alias("n"), F.struct(F.min("span_start").alias("start"), F.max("span_end").alias("end")).alias("span")
    )
    spans = joined.groupBy(*row).agg(F.sum("n").alias("n_hit"), F.array_sort(F.collect_list("span")).alias("spans"))
    merged = items.join(spans, (items["doc_id"].eqNullSafe(spans["doc_id"])) & (items["text_hash"] == spans["text_hash"])).select(items["doc_id"], items["text_hash"], "items", "n_hit", "spans")
    same = base["doc_id"].eqNullSafe(merged["doc_id"]) & (base["text_hash"] == merged["text_hash"])
    none = F.array().cast("array<string>")
    return base.join(merged, same, "left").select(
        base["doc_id"],
        base["text_hash"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )


def _contaminated(n_hit, n_words):
    """A twentieth of the words or more, of columns or of numbers."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """The digest of :func:`contamination`; contaminated: at least a twentieth of the words hit."""
    found = contamination(docs, benchmark, size)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        _contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def _clean(patterns: list[tuple[str, tuple[str, ...], int]], at_text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(patterns) if patterns else None

        def stays(text: str | None) -> bool:
            words = normal_words(text)
            covered, _ = _matches(machine, patterns, words)
            return covered is None or not _contaminated(int(covered.sum()), len(words))

        for batch in batches:
            yield batch.filter(pa.array([stays(t) for t in batch.column(at_text).to_pylist()], pa.bool_()))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13, max_bytes: int = 8_000_000) -> DataFrame:
    """``docs`` without the rows that :func:`contamination_report` calls contaminated.

    All columns stay; each row is judged by its own text, those with a null doc_id too. With
    one automaton that is done where the row lies; a benchmark with windows over ``max_bytes``
    takes several passes, whose result is joined by row.
    """
    if _parts(benchmark, size, max_bytes) == 1:
        return docs.mapInArrow(_clean(_patterns(benchmark, size), docs.columns.index("text")), docs.schema)
    bad = _by_row(docs, benchmark, size, max_bytes).where(_contaminated(F.col("n_hit"), F.col("n_words")))
    bad = bad.select("doc_id", "text_hash").distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["text"]) == bad["text_hash"])
    return docs.join(bad, same, "left_anti")
