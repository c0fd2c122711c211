"""Spelling variants: words one inserted, deleted or replaced letter apart, by two-dimensional
range reporting.

Words of one length are points: their place in forward order against their place in reverse
order. Those that agree with a word but at one position lie in a rectangle, the interval of its
prefix before that position by the interval of its suffix behind it, which a wavelet tree reports.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boughwork.llm.common import discard, settle

#: Words of a shard; letters, and so about positions, of the words searched at once.
_SHARD, _LETTERS = 131_072, 400_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DEALT = pa.schema([("group", pa.int32()), ("kind", pa.int8()), ("size", pa.int32()), ("length", pa.int32()), ("word", pa.string()), ("n", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])
_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def word_counts(docs: DataFrame, least_length: int = 7, least_n: int = 2, every: int = 31) -> DataFrame:
    """``(word, n)``: runs of letters of whole texts, A-Z lower-cased, of ``least_length`` code
    points or more that occur ``least_n`` times or more.

    Where ``every`` divides the crc32 of ``<doc_id>:<run>``, the run first loses the letter at
    that number modulo its length. A null doc_id is written as nothing; null texts have no runs.
    """
    runs = F.regexp_extract_all(F.translate(F.col("text"), _UPPER, _LOWER), F.lit(f"[a-zÀ-ÿ]{{{least_length},}}"), 0)
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    hashed = run.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).where(F.length("word") >= least_length)
    return counted.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


class WaveletTree:
    """Of a permutation of 0 to n - 1: which values in [c, d) stand in places [a, b)."""

    def __init__(self, values: np.ndarray):
        self._levels = max(1, int(len(values) - 1).bit_length()) if len(values) else 1
        self._zeros: list[np.ndarray] = []  # at each level, zeros before a place
        for level in reversed(range(self._levels)):
            bit = values >> level & 1
            self._zeros.append(np.r_[0, np.cumsum(1 - bit)])
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def report(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value) of all that the rectangles hold; queries go down the levels together."""
        query, node = np.arange(len(a)), np.zeros(len(a), np.int64)
        for level, zeros in zip(reversed(range(self._levels)), self._zeros):
            a0, b0 = zeros[a], zeros[b]
            a, b = np.r_[a0, zeros[-1] + a - a0], np.r_[b0, zeros[-1] + b - b0]
            query, node = np.r_[query, query], np.r_[2 * node, 2 * node + 1]
            low = node << level
            keep = (a < b) & (low < d[query]) & (low + (1 << level) > c[query])
            a, b, query, node = a[keep], b[keep], query[keep], node[keep]
        return query, node


class _Order:
    """Words of one length in order, and of each prefix the interval of those that begin with it."""

    def __init__(self, letters: np.ndarray):
        self._letters = letters
        self._keys: list[np.ndarray] = []
        self._groups = [np.zeros(len(letters), np.int64)]

    def intervals(self, words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """First and end, for each word and each prefix of 0 to ``depth`` letters; 0, 0 if none."""
        first, end = np.zeros((2, len(words), depth + 1), np.int32)
        end[:, 0] = len(self._letters)
        live, group = np.arange(len(words)), np.zeros(len(words), np.int64)
        for i in range(depth):
            if len(self._keys) == i:
                keys = self._groups[i] << 8 | self._letters[:, i]
                self._keys.append(keys)
                self._groups.append(np.cumsum(np.r_[0, keys[1:] != keys[:-1]]))
            own = group << 8 | words[live, i]
            a, b = np.searchsorted(self._keys[i], own), np.searchsorted(self._keys[i], own, "right")
            found = a < b
            live, a, b = live[found], a[found], b[found]
            if not len(live):
                break
            first[live, i + 1], end[live, i + 1] = a, b
            group = self._groups[i + 1][a]
        return first, end


def _sorted(letters: np.ndarray) -> np.ndarray:
    """Places of the rows in the order of their bytes."""
    return np.ascontiguousarray(letters).view(f"S{letters.shape[1]}").ravel().argsort(kind="stable")


class _Points:
    """Words of one length, as a shard holds them: forward and reverse order, and the tree."""

    def __init__(self, letters: np.ndarray, n: np.ndarray):
        order = _sorted(letters)
        self.letters, self.n = letters[order], n[order]
        self.by_end = _sorted(self.letters[:, ::-1])
        self.rank = np.empty(len(order), np.int64)
        self.rank[self.by_end] = np.arange(len(order))
        self._forward, self._reverse = _Order(self.letters), _Order(self.letters[self.by_end, ::-1])
        self._tree = WaveletTree(self.rank)

    def near(self, words: np.ndarray, low: np.ndarray, high: np.ndarray, mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
        """(word, row) one edit apart, the edit at a position of ``low`` to ``high``: a letter
        replaced, or, in rows a letter longer, inserted (of a run of equal letters, its first)."""
        length, size = words.shape[1], self.letters.shape[1]
        first, end = self._forward.intervals(words, length)
        start, stop = self._reverse.intervals(words[:, ::-1], length)
        back = length - np.arange(length + 1) - (size == length)  # letters behind each position
        start, stop = start[:, back], stop[:, back]
        at = np.arange(length + 1)
        some = (first < end) & (start < stop) & (at >= low[:, None]) & (at <= high[:, None])
        if size == length:  # a word's own row, which is alone in an interval where no other agrees so far
            some[:, length] = False
            own, last = first[:, length], end[:, length]
            some &= (own == last)[:, None] | (end - first > 1) & (stop - start > 1)
        word, i = np.nonzero(some)
        query, rank = self._tree.report(first[word, i].astype(np.int64), end[word, i].astype(np.int64), start[word, i].astype(np.int64), stop[word, i].astype(np.int64))
        word, i, row = word[query], i[query], self.by_end[rank]
        if size == length:
            keep = self.letters[row, i] != words[word, i]
        elif mirrored:
            keep = (i == length) | (self.letters[row, i] != words[word, np.minimum(i, length - 1)])
        else:
            keep = (i == 0) | (self.letters[row, i] != words[word, i - 1])
        return word[keep], row[keep]


def _best(key: np.ndarray, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, how often each occurs, and where its largest n lies (ties: the smallest rank)."""
    order = np.lexsort((rank, -n, key))
    starts = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    return key[order[starts]], np.diff(np.r_[starts, len(key)]), order[starts]


def _report(shards: int):
    """Near words of a shard's queries, and of its own words among them; a row for each batch.

    A shard's words come first, then its queries by size, length and word. Shards from
    ``shards`` on hold words that are dealt by their ends, so all is reversed there.
    """

    def letters(words: list[str], back: bool) -> np.ndarray:
        flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
        return np.ascontiguousarray(flat[:, ::-1]) if back else flat

    def search(points: _Points, rows: dict[str, list], back: bool) -> pa.RecordBatch:
        words, n = rows["word"], np.array(rows["n"], np.int64)
        own = letters(words, back)
        length, size = own.shape[1], points.letters.shape[1]
        low, high = np.array(rows["low"]), np.array(rows["high"])
        if back:
            low, high = length - (size == length) - high, length - (size == length) - low
        query, row = points.near(own, low, high, back)
        if not len(query):
            return pa.RecordBatch.from_pylist([], _NEAR)

        def name(at: np.ndarray) -> list[str]:
            found = points.letters[at]
            text = (found[:, ::-1] if back else found).tobytes().decode("latin-1")
            return [text[i : i + size] for i in range(0, len(text), size)]

        key, count, best = _best(query, points.n[row], points.rank[row] if back else row)
        out = [[words[k] for k in key], count, points.n[row[best]], name(row[best])]
        if size > length:  # the longer words see the shorter ones here alone
            key, count, best = _best(row, n[query], query)
            out = [out[0] + name(key), np.r_[out[1], count], np.r_[out[2], n[query[best]]], out[3] + [words[k] for k in query[best]]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _NEAR)], schema=_NEAR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, back = -1, False
        own: dict[int, tuple[list[str], list[int]]] = {}
        points: tuple[int, _Points | None] = (-1, None)
        rows: dict[str, list] = {"word": [], "n": [], "low": [], "high": []}
        task = (-1, -1)  # size and length of the queries that wait

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal points, rows
            size = task[0]
            if rows["word"] and size in own:
                if points[0] != size:
                    points = (size, _Points(letters(own[size][0], back), np.array(own[size][1], np.int64)))
                yield search(points[1], rows, back)
            rows = {k: [] for k in rows}

        for batch in batches:
            for where, kind, size, length, word, n, low, high in zip(*(batch.column(f.name).to_pylist() for f in _DEALT)):
                if where != group or kind and ((size, length) != task or len(rows["word"]) * (length + 1) >= _LETTERS):
                    yield from flush()
                if where != group:
                    group, back, own, points = where, where >= shards, {}, (-1, None)
                if kind:
                    task = (size, length)
                    for column, value in zip(rows.values(), (word, n, low, high)):
                        column.append(value)
                else:
                    held = own.setdefault(size, ([], []))
                    held[0].append(word)
                    held[1].append(n)
        yield from flush()

    return run


class _Shards:
    """Which shards an interval of an order meets. ``firsts``: a shard's first (length, word)."""

    def __init__(self, firsts: list[tuple[int, bytes]]):
        self._firsts = firsts[1:]

    def of(self, size: int, start: bytes) -> tuple[int, int]:
        """First and last of those with words of ``size`` letters that begin with ``start``."""
        return bisect_right(self._firsts, (size, start)), bisect_right(self._firsts, (size, start + b"\xff" * (size - len(start))))


def _deal(forward: list[tuple[int, bytes]], reverse: list[tuple[int, bytes]], shards: int):
    """Each word to its shard in both orders, and as a query to those that may hold near words.

    Up to some position the interval of the suffix behind it meets fewer shards, from there on
    that of the prefix before it; each position is asked in the order where it meets fewer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead, behind = _Shards(forward), _Shards(reverse)
        for batch in batches:
            out: list[tuple] = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own, length = word.encode("latin-1"), len(word)
                back = own[::-1]
                out.append((ahead.of(length, own)[0], 0, length, length, word, n, 0, 0))
                out.append((shards + behind.of(length, back)[0], 0, length, length, word, n, 0, 0))
                for size in (length, length + 1):
                    last = size - 1  # positions are 0 to last
                    split = (last + 1) // 2
                    if split:
                        a, b = ahead.of(size, own[:split]), behind.of(size, back[: last - split + 1])
                        if a[0] < a[1] or b[0] < b[1]:
                            fewer = lambda i: (lambda x, y: x[1] - x[0] <= y[1] - y[0])(ahead.of(size, own[:i]), behind.of(size, back[: last - i]))
                            split, end = 0, last + 1
                            while split < end:  # from which position on the prefix meets fewer
                                middle = (split + end) // 2
                                split, end = (split, middle) if fewer(middle) else (middle + 1, end)
                    if split <= last:
                        a = ahead.of(size, own[:split])
                        out += [(s, 1, size, length, word, n, split, last) for s in range(a[0], a[1] + 1)]
                    if split:
                        b = behind.of(size, back[: last - split + 1])
                        out += [(shards + s, 1, size, length, word, n, 0, split - 1) for s in range(b[0], b[1] + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * len(_DEALT), _DEALT)], schema=_DEALT)

    return run


def near_words(words: DataFrame, shard_words: int = _SHARD) -> DataFrame:
    """``(word, n, n_near, best_n, best)`` of ``words`` (word, n; distinct, of U+0000 to U+00FF):
    how many others differ by one inserted, deleted or replaced letter, and of those the one of
    largest n (ties: the first in code-point order), null if there is none.

    Shards are ranges of the forward and of the reverse order, by length first. The driver holds
    the first word of each.
    """
    n, cores = words.count(), words.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-n // shard_words), min(cores, n // 4096))

    def firsts(word: str) -> list[tuple[int, bytes]]:
        keyed = words.select(F.length("word").alias("length"), F.expr(word).alias("key")).repartitionByRange(shards, "length", "key")
        found = keyed.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("length", "key")).alias("f")).select("f.*").collect()
        return sorted((r["length"], r["key"].encode("latin-1")) for r in found)

    forward, reverse = firsts("word"), firsts("reverse(word)")
    shards = max(len(forward), len(reverse), 1)
    dealt = words.select("word", "n").mapInArrow(_deal(forward, reverse, shards), "group int, kind byte, size int, length int, word string, n long, low int, high int")
    dealt = dealt.repartitionById(2 * shards, "group").sortWithinPartitions("group", "kind", "size", "length", "word")
    found = dealt.mapInArrow(_report(shards), "word string, n_near long, best_n long, best string")
    none = F.lit(None)
    every = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("long").alias("best_n"), none.cast("string").alias("best"))
    every = every.unionByName(found.select("word", none.cast("long").alias("n"), "n_near", "best_n", "best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("b")))).alias("best")
    merged = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n", "n_near", (-F.col("best.m")).alias("best_n"), F.col("best.b").alias("best"))


def spelling_variants(docs: DataFrame, ratio: int = 10, shard_words: int = _SHARD) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the :func:`word_counts` of ``docs`` (doc_id, text).

    A word's form is the most frequent near word (:func:`near_words`), if that occurs ``ratio``
    times as often or more; its root is the last of the forms that follow one another. As counts
    grow by ``ratio`` at each, there are few, and roots come by doubling. No words give no rows.
    """
    words = settle(word_counts(docs), "words")
    near = near_words(words, shard_words)
    far = F.col("best_n") >= ratio * F.col("n")
    judged = settle(near.select("word", "n", "n_near", F.when(far, F.col("best")).alias("form"), F.when(far, F.col("best_n")).alias("form_n")), "near")
    most = judged.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    hops, doubled = len(str(most)), 1
    root = judged.where("form is not null").select("word", F.col("form").alias("root"))
    before: list[DataFrame] = []
    while doubled < hops:
        root = settle(root, "roots")
        discard(*before)
        before = [root]
        above = root.select(F.col("word").alias("_above"), F.col("root").alias("_root"))
        root = root.join(above, F.col("root") == F.col("_above"), "left").select("word", F.coalesce("_root", "root").alias("root"))
        doubled *= 2
    out = judged.join(root, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
