"""Lexical retrieval packing: BM25 neighbours fill the window of each seed document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boughwork.llm.common import settle
from boughwork.llm.tokens import default_vocabulary, encoder

#: BM25's usual constants.
K1, B = 1.2, 0.75

#: Ids of a partition of the shuffle, about; and keys of a document there.
_PARTITION_IDS, _KEYS = 4_000_000, 2


@dataclass
class Statistics:
    """Of a whole corpus: documents, their mean length, and by term the documents that hold it."""

    documents: int
    mean: float
    df: np.ndarray

    def idf(self, terms: np.ndarray | slice = slice(None)) -> np.ndarray:
        df = self.df[terms]
        return np.log1p((self.documents - df + 0.5) / (df + 0.5))


class Bm25Index:
    """Inverted index of one shard: postings by term, weights as BM25 gives them.

    Without ``statistics`` the shard is the corpus."""

    def __init__(self, docs: list[np.ndarray], statistics: Statistics | None = None):
        lengths = np.array([len(d) for d in docs], np.float64)
        owner = np.repeat(np.arange(len(docs)), lengths.astype(np.int64))
        terms = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
        pairs, counts = np.unique(terms << 32 | owner, return_counts=True)
        self._owner = (pairs & 0xFFFFFFFF).astype(np.int64)
        own_terms = pairs >> 32
        self._terms, self._starts = np.unique(own_terms, return_index=True)
        self._ends = np.r_[self._starts[1:], len(pairs)]
        df = self._ends - self._starts
        if statistics:
            idf, mean = statistics.idf(self._terms), statistics.mean
        else:
            idf, mean = Statistics(len(docs), 0.0, df).idf(), lengths.mean() if docs else 0.0
        norm = K1 * (1 - B + B * lengths / max(mean, 1.0))
        self._weight = np.repeat(idf, df) * counts * (K1 + 1) / (counts + norm[self._owner])
        # a document's own terms are its query; those of a quarter of the documents or more lie in full rows
        self._row = np.where(4 * df >= len(docs), np.cumsum(4 * df >= len(docs)) - 1, -1)
        own_rows = np.repeat(self._row, df)
        self._dense = np.zeros((int(self._row.max(initial=-1)) + 1, len(docs)))
        self._dense[own_rows[own_rows >= 0], self._owner[own_rows >= 0]] = self._weight[own_rows >= 0]
        by_doc = np.argsort(self._owner, kind="stable")
        self._query_terms = np.repeat(np.arange(len(self._terms)), df)[by_doc]
        self._query_starts = np.searchsorted(self._owner[by_doc], np.arange(len(docs) + 1))
        self._size = len(docs)

    def neighbours(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that share a term with the seed, scored with all of its terms."""
        a, b = self._query_starts[seed : seed + 2]
        terms = self._query_terms[a:b]
        rows = self._row[terms]
        scores = self._dense[rows[rows >= 0]].sum(axis=0)
        rare = terms[rows < 0]
        if len(rare):
            sizes = self._ends[rare] - self._starts[rare]
            at = np.arange(sizes.sum()) + np.repeat(self._starts[rare] - np.cumsum(sizes) + sizes, sizes)
            scores += np.bincount(self._owner[at], self._weight[at], self._size)
        found = np.flatnonzero(scores)  # every weight is above zero
        return found, scores[found]


def retrieval_order(docs: list[np.ndarray], window: int, marks: int = 0, statistics: Statistics | None = None) -> list[int]:
    """All documents in packing order; the last ``marks`` ids of each are no terms.

    The first unused document is a seed: its unused neighbours follow, best score first
    (ties: the earlier document), until the window is full. The window's last document, whose
    rest opens the next window, is the next seed. A seed whose neighbours are used up hands
    over to the first unused document.
    """
    index = Bm25Index([d[: len(d) - marks] for d in docs], statistics)
    free = np.ones(len(docs), bool)
    order: list[int] = []
    filled = first = 0
    seed: int | None = None

    def take(i: int) -> int:
        free[i] = False
        order.append(i)
        return filled + len(docs[i])

    while len(order) < len(docs):
        if seed is None:
            while not free[first]:
                first += 1
            seed = first
            filled = take(seed)
        if filled < window:
            found, scores = index.neighbours(seed)
            unused = free[found]
            found, scores = found[unused], scores[unused]
            for i in found[np.lexsort((found, -scores))].tolist():
                filled = take(i)
                if filled >= window:
                    break
        if filled >= window:
            filled %= window
            seed = order[-1]
        else:
            seed = None
    return order


_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]


def _encode(vocabulary: str):
    """(doc_id, n, ids): ids of ``n`` numbers, of two bytes each where those are enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in (whole.slice(i, 2500) for whole in batches for i in range(0, whole.num_rows, 2500)):
            docs = encode(batch.column(1))
            data = [d.astype("<u2" if d.max(initial=0) < 1 << 16 else "<u4").tobytes() for d in docs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, docs), pa.int64()), pa.array(data, pa.binary())], ["doc_id", "n", "ids"])

    return run


def _decode(n: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}" if n else "<u4")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df) of a partition's documents."""
    df, last = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    for batch in batches:
        for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = _decode(n, data)
            if n and (more := int(ids.max()) + 1 - len(df)) > 0:
                df, last = (np.r_[x, np.zeros(more, np.int64)] for x in (df, last))
            place = np.arange(n)
            last[ids] = place
            df[ids[last[ids] == place]] += 1  # each term where it stands last
    terms = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(df[terms], pa.int64())], ["term", "df"])


def corpus_statistics(encoded: DataFrame) -> Statistics:
    """Of all rows of ``encoded`` (n, ids). The driver gets a row for each term of the vocabulary."""
    documents, ids = encoded.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows = encoded.select("n", "ids").mapInArrow(_count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(max((r["term"] for r in rows), default=0) + 1, np.int64)
    df[[r["term"] for r in rows]] = [r["df"] for r in rows]
    return Statistics(documents, ids / max(1, documents), df)


def _keyed(held):
    """Adds keys by which documents of like terms lie together. Two documents share a key with
    a probability of their common idf over their joint idf (weighted min-hash, over the terms
    that two documents or more hold); -1 if there is no such term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        draws = np.random.default_rng(17).exponential(size=(_KEYS, len(own.df))) / own.idf()
        draws[:, own.df < 2] = np.inf
        by_draw = draws.argsort(axis=1)
        rank = by_draw.argsort(axis=1)
        drawn = int((own.df >= 2).sum())
        for batch in batches:
            n, data = batch.column(1).to_numpy(), batch.column(2).to_pylist()
            keys = np.full((_KEYS, batch.num_rows), -1, np.int64)
            full = np.flatnonzero(n)
            for part in np.array_split(full, 1 + int(n.sum()) // 2_000_000):
                if len(part):
                    ids = np.concatenate([_decode(n[i], data[i]) for i in part])
                    starts = np.cumsum(n[part]) - n[part]
                    for k in range(_KEYS):
                        least = np.minimum.reduceat(rank[k][ids], starts)
                        keys[k, part] = np.where(least < drawn, by_draw[k][least], -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, keys)], ["doc_id", "n", "ids", "at", *(f"key{k}" for k in range(_KEYS))])

    return run


def _pack(counted, window: int, end_id: int, shard_ids: int, with_ids: bool):
    fields = _FIELDS if with_ids else _FIELDS[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        statistics, base = counted.value, TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4")
        shard: list[tuple[int | None, np.ndarray]] = []
        held = 0
        left: list[tuple[int | None, int, int, np.ndarray]] = []  # pieces that don't fill a window yet
        left_ids = sequence = 0

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in _FIELDS]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

        def place(pieces: list[tuple[int | None, int, int, np.ndarray]], rows: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc_id, start, total, ids in pieces:
                data = ids.tobytes()
                rows.append((doc_id, start, len(ids), zlib.crc32(data), total, base + sequence, offset, data))
                offset += len(ids)
            sequence += 1

        def cut(pieces, size: int):
            """The first ``size`` ids of the pieces, and the rest."""
            head, n = [], 0
            for i, (doc_id, start, total, ids) in enumerate(pieces):
                if n + len(ids) >= size:
                    k = size - n
                    rest = [(doc_id, start + k, total, ids[k:])] if k < len(ids) else []
                    return [*head, (doc_id, start, total, ids[:k])], [*rest, *pieces[i + 1 :]]
                head.append(pieces[i])
                n += len(ids)
            return head, []

        def fill() -> pa.RecordBatch:
            nonlocal shard, held, left, left_ids
            rows: list[tuple] = []
            for i in retrieval_order([ids for _, ids in shard], window, 1, statistics):
                doc_id, ids = shard[i]
                left.append((doc_id, 0, len(ids), ids))
                left_ids += len(ids)
                while left_ids >= window:
                    head, left = cut(left, window)
                    place(head, rows)
                    left_ids -= window
            shard, held = [], 0
            return table(rows)

        for batch in batches:
            for doc_id, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                shard.append((doc_id, np.concatenate([_decode(n, data).astype("<u4"), end])))
                held += len(shard[-1][1])
                if held >= shard_ids:
                    yield fill()
        yield fill()
        rows: list[tuple] = []
        while left_ids:  # what is left goes to sequences of powers of two, which need no padding
            size = 1 << (left_ids.bit_length() - 1)
            head, left = cut(left, size)
            place(head, rows)
            left_ids -= size
        yield table(rows)

    return run


def pack_documents(docs: DataFrame, vocabulary: str | None = None, window: int = 1024, end_id: int = 0, shard_ids: int = 1_000_000, with_ids: bool = False) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) in sequences of at most ``window`` (a power of two) ids.

    A document is its ids and ``end_id``; null and empty texts have that id alone. The ids
    are written once; document count, mean length and the documents of each term are counted
    over all of them. A shuffle sorts documents by lexical keys (:func:`_keyed`), then by where
    they lay, which parts even a group of like documents. Documents gather in this order to a
    shard of about ``shard_ids`` ids, whose BM25 index (terms are token ids; a query is all
    terms of a document, without ``end_id``; weights are those of the whole corpus) orders
    them, and the order is cut into windows. Neighbours in another shard are not found: the
    README has the measured recall; with ``shard_ids`` of the corpus's ids or more there is
    one shard, and the search is exact. A window that a
    shard leaves open goes on with the next shard; a partition's last ids become sequences of
    powers of two, so no sequence needs padding. ``sequence_id`` is unique, ``offset`` gapless
    from 0. Null doc_ids and repeated rows are documents of their own; an empty table gives
    no rows. ``with_ids`` adds the ids, as little-endian unsigned 32-bit integers.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    encoded = settle(rows.mapInArrow(_encode(vocabulary or default_vocabulary()), "doc_id long, n long, ids binary"), "ids")
    statistics = corpus_statistics(encoded)
    held = docs.sparkSession.sparkContext.broadcast(statistics)
    keys = [f"key{k}" for k in range(_KEYS)]
    keyed = encoded.withColumn("at", F.monotonically_increasing_id())
    keyed = keyed.mapInArrow(_keyed(held), "doc_id long, n long, ids binary, at long, " + ", ".join(f"{k} long" for k in keys))
    parts = 1 + int(statistics.documents * (statistics.mean + 1)) // max(_PARTITION_IDS, shard_ids)
    dealt = keyed.repartitionByRange(parts, *keys, "at").sortWithinPartitions(*keys, "at")
    return dealt.select("doc_id", "n", "ids").mapInArrow(_pack(held, window, end_id, shard_ids, with_ids), schema)
