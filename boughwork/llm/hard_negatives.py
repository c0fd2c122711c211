"""Hard negatives by norm-bucketed search: rows a score window away from an anchor's positives."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boughwork.llm.common import settle

#: Rows of a bucket; buckets of the first wave; anchors that a task scores at once, or that a
#: first-wave group holds.
_BUCKET, _SEEDS, _CHUNK, _SLICE = 2048, 8, 256, 16_384
_LEAST, _MOST = -(1 << 62), 1 << 62
_ROW = np.dtype([("at", "<i8"), ("id", "<i8"), ("null", "?"), ("label", "<i8"), ("norm", "<f8")])
_PACKED = "part int, bucket int, top double, rows binary, vectors binary"
_FOUND = "at long, window int, score long, found_at long, found_id long"


def quantised(embeddings: DataFrame, scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """``(at, id, label, vector, norm)``, written down: each component times ``scale``, rounded
    down; ``at`` numbers the rows.

    Rows with a null label or vector, or a component that is null or not finite, take no part.
    """
    own = F.col("label") if label is None else label
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(own.isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    small = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = rows.select(F.col(key).cast("long").alias("id"), own.cast("long").alias("label"), small.alias("vector"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return settle(rows.select(F.monotonically_increasing_id().alias("at"), "id", "label", "vector", norm.alias("norm")), "vectors")


def _matrix(vectors: pa.ListArray, width: int, kind: str) -> np.ndarray:
    """Rows of ``width`` numbers; shorter vectors end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy()
    out = np.zeros((len(vectors), width), kind)
    out[np.repeat(np.arange(len(vectors)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _records(batch: pa.RecordBatch) -> np.ndarray:
    out = np.zeros(batch.num_rows, _ROW)
    ids = batch.column("id")
    out["at"], out["label"], out["norm"] = (batch.column(c).to_numpy() for c in ("at", "label", "norm"))
    out["id"], out["null"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
    return out


def _pack(width: int, kind: str):
    """Buckets of a partition's rows, which come by falling norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, bucket = TaskContext.get().partitionId(), 0
        rows, vectors = np.zeros(0, _ROW), np.zeros((0, width), kind)

        def table(n: int) -> pa.RecordBatch:
            own = [[part], [bucket], [rows["norm"][0]], [rows[:n].tobytes()], [vectors[:n].tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(own, (pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary()))], ["part", "bucket", "top", "rows", "vectors"])

        for batch in batches:
            rows, vectors = np.r_[rows, _records(batch)], np.r_[vectors, _matrix(batch.column("vector"), width, kind)]
            while len(rows) >= _BUCKET:
                yield table(_BUCKET)
                rows, vectors, bucket = rows[_BUCKET:], vectors[_BUCKET:], bucket + 1
        if len(rows):
            yield table(len(rows))

    return run


class _Best:
    """The first ``k`` of each query's candidates, of all that were offered."""

    def __init__(self, queries: int, k: int):
        self._k, self._pool = k, np.zeros((5, 0), np.int64)  # query, score, null, id, at
        self.floor = np.full(queries, _LEAST)  # a score that a candidate must reach

    def offer(self, query: np.ndarray, score: np.ndarray, rows: np.ndarray) -> None:
        if not len(query):
            return
        pool = np.concatenate([self._pool, np.stack([query, score.astype(np.int64), rows["null"].astype(np.int64), rows["id"], rows["at"]])], axis=1)
        pool = pool[:, np.lexsort((pool[4], pool[3], pool[2], -pool[1], pool[0]))]
        starts = np.flatnonzero(np.r_[True, pool[0, 1:] != pool[0, :-1]])
        rank = np.arange(pool.shape[1]) - np.repeat(starts, np.diff(np.r_[starts, pool.shape[1]]))
        last = rank == self._k - 1
        self.floor[pool[0, last]] = pool[1, last]
        self._pool = pool[:, rank < self._k]

    def table(self, at: np.ndarray, windows: int) -> pa.RecordBatch:
        query, score, null, found, place = self._pool
        columns = [pa.array(at[query // windows]), pa.array((query % windows).astype(np.int32)), pa.array(score), pa.array(place), pa.array(found, mask=null.astype(bool))]
        return pa.RecordBatch.from_arrays(columns, ["at", "window", "score", "found_at", "found_id"])


def _search(width: int, kind: str, reach: float, k: int, same_label: bool):
    """Best candidates, in a group's buckets, of each of its anchors: the buckets come first.

    Buckets are searched by falling norm. An anchor leaves those whose largest norm times its
    own lies under what every window of it still needs: its lower limit, or its kth score.
    """
    exact = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64

    def chunk(anchors: list[dict], buckets: list[tuple[float, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        own = np.concatenate([np.frombuffer(a["rows"], _ROW) for a in anchors])
        vectors = np.stack([np.frombuffer(a["vectors"], kind) for a in anchors]).astype(exact)
        windows = max(len(a["low"]) for a in anchors)
        low, high = np.full((len(anchors), windows), _MOST), np.full((len(anchors), windows), _LEAST)
        for i, a in enumerate(anchors):
            low[i, : len(a["low"])], high[i, : len(a["low"])] = a["low"], a["high"]
        best = _Best(low.size, k)
        for top, rows, matrix in buckets:
            need = np.maximum(low, best.floor.reshape(low.shape))
            live = np.flatnonzero(own["norm"] * top * (1 + 1e-9) + 1e-6 >= need.min(axis=1))
            if not len(live):
                break
            scores = vectors[live] @ matrix.T
            fits = own["label"][live, None] == rows["label"]
            fits = fits & (own["at"][live, None] != rows["at"]) if same_label else ~fits
            for w in range(windows):
                i, j = np.nonzero(fits & (scores >= need[live, w, None]) & (scores <= high[live, w, None]))
                best.offer(live[i] * windows + w, scores[i, j], rows[j])
        return best.table(own["at"], windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, buckets, waiting = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != group or len(waiting) == _CHUNK:
                    if waiting and buckets:
                        yield chunk(waiting, buckets)
                    waiting = []
                if row["group"] != group:
                    group, buckets = row["group"], []
                if row["low"] is None:
                    buckets.append((row["top"], np.frombuffer(row["rows"], _ROW), np.frombuffer(row["vectors"], kind).reshape(-1, width).astype(exact)))
                else:
                    waiting.append(row)
        if waiting and buckets:
            yield chunk(waiting, buckets)

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """Adds ``rank`` from 1, of the first ``k`` of each anchor's window. A group holds at most
    ``k`` rows for each group of buckets."""
    order = Window.partitionBy("at", "window").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found_at")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class NormIndex:
    """Rows of :func:`quantised` by falling norm, in buckets; a written table.

    ``part_rows`` is at most what a task holds of them. Small tables are dealt to as many
    tasks as there are cores.
    """

    def __init__(self, rows: DataFrame, part_rows: int = 262_144):
        n, norm, width, size = rows.agg(F.count("*"), F.coalesce(F.max("norm"), F.lit(0.0)), F.coalesce(F.max(F.size("vector")), F.lit(0)), F.coalesce(F.max(F.array_max(F.transform("vector", F.abs))), F.lit(0))).first()
        self.reach = norm * norm * (1 + 1e-9)
        if self.reach >= 1 << 59:
            raise ValueError("scores must stay under 2^59")
        self.width, self.kind = max(1, width), "<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<i8"
        self.part_rows = part_rows
        parts = max(-(-n // part_rows), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // (_BUCKET * 2))), 1)
        order = (F.desc("norm"), F.asc("at"))
        self.packed = settle(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_pack(self.width, self.kind), _PACKED), "buckets")
        #: The largest norm of each part, falling.
        self.tops = [r["top"] for r in self.packed.groupBy("part").agg(F.max("top").alias("top")).orderBy("part").collect()]

    def anchors(self, rows: DataFrame) -> DataFrame:
        """``rows`` (of :func:`quantised`, with arrays ``low`` and ``high``) as the search takes them."""
        width, kind = self.width, self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own, vectors = _records(batch), _matrix(batch.column("vector"), width, kind)
                data = [pa.array([r.tobytes() for r in own], pa.binary()), pa.array([v.tobytes() for v in vectors], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("norm"), *data, batch.column("low"), batch.column("high")], ["at", "norm", "rows", "vectors", "low", "high"])

        return rows.select("at", "id", "label", "vector", "norm", "low", "high").mapInArrow(run, "at long, norm double, rows binary, vectors binary, low array<long>, high array<long>")

    def _run(self, buckets: DataFrame, anchors: DataFrame, groups: int, k: int, same_label: bool) -> DataFrame:
        none = F.lit(None).cast("array<long>")
        rows = buckets.select("group", "part", "bucket", "top", "rows", "vectors", none.alias("low"), none.alias("high"))
        rows = rows.unionByName(anchors.select("group", F.lit(None).cast("int").alias("part"), F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("double").alias("top"), "rows", "vectors", "low", "high"))
        dealt = rows.repartitionById(max(1, groups), F.col("group").cast("int")).sortWithinPartitions("group", F.asc_nulls_last("part"), "bucket")
        return dealt.drop("part", "bucket").mapInArrow(_search(self.width, self.kind, self.reach, k, same_label), _FOUND)

    def best(self, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
        """``(at, window, rank from 1, score, found_at, found_id)``: for each window (``low`` to
        ``high``) of each anchor its first ``k`` rows of the same label, itself left out, or of
        different labels; by falling score, then by id (null last).

        The buckets of the largest norms give each window a kth score; an anchor then goes to
        the parts that can still reach it or its lower limit. Of many parts, about the root of
        their number comes first, whose kth scores spare the others most of their answers.
        """
        own = settle(self.anchors(anchors), "anchors")
        n, parts = own.count(), len(self.tops)
        seed = (F.col("part") == 0) & (F.col("bucket") < _SEEDS)
        spread = lambda slices: F.pmod(F.xxhash64("at"), F.lit(slices))
        each = lambda first, last: F.explode(F.sequence(first.cast("long"), last.cast("long")))
        slices = max(1, -(-n // _SLICE))
        found = self._run(self.packed.where(seed).withColumn("group", each(F.lit(0), F.lit(slices - 1))), own.withColumn("group", spread(slices)), slices, k, same_label)
        found = settle(_first(found, k), "first")
        slices = max(1, -(-n // max(self.part_rows, _SLICE)))
        buckets = self.packed.where(~seed).withColumn("group", each(F.col("part") * slices, F.col("part") * slices + slices - 1))
        cuts = [0, math.isqrt(parts), parts] if parts > 8 else [0, parts]
        for begin, end in zip(cuts, cuts[1:]):
            kth = found.where(F.col("rank") == k).groupBy("at").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
            known = F.when(F.col("kth").isNull(), F.col("low")).otherwise(F.transform("low", lambda low, w: F.greatest(low, F.coalesce(F.element_at("kth", w), low))))
            rest = own.join(kth, "at", "left").withColumn("low", known).drop("kth")
            reached = F.size(F.filter(F.lit(self.tops[:end]).cast("array<double>"), lambda top: F.col("norm") * top * (1 + 1e-9) + 1e-6 >= F.array_min("low")))
            part = F.explode(F.filter(F.sequence(F.lit(begin), F.greatest(reached, F.lit(begin + 1)) - 1), lambda p: p < reached))
            rest = rest.withColumn("part_of", part).withColumn("group", F.col("part_of") * slices + spread(slices))
            own_buckets = buckets.where((F.col("part") >= begin) & (F.col("part") < end))
            more = self._run(own_buckets, rest, parts * slices, k, same_label)
            found = settle(_first(found.drop("rank").unionByName(more), k), "found")
        return found.select("at", "window", "rank", "score", "found_at", "found_id")


def hard_negatives(embeddings: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90, label: Column | None = None) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of
    ``embeddings`` (vec_id, embedding, label).

    Vectors are :func:`quantised`; a score is an integer inner product, over the components
    that both vectors have. ``is_anchor`` is an expression over the row's ``vec_id``; ``label``
    one over vec_id and label. An anchor's positives are its first ``positives`` other rows of
    the same label; for each, the first ``negatives`` rows of another label whose score lies
    between the two percentages of the positive's, ends included, are ranked from 1. Order:
    higher score, then smaller id (null ids last, then where rows lie). Each row counts as
    itself: rows that share a vec_id are anchors, positives and negatives each on its own. A
    positive of a negative score, and one without such rows, gives none; nor does an empty
    table. ValueError if scores may reach 2^59. Other columns don't matter.
    """
    rows = quantised(embeddings, label=label)
    index = NormIndex(rows)
    chosen = rows.withColumnRenamed("id", "vec_id").where(F.coalesce(is_anchor, F.lit(False))).withColumnRenamed("vec_id", "id")
    whole = lambda x: F.array(F.lit(x).cast("long"))
    near = index.best(chosen.withColumns({"low": whole(_LEAST), "high": whole(_MOST)}), positives, True)
    near = near.where("score >= 0").withColumns({"low": F.expr(f"({low_percent} * score + 99) div 100"), "high": F.expr(f"{high_percent} * score div 100")})
    windows = near.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("rank", "found_id", "score", "low", "high"))).alias("positive"))
    windows = settle(chosen.join(windows, "at").select("at", "id", "label", "vector", "norm", "positive"), "windows")
    asked = windows.select("at", "id", "label", "vector", "norm", F.transform("positive", lambda p: p["low"]).alias("low"), F.transform("positive", lambda p: p["high"]).alias("high"))
    found = index.best(asked, negatives, False)
    own = windows.select("at", F.col("id").alias("anchor_id"), F.posexplode("positive").alias("window", "p"))
    out = found.join(own, ["at", "window"])
    return out.select("anchor_id", F.col("p.found_id").alias("positive_id"), "rank", F.col("found_id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
