"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits share a variant within half that radius of both, so
if every fingerprint emits all variants in its half-radius ball, equal variants find all
links. Over all 64 bits and radius 4 a ball has 2081 variants. With ``blocks`` = 3 the same
search runs on each two thirds of the fingerprint instead: by pigeonhole one of the three
choices holds at most 2 of 4 differing bits, half of that is 1, and three balls of 43 or 44
variants (131 rows) do the work of 2081; what collides there is verified on all 64 bits.
``blocks`` = 1 is the search over whole fingerprints; both find the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boughwork.llm.common import settle
from boughwork.llm.graph import connected_components

#: Shingles whose bits are counted at once.
_BLOCK = 1 << 15


def _fingerprint(words: list[bytes], shingle: int, hasher) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, as a signed long."""
    if not words:
        return 0
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()
    span = min(shingle, len(words))
    count = len(words) - span + 1
    bits = np.zeros(64, np.int64)
    for at in range(0, count, _BLOCK):
        upto = min(at + _BLOCK, count)
        hashes = [hasher(text[a:b], 42) for a, b in zip(starts[at:upto], ends[at + span - 1 : upto + span - 1])]
        planes = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += planes.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, hashed: bool = False) -> DataFrame:
    """``(doc_id, fp long)`` of whole texts: A-Z lower-cased, words split at ASCII white space.

    Fewer words than ``shingle`` make one shingle of all of them; null, empty and blank texts
    have fingerprint zero. Repeated rows give repeated rows; other columns are ignored.
    ``hashed`` adds ``text_hash``, which tells texts of one fingerprint apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [_fingerprint((t or "").encode("utf-8").lower().split(), shingle, xxhash.xxh64_intdigest) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), *batch.columns[2:]], ["doc_id", "fp", *["text_hash"] * hashed])

    own = [F.xxhash64("text").alias("text_hash")] * hashed
    return docs.select(F.col("doc_id").cast("long"), "text", *own).mapInArrow(run, "doc_id long, fp long" + ", text_hash long" * hashed)


def block_balls(blocks: int, radius: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each choice of kept blocks: its bit runs ``(start, width)`` and half its radius."""
    if radius % 2 or not 0 <= radius < 64 or not 1 <= blocks <= 8:
        raise ValueError("radius must be even and blocks between 1 and 8")
    if blocks == 1:
        return [([(0, 64)], radius // 2)]
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keep = blocks - 1
    return [
        ([(edges[i], edges[i + 1] - edges[i]) for i in chosen], -(-(radius * keep // blocks) // 2))
        for chosen in combinations(range(blocks), keep)
    ]


def variants(fp: Column, blocks: int, radius: int) -> Column:
    """Array of the half-radius variants of a fingerprint, the choice of blocks in the top bits."""
    out = []
    for choice, (runs, half) in enumerate(block_balls(blocks, radius)):
        packed, at = F.lit(0).cast("long"), 0
        for start, width in runs:
            part = F.shiftrightunsigned(fp, start)
            if width < 64:
                part = part.bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            packed, at = packed.bitwiseOR(F.shiftleft(part, at)), at + width
        if at < 60:
            packed = packed.bitwiseOR(F.lit(choice << 60).cast("long"))
        flips = [sum(1 << b for b in bits) for k in range(half + 1) for bits in combinations(range(at), k)]
        masks = F.array(*[F.lit(f - (1 << 64) if f >> 63 else f).cast("long") for f in flips])
        out.append(_flipped(packed, masks))
    return F.flatten(F.array(*out))


def _flipped(packed: Column, masks: Column) -> Column:
    return F.transform(masks, lambda mask: packed.bitwiseXOR(mask))


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b).view(np.uint64))


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the fingerprints within ``radius`` of each other."""
    left, edges = fps, []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = _close(front[0], left) <= radius
            edges += [(int(x), int(front[0])) for x in left[near]]
            front, left = np.concatenate([front[1:], left[near]]), left[~near]
    return edges


def _find_links(radius: int, bucket: int):
    """Over rows sorted by (key, fp): edges of each bucket, and as ``(fp, null)`` the members
    of buckets larger than ``bucket``, which stream through without being gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held_key, held, large = None, [], False

        def close() -> list[tuple[int, int]]:
            return [] if large or not held else _forest(np.concatenate(held), radius)

        for batch in batches:
            keys, fps = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(keys):
                continue
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(keys)]
            edges: list[tuple[int, int]] = []
            over: list[np.ndarray] = []
            if held_key is not None and keys[0] != held_key:
                edges += close()
                held, large = [], False
            held_key = keys[-1]
            # the batch's first run continues what is held; its last run stays open
            first = fps[starts[0] : ends[0]]
            if large:
                over.append(first)
            else:
                held.append(first)
                if sum(map(len, held)) > bucket:
                    over, held, large = held, [], True
            if len(starts) > 1:
                edges += close()
                held, large = [fps[starts[-1] :]], False
                sizes = ends - starts
                inner = np.arange(1, len(starts) - 1)
                pairs = starts[inner[sizes[inner] == 2]]
                near = pairs[_close(fps[pairs], fps[pairs + 1]) <= radius]
                edges += zip(fps[near + 1].tolist(), fps[near].tolist())
                for i in inner[sizes[inner] > 2]:
                    group = fps[starts[i] : ends[i]]
                    if len(group) > bucket:
                        over.append(group)
                    else:
                        edges += _forest(group, radius)
                if len(held[0]) > bucket:
                    over, held, large = [*over, *held], [], True
            a = [x for x, _ in edges] + [int(x) for part in over for x in part]
            b = [y for _, y in edges] + [None] * (len(a) - len(edges))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)
        if edges := close():
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], schema=schema)

    return run


def links(fps: DataFrame, radius: int = 4, blocks: int = 3, bucket: int = 2048) -> DataFrame:
    """``(a, b)``: enough links between distinct fingerprints to connect all that are linked.

    A bucket (fingerprints with one variant) is verified where it lies; one of more than
    ``bucket`` members is not verified pair by pair. Its members emit their balls over all 64
    bits instead, where sharing a variant proves a link, and each joins its variant's smallest
    member: no link is lost and no pairs are emitted.
    """
    emitted = fps.select(F.explode(variants(F.col("fp"), blocks, radius)).alias("key"), "fp")
    found = emitted.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_find_links(radius, bucket), "a long, b long")
    found = settle(found, "links")
    over = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    edges = found.where("b is not null").distinct()
    if over.isEmpty():
        return edges
    balls = over.select(F.explode(variants(F.col("fp"), 1, radius)).alias("key"), "fp")
    least = balls.groupBy("key").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b <> top")
    stars = balls.join(least.select("key", "b"), "key").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return edges.unionByName(stars.distinct())


def simhash_components(docs: DataFrame, shingle: int = 4, radius: int = 4, blocks: int = 3, bucket: int = 2048) -> DataFrame:
    """``(doc_id, fp long, component_id)`` for each row of ``docs`` (doc_id, text).

    Documents link when their fingerprints differ in at most ``radius`` (even) bits;
    ``component_id`` is the smallest doc_id reachable, the row's own included. Empty texts
    (fingerprint zero) link like any other. Rows with a null doc_id keep their fingerprint;
    they take the component of their fingerprint, null if only null ids carry it. Repeated
    rows come back as often as they came; an empty table gives no rows.
    """
    prints = settle(fingerprints(docs, shingle), "fingerprints")
    reps = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "representatives")
    nodes = connected_components(links(reps.select("fp"), radius, blocks, bucket))
    nodes = settle(nodes.withColumnRenamed("node", "fp"), "nodes")
    roots = nodes.join(reps, "fp").groupBy("component").agg(F.min("rep").alias("root"))
    rooted = nodes.join(roots, "component").select("fp", "root")
    owner = settle(reps.join(rooted, "fp", "left").select("fp", F.coalesce("root", "rep").alias("component_id")), "owners")
    return prints.join(owner, "fp", "left").select("doc_id", "fp", "component_id")


def as_hex(fp: Column) -> Column:
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, blocks: int = 3) -> DataFrame:
    """Keep one row of each SimHash component: the one of its smallest doc_id, with all columns.

    Texts that share a doc_id are judged each on its own; of several in a component with its
    smallest doc_id, the one of the smallest hash stays. Null ids come after all others, so a
    row without an id stays only where no row of its component has one. Rows of one doc_id
    (or of none) and one text are one document, of which one row stays.
    """
    first = (F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    prints = fingerprints(docs, shingle, hashed=True)
    least = settle(prints.groupBy("fp").agg(F.min(F.struct(*first)).alias("row")), "representatives")
    nodes = connected_components(links(least.select("fp"), radius, blocks)).withColumnRenamed("node", "fp")
    keep = least.join(nodes, "fp", "left").groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("row").alias("row"))
    # ids that are never null, so that one shuffle of the texts does for both repeats and the join
    key = ["unnamed", "id", "text_hash"]
    keep = keep.select(F.col("row.unnamed").alias(key[0]), F.coalesce("row.doc_id", F.lit(0)).alias(key[1]), F.col("row.text_hash").alias(key[2]))
    named = docs.select(F.struct("*").alias("row"), F.col("doc_id").isNull().alias(key[0]), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias(key[1]), F.xxhash64("text").alias(key[2]))
    return named.dropDuplicates(key).join(keep, key, "left_semi").select("row.*")
