"""Token ids in files of bit-plane-shuffled blocks.

A dataset is a folder of Parquet files written by Spark, one row a block, so that a lost
executor's unfinished files are never read and any store Spark can write will do. A row is
the block's entry of the chunk index (shard, block, count, the documents that it holds and
where they lie) and ``payload``: the file format proper, see :func:`pack_block`.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boughwork.llm.common import scratch_path, settle
from boughwork.llm.tokens import default_vocabulary, encoder

_MAGIC = b"BPB1"
_HEAD = struct.Struct("<4sBBHII")  # magic, bits or bytes, planes, 0, ids, crc32 of the ids


def pack_block(ids: np.ndarray, bit_planes: bool = True, level: int = 1) -> bytes:
    """A block of unsigned 32-bit ids as planes, each compressed with zstandard on its own.

    Header, then the compressed length of each plane (unsigned 32-bit), then the planes,
    lowest first. A plane holds one bit (or byte) of every id; planes above the largest id's
    highest bit are left out.
    """
    import zstandard

    ids = np.ascontiguousarray(ids, "<u4")
    top = int(ids.max()).bit_length() if len(ids) else 0
    octets = ids.view(np.uint8).reshape(-1, 4)
    if bit_planes:
        bits = np.unpackbits(octets[:, : -(-top // 8)], axis=1, bitorder="little")[:, :top] if top else octets[:, :0]
        planes = [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(top)]
    else:
        planes = [octets[:, i].tobytes() for i in range(-(-top // 8))]
    squeeze = zstandard.ZstdCompressor(level=level)
    packed = [squeeze.compress(p) for p in planes]
    head = _HEAD.pack(_MAGIC, 1 if bit_planes else 8, len(packed), 0, len(ids), zlib.crc32(ids.tobytes()))
    return b"".join([head, struct.pack(f"<{len(packed)}I", *map(len, packed)), *packed])


def unpack_block(data: bytes) -> np.ndarray:
    """The ids of :func:`pack_block`; ValueError if the data is damaged."""
    import zstandard

    magic, width, count, _, n, crc = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a block of token ids")
    sizes = struct.unpack_from(f"<{count}I", data, _HEAD.size)
    at, planes = _HEAD.size + 4 * count, []
    expand = zstandard.ZstdDecompressor()
    for size in sizes:
        planes.append(np.frombuffer(expand.decompress(data[at : at + size]), np.uint8))
        at += size
    octets = np.zeros((n, 4), np.uint8)
    if width == 1 and planes:
        bits = np.zeros((n, 8 * -(-count // 8)), np.uint8)
        for i, plane in enumerate(planes):
            bits[:, i] = np.unpackbits(plane, count=n, bitorder="little")
        octets[:, : bits.shape[1] // 8] = np.packbits(bits, axis=1, bitorder="little")
    else:
        for i, plane in enumerate(planes):
            octets[:, i] = plane
    ids = octets.reshape(-1).view("<u4")
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("a block of token ids is damaged")
    return ids


#: A document in a block's index entry: ``start`` counts ids from the shard's first, and may
#: lie before the block; ``n_tokens`` is the whole document's.
_DOC = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_BLOCK_FIELDS = [("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int32()), ("docs", pa.list_(_DOC)), ("payload", pa.binary())]
SCHEMA = "shard int, block long, first long, n_ids int, docs array<struct<doc_id:long,start:long,n_tokens:long>>, payload binary"


def _write(vocabulary: str, end_id: int, block_ids: int, bit_planes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, shard = encoder(vocabulary).encode, TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        pending, held, docs, first, total, block = [np.zeros(0, "<u4")], 0, [], 0, 0, 0

        def emit(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pending, held, docs, first, block
            data = np.concatenate(pending)
            at = 0
            while len(data) - at >= block_ids or final and at < len(data):
                ids = data[at : at + block_ids]
                upto = first + len(ids)
                inside = [d for d in docs if d["start"] < upto]
                row = [[shard], [block], [first], [len(ids)], [inside], [pack_block(ids, bit_planes)]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(row, _BLOCK_FIELDS)], [n for n, _ in _BLOCK_FIELDS])
                docs = [d for d in docs if d["start"] + d["n_tokens"] > upto]
                first, at, block = upto, at + len(ids), block + 1
            pending = [data[at:].copy()]
            held = len(data) - at

        for batch in (whole.slice(i, 2500) for whole in batches for i in range(0, whole.num_rows, 2500)):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                n = len(ids) + 1
                docs.append({"doc_id": doc_id, "start": total, "n_tokens": n})
                pending += [ids, end]
                total, held = total + n, held + n
                if held >= 4 * block_ids:
                    yield from emit(False)
        yield from emit(True)

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2, block_ids: int = 65536, bit_planes: bool = True, shards: int | None = None, shard_bytes: int = 128_000_000) -> None:
    """Encode whole texts of ``docs`` (doc_id, text) and write them in ascending doc_id order.

    Every document's ids are followed by ``end_id``; null and empty texts have that id alone.
    A null doc_id sorts first; rows of one doc_id are ordered by their text's hash, equal rows
    stay as many as they are. Shards are ranges of doc_id in order, ``shards`` of them or as
    many as shuffle partitions, but none of much over ``shard_bytes`` of text; within one,
    documents follow each other across blocks of ``block_ids`` ids. An empty table writes no block.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] if not shards else 0
    count = shards or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    order = ["doc_id", "tie", "at"]  # where a row lies parts equal rows
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("at"))
    ranged = rows.repartitionByRange(count, *order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(_write(vocabulary or default_vocabulary(), end_id, block_ids, bit_planes), SCHEMA).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document in a block: its place there, and its ids if it lies in several blocks."""
    for batch in batches:
        out = {k: [] for k in ("shard", "doc_id", "start", "n_tokens", "ids_crc32", "piece_at", "piece")}
        for shard, first, docs, payload in zip(*(batch.column(i).to_pylist() for i in (0, 2, 4, 5))):
            data = unpack_block(payload).tobytes()
            upto = first + len(data) // 4
            for d in docs:
                a, b = max(d["start"], first), min(d["start"] + d["n_tokens"], upto)
                piece = data[4 * (a - first) : 4 * (b - first)]
                whole = b - a == d["n_tokens"]
                for k, v in zip(out, (shard, d["doc_id"], d["start"], d["n_tokens"], zlib.crc32(piece) if whole else None, a, None if whole else piece)):
                    out[k].append(v)
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, from the files.

    ``start`` counts the ids of all documents before it. Blocks are read wherever they lie;
    only documents that cross a block's edge are put together again, a document's own pieces
    at a time.
    """
    blocks = spark.read.schema(SCHEMA).parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids")).collect()  # one row a shard
    before, offsets = 0, []
    for row in sorted(shards):
        offsets.append((row["shard"], before))
        before += row["ids"]
    offset = spark.createDataFrame(offsets, "shard int, before long")
    parts = blocks.mapInArrow(_read, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long, piece_at long, piece binary")
    parts = settle(parts, "parts")  # each block is decoded once
    done = parts.where("piece is null").select("shard", "doc_id", "start", "n_tokens", "ids_crc32")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("piece_at", "piece"))), lambda x: x["piece"])
    crossing = parts.where("piece is not null").groupBy("shard", "start", "doc_id", "n_tokens").agg(pieces.alias("pieces"))
    joined = F.unhex(F.array_join(F.transform("pieces", F.hex), ""))
    crossing = crossing.select("shard", "doc_id", "start", "n_tokens", F.crc32(joined).alias("ids_crc32"))
    whole = done.unionByName(crossing).join(F.broadcast(offset), "shard")
    return whole.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, vocabulary: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the files to the shared folder and report what they hold."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, end_id)
    return read_documents(docs.sparkSession, path)
