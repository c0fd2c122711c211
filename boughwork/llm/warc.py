"""WARC archives of pages, and a two-level capture index over them.

Tasks write archives and index files straight to the shared folder, through ``pyarrow.fs``,
each under a name of its attempt; what they return names the files, so those of lost attempts
are never read.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boughwork.llm.common import scratch_path, settle

#: Bytes of an archive before the next one begins; lines of an index block; bytes that one
#: range read spans at most; bytes that a task reads, about; rows that it hands over at once.
_ARCHIVE, _LINES, _SPAN, _READ, _BATCH = 1 << 30, 1000, 8 << 20, 64 << 20, 2000
#: The WARC format's words for a revisit of an equal payload.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURE = "key string, page_id long, file string, offset long, length long"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI, as pyarrow reads it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _plain(text: str) -> str:
    """``text`` on one line: spaces and control characters as percent escapes."""
    return "".join(quote(c) if ord(c) <= 0x20 or ord(c) == 0x7F else c for c in text)


def url_key(url: str | None) -> str:
    """The reversed host, ``)``, and path and query as they stand: ``org,example,www)/a?b``.

    Scheme, user, port and fragment don't count, and hosts are lower-cased. A null url and one
    without ``://`` have an empty host.
    """
    scheme, found, rest = (url or "").partition("://")
    if not found:
        rest = "/" + scheme if scheme else ""
    rest = rest.partition("#")[0]
    cut = min((i for i in map(rest.find, "/?") if i >= 0), default=len(rest))
    host = rest[:cut].rpartition("@")[2].lower()
    name, colon, port = host.rpartition(":")
    host = name if colon and port.isdigit() else host
    return _plain(",".join(reversed(host.split("."))) + ")" + rest[cut:])


def with_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """``(page_id, url, payload, digest, refers_to)``: of equal payloads of ``least_bytes`` or
    more, all but those of the smallest page_id refer to it.

    Rows that share the smallest page_id are all responses, as are rows of a group that has
    null ids only; other null ids are revisits. The groups of two or more are written down: a
    join broadcasts them where their files are small, and else shuffles and splits hot ones.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    many = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    many = settle(many.where("n > 1 and first is not null").select("digest", "first"), "revisited")
    joined = rows.join(many, "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A WARC record, compressed on its own. A revisit has no payload, but its length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _record_id(page_id, digest), "WARC-Date": date, "WARC-Payload-Digest": f"sha256:{digest}"}
    if url:
        head["WARC-Target-URI"] = _plain(url)
    if page_id is not None:
        head["Page-ID"] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": _record_id(refers_to, digest), "Refers-To-Page-ID": str(refers_to)}
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    packer = zlib.compressobj(2, zlib.DEFLATED, 31)
    return packer.compress(lines.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one compressed record. ValueError if it isn't whole."""
    whole = zlib.decompress(data, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if first != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return headers, block


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * len(schema), schema)], schema=schema)


_CAPTURES = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, out, at, done = "", None, 0, []
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        store.create_dir(root)
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], date)
                    out.write(data)
                    done.append((url_key(row["url"]), row["page_id"], name, at, len(data)))
                    at += len(data)
                    if at >= _ARCHIVE:
                        out = out.close()
                    if len(done) == _BATCH:
                        yield _batch(done, _CAPTURES)
                        done = []
        finally:
            if out is not None:
                out.close()
        if done:
            yield _batch(done, _CAPTURES)

    return run


def _index(folder: str):
    """Files of compressed blocks of lines, each with its directory of the blocks' first keys."""
    fields = pa.schema([("first", pa.string()), ("last", pa.string()), ("file", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, out, at, lines, directory, key = f"{uuid.uuid4().hex}.cdx", None, 0, [], [], ""

        def close_block() -> None:
            nonlocal at, lines
            data = zlib.compress("\n".join(lines).encode("utf-8", "surrogatepass"), 6)
            out.write(data)
            directory.append((lines[0].partition("\t")[0], at, len(data)))
            at, lines = at + len(data), []

        for batch in batches:
            for key, page_id, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    store.create_dir(root)
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                lines.append(f"{key}\t{'' if page_id is None else page_id}\t{file}\t{offset}\t{length}")
                if len(lines) == _LINES:
                    close_block()
        if out is not None:
            if lines:
                close_block()
            data = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(data)
            out.write(at.to_bytes(8, "little") + len(data).to_bytes(8, "little"))
            out.close()
            yield _batch([(directory[0][0], key, name)], fields)

    return run


class _IndexFile:
    """An index file, of which the directory is held, and the block read last."""

    def __init__(self, store: pyarrow.fs.FileSystem, path: str):
        self._file = store.open_input_file(path)
        size = self._file.size()
        self._file.seek(size - 16)
        tail = self._file.read(16)
        at, length = (int.from_bytes(tail[i : i + 8], "little") for i in (0, 8))
        self._blocks = json.loads(zlib.decompress(self._read(at, length)))
        self._firsts = [key for key, _, _ in self._blocks]
        self._held: tuple[int, list[list[str]], list[str]] = (-1, [], [])

    def _read(self, at: int, length: int) -> bytes:
        self._file.seek(at)
        return self._file.read(length)

    def close(self) -> None:
        self._file.close()

    def _block(self, i: int) -> tuple[list[list[str]], list[str]]:
        if self._held[0] != i:
            _, at, length = self._blocks[i]
            lines = [x.split("\t") for x in zlib.decompress(self._read(at, length)).decode("utf-8", "surrogatepass").split("\n")]
            self._held = (i, lines, [x[0] for x in lines])
        return self._held[1:]

    def captures(self, key: str) -> Iterator[tuple]:
        """All of ``key``: from the last block that begins before it, on to one that begins after."""
        for i in range(max(0, bisect_left(self._firsts, key) - 1), bisect_right(self._firsts, key)):
            lines, keys = self._block(i)
            for _, page_id, file, offset, length in lines[bisect_left(keys, key) : bisect_right(keys, key)]:
                yield key, int(page_id) if page_id else None, file, int(offset), int(length)


def _find(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, index, found = "", None, []
        for batch in batches:
            for file, key in zip(batch.column("file").to_pylist(), batch.column("key").to_pylist()):
                if file != name:
                    if index:
                        index.close()
                    name, index = file, _IndexFile(store, f"{root}/{file}")
                for capture in index.captures(key):
                    found.append(capture)
                    if len(found) == _BATCH:
                        yield _batch(found, _CAPTURES)
                        found = []
        if found:
            yield _batch(found, _CAPTURES)

    return run


def _read(folder: str):
    fields = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def row(data: bytes) -> tuple:
        headers, block = parse_record(data)
        kind, told = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(line.partition(b":")[2]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length:"))
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != told):
            raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
        number = lambda name: int(headers[name]) if name in headers else None
        return number("Page-ID"), size, told, kind, number("Refers-To-Page-ID")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, archive = "", None
        for batch in batches:
            todo, rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")))), []
            while todo:
                file, begin, length = todo[0]
                end, n = begin + length, 1
                while n < len(todo) and todo[n][0] == file and todo[n][1] == end and end - begin < _SPAN:
                    end, n = end + todo[n][2], n + 1
                if file != name:
                    if archive:
                        archive.close()
                    name, archive = file, store.open_input_file(f"{root}/{file}")
                archive.seek(begin)
                data = archive.read(end - begin)
                rows += [row(data[at - begin : at - begin + size]) for _, at, size in todo[:n]]
                todo = todo[n:]
            yield _batch(rows, fields)
        if archive:
            archive.close()

    return run


@dataclass
class Archive:
    """Archives and their capture index. ``files``: of each index file the first and the last
    key and its name, in order; a few bytes for what a whole task has sorted. ``bytes`` is the
    size of all records."""

    spark: SparkSession
    archives: str
    indexes: str
    files: list[tuple[str, str, str]]
    bytes: int

    def captures(self, urls: DataFrame, url: str = "url") -> DataFrame:
        """``(key, page_id, file, offset, length)`` of the captures of each distinct key of
        ``urls``. A key is searched in the list of files, goes to those that may hold it, there
        to the blocks by their directory, and only those are read."""
        files, folder = self.files, self.indexes
        lasts = [last for _, last, _ in files]

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for key in set(map(url_key, batch.column(0).to_pylist())):
                    i = bisect_left(lasts, key)
                    while i < len(files) and files[i][0] <= key:
                        rows.append((files[i][2], key))
                        i += 1
                yield _batch(rows, pa.schema([("file", pa.string()), ("key", pa.string())]))

        dealt = urls.select(F.col(url).cast("string")).mapInArrow(deal, "file string, key string").distinct()
        order = ("file", "key")
        return dealt.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_find(folder), _CAPTURE)

    def records(self, captures: DataFrame) -> DataFrame:
        """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of captures, by
        range reads in the order of the archives; neighbours are read together."""
        order, cores = ("file", "offset"), self.spark.sparkContext.defaultParallelism
        parts = max(1, -(-self.bytes // _READ), min(cores, self.bytes >> 20))  # by what they lead to, not by their own size
        dealt = captures.select("file", "offset", "length").repartitionByRange(parts, *order).sortWithinPartitions(*order)
        return dealt.mapInArrow(_read(self.archives), _RECORD)


def write_archive(pages: DataFrame, least_bytes: int = 100, date: str | None = None) -> Archive:
    """Write ``pages`` (page_id, url, html) as WARC records (:func:`with_revisits`) and index them.

    A null html is an empty payload, a null url has the key ``)``. Repeated rows are records of
    their own. An empty table gives no files. Index files are ranges of the sorted keys, cut
    between the captures of one key too, so a hot url is dealt out.
    """
    spark = pages.sparkSession
    archives, indexes = _folder(spark, "warc"), _folder(spark, "cdx")
    date = date or f"{datetime.datetime.now(datetime.timezone.utc):%Y-%m-%dT%H:%M:%SZ}"
    captures = settle(with_revisits(pages, least_bytes).mapInArrow(_write(archives, date), _CAPTURE), "captures")
    order = ("key", "page_id", "file", "offset")
    sorted_lines = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    files = settle(sorted_lines.mapInArrow(_index(indexes), "first string, last string, file string"), "files")
    size = captures.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return Archive(spark, archives, indexes, sorted((r["first"], r["last"], r["file"]) for r in files.collect()), size)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as an archive, look every url up in its index, and read the records back."""
    archive = write_archive(pages)
    return archive.records(archive.captures(pages))
