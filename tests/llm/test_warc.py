import hashlib
import zlib

import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from boughwork.llm import warc
from tests.llm.sql import assert_query_equals_sql


def brute(rows, least=100):
    data = [(p, (h or "").encode()) for p, _, h in rows]
    first = {}
    for p, payload in data:
        if p is not None:
            first[payload] = min(p, first.get(payload, p))
    out = []
    for p, payload in data:
        of = first.get(payload) if len(payload) >= least else None
        again = of is not None and p != of
        out.append((p, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", of if again else None))
    return sorted(out, key=str)


def test_query_equals_sql(spark, sf_dir):
    assert_query_equals_sql(spark, sf_dir, "op12_warc_index")


def test_revisits_nulls_and_hot_urls(spark, monkeypatch):
    monkeypatch.setattr(warc, "_LINES", 3)
    monkeypatch.setattr(warc, "_ARCHIVE", 4000)
    monkeypatch.setattr(warc, "_SPAN", 700)
    big, other = "é" * 50, "<p>\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(i, "http://hot.example.org/", big) for i in range(60)]
    rows += [(100 + i, f"https://h{i % 7}.example.org/p/{i}?a=b", other + str(i % 5)) for i in range(40)]
    rows += [(200, None, None), (201, "", ""), (202, "no scheme\twith a tab", "e" * 99), (203, "http://a/\r\nX: y", "e" * 99), (None, "http://a/", big), (None, None, "only null ids " * 20), (None, None, "only null ids " * 20), (3, "http://b/", big), (0, "http://b/", big), (204, "HTTP://U@Hot.Example.ORG:80/", "long " * 100_000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    pages = table.withColumns({"digest": F.lit(1), "first": F.lit(2), "payload": F.lit("x"), "refers_to": F.lit(0), "key": F.lit("k")})
    found = warc.archive_round_trip(pages)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_look_up_reads_what_is_asked_for(spark):
    rows = [(i, f"http://h{i % 9}.org/{i % 50}", f"text {i} " * 20) for i in range(400)]
    archive = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    asked = spark.createDataFrame([("http://h3.org/3",), ("http://H3.org:80/3#x",), ("http://nowhere.org/",), (None,)], "url string")
    got = archive.captures(asked)
    assert {(r["key"], r["page_id"]) for r in got.collect()} == {("org,h3)/3", i) for i, url, _ in rows if url == "http://h3.org/3"}
    records = archive.records(got).collect()
    assert sorted(r["payload_digest"] for r in records) == sorted(hashlib.sha256(h.encode()).hexdigest() for _, url, h in rows if url == "http://h3.org/3")


def test_archives_hold_standard_records(spark):
    rows = [(1, "http://a.org/x", "p" * 100), (2, "http://a.org/y", "p" * 100)]
    archive = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), date="2020-01-01T00:00:00Z")
    store, root = pyarrow.fs.FileSystem.from_uri(archive.archives)
    whole = b""
    for found in store.get_file_info(pyarrow.fs.FileSelector(root)):
        data = store.open_input_file(found.path).read()
        while data:
            member = zlib.decompressobj(31)
            whole += member.decompress(data)
            data = member.unused_data
    records = [x for x in whole.split(b"\r\n\r\nWARC/1.1\r\n")]
    assert len(records) == 2 and records[0].startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")
    first, second = (dict(line.split(": ", 1) for line in r.decode().split("\r\n\r\n")[0].split("\r\n") if ": " in line) for r in records)
    assert (first["WARC-Type"], second["WARC-Type"]) == ("response", "revisit")
    assert second["WARC-Refers-To"] == first["WARC-Record-ID"] and second["WARC-Payload-Digest"] == first["WARC-Payload-Digest"]
    assert first["WARC-Target-URI"] == "http://a.org/x" and first["WARC-Date"] == "2020-01-01T00:00:00Z"


@pytest.mark.parametrize("url,key", [("http://www.Example.org:8080/a?b#c", "org,example,www)/a?b"), ("x://u:p@h/", "h)/"), (None, ")"), ("a b", ")/a%20b"), ("http://h?q", "h)?q")])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_damaged_records_are_refused():
    data = warc.record(1, "http://a/", b"payload", hashlib.sha256(b"payload").hexdigest(), None, "2020-01-01T00:00:00Z")
    headers, block = warc.parse_record(data)
    assert headers["Page-ID"] == "1" and block.endswith(b"payload")
    short = zlib.decompress(data, 31)[:-2]
    packer = zlib.compressobj(wbits=31)
    with pytest.raises(ValueError):
        warc.parse_record(packer.compress(short) + packer.flush())
