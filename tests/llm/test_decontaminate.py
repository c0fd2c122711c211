import hashlib
import re

import pytest
from pyspark.sql import functions as F

from boughwork.llm import decontaminate, queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items, size=13):
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        span = min(size, len(words))
        for i in range(len(words) - span + 1) if words else ():
            windows.setdefault(tuple(words[i : i + span]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if own := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(words)))
    return out


@pytest.mark.parametrize("max_bytes", [8_000_000, 40_000])
def test_tables_equal_brute_force(spark, sf_dir, max_bytes):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    got = decontaminate.contamination(docs, bench, max_bytes=max_bytes)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["items"])) for r in got.collect()}
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert got == {d: (n, h, k) for d, n, h, k, _, _ in want}
    assert any(h for _, _, h, _, _, _ in want)


def test_query_equals_sql(spark):
    import duckdb

    sf_dir = "/root/testdata/sf0.01"
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = duck.execute(queries.oracle_sql()["op9_benchmark_decontamination"])
    names = [d[0] for d in want.description]
    got = queries.op9_benchmark_decontamination(spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_report_spans_and_edges(spark):
    words = "Alpha béta gamma1 delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()
    items = [(1, " ".join(words)), (2, "Short Item"), (3, None), (4, "..."), (2, "short item"), (5, "xi xi xi")]
    docs = [(1, "Ünx, " + "; ".join(w.upper() if w.isascii() else w for w in words[1:]) + "!"), (2, None), (3, ""), (4, "a short—item"), (5, "a SHORT item"), (6, "short items"), (None, "short item"), (7, "xi xi xi xi"), (8, "w " * 60000 + "short item")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit(0)).withColumn("items", F.lit(0))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, decontaminate.contamination_report(df, bench).collect()), key=str)
    assert got == sorted(brute(docs, items), key=str)
    spans = {r["doc_id"]: [docs[0][1][s["start"] : s["end"]] for s in r["spans"]] for r in decontaminate.contamination(df, bench).collect() if r["doc_id"] == 1}
    assert len(spans[1]) == 1 and spans[1][0].startswith("béta") and spans[1][0].endswith("XI")
    assert decontaminate.contamination_report(df.limit(0), bench).count() == 0
    assert decontaminate.contamination_report(df, bench.limit(0)).where("n_hit > 0").count() == 0
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "4", "6", "8"]


def test_spans_are_the_same_for_any_number_of_parts(spark):
    """Windows of different items overlap, touch and lie apart; a single part sees them together."""
    words = [f"w{i}" for i in range(60)]
    items = [(1, " ".join(words[:20])), (2, " ".join(words[6:22])), (3, " ".join(words[12:28])), (4, " ".join(words[28:41])), (5, " ".join(words[45:58]))]
    docs = [(1, "Ä, " + "; ".join(words) + "."), (1, "é " + " ".join(words[:30])), (None, " ".join(words[10:])), (2, "clean"), (3, None), (1, "é " + " ".join(words[:30]))]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")

    def found(max_bytes):
        return sorted(map(str, decontaminate.contamination(df, bench, max_bytes=max_bytes).collect()))

    assert found(8_000_000) == found(1500) == found(300)
    spans = [[docs[0][1][s["start"] : s["end"]] for s in r["spans"]] for r in decontaminate.contamination(df, bench, max_bytes=300).collect() if r["n_words"] == 61]
    assert spans == [["; ".join(words[:41]), "; ".join(words[45:58])]]


@pytest.mark.parametrize("max_bytes", [8_000_000, 260])
def test_rows_of_one_id_are_judged_each_on_its_own(spark, max_bytes):
    items = [(1, "short item"), (2, "another one"), (3, None)]
    rows = [(1, "a short item"), (1, "clean"), (1, "a short item"), (2, None), (2, "another one here"), (3, ""), (3, ""), (None, "short item"), (None, "fine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_hit", F.lit(7)).withColumn("text_hash", F.lit(7))
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), max_bytes=max_bytes)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, "clean"), (2, None), (3, ""), (3, ""), (None, "fine")], key=str)
