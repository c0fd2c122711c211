import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from boughwork.llm import decontaminate, quality_fm, secret_scan, simhash
from boughwork.llm.common import fold
from boughwork.llm.tokens import default_vocabulary
from tests.llm.test_decontaminate import brute
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_stages_hold_to_their_operators(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = pipeline.quality(spark, docs, sf_dir)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    single = pipeline.near_duplicates(spark, docs, sf_dir)
    groups = simhash.simhash_components(docs)
    assert single.columns == docs.columns
    assert {r["doc_id"] for r in single.collect()} == {r["component_id"] for r in groups.collect()}
    clean = pipeline.decontaminated(spark, docs, sf_dir)
    bad = decontaminate.contamination_report(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated")
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in bad.collect()}
    masked = pipeline.without_secrets(spark, docs, sf_dir)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert masked.where(F.col("n_chars") != F.length("text")).count() == 0


def test_run_packs_what_is_kept(spark, sf_dir):
    rows = pipeline.run(spark, sf_dir).collect()
    totals = {}
    for r in rows:
        totals.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    assert totals
    for pieces in totals.values():
        assert sum(n for _, n, _ in pieces) == pieces[0][2]


def test_empty_and_odd_documents(spark, sf_dir):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 500, None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("x"))
    for table in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES[:-1]:
            assert stage(spark, table, sf_dir).columns == docs.columns
            assert stage(spark, table, sf_dir).count() <= table.count()
        name, packed = pipeline.STAGES[-1]
        pieces = packed(spark, table, sf_dir).collect()
        assert sum(r["start"] == 0 for r in pieces) == table.count() and all(r["length"] > 0 for r in pieces)


def test_null_ids_are_filtered_by_content(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rows = [(None, item), (None, item), (7, item), (None, "a clean text of a few words"), (None, "a clean text of a few words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [tuple(r) for r in pipeline.decontaminated(spark, docs, sf_dir).collect()] == rows[3:]
    assert sorted(map(tuple, pipeline.near_duplicates(spark, docs, sf_dir).collect()), key=str) == sorted([(7, item), rows[3]], key=str)


def test_run_equals_plain_stages(spark, sf_dir):
    """Each stage's decisions taken plainly, one after the other, on the same table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    held_out = fold(F.col("doc_id"), 4) == 2
    good = {r["doc_id"] for r in quality_fm.quality_scores(docs, labels, held_out).where("score >= 0.7").collect()}
    rows = {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect() if r["doc_id"] in good}
    alone = set(brute_components({d: brute_fingerprint(t) for d, (t, _) in rows.items()}).values())
    judged = brute([(d, rows[d][0]) for d in sorted(alone)], [(r["item_id"], r["text"]) for r in bench.collect()])
    kept = [d for d, *_, bad in judged if not bad]
    forest = secret_scan.train(secret_scan.labelled_findings())
    ids = Tokenizer.from_file(default_vocabulary())
    want = {}
    for d in kept:
        text, source = rows[d]
        for start, end, _, score in reversed(secret_scan.judge(text, source, forest)):
            text = text[:start] + "<SECRET>" + text[end:] if score >= 0.5 else text
        own = np.array([*ids.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want[d] = (len(own), own.tobytes())
    pieces = {}
    for r in pipeline.run(spark, sf_dir).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == want.keys()
    for d, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            piece = want[d][1][4 * at : 4 * (at + r["length"])]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, want[d][0], zlib.crc32(piece))
            at += r["length"]
        assert at == want[d][0]
