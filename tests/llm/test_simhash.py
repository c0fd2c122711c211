import random
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from boughwork.llm import simhash


def brute_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    span = min(n, len(words))
    shingles = [b" ".join(words[i : i + span]) for i in range(len(words) - span + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=4):
    """doc_id -> smallest doc_id reachable."""
    owner = {d: d for d in fps}

    def root(d):
        while owner[d] != d:
            d = owner[d]
        return d

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                owner[y] = x
    return {d: root(d) for d in ids}


def result(df):
    return {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in df.collect()}


def test_documents_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = result(simhash.simhash_components(docs))
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    assert {d: fp for d, (fp, _) in got.items()} == fps
    assert {d: c for d, (_, c) in got.items()} == brute_components(fps)
    assert len(set(brute_components(fps).values())) < len(fps)


@pytest.mark.parametrize("blocks,bucket", [(3, 2048), (1, 2048), (2, 2048), (3, 5)])
def test_links_connect_what_brute_force_links(spark, blocks, bucket):
    rng = random.Random(7)
    fps = [rng.getrandbits(64) for _ in range(30)]
    for base in fps[:12]:
        for k in (1, 2, 3, 4, 5, 6):
            fps.append(base ^ sum(1 << b for b in rng.sample(range(64), k)))
    for _ in range(40):  # one crowded ball, over the smallest bucket
        fps.append(fps[0] ^ sum(1 << b for b in rng.sample(range(20), 2)))
    fps = sorted(set(fps))
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    edges = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.links(table, 4, blocks, bucket).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    want, got = brute_components(dict(enumerate(fps))), defaultdict(set)
    at = {x: i for i, x in enumerate(fps)}
    for a, b in edges:
        got[at[a]].add(at[b])
        got[at[b]].add(at[a])
    for start in range(len(fps)):
        seen, front = {start}, [start]
        while front:
            new = got[front.pop()] - seen
            seen |= new
            front += new
        assert min(seen) == want[start]


def test_edge_cases(spark):
    rows = [(1, ""), (2, None), (3, " \n\t"), (4, "one"), (4, "one"), (5, "ONE"), (None, "one"), (None, "only here"), (6, "word " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    got = sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in simhash.simhash_components(docs).collect()), key=str)
    one = next(fp for d, fp, _ in got if d == 4)
    assert [(d, c) for d, fp, c in got if fp == 0] == [(1, 1), (2, 1), (3, 1)]
    assert sorted((str(d), c) for d, fp, c in got if fp == one) == [("4", 4), ("4", 4), ("5", 4), ("None", 4)]
    assert [c for d, fp, c in got if d is None and fp != one] == [None]
    assert simhash.simhash_components(docs.limit(0)).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "6", "None"]


def test_odd_radius_is_refused():
    with pytest.raises(ValueError):
        simhash.block_balls(3, 3)


def test_texts_that_share_an_id_are_judged_each_on_its_own(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(200)) for x in "abcd")
    rows = [(1, a), (5, a), (5, b), (5, b), (7, c), (7, d), (8, d), (None, a), (None, "e"), (None, "e")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("text_hash", "_id", "_unnamed", "_text_hash", "unnamed", "id", "row", "fp", "rep", "component", "node")})
        kept = simhash.drop_near_duplicates(docs)
        assert kept.columns == docs.columns and all(r[c] == c for r in kept.collect() for c in docs.columns[2:])
        got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
        assert got == sorted([(1, a), (5, b), (7, c), (7, d), (None, "e")], key=str)
