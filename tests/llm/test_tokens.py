import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from boughwork.llm import packing, token_files, tokens
from boughwork.llm.tokens import WordEncoder, default_vocabulary


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_word_encoder_equals_the_library(plain):
    rng = random.Random(3)
    marks = list("ab'sdtreém 1²9 \n\t.,!-ß漢　᠎​﻿\x1c\x85\U0001f600\r") + ["'s", "<|endoftext|>", "\n\n"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += [" ".join("".join(rng.choice([m for m in marks if not m.isspace()]) for _ in range(4)) for _ in range(9)).replace(" ", "\n", 2) for _ in range(1000)]
    encoder = WordEncoder(default_vocabulary(), max_words=500)
    for at in range(0, len(texts), 400):
        got = encoder.encode([*texts[at : at + 400], None])
        assert [x.tolist() for x in got] == [plain(t) for t in [*texts[at : at + 400], None]]


def test_pieces_are_put_together_from_words_and_marks(plain):
    rng = random.Random(6)
    words = ["one", "éte", "Œuvre", "it's", "x1", "12", "(456)", "漢字", "ŀa", "\u0250a", "a*b", "don't?"]
    ends = ["", ".", "!?", ";:", "'", "%$", "...", ")"]
    texts = ["".join(rng.choice(words) + rng.choice(ends) + rng.choice(" \n  ") for _ in range(rng.randint(1, 40)))[:-1] for _ in range(2000)]
    for size in (10, 100_000):
        encoder = WordEncoder(default_vocabulary(), max_words=size)
        for at in range(0, len(texts), 250):
            assert [x.tolist() for x in encoder.encode(texts[at : at + 250])] == [plain(t) for t in texts[at : at + 250]]


@pytest.mark.parametrize("bit_planes", [True, False])
def test_blocks_round_trip(bit_planes):
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 1), (1000, 300), (65536, 50257), (77, 2**32)):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
        assert (token_files.unpack_block(token_files.pack_block(ids, bit_planes)) == ids).all()
    data = bytearray(token_files.pack_block(np.arange(100), bit_planes))
    data[10] ^= 1
    with pytest.raises(ValueError):
        token_files.unpack_block(bytes(data))


ROWS = [(5, "five words in this text"), (1, ""), (2, None), (None, "no id"), (3, "long text " * 9000), (5, "five words in this text"), (4, "tail")]


def test_files_hold_all_documents_in_order(spark, plain, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("start", F.lit("clash"))
    path = f"file://{tmp_path}/ids"
    token_files.write_tokens(docs, path, block_ids=1000, shards=3)
    got = sorted(map(tuple, token_files.read_documents(spark, path).collect()), key=lambda r: r[1])
    at, want = 0, []
    for doc_id, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*plain(text), 2], "<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    token_files.write_tokens(docs.limit(0), path + "0")
    assert token_files.read_documents(spark, path + "0").count() == 0


def test_documents_table_round_trips(spark, plain, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.round_trip(docs).collect()}
    at = 0
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = np.array([*plain(r["text"]), 2], "<u4")
        assert got.pop(r["doc_id"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not got


def check_packing(rows, docs, plain, window):
    """Every id in one piece; sequences gapless, full or of a power of two."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0
    for doc_id, text in docs:
        ids = np.array([*plain(text), 0], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


@pytest.mark.parametrize("shard_ids", [3000, 1_000_000])
def test_packing_keeps_every_id(spark, plain, sf_dir, shard_ids):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = packing.pack_documents(docs, shard_ids=shard_ids).collect()
    check_packing(got, [(r["doc_id"], r["text"]) for r in docs.collect()], plain, 1024)


def test_packing_edges(spark, plain):
    rows = [(i, t) for i, (_, t) in enumerate(ROWS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).withColumn("offset", F.lit("clash"))
    check_packing(packing.pack_documents(docs, window=64, with_ids=True).collect(), rows, plain, 64)
    assert packing.pack_documents(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (None, None)], "doc_id long, text string")
    assert sum(r["length"] for r in packing.pack_documents(nulls).collect()) == 5
    with pytest.raises(ValueError):
        packing.pack_documents(docs, window=1000)


def test_neighbours_come_first():
    words = {w: i for i, w in enumerate("the a cat dog fish boat rain snow".split())}
    docs = [np.array([words[w] for w in t.split()], "<u4") for t in ("the cat", "the boat", "a cat the", "the rain", "a boat")]
    assert packing.retrieval_order(docs, 4)[:2] == [0, 2]
    assert sorted(packing.retrieval_order(docs, 3)) == list(range(5))
    assert packing.retrieval_order([], 8) == []


def brute_bm25(docs, seed):
    """Scores of all documents for all terms of the seed, term by term."""
    mean = sum(map(len, docs)) / len(docs)
    scores = [0.0] * len(docs)
    for term in set(docs[seed].tolist()):
        df = sum(term in d for d in docs)
        idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5))
        for i, d in enumerate(docs):
            tf = int((d == term).sum())
            scores[i] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
    return scores


def test_all_terms_of_a_seed_count():
    rng = np.random.default_rng(5)
    docs = [np.minimum(rng.zipf(1.3, rng.integers(15, 60)), 400).astype("<u4") for _ in range(60)]
    docs = [np.r_[d, 1000 + 20 * i + np.arange(15)].astype("<u4") for i, d in enumerate(docs)]  # 15 tokens of its own each
    index = packing.Bm25Index(docs)
    for seed in range(len(docs)):
        found, scores = index.neighbours(seed)
        want = np.array(brute_bm25(docs, seed))
        assert found.tolist() == np.flatnonzero(want).tolist()
        assert np.allclose(scores, want[found])
    order = packing.retrieval_order(docs, 10**6)
    want = brute_bm25(docs, 0)
    assert order == [0, *sorted(range(1, 60), key=lambda i: (-round(want[i], 9), i))]


def test_own_tokens_do_not_hide_neighbours():
    own = lambda i: 1000 + 20 * i + np.arange(15)
    docs = [np.r_[own(0), 1, 2, 3], np.r_[own(1), 4, 5], np.r_[own(2), 6, 7], np.r_[own(3), 1, 2, 3]]
    docs = [np.r_[d, 0].astype("<u4") for d in docs]
    assert packing.retrieval_order(docs, 1000, marks=1)[:2] == [0, 3]
    assert packing.retrieval_order([np.r_[own(i), 1, 2, 3 + i].astype("<u4") for i in range(3)], 1000) == [0, 1, 2]


def test_statistics_and_neighbours_span_partitions(spark, plain):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    topics = [" ".join(rng.choices(words[8 * i : 8 * i + 8], k=40)) for i in range(50)]
    rows = [(2 * i + j, topics[i]) for j in range(2) for i in range(50)]  # a text's copy lies 50 rows on
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(2, F.col("doc_id") % 2)
    ids = [plain(t) for _, t in rows]
    encoded = docs.mapInArrow(packing._encode(default_vocabulary()), "doc_id long, n long, ids binary")
    found = packing.corpus_statistics(encoded)
    df = np.bincount([x for d in ids for x in set(d)])
    assert found.documents == 100 and found.mean == sum(map(len, ids)) / 100 and found.df.tolist() == df.tolist()
    got = sorted(packing.pack_documents(docs, window=1 << 16).collect(), key=lambda r: (-r["length"] - r["offset"], r["sequence_id"]))
    order = [r["doc_id"] for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])) if r["start"] == 0]
    assert sum(abs(order.index(2 * i) - order.index(2 * i + 1)) == 1 for i in range(50)) >= 45
    # both halves weigh a term alike: as the corpus does
    half = packing.Bm25Index([np.array(d, "<u4") for d in ids[:50]], found)
    whole = packing.Bm25Index([np.array(d, "<u4") for d in ids])
    for seed in (0, 7):
        places, scores = half.neighbours(seed)
        more, wanted = whole.neighbours(seed)
        assert np.allclose(scores, wanted[more < 50]) and places.tolist() == more[more < 50].tolist()


def test_one_shard_is_the_search_over_the_corpus(spark, plain, sf_dir, monkeypatch):
    """Each document that follows a seed in its window is the seed's best unused neighbour by
    BM25 of the whole table, term by term."""
    monkeypatch.setattr(packing, "_PARTITION_IDS", 5000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars < 1500")
    rows = packing.pack_documents(docs, window=4096, shard_ids=10**9).collect()
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])) if r["start"] == 0]
    assert len({r["sequence_id"] >> 40 for r in rows}) == 1 and len(order) == docs.count()
    ids = {r["doc_id"]: np.array(plain(r["text"])) for r in docs.collect()}
    names = list(ids)
    corpus = list(ids.values())
    free, filled, seed = set(names), 0, None
    for doc in order:
        if seed is not None:
            scores = dict(zip(names, brute_bm25(corpus, names.index(seed))))
            best = max((scores[d] for d in free), default=0)
            assert best == 0 or scores[doc] >= best - 1e-6
        if seed is None or best == 0:
            seed, filled = doc, len(ids[doc]) + 1 if seed is None else filled + len(ids[doc]) + 1
        else:
            filled += len(ids[doc]) + 1
        free.discard(doc)
        if filled >= 4096:
            filled, seed = filled % 4096, doc


def test_operators_take_added_tokens_as_the_library_does(spark):
    as_loaded = Tokenizer.from_file(default_vocabulary())
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "b ", " ", "\n", "é", "<|", "|>", "<|endoftext|>"]) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "one\ntwo<|endoftext|><|endoftext|>three", "plain words"]
    want = [as_loaded.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[500] == [64, 220, 50256, 275]
    assert [x.tolist() for x in tokens.encoder(default_vocabulary()).encode(texts)] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    crcs = [(len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes())) for ids in want]
    assert [(r["n_tokens"], r["ids_crc32"]) for r in token_files.round_trip(docs).orderBy("doc_id").collect()] == crcs
    assert {r["doc_id"]: r["doc_tokens"] for r in packing.pack_documents(docs).collect()} == {i: len(ids) + 1 for i, ids in enumerate(want)}
