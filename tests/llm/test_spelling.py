import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from boughwork.llm import spelling

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def edits(word):
    """All words one edit away, of the letters in use."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in LETTERS}
        out |= {word[:i] + c + word[i + 1 :] for c in LETTERS} if i < len(word) else set()
    return out - {word}


def brute(words):
    form, rows = {}, {}
    for w, n in words.items():
        near = edits(w) & words.keys()
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
        rows[w] = (n, len(near), words[best] if form[w] else None)
    root = {}
    for w in words:
        r = w
        while form[r]:
            r = form[r]
        root[w] = r
    return {w: (form[w], root[w], *rows[w]) for w in words}


def got(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_documents_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute(counted((r["doc_id"], r["text"]) for r in docs.collect()))
    assert got(spelling.spelling_variants(docs)) == want
    assert sum(v[3] > 0 for v in want.values()) > 20


@pytest.mark.parametrize("shard_words", [3, 40, 100_000])
def test_crowded_words_in_many_shards(spark, shard_words):
    rng = random.Random(3)
    words = {"aaaaaaa": 5000, "aaaaaaaa": 40, "aaaaaaaaa": 3, "ÿ" * 7: 9, "ÿ" * 8: 900, "à" + "ÿ" * 7: 7}
    for _ in range(250):  # long equal beginnings and ends
        words["prefixprefix" + "".join(rng.choices("abé", k=4)) + "ending"] = rng.choice([2, 3, 30, 400, 40_000])
        words["".join(rng.choices("ab", k=rng.randint(7, 9)))] = rng.choice([2, 3, 50, 600])
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = spelling.near_words(table, shard_words).collect()
    want = {}
    for w in words:
        near = edits(w) & words.keys()
        best = min(near, key=lambda x: (-words[x], x), default=None)
        want[w] = (words[w], len(near), words.get(best), best)
    assert {r["word"]: (r["n"], r["n_near"], r["best_n"], r["best"]) for r in rows} == want


def test_edge_cases(spark):
    long = "x" * 40_000
    rows = [(1, "Colour colour, COLOUR colours colours"), (1, None), (2, ""), (None, "Naturel naturel Énaturel Énaturel"), (3, f"{long} {long} {long}a {long}a"), (3, f"{long} {long} {long}a {long}a"), (4, " ".join(["÷×abcdefg"] * 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as word", "1 as n", "'y' as form")
    assert got(spelling.spelling_variants(docs)) == brute_long(counted(rows))
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    assert spelling.spelling_variants(docs.where("text is null or text = ''")).count() == 0


def brute_long(words):
    """As :func:`brute`, without spelling out the edits of the longest words."""
    want = brute({w: n for w, n in words.items() if len(w) < 1000})
    for w in words:
        if len(w) >= 1000:
            near = [x for x in words if x != w and len(x) >= 1000 and abs(len(x) - len(w)) == 1]
            assert len(near) == 1 and words[near[0]] < 10 * words[w]
            want[w] = (None, w, words[w], 1, None)
    return want


def test_chains_of_forms_end_at_their_root(spark):
    words = [("abcdefg", 20_000), ("abcdefgh", 2000), ("abcdefghi", 200), ("abcdefghij", 20), ("abcdefghijk", 2)]
    text = " ".join(" ".join([w] * n) for w, n in words)
    docs = spark.createDataFrame([(d, text) for d in range(1, 4)], "doc_id long, text string")
    found = got(spelling.spelling_variants(docs))
    assert found == brute(counted((r["doc_id"], r["text"]) for r in docs.collect()))
    assert len({r for _, r, *_ in found.values()}) < len(found)


def test_wavelet_tree_reports_rectangles():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        a, b, c, d = rng.integers(0, n + 1, (4, 50))
        query, value = spelling.WaveletTree(values).report(a, b, c, d)
        found = sorted(zip(query.tolist(), value.tolist()))
        assert found == sorted((q, int(v)) for q in range(50) for v in values[a[q] : b[q]] if c[q] <= v < d[q])
