import math
import random

import pytest
from pyspark.sql import functions as F

from boughwork.llm import hard_negatives
from tests.llm.sql import assert_query_equals_sql


def brute(rows, anchor, positives=5, negatives=10):
    """``rows`` (id, vector, label); order by score, then id with nulls last."""
    kept = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, (i, v, y) in enumerate(kept):
        if i is None or not anchor(i):
            continue
        scored = sorted(((-dot(v, w), j is None, j or 0, j, z == y) for m, (j, w, z) in enumerate(kept) if m != k), key=lambda t: t[:3])
        for s, _, _, p, same in [t for t in scored if t[4]][:positives]:
            inside = [t for t in scored if not t[4] and 30 * -s <= 100 * -t[0] <= 90 * -s][:negatives]
            out += [(i, p, r, t[3], -s, -t[0]) for r, t in enumerate(inside, 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_sql(spark, sf_dir):
    assert_query_equals_sql(spark, sf_dir, "op11_hard_negatives")


@pytest.mark.parametrize("scale", [1, 1000, 1e5])
def test_unlike_norms_ties_and_many_parts(spark, monkeypatch, scale):
    monkeypatch.setattr(hard_negatives, "_BUCKET", 16)
    monkeypatch.setattr(hard_negatives, "_SEEDS", 2)
    monkeypatch.setattr(hard_negatives, "_CHUNK", 5)
    monkeypatch.setattr(hard_negatives, "_SLICE", 7)
    rng = random.Random(2)
    rows = [(i, [scale * rng.choice([0.1, 1, 1, 8]) * rng.randint(-3, 3) / 4 for _ in range(6)], rng.randint(0, 3)) for i in range(300)]
    rows += [(400 + i, rows[10][1], i % 2) for i in range(40)]  # copies: ties in score
    rows = [(i, [float(x) for x in v], y) for i, v, y in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute(rows, lambda i: i % 10 == 0)
    whole = hard_negatives.NormIndex
    for part_rows in (262_144, 20):
        monkeypatch.setattr(hard_negatives, "NormIndex", lambda rows: whole(rows, part_rows))
        found = hard_negatives.hard_negatives(table.repartition(5), F.col("vec_id") % 10 == 0)
        assert got(found) == want and len(want) > 500


def test_parts_of_small_norm_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "_BUCKET", 8)
    rows = [(i, [8.0 / 2 ** (i // 40), 0.0], i % 2) for i in range(320)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    index = hard_negatives.NormIndex(hard_negatives.quantised(table), part_rows=40)
    assert index.tops == sorted(index.tops, reverse=True) and len(index.tops) == 8
    found = hard_negatives.hard_negatives(table, F.col("vec_id") % 100 == 0)
    assert got(found) == brute(rows, lambda i: i % 100 == 0)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, None, 1), (3, [0.5, nan], 2), (4, [inf, 0.0], 2), (5, [0.5, None], 2), (6, [0.5, 0.0], None), (7, [0.5], 2), (8, [], 2), (None, [0.6, 0.6], 2), (None, [0.6, 0.6], 2), (9, [0.6, 0.6], 2), (0, [1.0, 0.0], 1), (100, [-1.0, 0.0], 1), (200, [0.0, 0.0], 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"at": F.lit("x"), "score": F.lit(1), "rank": F.lit(2), "norm": F.lit(0)})
    assert got(hard_negatives.hard_negatives(table, F.col("vec_id") % 100 == 0)) == brute(rows, lambda i: i % 100 == 0)
    assert hard_negatives.hard_negatives(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(spark.createDataFrame([(0, [1e8], 1)], "vec_id long, embedding array<double>, label int"), F.col("vec_id") == 0)
