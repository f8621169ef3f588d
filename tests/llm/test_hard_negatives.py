import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows, every, low=30, high=90, positives=5, negatives=10):
    """Sorted result rows of (id, vector, label) rows, all pairs spelled out."""
    fit = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, v, label in fit:
        if a is None or a % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), i, own) for i, w, own in fit if len(w) == len(v)]
        near = sorted((r for r in scored if r[2] == label and r[1] != a), key=order)[:positives]
        for p, i, _ in near:
            inside = sorted((r for r in scored if r[2] != label and low * p <= 100 * r[0] <= high * p), key=order)
            out += [(a, i, k, n, p, s) for k, (s, n, _) in enumerate(inside[:negatives], 1)]
    return sorted(out, key=str)


def mined(spark, rows, every, schema=SCHEMA, **options):
    vectors = hard_negatives.prepared(spark.createDataFrame(rows, schema))
    found = hard_negatives.mine(vectors, F.col("id") % every == 0, **options)
    return sorted((tuple(r) for r in found.collect()), key=str)


def vectors(seed, n, dims=6, coarse=False):
    rng = random.Random(seed)
    step = (lambda: rng.randint(-2, 3) / 4) if coarse else (lambda: rng.gauss(0.3, 1))
    return [(i, [step() for _ in range(dims)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("coarse", [False, True])  # coarse vectors tie often
def test_equals_brute_force(spark, monkeypatch, coarse):
    monkeypatch.setattr(hard_negatives, "_ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "_STRIP", 50)
    rows = vectors(1, 400, coarse=coarse)
    assert mined(spark, rows, 10) == brute_force(rows, 10)
    assert mined(spark, rows, 20, positives=2, negatives=3, low=10, high=60) == brute_force(rows, 20, 10, 60, 2, 3)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "_STRIP", 20)
    rows = vectors(2, 100, coarse=True)
    rows += [(None, [0.5] * 6, 1), (None, [0.5] * 6, 2), (0, [1.0] * 6, 1), (0, [1.0] * 6, 1), (10, None, 1), (20, [0.5] * 6, None)]
    rows += [(30, [0.5, None, 0.0, 0.0, 0.0, 0.0], 1), (40, [math.nan] * 6, 1), (50, [math.inf] + [0.0] * 5, 1), (60, [], 1), (70, [], 2), (80, [], 1)]
    rows += [(90 + i, [0.5, 0.25], i % 2) for i in range(30)]
    assert mined(spark, rows, 10) == brute_force(rows, 10)


def test_one_label_and_a_hot_vector(spark):
    same = [(i, [1.0, 0.5, 0.25], 3) for i in range(300)] + [(1000 + i, [0.5, 0.5, 0.0], i % 2) for i in range(50)]
    assert mined(spark, same, 50) == brute_force(same, 50)
    assert mined(spark, same[:300], 50) == []


def test_extra_columns_and_empty_tables(spark):
    rows = [(*r, "clash", "clash") for r in vectors(3, 80)]
    found = mined(spark, rows, 10, SCHEMA + ", id string, vector string")
    assert found == brute_force([r[:3] for r in rows], 10)
    assert mined(spark, [], 10) == []


def test_long_vectors(spark):
    rows = vectors(4, 60, dims=3000)
    assert mined(spark, rows, 20) == brute_force(rows, 20)


def test_products_are_exact_or_an_error():
    rng = np.random.default_rng(1)
    left, right = (rng.integers(-(2**27), 2**27, (5, 4)) for _ in range(2))
    assert hard_negatives.products(left, right).tolist() == (left.astype(object) @ right.T.astype(object)).tolist()
    with pytest.raises(OverflowError):
        hard_negatives.products(left * 2**20, right)


def test_query_equals_brute_force(spark, tmp_path):
    rows = vectors(5, 700, dims=8)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    changed = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    found = hard_negatives.op13_hard_negatives(spark, str(tmp_path))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_force(changed, 100)
