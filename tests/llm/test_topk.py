import math

import numpy as np
import pytest

from siftwork.llm import topk


def brute(rows, k=5):
    valid = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in dict(reversed(valid)).items():
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in valid if i != q and len(b) == len(a))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "clash", b"x") for i, v in rows], "vec_id long, embedding array<float>, score string, data binary")
    vectors = topk.quantize(df)
    return sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 50 = 0")).collect())


@pytest.mark.parametrize("seed", range(2))
def test_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(topk, "CELLS", 700)
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.integers(-4, 5, 9) / 8).tolist()) for i in range(320)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    ones = [1.0] * 8
    rows = [(0, ones), (50, [0.5] * 8), (100, None), (150, [float("nan")] + ones[1:]), (200, ones[:3]), (None, ones), (7, ones), (8, ones), (9, [None] + ones[1:]), (300, []), (350, [float("inf")] * 8)]
    rows += [(1000 + k, ones) for k in range(12)]
    assert run(spark, rows) == brute([r for r in rows if r[1] != []])


def test_few_candidates_and_empty(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 1.0]), (2, [3e6, 1.5])]
    assert run(spark, rows)[0] == (0, 1, 2, (768_000_000**2) + 256 * 384)
