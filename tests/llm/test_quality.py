import math
import random
import zlib

import numpy as np
import pytest

from siftwork.llm import quality


def test_learns_main_and_pair_effects():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.uniform(size=4000) < 0.03)).astype(float)
    model = quality.fit(x[:3000], y[:3000], rounds=40)
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.85
    z = (x[:, 2] > 0.3).astype(float)
    plain = quality.fit(x[:3000], z[:3000], rounds=40)
    assert np.mean((plain.score(x[3000:]) >= 0.5) == z[3000:]) > 0.98


@pytest.mark.parametrize("y", [[], [1.0, 1.0], [0.0, 0.0]])
def test_one_sided_labels_give_the_share(y):
    x = np.zeros((len(y), len(quality.FEATURES)))
    score = quality.fit(x, np.array(y)).score(np.zeros((1, len(quality.FEATURES))))[0]
    assert score == pytest.approx(y[0] if y else 0.5, abs=1e-5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = {r.doc_id: r for r in quality.op2_quality(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    out = [(scored[r.doc_id].predicted, r.quality) for r in labels if scored[r.doc_id].held_out]
    assert len(out) > 50
    assert np.mean([a == b for a, b in out]) >= 0.97
    assert all(0 <= r.score <= 1 for r in scored.values())


def test_scores_are_plain_table_sums(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: r for r in quality.op2_quality(spark, sf).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        x = quality.features(r.text)
        bins = [sum(1 for edge in model.edges[j] if edge <= x[j]) for j in range(len(x))]
        total = model.intercept + sum(float(model.tables[j][bins[j]]) for j in range(len(x)))
        for (i, j), pair in zip(model.pairs, model.pair_tables, strict=True):
            total += float(pair[model.coarse[i][bins[i]]][model.coarse[j][bins[j]]])
        score = 1 / (1 + math.exp(-max(-30, min(30, total))))
        assert got[r.doc_id].score == pytest.approx(score, abs=1e-9) and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_tree_takes_the_best_cut():
    rng = np.random.default_rng(2)
    for _ in range(30):
        g, w = rng.normal(size=12), rng.uniform(0.5, 3, 12)
        worth = lambda a, b: g[a:b].sum() ** 2 / (w[a:b].sum() + 1.0)  # noqa: B023, E731
        best = max(range(1, 12), key=lambda c: worth(0, c) + worth(c, 12))
        step = quality._shallow_tree(g, w, 2, 0.0)
        if worth(0, best) + worth(best, 12) - worth(0, 12) > 1e-6:
            assert step[:best] == pytest.approx(g[:best].sum() / (w[:best].sum() + 1)) and step[best:] == pytest.approx(g[best:].sum() / (w[best:].sum() + 1))


def test_reruns_agree(spark, sf):
    first, second = ({r.doc_id: r.score for r in quality.op2_quality(spark, sf).collect()} for _ in range(2))
    assert first == second


def test_odd_rows(spark, frame, odd_pairs):
    docs = frame(odd_pairs)
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (9, 1), (None, 1), (11, None), (77, 0), (11, 0)], "doc_id long, quality int")
    rows = quality.classify(docs, quality.train(docs, labels), "doc_id", "size").collect()
    assert len(rows) == len(odd_pairs) and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(docs.limit(0), quality.train(docs, labels), "doc_id").count() == 0
    nothing = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.classify(docs, nothing, "doc_id").collect()} == {0.5}


def test_training_rows_are_bounded(spark, frame):
    rng = random.Random(3)
    docs = frame([(k, " ".join(rng.choice(["x", "yy"]) for _ in range(9))) for k in range(80)])
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    sizes = []
    real = quality.fit
    try:
        quality.fit = lambda x, y: (sizes.append(len(y)), real(x, y))[1]
        quality.train(docs, labels, max_rows=10)
    finally:
        quality.fit = real
    assert sizes == [10]
