import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftwork.operators import dedup, sampling

POOL = "candidate_id long, paper_id string, month string, year int, bucket string, confidence double, is_eval boolean"


def pool(rng, n):
    rows = []
    for k in range(n):
        paper = rng.randrange(n // 3)
        year, month = 2020 + paper % 6, paper % 5
        rows.append((k, f"p{paper}", f"{year}-{month}", year, rng.choice("abc"), rng.choice([None, 0.5, 0.8, 0.9]), paper % 11 == 0))
    rng.shuffle(rows)
    return rows


def greedy(rows, target, per_paper=2):
    """The four phases one row at a time."""
    quotas = {y: target // 6 for y in range(2020, 2026)}
    quotas[2025] += target - sum(quotas.values())
    caps = {y: math.ceil(q / 12 * 1.3) for y, q in quotas.items()}
    taken, papers, months = [], Counter(), Counter()

    def offer(r, month=True):
        if len(taken) < target and r not in taken and papers[r[1]] < per_paper and not (month and months[r[2]] >= caps[r[3]]):
            taken.append(r)
            papers[r[1]] += 1
            months[r[2]] += 1

    sure = lambda r: (-(r[5] or 0), r[0])
    for r in sorted((r for r in rows if r[6]), key=sure):
        offer(r)
    for y, quota in quotas.items():
        held = Counter(r[4] for r in taken)
        for r in sorted((r for r in rows if r[3] == y), key=lambda r: (held[r[4]], *sure(r))):
            if sum(t[3] == y for t in taken) < quota:
                offer(r)
    for month in (True, False):
        for r in sorted(rows, key=sure):
            offer(r, month)
    return [r[0] for r in taken]


@pytest.mark.parametrize("seed", range(3))
def test_group_sample_is_greedy(spark, seed):
    rows = pool(random.Random(seed), 120)
    got = sampling.group_sample(spark.createDataFrame(rows, POOL), 50).orderBy("sample_index").collect()
    assert [r.candidate_id for r in got] == greedy(rows, 50)
    assert [r.sample_index for r in got] == list(range(len(got)))


def test_group_sample_compat_may_repeat(spark):
    rows = [(1, "p", "2020-1", 2020, "a", 0.9, True), (2, "q", "2020-2", 2020, "a", 0.8, False)]
    ids = [r.candidate_id for r in sampling.group_sample(spark.createDataFrame(rows, POOL), 120, compat=True).collect()]
    assert ids.count(1) == 2
    assert [r.candidate_id for r in sampling.group_sample(spark.createDataFrame(rows, POOL), 120).collect()].count(1) == 1


@pytest.mark.parametrize("seed", range(2))
def test_nested_ranks_are_greedy(spark, seed):
    rng = random.Random(seed)
    rows = [(k, p := rng.randrange(20), p % 7, (p % 7) % 3, rng.random()) for k in range(150)]
    taken, caps = [], Counter()
    for r in sorted(rows, key=lambda r: -r[4]):
        keys = [("p", r[1]), ("m", r[2]), ("y", r[3])]
        if all(caps[k] < most for k, most in zip(keys, (2, 5, 12), strict=True)):
            caps.update(keys)
            taken.append(r[0])
    df = spark.createDataFrame(rows, "id long, p int, m int, y int, s double")
    got = sampling.nested_caps(df, [(["p", "m", "y"], 2), (["m", "y"], 5), (["y"], 12)], [F.desc("s")])
    assert sorted(r.id for r in got.collect()) == sorted(taken)


@pytest.mark.parametrize("similar", [False, True])
def test_task_sample_is_greedy(spark, similar):
    rng = random.Random(5)
    words = ["red", "blue", "line", "peak", "rise", "fall"]
    weights = {"a": 5, "b": 3, "c": 2}
    rows = [(f"q{k}", rng.choice("abcd"), rng.randrange(9), rng.randint(1, 5), " ".join(rng.sample(words, 3))) for k in range(80)]
    df = spark.createDataFrame(rows, "id string, task_type string, image_id int, difficulty_score int, question string")
    seed = 7
    place = {r.id: r.h for r in df.select("id", sampling.seeded_order(seed, "id").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (-r[3], place[r[0]], r[0]))
    taken, images, kept = [], Counter(), {}

    def offer(r):
        old = [set(q.split()) for q in kept.get(r[2], [])]
        if images[r[2]] >= 3 or (similar and dedup.too_similar(set(r[4].split()), old)):
            return False
        taken.append(r[0])
        images[r[2]] += 1
        kept.setdefault(r[2], []).append(r[4])
        return True

    for task, quota in sampling.apportion(24, weights).items():
        added = 0
        for r in order:
            if r[1] == task and added < quota:
                added += offer(r)
    for r in order:
        if len(taken) < 24 and r[0] not in taken:
            offer(r)
    got = sampling.task_sample(df, 24, weights, seed=seed, text="question" if similar else None).orderBy("sample_index").collect()
    assert [r.id for r in got] == taken
    assert sampling.task_sample(df, 0, weights).count() == 80 == sampling.task_sample(df, 500, weights).count()


def test_apportionment():
    assert sampling.apportion(100, {"a": 18, "b": 15, "c": 67}) == {"a": 18, "b": 15, "c": 67}
    assert sum(sampling.apportion(7, {"a": 1, "b": 1, "c": 98}).values()) == 7
    assert sampling.apportion(10, {"a": 25, "b": 75}) == {"a": 2, "b": 8}  # half to even
    assert sampling.shard_targets(10, 4) == [3, 3, 2, 2]
    assert sampling.year_quotas(20) == {2020: 3, 2021: 3, 2022: 3, 2023: 3, 2024: 3, 2025: 5}


def test_row_numbers(spark):
    rows = spark.range(1000).withColumn("k", F.col("id") * 37 % 1000)
    got = {r.k: r.row_index for r in sampling.number_rows(rows, [F.col("k")]).collect()}
    assert got == {k: k for k in range(1000)}


def test_two_level_dedup(spark):
    rows = [("a", 1, "h", None), ("b", 1, "h", 0.9), ("c", 2, "h", 0.5), ("d", 3, None, 0.5), ("e", 4, None, 0.5), ("f", 2, "x", 0.4), ("g", None, "y", 0.1), ("i", None, "z", 0.2)]
    got = {r.id: (r.duplicate_reason, r.duplicate_of) for r in dedup.two_level(spark.createDataFrame(rows, "id string, k int, h string, c double"), ["k"], "h", "c", "id").collect()}
    assert got == {"a": ("key_duplicate", None), "b": (None, None), "c": ("hash_duplicate", "b"), "d": (None, None), "e": (None, None), "f": ("key_duplicate", None), "g": ("key_duplicate", None), "i": (None, None)}


def test_first_and_last(spark):
    rows = spark.createDataFrame([(1, 0, "a"), (1, 2, "b"), (2, 1, None), (None, 5, "n")], "k int, o int, v string")
    assert sorted((r.k or 0, r.v) for r in dedup.last_wins(rows, ["k"], ["o"]).collect()) == [(0, "n"), (1, "b"), (2, None)]
    assert sorted((r.k or 0, r.v) for r in dedup.first_seen(rows, "k", ["o"]).collect()) == [(0, "n"), (1, "a"), (2, None)]


def test_questions_accepted_in_order(spark):
    said = [(1, 0, "red line peak"), (1, 1, "red line peak"), (1, 2, "the chart"), (1, 3, "blue fall"), (1, 4, "green rise"), (2, 0, "red line peak"), (None, 0, "alone here")]
    rows = spark.createDataFrame(said, "g int, o int, q string")
    got = dedup.accept_in_order(rows, "g", ["o"], F.col("q"), cap=2)
    assert sorted((r.g or 0, r.o) for r in got.collect()) == [(0, 0), (1, 0), (1, 3), (2, 0)]
