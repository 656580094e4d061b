"""Similar pairs against SQL and plain Python: all sets count for the order of words, and no pair is lost."""

import random
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siftwork import rarity
from siftwork.operators import dedup
from siftwork.plans import relations


def test_odd_rows_give_what_sql_gives(spark, tmp_path):
    """Null groups and ids, ids listed again, and a capital I with a dot (an i for SQL; pairs were lost before)."""
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    documents = [
        (1, text, "s"), (2, text, "s"), (2, text, "s"), (2, text + " one", "s"), (3, text.upper().replace("I", "İ"), "s"), (4, text, None), (5, text, None), (None, text + " two", "s"),
        (6, "", "s"), (7, None, "s"), (8, "the and of it", "s"), (9, text + " one two three", "s"), (10, text + " one two three four", "s"), (11, text, "t"), (12, text.replace(" ", "\x0b"), "t"), (13, text + " one", "t"),
    ]
    spark.createDataFrame(documents, "doc_id long, text string, source string").coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in relations.QUERIES["near_duplicate_pairs"](spark, f"file://{tmp_path}").select("source", "left", "right", "overlap").collect())
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = sorted(con.execute(f'SELECT source, "left", "right", overlap FROM ({relations.SQL["near_duplicate_pairs"]})').fetchall())
    assert got == want and len(want) > 8


@pytest.mark.parametrize("meetings", [1, 4, 50])
def test_no_pair_is_lost(spark, monkeypatch, meetings):
    monkeypatch.setattr(dedup, "MEETINGS", meetings)
    draw = random.Random(meetings)
    vocabulary = [f"word{k}" for k in range(400)]
    texts = []
    for size in (1, 2, 3, 5, 8, 13, 25, 50, 100, 175):
        for _ in range(6):
            base = draw.sample(vocabulary, size)
            texts += [base] + [[draw.choice(vocabulary) if draw.random() < p else w for w in base] + draw.sample(vocabulary, int(size * q)) for p, q in ((0.05, 0), (0.14, 0), (0.16, 0), (0, 0.3), (0, 0.38), (0.1, 0.1))]
    rows = [(k, f"g{k % 2}", " ".join(t)) for k, t in enumerate(texts)] + [(len(texts) + k, "g0", " ".join(t)) for k, t in enumerate(texts)]
    got = {(r.left, r.right) for r in dedup.similar_pairs(spark.createDataFrame(rows, "id long, g string, t string"), "g", "id", F.col("t")).collect()}
    sets, first, want = {k: (g, frozenset(t.split())) for k, g, t in rows}, {}, set()
    for k, s in sets.items():
        if first.setdefault(s, k) != k:
            want.add((first[s], k))
    reps = sorted(first.values())
    for i in reps:
        want |= {(i, j) for j in reps if i < j and sets[i][0] == sets[j][0] and len(sets[i][1] & sets[j][1]) >= Fraction("0.72") * len(sets[i][1] | sets[j][1])}
    assert got == want and len(want) > 400


def test_sets_that_share_common_words_are_not_compared(spark):
    """1,000 sets share 60 of their 100 words: no pair of them is looked at in full."""
    common = " ".join(f"common{k}" for k in range(60))
    rows = spark.createDataFrame([("g", k, f"{common} " + " ".join(f"own{k}x{j}" for j in range(40))) for k in range(1000)], "g string, id long, text string")
    sets = dedup._word_sets(rows).withColumn("node", F.col("id"))
    counts = rarity.cell_counts(sets.select("words"), dedup._hashes_of_words)
    assert dedup._meeting(dedup._heads(sets, counts, Fraction("0.72")), Fraction("0.72")).count() == 0


def test_all_rows_are_counted(spark):
    """Past the 20,000 rows that were sampled before."""
    rows = spark.range(50_000).select(F.concat(F.lit("w"), (F.col("id") % 7).cast("string")).alias("word"))

    def words():
        return lambda batch: (np.array([xxhash.xxh64_intdigest(w.as_py())], np.uint64) for w in batch.column(0))

    counts = rarity.cell_counts(rows, words)
    want = Counter(k % 7 for k in range(50_000))
    hashes = np.array([xxhash.xxh64_intdigest(f"w{k}") for k in range(7)], np.uint64)
    assert counts[rarity.cells(hashes)].tolist() == [want[k] for k in range(7)] and counts.sum() == 50_000
    none = rarity.cell_counts(rows.where("false"), words)
    assert none.sum() == 0
