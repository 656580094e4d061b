import re

import duckdb
import pytest
from pyspark.sql import functions as F

from siftwork.llm import mixing


def targets(sizes, weights=(1, 2, 3), most=3):
    """Reshare what stands above its cap until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: float(most * sizes[s]) for s in over}


def sized(spark, rows):
    """Rows (doc_id, source, words) with the columns that the schedule works on."""
    texts = spark.createDataFrame([(k, i, s, "w " * n) for k, (i, s, n) in enumerate(rows)], "rid long, doc_id long, source string, text string")
    return mixing.sized(texts)


@pytest.mark.parametrize(
    "sizes",
    [{"a": 50, "b": 60, "c": 70}, {"a": 500, "b": 3, "c": 2, "d": 9}, {"a": 10, "B": 900, None: 40}, {"é": 5, "z": 7, "Z": 0, "": 11}, {"only": 42}],
)
def test_targets_are_the_fixed_point(spark, sizes):
    rows = [(k, s, n) for k, (s, n) in enumerate(sizes.items())]
    got = {r.source: r.target for r in mixing.source_targets(sized(spark, rows)).collect()}
    assert got == pytest.approx(targets(sizes))


def test_mix_holds_targets_and_caps(spark):
    rows = [(k, f"s{k % 4}" if k % 4 else None, (k * 37) % 61 + (k % 4 == 0) * 40) for k in range(400)]
    docs = sized(spark, rows)
    taken = mixing.schedule(docs).where("words > 0").collect()
    want = targets({s: sum(n for _, t, n in rows if t == s) for s in {t for _, t, _ in rows}})
    got, each = {}, {}
    for r in taken:
        got[r.source] = got.get(r.source, 0) + r.words
        each[r.doc_id] = each.get(r.doc_id, 0) + r.words
    assert all(abs(got[s] - want[s]) <= 1 for s in want) and sum(got.values()) <= sum(n for _, _, n in rows)
    assert all(each[k] <= 3 * n for k, _, n in rows if k in each)
    assert max(r.virtual_finish for r in taken) == 1
    assert sum(r.words < r["size"] for r in taken) <= len(want) + 1  # a source is cut once, and the order once
    assert sorted(map(str, mixing.schedule(docs).where("words > 0").collect())) == sorted(map(str, taken))


def test_schedule_is_range_sorted_and_texts_are_read_once(spark, frame, odd_pairs):
    docs = sized(spark, [(k, f"s{k % 5}", k % 70) for k in range(500)])
    plan = mixing.schedule(docs)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(slot" in plan and "Python" not in plan and "Arrow" not in plan
    rows = mixing.mix_documents(docs.select("doc_id", "source", F.concat_ws(" ", F.array_repeat(F.concat(F.lit("w"), "rid"), F.col("size").cast("int"))).alias("text")))
    served = [len(r.text.split()) for r in rows.collect()]
    assert sum(served) == sum(k % 70 for k in range(500))


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = sorted((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.op5_mixing(spark, sf).collect())
    want = sorted((a, b, c, round(t, 6), k) for a, b, c, t, k in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.OP5_SQL})").fetchall())
    assert got == want


def test_documents_come_back_whole_or_cut(spark, frame, odd_pairs):
    docs = frame(odd_pairs)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    texts = {t for _, t in odd_pairs if t}
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    rows = mixed.collect()
    assert rows and all(r.text in texts or any(words(t)[: len(words(r.text))] == words(r.text) for t in texts) for r in rows)
    assert all(words(r.text) for r in rows)  # documents without words take no budget


def test_empty_and_wordless(spark, frame):
    assert mixing.mix_documents(frame([])).count() == 0
    assert mixing.mix_documents(frame([(1, None), (2, " "), (None, "")])).count() == 0
    rows = mixing.schedule(sized(spark, [(1, "a", 0), (2, None, 0)])).collect()
    assert len(rows) == 2 and all(r.words == 0 for r in rows)
