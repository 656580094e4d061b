from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

COLUMNS = list(pipeline.COLUMNS)


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_dedup", "suffix_dedup", "mixing", "packing"]


def test_each_stage_on_its_input(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stage = {}
    for name, f in pipeline.STAGES:
        f(spark, docs, sf).write.parquet(f"file://{tmp_path}/{name}")
        docs = stage[name] = spark.read.parquet(f"file://{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == COLUMNS
    # Clean documents stay, bad ones go.
    kept = stage["quality"].join(labels, "doc_id").groupBy("quality").count().collect()
    assert {r.quality for r in kept} == {1} and kept[0]["count"] == labels.where("quality = 1").count()
    # No two equal texts stay, and every group keeps one.
    near = stage["near_dedup"]
    assert near.groupBy("text").count().where("count > 1").isEmpty()
    assert near.join(stage["quality"].select("doc_id"), "doc_id", "left_anti").isEmpty()
    # No 100-byte string is left twice where neither end was cut.
    texts = [r.text.encode() for r in near.orderBy("doc_id").collect()]
    cut = {r.doc_id: r for r in stage["suffix_dedup"].collect()}
    assert sum(len(t) for t in texts) > sum(len(r.text.encode()) for r in cut.values())
    assert all(r.n_chars == len(r.text) and r.text.strip() for r in cut.values())
    # Every text is a subsequence of the one it was, and texts without a repeated string are as they were.
    seen = Counter(w for t in texts for w in {t[k : k + 100] for k in range(len(t) - 99)})
    for r in near.collect():
        old, new = r.text.encode(), cut[r.doc_id].text.encode() if r.doc_id in cut else b""
        rest = iter(old)
        assert all(b in rest for b in new)
        if len({old[k : k + 100] for k in range(len(old) - 99)}) == max(0, len(old) - 99) and all(seen[old[k : k + 100]] == 1 for k in range(len(old) - 99)):
            assert new == old
    # The mix takes as many words as its input has, from every source.
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    before, after = (stage[n].agg(F.sum(words)).first()[0] for n in ("suffix_dedup", "mixing"))
    assert abs(before - after) <= 25
    # Pieces hold exactly the ids of the rows.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(e.ids) + 1 for e in tokenizer.encode_batch([r.text for r in stage["mixing"].collect()], add_special_tokens=False))
    assert stage["packing"].agg(F.sum("length")).first()[0] == total
    used = stage["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).toPandas().n
    assert used.max() <= 1024 and np.mean(used) > 900


def test_run_equals_the_stages_and_reruns_agree(spark, sf):
    first, second = (sorted(tuple(r) for r in pipeline.run(spark, sf).collect()) for _ in range(2))
    assert first and first == second


def test_odd_rows(spark, frame, odd_pairs, tmp_path):
    docs = frame(odd_pairs)
    folder = f"file://{tmp_path}"
    spark.createDataFrame([(4, 1, 0), (9, 1, 0), (11, 0, 0), (12, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for rows in (docs, docs.limit(0)):
        current = rows
        for name, f in pipeline.STAGES:
            current = f(spark, current, folder)
            count = current.count()
            if not rows.count():
                assert count == 0
            if name == "near_dedup":  # one row of each class that the quality stage kept
                assert count == current.select("doc_id", "text").distinct().count()
