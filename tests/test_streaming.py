import pytest
from pyspark.sql import functions as F

from siftwork.sources.store import new_folder
from siftwork.streaming import stages

SCHEMA = "id long, v string"


def lot(spark, folder, ids):
    spark.createDataFrame([(i, f"v{i}") for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_a_chain_resumes(spark):
    folder = new_folder(spark, "chain")
    chain = [("a", ["id"], lambda r: r), ("b", ["id"], lambda r: r.where("id % 2 = 0").withColumn("w", F.upper("v")))]
    schema = spark.createDataFrame([], SCHEMA).schema
    lot(spark, f"{folder}/in", range(6))
    assert stages.run_chain(spark, f"{folder}/in", schema, folder, chain).count() == 3
    assert stages.run_chain(spark, f"{folder}/in", schema, folder, chain).count() == 3
    lot(spark, f"{folder}/in", [4, 5, 6, 7, 8])  # repeats of rows that came before
    rows = stages.run_chain(spark, f"{folder}/in", schema, folder, chain).collect()
    assert sorted(r.id for r in rows) == [0, 2, 4, 6, 8]


def test_a_crash_between_sink_and_commit_repeats_nothing(spark, monkeypatch):
    folder = new_folder(spark, "crash")
    schema = spark.createDataFrame([], SCHEMA).schema
    lot(spark, f"{folder}/in", range(5))
    commit = stages.commit_batch

    def run():
        stages.run_stage(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/cp", ["id"]).awaitTermination()

    def lost(*args):
        commit(*args)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(stages, "commit_batch", lost)
    with pytest.raises(Exception, match="lost after the write"):
        run()
    assert spark.read.parquet(f"{folder}/out").count() == 5
    monkeypatch.setattr(stages, "commit_batch", commit)
    run()
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect()) == list(range(5))


def test_a_target_ends_a_stage_and_loses_no_row(spark):
    folder = new_folder(spark, "target")
    schema = spark.createDataFrame([], SCHEMA).schema
    for k in range(4):
        lot(spark, f"{folder}/in", range(10 * k, 10 * k + 10))
    run = lambda target: stages.run_stage(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/cp", ["id"], files_a_batch=1, target=target).awaitTermination()
    held = lambda: spark.read.parquet(f"{folder}/out").count()
    run(25)
    assert held() == 30
    run(30)
    assert held() == 30
    run(100)
    assert held() == 40 and spark.read.parquet(f"{folder}/out").select("id").distinct().count() == 40


def test_stages_run_together(spark):
    folder = new_folder(spark, "together")
    schema = spark.createDataFrame([], SCHEMA).schema
    lot(spark, f"{folder}/in", range(8))

    def then_more(rows):  # a producer that goes on while the stages run
        if not more and not rows.isEmpty():
            more.append(1)
            lot(spark, f"{folder}/in", range(6, 20))
            spark.range(1).write.csv(f"{folder}/done")
        return rows.withColumn("w", F.upper("v"))

    more = []
    made = [("first", None, ["id"], then_more), ("second", "first", ["id"], lambda r: r.where("id % 2 = 0")), ("captions", None, ["id"], lambda r: r.select("id"))]
    tables = stages.run_together(spark, f"{folder}/in", schema, folder, made, f"{folder}/done", every="200 milliseconds", timeout=120)
    assert {n: sorted(r.id for r in t.collect()) for n, t in tables.items()} == {"first": list(range(20)), "second": list(range(0, 20, 2)), "captions": list(range(20))}

    def fails(rows):
        if not rows.isEmpty():
            raise RuntimeError("no endpoint")
        return rows

    with pytest.raises(Exception, match="no endpoint"):
        stages.run_together(spark, f"{folder}/in", schema, f"{folder}/again", [("a", None, ["id"], fails)], f"{folder}/done", every="200 milliseconds", timeout=60)


def test_dispatch_and_compaction(spark):
    folder = new_folder(spark, "dispatch")
    schema = spark.createDataFrame([], SCHEMA).schema
    for part in (range(30), range(20, 50)):
        lot(spark, f"{folder}/in", part)
        stages.dispatch(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/cp", "id", 3).awaitTermination()
    rows = spark.read.parquet(f"{folder}/out")
    assert rows.count() == 50 == rows.select("id").distinct().count() and rows.select("shard").distinct().count() == 3
    stages.compact(spark, f"{folder}/out", ["id"], 1)
    assert len(spark.read.parquet(f"{folder}/out").inputFiles()) == 1 and spark.read.parquet(f"{folder}/out").count() == 50


def test_event_time(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/in")
    query = stages.tumbling_counts(stream).writeStream.format("memory").queryName("days").outputMode("complete").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("days").agg(F.sum("n")).first()[0] == events.count()
    assert stages.sessions(events).agg(F.sum("n")).first()[0] == events.count()


def test_rounds_and_guards(spark):
    table = new_folder(spark, "rounds")
    rows = spark.range(10)
    assert not stages.is_complete(spark, table, 10)
    first = stages.complete_in_rounds(rows, table, ["id"], [lambda r: r.where("id < 4"), lambda r: r.where("id % 2 = 0"), lambda r: r.where("id < 9")])
    assert sorted(r.id for r in first.collect()) == list(range(9))
    assert stages.complete_in_rounds(rows, table, ["id"], [lambda r: r]).count() == 10 and stages.is_complete(spark, table, 10)
    few = new_folder(spark, "few")
    assert stages.complete_in_rounds(rows, few, ["id"], [lambda r: r.where("id < 5")] * 9, target=5).count() == 5


def test_progress_counts_rows(spark):
    import time

    folder = new_folder(spark, "progress")
    schema = spark.createDataFrame([], SCHEMA).schema
    lot(spark, f"{folder}/in", range(7))
    progress = stages.Progress()
    spark.streams.addListener(progress)
    try:
        query = stages.run_stage(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/cp", ["id"])
        query.awaitTermination()
        until = time.time() + 20
        while str(query.id) not in progress.ended and time.time() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(progress)
    assert progress.rows[str(query.id)] == 7 and progress.ended[str(query.id)] is None
