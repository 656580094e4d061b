"""Incremental stages: each reads its predecessor's new files and adds new files to its own table.

The file source never reads a file twice, so a stage's position is its checkpoint, and its input must come as whole new
files (never by appending to one). Keys that came before are held in the query's state store, so no batch looks at the table
again; a batch's files carry its number, so a batch that runs again after a crash replaces what it wrote. Every key is
there once.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions.text import shard_of
from ..sources.store import filesystem
from ..sources.tables import read_or_none

Work = Callable[[DataFrame], DataFrame]


class TargetReached(Exception):
    """A stage's table holds what it should; the batch at hand was not taken and stays for a larger target."""


class Stage:
    """A running stage: its streaming query, which may end because its target is reached."""

    def __init__(self, query) -> None:
        self.query = query

    def __getattr__(self, name: str):
        return getattr(self.query, name)

    def awaitTermination(self, timeout: float | None = None) -> bool | None:  # noqa: N802  as the query names it
        try:
            return self.query.awaitTermination(timeout) if timeout else self.query.awaitTermination()
        except StreamingQueryException as error:
            if TargetReached.__name__ not in str(error):
                raise
            return True


def insert_if_absent(batch: DataFrame, table: str, key: list[str]) -> None:
    """Append the rows whose key the table does not hold, one row a key, as new files."""
    held = read_or_none(batch.sparkSession, table)
    new = batch.dropDuplicates(key)
    if held is not None:
        new = new.join(held.select(*key).distinct(), key, "left_anti")
    new.write.mode("append").parquet(table)


def commit_batch(batch: DataFrame, table: str, tag: str, partition_by: list[str] | None = None) -> int:
    """Add a batch's rows as files named by ``tag``, in place of such files of an earlier attempt; returns the rows.

    The files are written aside and moved in one by one, so a reader never sees part of a file.
    """
    spark = batch.sparkSession
    staged = f"{table}/_staged/{tag}"
    writer = batch.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
    fs, root = filesystem(spark, table)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    depth = "*/" * len(partition_by or [])
    for old in fs.globStatus(at(f"{table}/{depth}{tag}-*")) or []:
        fs.delete(old.getPath(), False)
    base = len(fs.makeQualified(at(staged)).toString()) + 1
    files = fs.listFiles(at(staged), True)
    while files.hasNext():
        path = files.next().getPath()
        if path.getName().startswith("part-"):
            folder = path.getParent().toString()[base:]
            target = at(f"{table}/{folder}" if folder else table)
            fs.mkdirs(target)
            fs.rename(path, at(target, f"{tag}-{path.getName()}"))
    rows = spark.read.parquet(f"{table}/{depth}{tag}-*").count() if fs.globStatus(at(f"{table}/{depth}{tag}-*")) else 0
    fs.delete(at(staged), True)
    return rows


def _tag(checkpoint: str, batch: int) -> str:
    return f"b{hashlib.sha1(checkpoint.encode()).hexdigest()[:8]}-{batch:09d}"


def run_stage(
    spark: SparkSession, source: str, schema: T.StructType, table: str, checkpoint: str, key: list[str],
    work: Work = lambda rows: rows, files_a_batch: int = 0, target: int = 0, continuous: str = "", partition_by: list[str] | None = None,
) -> Stage:
    """Start a stage; drained at once unless ``continuous`` gives an interval. ``key`` are columns of the source.

    With a ``target`` the stage ends once its table holds so many rows. Batches are taken whole, so the last one may
    pass the target, and rows that were not taken are there for a run with a larger one.
    """
    reader = spark.readStream.schema(schema)
    rows = (reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader).parquet(source).dropDuplicates(key)
    held = {"rows": 0}
    if target and (before := read_or_none(spark, table)) is not None:
        held["rows"] = before.count()

    def write(batch: DataFrame, number: int) -> None:
        if target and held["rows"] >= target:
            raise TargetReached(f"{table} holds {held['rows']} rows")
        held["rows"] += commit_batch(work(batch), table, _tag(checkpoint, number), partition_by)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return Stage((writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)).start())


def run_chain(spark: SparkSession, source: str, schema: T.StructType, folder: str, stages: list[tuple[str, list[str], Work]]) -> DataFrame:
    """Drain a chain of stages, each over the table of the one before; returns the last table."""
    for name, key, work in stages:
        table = f"{folder}/{name}"
        run_stage(spark, source, schema, table, f"{folder}/checkpoints/{name}", key, work).awaitTermination()
        source, schema = table, spark.read.parquet(table).schema
    return spark.read.parquet(source)


def run_together(
    spark: SparkSession, source: str, schema: T.StructType, folder: str, stages: list[tuple[str, str | None, list[str], Work]], done: str, every: str = "1 second", quiet: int = 2, timeout: float = 3600.0
) -> dict[str, DataFrame]:
    """Run stages at the same time, each over the source (None) or an earlier stage's table, until all is done.

    ``stages`` are (name, stage it reads, key, work); several may read one table. They end when the file ``done`` is there and
    every query has been without new rows for ``quiet`` looks; what came in between is then drained in order. A
    stage that fails ends all of them. Returns each stage's table.
    """
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    known = {None: (source, schema)}
    for name, reads, _, work in stages:
        table = f"{folder}/{name}"
        known[name] = table, work(spark.createDataFrame([], known[reads][1])).schema
        filesystem(spark, table)[0].mkdirs(jvm.Path(table))
    start = lambda name, reads, key, work, interval: run_stage(spark, *known[reads], known[name][0], f"{folder}/checkpoints/{name}", key, work, continuous=interval)
    running = [start(*stage, every) for stage in stages]
    fs, marker = filesystem(spark, done)
    still, until = 0, time.monotonic() + timeout
    try:
        while still < quiet:
            if time.monotonic() > until:
                raise TimeoutError(f"the stages are not done after {timeout:g} seconds")
            for query in running:
                query.awaitTermination(0.2)  # raises where a query has failed
            idle = all((p := q.lastProgress) and not p["numInputRows"] and not q.status["isDataAvailable"] for q in running)
            still = still + 1 if idle and fs.exists(marker) else 0
    finally:
        for query in running:
            query.stop()
    for stage in stages:
        start(*stage, "").awaitTermination()
    return {name: spark.read.schema(known[name][1]).parquet(known[name][0]) for name, *_ in stages}


def dispatch(spark: SparkSession, source: str, schema: T.StructType, table: str, checkpoint: str, key: str, shards: int) -> Stage:
    """Deal new rows to ``shard=k`` folders by a hash of their id, each id once."""
    return run_stage(spark, source, schema, table, checkpoint, [key], lambda rows: rows.withColumn("shard", shard_of(F.col(key), shards)), partition_by=["shard"])


def compact(spark: SparkSession, table: str, key: list[str], files: int) -> None:
    """Rewrite a table of many small files as a few, one row a key."""
    from ..sources.sinks import replace_table

    replace_table(spark.read.parquet(table).dropDuplicates(key).repartition(files), table)


def tumbling_counts(events: DataFrame, every: str = "1 day", late: str = "10 minutes") -> DataFrame:
    """Events by type and window; on a stream, rows later than the watermark are left out."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    window = F.window("ts", every)
    return rows.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Runs of a user's events without a gap: start, end of the last event plus the gap, events."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def is_complete(spark: SparkSession, table: str, expected: int) -> bool:
    """Whether a stage's table holds what it should, so that the stage need not run."""
    held = read_or_none(spark, table)
    return held is not None and held.count() == expected


def complete_in_rounds(rows: DataFrame, table: str, key: list[str], rounds: list[Callable[[DataFrame], DataFrame]], target: int = 0) -> DataFrame:
    """Run each round's work on the rows whose key is still missing, until all (or ``target``) are there.

    Rounds are bounded: a row that no round completes is left missing, and the caller sees it by an anti join.
    """
    spark = rows.sparkSession
    for work in rounds:
        held = read_or_none(spark, table)
        left = rows if held is None else rows.join(held.select(*key).distinct(), key, "left_anti")
        if (target and held is not None and held.count() >= target) or left.isEmpty():
            break
        insert_if_absent(work(left), table, key)
    return spark.read.parquet(table)


class Progress(StreamingQueryListener):
    """Rows and batches of the streams of a session: ``spark.streams.addListener(Progress())``."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        self.rows.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        key = str(event.progress.id)
        self.rows[key] = self.rows.get(key, 0) + event.progress.numInputRows
        self.batches[key] = self.batches.get(key, 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception
