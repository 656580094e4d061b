"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts, as a Java regular expression class.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, read by Spark (any store Spark can open).

    A file too small to be split for all cores is dealt over them; a larger scan stays as it is.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of a scan's files that a task of an exchange gets at most, where there are more than its partitions.
TASK_BYTES = 128 << 20


def tasks_for(rows: DataFrame) -> int:
    """Partitions of an exchange of ``rows``: as the session has them, or more for a scan whose files are large.

    The size is the planner's (file sizes for a scan); where it knows none, the session's number holds.
    """
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(partitions(rows.sparkSession), -(-size // TASK_BYTES) if size < 1 << 56 else 0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is spark.checkpoint.dir where the session names one; a folder of this machine is taken
    only where the setting is empty and the session is local, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/siftwork-checkpoints"
    return base


#: The folder of each application, which goes when its JVM ends.
_RUNS: dict[str, str] = {}


def fresh_dir(spark: SparkSession, what: str) -> str:
    """A new folder's URI below the shared folder, in one that is deleted when the session's JVM ends."""
    context = spark.sparkContext
    if context.applicationId not in _RUNS:
        run = f"{shared_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
        path = context._jvm.org.apache.hadoop.fs.Path(run)
        system = path.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _RUNS[context.applicationId] = run
    return f"{_RUNS[context.applicationId]}/{what}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder; survives the loss of any executor."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)
