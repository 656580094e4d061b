"""The shared folder of a session: checkpoints, staged tables, versioned backups."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of this machine, which only a local session may use."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.gettempdir()}/siftwork-checkpoints"
    return folder.rstrip("/")


#: The folder of each application, which goes when its JVM ends.
_RUNS: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, in one that is deleted when the session's JVM ends."""
    application = spark.sparkContext.applicationId
    if application not in _RUNS:
        run = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
        fs, path = filesystem(spark, run)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _RUNS[application] = run
    return f"{_RUNS[application]}/{name}-{uuid.uuid4().hex}"


def checkpoint(rows: DataFrame) -> DataFrame:
    """The rows, cut from their lineage by files that any executor can read."""
    context = rows.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint(eager=True)


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a URI: any store that Spark can open."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at
