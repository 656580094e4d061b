"""Session factory and settings shared by tests, the bench and the entry points."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go with the frames that they were written for.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Keys that streams hold are not kept on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Model calls have side effects, so a second copy of a task must not start.
    "spark.speculation": "false",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", app: str = "siftwork", **extra: str) -> SparkSession:
    """A session with the engine's defaults; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
