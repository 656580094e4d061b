"""Reading the driver's tables, and values of SQL made from fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores where the scan has fewer splits than cores (small files); a larger scan stays as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"
