"""JSON-line tables and their repair; Parquet tables of the engine."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Bytes of a tailed file that are read at once.
TAIL_BYTES = 8 << 20


def read_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A JSON-line table; blank lines are skipped and a line that is no object of the schema fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_object(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A file that holds one JSON value: one row for an object, one an element for a list."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, value): every JSON line as VARIANT, for records whose keys are not fixed."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")).where(F.trim("line") != "")
    return lines.withColumn("value", F.try_parse_json("line"))


def repair_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good lines, broken lines) of a table that may hold torn lines, blank ones left out; both as text.

    A line is good when it is a JSON object; lists, literals and torn objects are broken.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    good = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    return lines.where(good), lines.where(~good)


def repair_table(spark: SparkSession, path: str) -> tuple[str | None, int, int]:
    """Rewrite a JSON-line table with its good lines only: (the copy kept of it, good lines, broken lines).

    A table without broken lines is left as it is. The broken lines stay in the copy.
    """
    from .sinks import backup, replace_table

    good, broken = repair_lines(spark, path)
    bad, fine = broken.count(), good.count()
    if not bad:
        return None, fine, 0
    copy = backup(spark, path)
    replace_table(good, path, lambda rows, to: rows.write.text(to))
    return copy, fine, bad


def tail_lines(files: DataFrame, offsets: DataFrame | None = None) -> DataFrame:
    """(path, value, until): the whole lines of each file after its offset, for files that a producer still appends to.

    ``files`` has path, ``offsets`` path and until (a file's last, as an earlier call gave it). A last line without
    its line end is left for a later call, blank lines count in the offset and are no rows. ``until`` is the place after the
    row's line, in bytes.
    """
    from collections.abc import Iterator

    import pandas as pd
    from pyarrow import fs

    rows = files.select("path").distinct()
    if offsets is not None:
        last = offsets.groupBy(F.col("path").alias("file")).agg(F.max("until").alias("since"))
        rows = rows.join(last, F.col("path") == F.col("file"), "left").select("path", F.coalesce("since", F.lit(0)).alias("since"))
    else:
        rows = rows.withColumn("since", F.lit(0).cast("long"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, since in zip(batch["path"], batch["since"], strict=True):
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as stream:
                    stream.seek(int(since))
                    at, rest = int(since), b""
                    while piece := stream.read(TAIL_BYTES):
                        lines = (rest + piece).split(b"\n")
                        rest = lines.pop()
                        found = []
                        for line in lines:
                            at += len(line) + 1
                            if line.strip():
                                found.append((path, line.decode(errors="replace"), at))
                        if found:
                            yield pd.DataFrame(found, columns=["path", "value", "until"])

    return rows.mapInPandas(read, "path string, value string, until long")


def read_text(spark: SparkSession, path: str, suffix: str = "*") -> DataFrame:
    """(path, text) of whole files: UTF-8, or Latin-1 where they are not (which always reads)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)
    utf8 = F.col("content").cast("string")
    return files.select("path", F.when(F.is_valid_utf8(utf8), utf8).otherwise(F.decode("content", "ISO-8859-1")).alias("text"))


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where nothing was written yet."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return found


def first_seen_files(spark: SparkSession, patterns: list[str], schema: T.StructType, key: str, keep: F.Column | None = None, target: int = 0) -> DataFrame:
    """The first row of each key over several patterns, in their order, then by file and row.

    ``keep`` filters before; with a ``target``, the first so many rows are returned and fewer is an error.
    """
    from ..operators.dedup import first_seen

    parts = [read_lines(spark, p, schema).withColumns({"priority": F.lit(k), "file": F.col("_metadata.file_path"), "position": F.monotonically_increasing_id()}) for k, p in enumerate(patterns)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = first_seen(rows.where(keep) if keep is not None else rows, key, ["priority", "file", "position"])
    if not target:
        return rows
    found = rows.orderBy("priority", "file", "position").limit(target)
    if (n := found.count()) < target:
        raise ValueError(f"{n} rows where {target} are needed")
    return found
