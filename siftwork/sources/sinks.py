"""Table and report sinks. A write goes to a new folder and is moved into place, so readers see all of it or none."""

from __future__ import annotations

import hashlib
import html
import json
import posixpath
import re
import time
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .store import checkpoint, filesystem


def write_lines(rows: DataFrame, path: str, order: list[str] | None = None) -> int:
    """Replace a JSON-line table, keys in sorted order, nulls kept; returns the rows written, counted as they are written."""
    ordered = rows.orderBy(*order) if order else rows
    written = Observation()
    lines = ordered.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("value"))
    lines.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").text(path)
    return written.get["rows"]


def append_lines(rows: DataFrame, path: str) -> None:
    """Add rows to a JSON-line table as new files; what is there is never touched."""
    rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("append").text(path)


def replace_table(rows: DataFrame, path: str, write: Callable[[DataFrame, str], None] = lambda rows, to: rows.write.parquet(to)) -> None:
    """Write beside a table and swap folders; the table may be one of the rows' own inputs.

    Between the two renames the table is absent, under a name that ``recover_table`` puts back if the driver is lost there.
    """
    spark = rows.sparkSession
    recover_table(spark, path)
    staged, old = f"{path}.staged-{time.time_ns()}", f"{path}.old"
    write(rows, staged)
    fs, target = filesystem(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if fs.exists(target):
        fs.rename(target, at(old))
    fs.rename(at(staged), target)
    fs.delete(at(old), True)


def recover_table(spark: SparkSession, path: str) -> bool:
    """Put a table back that a lost driver left between its two names; whether that was so."""
    fs, target = filesystem(spark, path)
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.old")
    if not fs.exists(old):
        return False
    if fs.exists(target):  # the new table is in place: only the old one was not deleted
        fs.delete(old, True)
        return False
    fs.rename(old, target)
    return True


def backup(spark: SparkSession, path: str) -> str | None:
    """Copy a table to a folder named by the time; None where there is no table."""
    fs, source = filesystem(spark, path)
    if not fs.exists(source):
        return None
    copy = f"{path}.backup-{time.strftime('%Y%m%d%H%M%S')}-{time.time_ns() % 10**9:09d}"
    jvm = spark.sparkContext._jvm
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, jvm.org.apache.hadoop.fs.Path(copy), False, spark.sparkContext._jsc.hadoopConfiguration())
    return copy


def write_shards(rows: DataFrame, path: str, shards: int, order: list[F.Column]) -> None:
    """Deal rows round-robin, in order, into ``shard=k`` folders."""
    from ..operators.sampling import number_rows

    numbered = number_rows(rows, order, "row number").withColumn("shard", (F.col("row number") % shards).cast("int")).drop("row number")
    numbered.write.mode("overwrite").partitionBy("shard").parquet(path)


def split_writes(rows: DataFrame, tables: dict[str, F.Column]) -> None:
    """Write each named path its rows (successes, failures, failures of a kind); the rows are computed once."""
    held = checkpoint(rows)
    for path, condition in tables.items():
        held.where(condition).write.mode("append").parquet(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small report to any store that Spark can open, moved into place when it is whole."""
    fs, target = filesystem(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(at, target)


def report(rows: DataFrame, limit: int = 10_000) -> list[dict]:
    """A report's rows on the driver: aggregates of a few rows; more than ``limit`` is an error, not a cut."""
    found = [r.asDict(recursive=True) for r in rows.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"a report of more than {limit} rows")
    return found


def as_json(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n"


def sampling_markdown(title: str, samples: dict[str, list[dict]], leaks: dict[str, int]) -> str:
    """Counts of each sample by name and value, and how many evaluation papers each holds."""
    lines = [f"# {title}", ""]
    for name, counts in samples.items():
        lines += [f"## {name}", "", f"- evaluation papers: {leaks.get(name, 0)}", ""]
        lines += [f"- {c['name']} {c['value']}: {c['n']}" for c in sorted(counts, key=lambda c: (c["name"], -c["n"], c["value"]))]
        lines.append("")
    return "\n".join(lines)


def compact_json(value: object, most: int = 0) -> str:
    """Text as it is, anything else as JSON; cut to ``most`` characters where that is given, with a mark that it is."""
    shown = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, default=str, sort_keys=True)
    return shown if not most or len(shown) <= most else shown[:most] + " …"


def review_page(rows: list[dict], fields: list[str], image: str | None = None, title: str = "Review", links: dict[str, str] | None = None, most: int = 0) -> str:
    """A static page of complete rows, everything escaped.

    ``links`` names fields whose value is a path, with the text they are shown by; ``most`` cuts long values.
    """
    esc = lambda v: html.escape(compact_json(v, most))
    parts = [f"<!doctype html><meta charset=utf-8><title>{esc(title)}</title><h1>{esc(title)}</h1><p>{len(rows)} rows</p>"]
    for row in rows:
        picture = f'<img src="{html.escape(str(row.get(image) or ""))}" loading=lazy>' if image else ""
        shown = [f"<dt>{esc(f)}</dt><dd>{esc(row.get(f))}</dd>" for f in fields]
        shown += [f'<dt>{esc(f)}</dt><dd><a href="{html.escape(str(row[f]))}">{esc(text)}</a></dd>' for f, text in (links or {}).items() if row.get(f)]
        parts.append(f"<section>{picture}<dl>{''.join(shown)}</dl></section>")
    return "\n".join(parts)


def chat_page(rows: list[dict], messages: str, image: str | None = None, title: str = "Conversations") -> str:
    """A static page of training examples: each row's turns in order."""
    parts = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title>"]
    for row in rows:
        picture = f'<img src="{html.escape(str(row.get(image) or ""))}" loading=lazy>' if image else ""
        turns = "".join(f'<p class="{html.escape(str(m["role"]))}"><b>{html.escape(str(m["role"]))}</b> {html.escape(str(m["content"]))}</p>' for m in row.get(messages) or [])
        parts.append(f"<article>{picture}{turns}</article>")
    return "\n".join(parts)


def table_page(rows: list[dict], fields: list[str], title: str = "Summary") -> str:
    """A static page with one table: a report's rows."""
    head = "".join(f"<th>{html.escape(f)}</th>" for f in fields)
    body = "".join("<tr>" + "".join(f"<td>{html.escape(compact_json(row.get(f)))}</td>" for f in fields) + "</tr>" for row in rows)
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><table><tr>{head}</tr>{body}</table>"


def export_page(spark: SparkSession, page: str, folder: str, name: str = "index.html") -> list[str]:
    """Write a page with the images it shows beside it; returns the images that could not be copied.

    Images are named by a hash of their path, so that equal names of different folders do not meet.
    """
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assets: dict[str, str] = {}
    for path in sorted({unquote(x) for x in re.findall(r'src="file://([^"]+)"', page)}):
        source_fs, source = filesystem(spark, f"file://{path}")
        if source_fs.exists(source):
            asset = f"assets/{hashlib.sha1(path.encode()).hexdigest()[:16]}{posixpath.splitext(path)[1].lower()}"
            to_fs, to = filesystem(spark, f"{folder}/{asset}")
            jvm.FileUtil.copy(source_fs, source, to_fs, to, False, True, conf)
            assets[path] = asset
    written, missing = rewrite_images(page, assets)
    write_text(spark, f"{folder}/{name}", written)
    return missing


def rewrite_images(page: str, assets: dict[str, str]) -> tuple[str, list[str]]:
    """A page whose file:// images point to exported assets, and the images that have none."""
    missing: list[str] = []

    def one(match: re.Match) -> str:
        path = unquote(match.group(1))
        if path not in assets:
            missing.append(path)
            return match.group(0)
        return f'src="{html.escape(assets[path])}"'

    return re.sub(r'src="file://([^"]+)"', one, page), missing
