"""Counters, histograms, rates and rollups of the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def counter(rows: DataFrame, value: Column, is_array: bool = False) -> DataFrame:
    """(value, n): rows by a value, or by each element of a list; missing is "None", an empty list counts nothing."""
    shown = F.explode(value) if is_array else value
    return rows.select(F.coalesce(shown.cast("string"), F.lit("None")).alias("value") if not is_array else shown.cast("string").alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def counters(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(name, value, n) of several columns in one pass: each row becomes its (name, value) pairs, combined before the shuffle."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("value")) for c in columns]))
    return rows.select(pairs.alias("p")).groupBy("p.name", "p.value").agg(F.count("*").alias("n"))


def length_histogram(rows: DataFrame, length: Column, width: int = 100, cap: int = 20) -> DataFrame:
    """(bucket, n): lengths in bins of ``width``, all above the cap in one."""
    bin_ = F.least(F.floor(length / width), F.lit(cap)).cast("int")
    label = F.when(bin_ >= cap, F.lit(f"{width * cap}+")).otherwise(F.concat((bin_ * width).cast("string"), F.lit("-"), (bin_ * width + width - 1).cast("string")))
    return rows.groupBy(label.alias("bucket")).agg(F.count("*").alias("n"))


def rate(part: Column, whole: Column) -> Column:
    """A share, 0 of nothing."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def reason_histogram(rows: DataFrame, reasons: str) -> DataFrame:
    return rows.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def _paths(files: DataFrame, path: str) -> DataFrame:
    """(group, paper, kind, suffix, image) of files below arXiv_src_ folders; see ``directory_rollup``."""
    part = F.split(path, "/")
    paper, folder, name = F.element_at(part, -3), F.element_at(part, -2), F.element_at(part, -1)
    suffix = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    kind = (
        F.when(folder == F.concat(paper, F.lit("_extracted_figs")), "extracted")
        .when(folder == F.concat(paper, F.lit("_extracted_figs_merged")), "merged")
        .when(folder.rlike("_extracted_figs(_merged)?$"), "other")
    )
    source = F.element_at(part, -4)
    inside = files.where((F.size(part) >= 5) & source.startswith("arXiv_src_"))
    return inside.select(F.element_at(part, -5).alias("group"), F.concat_ws("/", source, paper).alias("paper"), kind.alias("kind"), suffix.alias("suffix"), suffix.isin(*C.IMAGE_SUFFIXES).alias("image"))


def directory_rollup(files: DataFrame, path: str) -> DataFrame:
    """Papers and images a group and in all (group null): a rollup over image and directory paths.

    Paths end in GROUP/arXiv_src_X/PAPER/FOLDER/file. A folder named after its paper holds extracted or merged
    images; other extracted folders count as other.
    """
    rows = _paths(files, path)
    of = lambda k: F.col("kind") == k
    return rows.rollup("group").agg(
        F.count_distinct("paper").alias("papers"),
        F.count_distinct(F.when(of("extracted"), F.col("paper"))).alias("with_extracted"),
        F.count_distinct(F.when(of("merged"), F.col("paper"))).alias("with_merged"),
        F.count_if(of("extracted") & F.col("image")).alias("extracted_images"),
        F.count_if(of("merged") & F.col("image")).alias("merged_images"),
        F.count_if(of("other") & F.col("image")).alias("other_images"),
    )


def suffix_counts(files: DataFrame, path: str) -> DataFrame:
    """(group, suffix, n): images of each suffix a group and in all (group null), in folders of any of the kinds."""
    images = _paths(files, path).where(F.col("kind").isNotNull() & F.col("image"))
    return images.groupingSets([["group", "suffix"], ["suffix"]], "group", "suffix").agg(F.count("*").alias("n"))


def consensus(values: Column, answer_type: Column, numbers: Column) -> Column:
    """Whether answers agree: all equal, or approximate numbers within 2 % or 0.05, or within 5 % of the largest.

    ``values`` are normalised answers and ``numbers`` each one's first number (null: none); a scale is at least 1.
    """
    spread = F.array_max(numbers) - F.array_min(numbers)
    scale = F.greatest(F.array_max(F.transform(numbers, lambda x: F.abs(x))), F.lit(1.0))
    close = (spread <= F.greatest(0.02 * scale, F.lit(0.05))) | (spread / scale <= 0.05)
    numeric = (answer_type == "numeric_approx") & ~F.exists(numbers, lambda x: x.isNull())
    return F.coalesce((F.size(values) > 0) & ((F.size(F.array_distinct(values)) == 1) | (numeric & close)), F.lit(False))
