"""File listings and the figure sources that rest on them. A listing is a scan of names: no content is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of all files below a folder, unreadable ones left out; sort by path for a fixed order."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("ignoreMissingFiles", True)
    return reader.load(root).select("path", "length", F.col("modificationTime").alias("modified"))


def with_suffix(files: DataFrame, suffixes: tuple[str, ...] = C.IMAGE_SUFFIXES) -> DataFrame:
    return files.where(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*suffixes))


def directories(files: DataFrame, name_pattern: str, max_depth: int = 0) -> DataFrame:
    """(directory): folders on a file's path whose name matches; 0 is any depth below the listing."""
    parts = F.split("path", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    found = files.select(F.explode(prefixes).alias("directory")).distinct().where(F.element_at(F.split("directory", "/"), -1).rlike(name_pattern))
    return found if not max_depth else found.where(F.size(F.split("directory", "/")) <= max_depth)


def merged_directories(files: DataFrame, fixed: str, name_pattern: str, max_depth: int) -> DataFrame:
    """Folders of the fixed layout; those of any folder down to a depth only where the layout has none."""
    first = directories(files, name_pattern).where(F.col("directory").rlike(fixed))
    return first if not first.isEmpty() else directories(files, name_pattern, max_depth)


def resolve_image(records: DataFrame, files: DataFrame, declared: Column, json_path: Column) -> DataFrame:
    """Adds image_path: the declared path, its name beside the JSON file, the JSON's stem with .png, then with any image suffix.

    One join of each record's few candidate paths with the listing; the earliest that exists wins, else the declared path.
    """
    folder, stem = F.regexp_extract(json_path, r"^(.*/)?[^/]*$", 1), F.regexp_replace(json_path, r"\.[^./]*$", "")
    name = F.regexp_extract(declared, r"([^/]+)$", 1)
    candidates = [F.nullif(declared, F.lit("")), F.when(name != "", F.concat(folder, name)), *[F.concat(stem, F.lit(s)) for s in (".png", *[x for x in C.IMAGE_SUFFIXES if x != ".png"])]]
    keyed = records.withColumns({"record of image": F.xxhash64(F.struct(*[F.col(c) for c in records.columns])), "paths of image": F.array(*candidates), "declared image": declared})
    tried = keyed.select("record of image", F.posexplode("paths of image").alias("place", "tried")).where(F.col("tried").isNotNull())
    found = tried.join(files.select(F.col("path").alias("tried")).distinct(), "tried").groupBy("record of image").agg(F.min_by("tried", "place").alias("found image"))
    joined = keyed.join(found, "record of image", "left")
    return joined.withColumn("image_path", F.coalesce("found image", "declared image", F.lit(""))).drop("record of image", "paths of image", "declared image", "found image")


def figure_records(spark: SparkSession, root: str, years: range = range(2020, 2026)) -> tuple[DataFrame, DataFrame]:
    """(candidates without images resolved, broken records) of the layout arxiv_YYMM/arXiv_src_*/paper/*_extracted_figs[_merged]/*.json.

    Folders of other years are pruned by the path before a file is opened.
    """
    buckets = ",".join(f"{y % 100:02d}" for y in years)
    pattern = f"{root}/arxiv_{{{buckets}}}[0-9][0-9]/arXiv_src_*/*/*_extracted_figs*/*.json"
    raw = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("json_path"), F.col("value").alias("raw"))
    parsed = raw.withColumn("record", F.try_parse_json("raw"))
    is_object = F.coalesce(F.schema_of_variant("record").startswith("OBJECT"), F.lit(False))
    return project_records(parsed.where(is_object)), parsed.where(~is_object).select("json_path", F.lit("not a JSON object").alias("error"))


def project_records(parsed: DataFrame) -> DataFrame:
    """The candidate columns of (json_path, record VARIANT), only papers of the wanted years."""
    from ..operators import filters

    get = lambda name, kind="string": F.try_variant_get("record", f"$.{name}", kind)
    when = T.year_month_from_path(F.col("json_path"))
    name = F.regexp_extract("json_path", r"([^/]+)$", 1)
    merged = filters.is_merged(get("is_merged_figure", "boolean"), get("record_type"), name)
    listed = lambda field: F.coalesce(get(field, "array<string>"), F.when(get(field).isNotNull(), F.array(get(field))), F.array().cast("array<string>"))
    indices = get("merged_source_image_indices", "array<int>")
    image_index = F.coalesce(F.nullif(get("image_index_in_figure", "int"), F.lit(0)), F.get(indices, F.lit(0)))
    figure = F.coalesce(get("figure_index", "int"), F.lit(0))
    rows = parsed.withColumns({"when": when, "merged": merged, "paper_id": get("paper_id"), "figure_index": figure})
    rows = rows.where(F.col("paper_id").rlike(C.PAPER_ID) & F.col("when.year").between(2020, 2025))
    return rows.select(
        T.candidate_id(F.col("paper_id"), F.col("figure_index"), F.col("merged"), image_index).alias("candidate_id"),
        "paper_id", F.col("when.year").alias("year"), F.col("when.month").alias("month"), F.col("when.bucket").alias("source_bucket"), "figure_index",
        F.when(F.col("merged"), "merged").otherwise("single").alias("image_kind"),
        F.coalesce(get("output_image"), get("image_path"), F.lit("")).alias("declared_image"), "json_path",
        F.coalesce(get("caption_latex"), F.lit("")).alias("caption_latex"), listed("reference_paragraphs_latex").alias("reference_paragraphs_latex"), listed("labels").alias("labels"),
        F.coalesce(get("figure_tex"), F.lit("")).alias("figure_tex"), filters.with_status(rows, "record").alias("status"),
        get("merged_panel_count", "int").alias("merged_panel_count"), get("merged_source_image_count", "int").alias("merged_source_image_count"),
        F.to_json(get("merge_layout", "variant")).alias("merge_layout"),
    )


def image_folder(spark: SparkSession, root: str, expected: int = 0) -> DataFrame:
    """Figures of a flat folder of images named by paper id; with ``expected``, another number of them is an error."""
    files = with_suffix(listing(spark, root)).withColumn("stem", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))
    rows = files.select(
        F.col("stem").alias("candidate_id"), F.regexp_extract("stem", r"([0-9]{4}\.[0-9]+)", 1).alias("paper_id"), F.col("path").alias("image_path"),
        F.regexp_extract("stem", r"([0-9]{4})\.[0-9]+", 1).alias("month"), F.lit(True).alias("accepted"), F.lit(1.0).alias("chart_confidence"),
    )
    rows = rows.withColumn("year", (2000 + F.left("month", F.lit(2)).try_cast("int")))
    if expected and (n := rows.count()) != expected:
        raise ValueError(f"{n} images where {expected} are expected")
    return rows.orderBy("image_path")


def resized_images(images: DataFrame, folder: str, max_pixels: int) -> DataFrame:
    """(path, copy, made): each image's copy shrunk to an area, as a PNG file in ``folder``; 0 is the image itself.

    ``images`` has path, length and modified, as ``listing`` gives them. A copy's name holds a digest of these, so a
    changed image gets another one; a copy that is there is not made again. Images are decoded by Spark's image source.
    """
    from collections.abc import Iterator
    from uuid import uuid4

    import pandas as pd
    from pyarrow import fs

    from ..functions import images as I

    if max_pixels <= 0:
        return images.select("path", F.col("path").alias("copy"), F.lit(False).alias("made"))
    spark = images.sparkSession
    named = [f for f in images.columns if f in ("path", "length", "modified")]
    paths = images.select(*named, F.regexp_replace("path", "^file:/+", "/").alias("plain"))
    roots = [r[0] for r in images.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1)).distinct().collect()]
    pixels = spark.read.format("image").load(roots).select("image.*").withColumn("of", F.regexp_replace("origin", "^file:/+", "/"))
    rows = paths.join(pixels, F.col("plain") == F.col("of")).select("path", "length", F.unix_micros("modified").alias("modified"), "height", "width", "nChannels", "data")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        for batch in batches:
            done = []
            for r in batch.itertuples(index=False):
                name = I.cache_name(r.path, r.length, 1000 * r.modified, max_pixels)
                missing = system.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound
                if missing:  # written aside and moved, so that no other task sees part of it
                    temporary = f"{base}/.{name}.{uuid4().hex}"
                    with system.open_output_stream(temporary) as out:
                        out.write(I.encode_png(I.resized_copy(I.from_spark(r.height, r.width, r.nChannels, r.data), max_pixels)))
                    system.move(temporary, f"{base}/{name}")
                done.append((r.path, f"{folder}/{name}", missing))
            yield pd.DataFrame(done, columns=["path", "copy", "made"])

    return rows.mapInPandas(make, "path string, copy string, made boolean")


def eval_records(metadata: DataFrame, chart_types: DataFrame) -> DataFrame:
    """Evaluation figures with their chart types.

    ``metadata`` has split, figure_id, paper_id and descriptive columns; ``chart_types`` has split, figure_id and any of chart_type,
    chart_types, answer, label (the first that is not empty counts; a scalar is a list of one). Rows without a paper go.
    """
    listed = lambda c: F.array(F.col(c)) if dict(chart_types.dtypes)[c] == "string" else F.col(c)
    filled = [F.when((F.size(listed(c)) > 0) & (F.coalesce(F.get(listed(c), F.lit(0)), F.lit("")) != ""), listed(c)) for c in ("chart_type", "chart_types", "answer", "label") if c in chart_types.columns]
    types = chart_types.select(F.col("split").alias("s"), F.col("figure_id").alias("f"), F.coalesce(*filled, F.array().cast("array<string>")).alias("chart_types"))
    rows = metadata.withColumn("paper_id", F.trim("paper_id")).where(F.col("paper_id") != "")
    joined = rows.join(types, (F.col("split") == F.col("s")) & (F.col("figure_id") == F.col("f")), "left").drop("s", "f")
    return joined.withColumn("chart_types", F.coalesce("chart_types", F.array().cast("array<string>")))
