"""Documents as blocks and pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import latex as L
from .joins import containing

_TEXT, _WHOLE = T.StringType(), T.IntegerType()
_FIELDS = (("id", _TEXT), ("type", _TEXT), ("level", _WHOLE), ("raw", _TEXT), ("text", _TEXT), ("caption", _TEXT), ("figure_index", _WHOLE), ("table_rows", T.ArrayType(T.ArrayType(_TEXT))))
BLOCK = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in _FIELDS]))


@F.pandas_udf(BLOCK)
def blocks_of(tex: pd.Series) -> pd.Series:
    return pd.Series([[{n: b.get(n) for n, _ in _FIELDS} for b in L.document_blocks(t or "")] for t in tex])


@F.pandas_udf(T.StringType())
def latex_text(tex: pd.Series) -> pd.Series:
    return pd.Series([L.to_text(t or "") for t in tex], dtype=object)


@F.pandas_udf(T.StringType())
def latex_bare(tex: pd.Series) -> pd.Series:
    return pd.Series([L.bare(t or "") for t in tex], dtype=object)


def blocks(papers: DataFrame, key: str, tex: str) -> DataFrame:
    """One row a block: the paper's key, its place and the block's fields."""
    return papers.select(key, F.posexplode(blocks_of(F.col(tex))).alias("place", "block")).select(key, "place", "block.*")


def with_figures(rows: DataFrame, figures: DataFrame, key: str) -> DataFrame:
    """Blocks with their figure's images and, where there are any, its caption (a join on paper and number)."""
    per = figures.groupBy(F.col(key).alias("paper"), F.col("figure_index").alias("number")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("json_name", "image_name"))), lambda x: x["image_name"]).alias("images"), F.min_by("caption_text", "json_name").alias("figure_caption")
    )
    joined = rows.join(per, (F.col(key) == F.col("paper")) & (F.col("figure_index") == F.col("number")), "left").drop("paper", "number")
    return joined.withColumns({"images": F.coalesce("images", F.array().cast("array<string>")), "caption": F.coalesce("figure_caption", "caption")}).drop("figure_caption")


def references(rows: DataFrame, paragraphs: DataFrame, key: str) -> DataFrame:
    """(paper, figure_id, block_id): reference paragraphs and blocks of a paper of which one contains the other, without white space."""
    block = rows.select(F.col(key).alias("paper"), F.col("id").alias("block_id"), latex_bare("raw").alias("block_text"))
    ref = paragraphs.select(F.col(key).alias("paper"), "figure_id", latex_bare("paragraph").alias("ref_text")).where("ref_text <> ''")
    block, ref = block.withColumnRenamed("paper", "paper of block"), ref.withColumnRenamed("paper", "paper of ref")
    found = [
        containing(block, ref, "block_text", "ref_text", ("paper of block", "paper of ref")),
        containing(ref, block, "ref_text", "block_text", ("paper of ref", "paper of block")),
    ]
    shown = [f.select(F.col("paper of ref").alias("paper"), "figure_id", "block_id") for f in found]
    return shown[0].union(shown[1]).distinct()


def block_cost(kind: Column, text: Column, images: Column, rows: Column) -> Column:
    return (
        F.when(kind == "title", 150)
        .when(kind == "author", 90)
        .when(kind == "heading", 70)
        .when(kind == "figure", 360 + 120 * F.greatest(F.lit(0), images - 1))
        .when(kind == "table", 180 + F.least(F.lit(700), F.greatest(rows, F.lit(3)) * 42))
        .otherwise(F.greatest(F.lit(56), 24 + F.floor(F.length(text) / 2).cast("int")))
    )


def paginate(rows: DataFrame, key: str, place: str, cost: str, limit: int = C.PAGE_LIMIT) -> DataFrame:
    """Adds ``page`` (from 1): blocks fill a page until the next would pass the limit; a block alone may.

    A running total that starts anew has no window form, so each key's blocks stream past in order; only the total is held.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, page, used = object(), 0, 0
        for batch in batches:
            pages = []
            for of, c in zip(batch["key of page"], batch[cost], strict=True):
                if of != current:
                    current, page, used = of, 1, 0
                elif used + c > limit:
                    page, used = page + 1, 0
                used += c
                pages.append(page)
            yield batch.drop(columns="key of page").assign(page=pages)

    keyed = rows.withColumn("key of page", F.coalesce(F.col(key).cast("string"), F.lit("")))
    placed = keyed.repartition(F.col("key of page")).sortWithinPartitions("key of page", place)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return placed.mapInPandas(run, f"{schema}, page int")


def stats(papers: DataFrame, rows: DataFrame, key: str, tex: str) -> DataFrame:
    """Lengths of each paper's source and blocks."""
    per = rows.groupBy(key).agg(F.sum(F.length("raw")).alias("block_raw_chars"), F.sum(F.length("text")).alias("block_text_chars"), F.count("*").alias("num_blocks"))
    return papers.select(key, F.length(tex).cast("long").alias("total_tex_chars")).join(per, key, "left")
