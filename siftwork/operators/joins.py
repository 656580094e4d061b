"""Lookups and merges. Every key is compared as a key: a null never joins, and lookup sides hold one row a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import last_wins


def mark(rows: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Adds ``name``: whether the row's key is among ``keys`` (an existence join)."""
    distinct = keys.select(F.col(key).alias("marked key")).where(F.col("marked key").isNotNull()).distinct()
    return rows.join(distinct, F.col(key) == F.col("marked key"), "left").withColumn(name, F.col("marked key").isNotNull()).drop("marked key")


def exclude(rows: DataFrame, keys: DataFrame, *key: str) -> DataFrame:
    """Rows whose key is not among ``keys``; rows with a null key stay."""
    return rows.join(keys.select(*key).distinct(), list(key), "left_anti")


def lookup(rows: DataFrame, side: DataFrame, key: str, order: list[str], required: bool = False) -> DataFrame:
    """Rows with their key's last row of ``side``, whose columns must be named apart; ``required`` drops rows without."""
    last = last_wins(side.where(F.col(key).isNotNull()), [key], order)
    return rows.join(last, key, "inner" if required else "left")


def prefer(*columns: Column) -> Column:
    """The first that is present: repaired, then existing, then fallback."""
    return F.coalesce(*columns)


def overlay(existing: DataFrame, repaired: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``existing`` with the repaired rows' values where there are any; adds ``repaired``."""
    new = repaired.select(F.col(key).alias("repaired key"), *[F.col(c).alias(f"repaired {c}") for c in columns])
    joined = existing.join(new, F.col(key) == F.col("repaired key"), "left")
    found = F.col("repaired key").isNotNull()
    return joined.withColumns({c: F.when(found, F.col(f"repaired {c}")).otherwise(F.col(c)) for c in columns}).withColumn("repaired", found).drop("repaired key", *[f"repaired {c}" for c in columns])


def with_tasks(rows: DataFrame, tasks: list[str], done: DataFrame, key: str) -> DataFrame:
    """Every row with every task that is not done; the tasks are a fixed short list, so they are exploded, not joined."""
    every = rows.withColumn("task_type", F.explode(F.array(*[F.lit(t) for t in tasks])))
    return every.join(done.select(key, "task_type").distinct(), [key, "task_type"], "left_anti")


#: Twelve characters from an "a" or "s" on: about one place in seven of a text in Latin script.
_ANCHOR = "(?s)(?=([as].{11}))"


def containing(texts: DataFrame, passages: DataFrame, text: str, passage: str, within: tuple[str, str] | None = None) -> DataFrame:
    """Pairs where a text contains a passage, both without white space: (all columns of both).

    A text that contains a passage contains its first anchor, so pairs meet by an equi-join on anchors, and only those
    that met fetch their texts and are compared in full; no side is crossed with the other, and a text travels once. ``within``
    names a column of each side that must be equal (the paper): it is part of the join. Passages without an
    anchor (short ones, other scripts) meet by their first characters, cut at every place of the texts; that branch runs only for them.
    """
    squeezed = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\s+", "")
    of = lambda side: F.col(within[side]) if within else F.lit(0)
    row = lambda rows: F.xxhash64(*[F.col(c) for c in rows.columns])
    wanted = passages.withColumns({"passage row": row(passages), "bare passage": squeezed(passage), "within": of(1)}).where(F.col("bare passage") != "")
    wanted = wanted.withColumn("head", F.regexp_extract("bare passage", _ANCHOR, 1))
    bare = texts.withColumns({"text row": row(texts), "bare text": squeezed(text), "within text": of(0)})

    def meet(heads: Column, sought: DataFrame) -> DataFrame:
        cut = bare.select("text row", "within text", F.explode(F.array_distinct(heads)).alias("head of text"))
        sought = sought.select("passage row", "within", "head").distinct()
        return cut.join(sought, (F.col("head of text") == F.col("head")) & (F.col("within text") == F.col("within"))).select("text row", "passage row")

    met = meet(F.regexp_extract_all("bare text", F.lit(_ANCHOR), F.lit(1)), wanted.where("head <> ''"))
    plain = wanted.where("head = ''")
    short = F.least(F.length("bare passage"), F.lit(12))

    def cuts(n: int) -> Column:
        last = F.length("bare text") - n + 1
        places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substring("bare text", i, F.lit(n)))

    for n in [r[0] for r in plain.select(short).distinct().collect()]:
        met = met.union(meet(cuts(n), plain.where(short == n).withColumn("head", F.left("bare passage", F.lit(n)))))
    pairs = met.distinct().select(F.col("text row").alias("of text"), F.col("passage row").alias("of passage"))
    joined = pairs.join(wanted.drop("within", "head"), F.col("of passage") == F.col("passage row")).join(bare.drop("within text"), F.col("of text") == F.col("text row"))
    found = joined.where(F.contains("bare text", F.col("bare passage")))
    return found.select(*[c for c in texts.columns], *[c for c in passages.columns])


def row_id(rows: DataFrame, own: str = "id") -> Column:
    """A row's id as text: candidate_id, else its source's, else its own; columns that are not there count as null."""
    names = rows.columns
    source = [F.col("source.candidate_id")] if "source" in names and "candidate_id" in getattr(rows.schema["source"].dataType, "names", []) else []
    given = [F.col("candidate_id")] if "candidate_id" in names else []
    last = [F.col(own)] if own in names else []
    filled = [F.nullif(c.cast("string"), F.lit("")) for c in [*given, *source]]
    return F.coalesce(*filled, *[c.cast("string") for c in last], F.lit(None).cast("string"))


def caption_latex(rows: DataFrame) -> Column:
    """A row's caption source, its own or its source's, without white space at its ends."""
    source = [F.nullif(F.col("source.caption_latex"), F.lit(""))] if "source" in rows.columns and "caption_latex" in getattr(rows.schema["source"].dataType, "names", []) else []
    own = [F.nullif(F.col("caption_latex"), F.lit(""))] if "caption_latex" in rows.columns else []
    return F.trim(F.coalesce(*own, *source, F.lit("")))


#: Fields of a question that a merged record takes from its reasoning row, or else from its direct row.
QA_FIELDS = ("question", "answer", "task_type", "difficulty", "answer_type")


def merge_outputs(sample: DataFrame, direct: DataFrame, thinking: DataFrame, captions: DataFrame, group: str, qa_only: bool = False, order: str = "line") -> DataFrame:
    """Every sampled figure with its direct answer, its reasoning and its caption, each the last row of its id.

    ``sample`` has candidate_id and its own columns; ``direct`` and ``thinking`` candidate_id, ``order`` and QA_FIELDS (thinking also response and
    failed), ``captions`` candidate_id, ``order``, dense_caption and failed. A figure that has a reasoning row takes all question fields from it,
    nulls included. ``qa_only`` drops figures without one. The has_ flags tell what was there.
    """
    last = lambda rows, name, fields: last_wins(rows.select("candidate_id", order, *fields), ["candidate_id"], [order]).select("candidate_id", F.struct(*fields).alias(name))
    sides = [last(direct, "of direct", QA_FIELDS), last(thinking, "of thinking", (*QA_FIELDS, "response", "failed")), last(captions, "of caption", ("dense_caption", "failed"))]
    rows = sample.join(sides[0], "candidate_id", "left").join(sides[1], "candidate_id", "inner" if qa_only else "left").join(sides[2], "candidate_id", "left")
    there = {n: F.col(f"of {n}").isNotNull() for n in ("direct", "thinking", "caption")}
    fields = {f: F.when(there["thinking"], F.col(f"of thinking.{f}")).otherwise(F.col(f"of direct.{f}")) for f in QA_FIELDS}
    return rows.withColumns(
        fields
        | {"id": F.concat(F.lit(f"{group}_"), F.col("candidate_id").cast("string")), "group": F.lit(group)}
        | {"thinking_response": F.col("of thinking.response"), "thinking_response_failed": F.col("of thinking.failed"), "dense_caption": F.col("of caption.dense_caption"), "caption_failed": F.coalesce("of caption.failed", F.lit(False))}
        | {f"has_{n}": c for n, c in there.items()}
    ).drop("of direct", "of thinking", "of caption")


def review_rows(sample: DataFrame, questions: DataFrame, answers: DataFrame, thinking: DataFrame, captions: DataFrame, limit: int, place: str) -> DataFrame:
    """The first ``limit`` figures, by ``place`` in the sample, that are complete: all four tables have them, with some reasoning and caption.

    Columns: candidate_id in all; thinking has response, captions dense_caption; other columns must be named apart.
    """
    rows = sample
    for side in (questions, answers, thinking.where(F.coalesce("response", F.lit("")) != ""), captions.where(F.coalesce("dense_caption", F.lit("")) != "")):
        rows = rows.join(side, "candidate_id")
    return rows.orderBy(place).limit(limit)
