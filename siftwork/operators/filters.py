"""Filters that say why a row goes, accept rules, and the repair of open model output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T


def reasons(*rules: tuple[str, Column]) -> Column:
    """The names of the rules that hold, in order; a null rule does not hold."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))


def hard_filter(rows: DataFrame, image_exists: Column | None = None) -> DataFrame:
    """Adds ``reasons`` (empty: the row passes) and the figures they rest on.

    Columns: image_kind, status, image_path, caption_latex, width, height (null: not decodable).
    A missing image hides all later reasons, as nothing else can be said of it.
    """
    exists = F.coalesce(F.col("image_path"), F.lit("")) != "" if image_exists is None else image_exists
    status = ("status_not_success", (F.coalesce(F.col("image_kind"), F.lit("")) != "merged") & ~F.col("status").eqNullSafe("success"))
    suffix = F.lower(F.regexp_extract("image_path", r"(\.[^./]+)$", 1))
    rows = rows.withColumns({
        "short_side": F.when(F.col("width").isNotNull() & F.col("height").isNotNull(), F.least("width", "height")),
        "area": F.col("width").cast("long") * F.col("height"),
        "aspect_ratio": F.when(F.col("height") > 0, F.col("width") / F.col("height")).otherwise(F.when(F.col("height") == 0, 0.0)),
    })
    full = reasons(
        status,
        ("unsupported_image_suffix", ~suffix.isin(*C.IMAGE_SUFFIXES)),
        ("caption_too_short", F.length(F.trim(F.coalesce("caption_latex", F.lit("")))) < C.MIN_CAPTION),
        ("image_decode_failed", F.col("width").isNull() | F.col("height").isNull()),
        ("short_side_too_small", F.col("short_side") < C.MIN_SHORT_SIDE),
        ("area_too_small", F.col("area") < C.MIN_AREA),
        ("aspect_ratio_out_of_range", (F.col("aspect_ratio") < C.MIN_ASPECT) | (F.col("aspect_ratio") > C.MAX_ASPECT)),
    )
    return rows.withColumn("reasons", F.when(exists, full).otherwise(reasons(status, ("image_missing", F.lit(True)))))


def prefer_merged(rows: DataFrame, key: list[str], kind: str, panels: str) -> DataFrame:
    """Keeps merged rows of 2 to 8 panels over the single rows of their key.

    Single rows go where such a merged row exists; merged rows go where their key has none; single
    rows of a key that has several become ``single_panel``. What a key has is one small aggregate, and rows meet it
    by a join that AQE can split, so a key (a null one too) may hold any share of the rows.
    """
    good = (F.col(kind) == "merged") & F.coalesce(F.col(panels), F.lit(0)).between(2, 8)
    named = {k: f"key of {k}" for k in key}
    of_key = rows.groupBy(*[F.col(k).alias(n) for k, n in named.items()]).agg(F.coalesce(F.max(good), F.lit(False)).alias("has merged"), F.count_if(F.col(kind) == "single").alias("singles"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()])
    marked = rows.join(of_key, same)
    keep = F.when(F.col(kind) == "single", ~F.col("has merged")).when(F.col(kind) == "merged", F.col("has merged")).otherwise(True)
    renamed = F.when((F.col(kind) == "single") & (F.col("singles") > 1), "single_panel").otherwise(F.col(kind))
    return marked.where(keep).withColumn(kind, renamed).select(*rows.columns)


def accept(real: Column, confidence: Column, vqa: Column, caption: Column, rejects: list[Column]) -> Column:
    """The strict accept rule over flags that ``truthy`` made."""
    sure = F.coalesce(confidence, F.lit(0.0)) >= C.ACCEPT
    rule = real & sure & vqa & caption
    for reject in rejects:
        rule = rule & ~reject
    return rule


def weak_accept(real: Column, confidence: Column) -> Column:
    sure = F.coalesce(confidence, F.lit(0.0))
    return real & (sure >= C.WEAK_ACCEPT) & (sure < C.ACCEPT)


def accepted(rows: DataFrame, include_weak: bool = False) -> DataFrame:
    """Rows with ``accepted`` set, or also those with ``weak_accept``."""
    rule = F.coalesce("accepted", F.lit(False))
    return rows.where(rule | F.coalesce("weak_accept", F.lit(False)) if include_weak else rule)


def clean_types(types: Column, primary: Column, real: Column) -> Column:
    """struct(chart_types, primary): the closed enumeration only; ``other_chart`` for a real chart without any."""
    known = F.array(*[F.lit(t) for t in C.CHART_TYPES])
    kept = F.filter(F.coalesce(types, F.array()), lambda t: F.array_contains(known, t))
    kept = F.when((F.size(kept) == 0) & real, F.array(F.lit("other_chart"))).otherwise(kept)
    fallback = F.coalesce(F.get(kept, F.lit(0)), F.lit("other_chart"))
    return F.struct(kept.alias("chart_types"), F.when(primary.isin(*C.CHART_TYPES), primary).otherwise(fallback).alias("primary"))


def validate_questions(rows: DataFrame, unicode: bool = False) -> DataFrame:
    """Adds ``reject`` (null: valid) and repairs the fields of generated questions.

    Columns: question, requested_task, answer_type, difficulty, steps, visual_elements, risk_notes.
    The requested task always holds; a reply under another task is repaired, not believed.
    """
    question = F.trim(F.coalesce("question", F.lit("")))
    allowed = F.create_map(*[x for t, (_, types) in C.TASKS.items() for x in (F.lit(t), F.array(*[F.lit(a) for a in types]))])
    own = F.try_element_at(allowed, F.col("requested_task"))
    answer = F.trim(F.coalesce("answer_type", F.lit("")))
    return rows.withColumns({
        "reject": F.when(question == "", "empty question").when(T.is_low_value(question, unicode), "low_value_question"),
        "question": question,
        "task_type": F.col("requested_task"),
        "answer_type": F.when(F.array_contains(own, answer), answer).otherwise(F.get(own, F.lit(0))),
        "difficulty": T.enum_or_default(F.col("difficulty"), C.DIFFICULTIES, "medium"),
        "steps": F.greatest(F.lit(1), F.coalesce("steps", F.lit(1))),
        "visual_elements": F.slice(F.coalesce("visual_elements", F.array()), 1, 12),
        "risk_notes": F.slice(F.coalesce("risk_notes", F.array()), 1, 12),
    })


def answers_pass(verdict: Column, all_consistent: Column, canonical: Column) -> Column:
    return (F.lower(F.coalesce(verdict, F.lit(""))) == "consistent") & F.coalesce(all_consistent, F.lit(False)) & (F.trim(F.coalesce(canonical, F.lit(""))) != "")


def thinking_passes(verdict: Column, answer_matches: Column, grounded: Column, contradiction: Column, verified_match: Column) -> Column:
    true = lambda c: F.coalesce(c, F.lit(False))
    return (F.lower(F.coalesce(verdict, F.lit(""))) == "pass") & true(answer_matches) & true(grounded) & ~true(contradiction) & true(verified_match)


def caption_failed(caption: Column, generation_failed: Column | None = None) -> Column:
    text = F.trim(F.coalesce(caption, F.lit("")))
    failed = (text == "") | F.contains(text, F.lit(C.CAPTION_FAILED))
    return failed if generation_failed is None else failed | F.coalesce(generation_failed, F.lit(False))


def image_bytes_lines(files: DataFrame, file: str, line: str, text: str) -> DataFrame:
    """The first line of each file that holds image bytes: (file, line)."""
    return files.where(F.col(text).rlike("base64|data:image/")).groupBy(file).agg(F.min(line).alias(line))


def with_status(rows: DataFrame, record: str, default: str = "success") -> Column:
    """A VARIANT record's status: the default only where the key is absent; an explicit null stays null."""
    value = F.try_variant_get(F.col(record), "$.status", "string")
    return F.when(F.try_variant_get(F.col(record), "$.status", "variant").isNull(), F.lit(default)).otherwise(value)


def is_merged(flag: Column, record_type: Column, name: Column) -> Column:
    return F.coalesce(flag, F.lit(False)) | record_type.eqNullSafe("merged_figure") | F.contains(F.coalesce(name, F.lit("")), F.lit("_merged_"))


def done(raw: DataFrame, verified: DataFrame, key: list[str], retry_failed: bool, schema: tuple[str, str] | None = None) -> DataFrame:
    """Keys that need no work: the verified, and the raw ones unless failures are to be tried again.

    ``schema`` (column, version) lets only rows of the current schema version count.
    """
    both = verified if retry_failed else verified.unionByName(raw, allowMissingColumns=True)
    if schema:
        both = both.where(F.col(schema[0]) == schema[1])
    return both.select(*key).where(F.col(key[0]).isNotNull()).distinct()
