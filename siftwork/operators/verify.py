"""Answers, reasoning and captions: generation with checks, by a pluggable model."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as St

from .. import constants as C
from ..functions import answers as A
from ..functions import text as T
from . import filters
from .aggregates import consensus
from .model import Calling, ModelClient, call_model


def _settings(task: str, **fields: str) -> F.Column:
    return F.to_json(F.struct(F.lit(task).alias("task"), F.struct(*[F.col(v).alias(k) for k, v in fields.items()]).alias("fields")))


def classify(rows: DataFrame, factory: Callable[[], ModelClient], how: Calling = Calling()) -> DataFrame:  # noqa: B008
    """Figures with the classifier's fields, accepted and weak_accept. Columns: candidate_id, prompt, score."""
    asked = call_model(rows.withColumn("call settings", _settings("classify", score="score")), "prompt", factory, "call settings", how=how).drop("call settings")
    reply = F.try_parse_json(A.lenient_json("raw_response"))
    get = lambda name, kind: F.try_variant_get(reply, f"$.{name}", kind)
    true = lambda name: F.coalesce(get(name, "boolean"), F.coalesce(get(name, "string"), F.lit("")) != "")
    cleaned = filters.clean_types(get("chart_types", "array<string>"), get("primary_chart_type", "string"), true("is_real_chart"))
    sure = F.coalesce(get("chart_confidence", "string").try_cast("double"), F.lit(0.0))
    rejects = [true("is_diagram"), true("is_table_screenshot"), true("is_photo_or_qualitative_image")]
    return asked.withColumns({
        "is_real_chart": true("is_real_chart"),
        "chart_confidence": sure,
        "chart_types": cleaned["chart_types"],
        "primary_chart_type": cleaned["primary"],
        "accepted": filters.accept(true("is_real_chart"), sure, true("suitable_for_vqa"), true("suitable_for_dense_caption"), rejects),
        "weak_accept": filters.weak_accept(true("is_real_chart"), sure),
    })


def grouped_questions(rows: DataFrame, factory: Callable[[], ModelClient], tasks: list[str], how: Calling = Calling()) -> DataFrame:  # noqa: B008
    """One call a figure for all its missing tasks; a row for each, with ``reject`` where it gave none or a bad one.

    Columns: candidate_id, task_type (the missing tasks, one row each).
    """
    per = rows.groupBy("candidate_id").agg(F.array_sort(F.collect_set("task_type")).alias("tasks"))
    fields = F.struct(F.col("candidate_id").cast("string").alias("id"), F.col("tasks"))
    asked = per.withColumns({"prompt": F.concat(F.lit("Questions for "), F.col("candidate_id").cast("string")), "call settings": F.to_json(F.struct(F.lit("questions").alias("task"), fields.alias("fields")))})
    replied = call_model(asked, "prompt", factory, "call settings", how=how).drop("call settings")

    @F.pandas_udf("array<struct<task_type: string, question: string, answer_type: string, difficulty: string>>")
    def parsed(reply: pd.Series, wanted: pd.Series) -> pd.Series:
        def one(text: str | None, names: list[str]) -> list[dict]:
            try:
                found = A.grouped_questions(text or "", list(names))
            except ValueError:
                return []
            return [{"task_type": t, "question": _text(q, "question"), "answer_type": _text(q, "answer_type"), "difficulty": _text(q, "difficulty")} for t, q in found.items()]

        def _text(q: dict, name: str) -> str | None:
            return None if q.get(name) is None else q[name] if isinstance(q[name], str) else json.dumps(q[name])

        return pd.Series([one(r, w) for r, w in zip(reply, wanted, strict=True)])

    found = replied.withColumn("found", parsed("raw_response", "tasks"))
    each = found.select("candidate_id", "call_error", "found", F.explode("tasks").alias("requested_task"))
    own = F.get(F.filter("found", lambda q: q["task_type"] == F.col("requested_task")), F.lit(0))
    none = F.array().cast("array<string>")
    rows = each.select("candidate_id", "call_error", "requested_task", own["question"].alias("question"), own["answer_type"].alias("answer_type"), own["difficulty"].alias("difficulty"), F.lit(1).alias("steps"), none.alias("visual_elements"), none.alias("risk_notes"))
    checked = filters.validate_questions(rows)
    missing = F.when(F.col("call_error").isNotNull(), F.col("call_error")).when(F.col("question") == "", F.lit("missing_from_grouped_response")).otherwise(F.col("reject"))
    key = F.concat_ws(":", F.col("candidate_id").cast("string"), "task_type", "question")
    return checked.withColumns({"reject": missing, "id": T.stable_id("q", key)}).drop("call_error")


def answers(rows: DataFrame, factory: Callable[[], ModelClient], samples: int = 3, how: Calling = Calling()) -> DataFrame:  # noqa: B008
    """Independent answers to each question, and whether they agree.

    Columns: id, question, answer_type. Each sample is a row of its own while it is asked for, so samples run in
    parallel and one that fails is retried alone; all of them must be there for a consensus.
    """
    asked = rows.select("id", "question", "answer_type", F.explode(F.sequence(F.lit(1), F.lit(samples))).alias("sample"))
    asked = asked.withColumns({"prompt": F.col("question"), "call settings": F.to_json(F.struct(F.lit("answer").alias("task")))})
    replied = call_model(asked, "prompt", factory, "call settings", how=how).drop("call settings")
    found = replied.withColumn("thinking", A.extract_thinking("raw_response"))
    found = found.withColumn("answer", F.col("thinking.final_answer")).withColumn("normal", A.normalize_answer("answer", "answer_type"))
    sample = F.struct("sample", "answer", "normal", F.get(T.parse_numbers(F.col("normal")), F.lit(0)).alias("number"), F.coalesce("call_error", F.when(F.col("answer").isNull(), F.lit("missing final answer"))).alias("error"))
    per = found.groupBy("id", "question", "answer_type").agg(F.array_sort(F.collect_list(sample)).alias("samples"))
    normal, number = F.transform("samples", lambda s: s["normal"]), F.transform("samples", lambda s: s["number"])
    error = F.get(F.filter(F.transform("samples", lambda s: s["error"]), lambda e: e.isNotNull()), F.lit(0))
    return per.withColumns({
        "error": error,
        "answer": F.get("samples", F.lit(0))["answer"],
        "consensus": error.isNull() & consensus(normal, F.col("answer_type"), number),
    })


def judged(rows: DataFrame, verdict: str) -> DataFrame:
    """Answers after a judge: the canonical answer replaces the first, and a valid index picks its sample.

    Columns: samples, answer, answer_type and ``verdict``, a VARIANT with verdict, all_answers_consistent, canonical_answer, canonical_answer_index.
    """
    get = lambda name, kind: F.try_variant_get(F.col(verdict), f"$.{name}", kind)
    canonical = F.trim(F.coalesce(get("canonical_answer", "string"), F.lit("")))
    index = get("canonical_answer_index", "int")
    passed = filters.answers_pass(get("verdict", "string"), get("all_answers_consistent", "boolean"), canonical)
    chosen = F.when(canonical != "", canonical).otherwise(F.col("answer"))
    valid = F.when((canonical != "") & (index >= 1) & (index <= F.size("samples")), index - 1).otherwise(F.lit(0))
    return rows.withColumns({"answer": chosen, "sample": F.get("samples", valid), "answer_normalized": A.normalize_answer(chosen, F.col("answer_type")), "answer_verified": passed})


def with_reasoning(rows: DataFrame, response: str, answer: str, answer_type: str) -> DataFrame:
    """Reasoning texts that end with the verified answer; a missing last line is added and flagged, as it matches by construction."""
    marked = F.coalesce(T.matches(F.col(response), r"final answer\s*:"), F.lit(False))
    full = F.when(marked, F.col(response)).otherwise(F.concat(F.rtrim(F.coalesce(response, F.lit(""))), F.lit("\n\nFinal answer: "), F.col(answer)))
    shown = F.when(marked, T.final_answer(F.col(response))).otherwise(F.col(answer))
    return rows.withColumns({
        "final_answer": shown,
        "final_answer_appended": ~marked,
        "final_answer_matches": A.normalize_answer(shown, F.col(answer_type)).eqNullSafe(A.normalize_answer(F.col(answer), F.col(answer_type))),
        response: full,
    })


def chat_messages(question: F.Column, reply: F.Column) -> F.Column:
    """The two turns of a training example about an image."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("user", F.concat(F.lit("<image>\n"), question)), turn("assistant", reply))


def captions(rows: DataFrame, factory: Callable[[], ModelClient], how: Calling = Calling()) -> DataFrame:  # noqa: B008
    """Dense captions; a reply that is no JSON is the caption itself. Columns: candidate_id, prompt."""
    asked = rows.withColumn("call settings", F.to_json(F.struct(F.lit("caption").alias("task"))))
    replied = call_model(asked, "prompt", factory, "call settings", how=how).drop("call settings")
    reply = F.try_parse_json(A.caption_response("raw_response"))
    get = lambda name, kind: F.try_variant_get(reply, f"$.{name}", kind)
    caption = F.coalesce(get("dense_caption", "string"), F.lit(""))
    return replied.withColumns({
        "dense_caption": caption, "caption_thinking": get("caption_thinking", "string"), "uncertainty": get("uncertainty", "array<string>"),
        "caption_id": F.concat(F.lit("caption_"), F.col("candidate_id").cast("string")), "caption_verified": ~filters.caption_failed(caption) & F.col("call_error").isNull(),
        "schema_version": F.lit(C.CAPTION_SCHEMA),
    })


def reasoning(rows: DataFrame, factory: Callable[[], ModelClient], regenerate: int = 1, how: Calling = Calling()) -> DataFrame:  # noqa: B008
    """Reasoning for verified answers, asked again where its answer differs; what never matches goes to ``error``.

    Columns: id, prompt, answer, answer_type. A round asks only for the rows that the rounds before left unmatched; a row
    without a matching text is a dead letter and never a row with the answer alone.
    """
    from ..sources.store import checkpoint

    left, found = rows, None
    for attempt in range(regenerate + 1):
        asked = left.withColumn("call settings", F.to_json(F.struct(F.lit("reason").alias("task"), F.lit(attempt).alias("attempt"))))
        replied = call_model(asked, "prompt", factory, "call settings", how=how).drop("call settings")
        said = checkpoint(with_reasoning(replied.withColumnRenamed("raw_response", "response"), "response", "answer", "answer_type"))
        good = said.where(F.col("final_answer_matches") & F.col("call_error").isNull())
        bad = said.where(~F.col("final_answer_matches") | F.col("call_error").isNotNull())
        found = good if found is None else found.unionByName(good)
        left = bad.select(*rows.columns)
    failed = bad.withColumn("call_error", F.coalesce("call_error", F.lit("final answer does not match")))
    return found.unionByName(failed).withColumnRenamed("call_error", "error")


# Prompts of the judges and of single questions; a caller may give its own with the same fields.
ANSWER_JUDGE = (
    "Question: %s\nTask: %s\nAnswer type: %s\nExtracted answers:\n%s\n\nDo all of them give the same answer? Small differences of rounding or reading count as the same "
    "where scale and unit agree; conclusions must be the same. Choose the canonical answer among them. Reply with a JSON object: verdict (consistent or inconsistent), "
    "all_answers_consistent, canonical_answer, canonical_answer_index (from 1), normalized_answers, normalized_answer, reason."
)
REASONING_JUDGE = (
    "Question: %s\nTask: %s\nAnswer type: %s\nVerified answer: %s\nFinal answer of the reasoning: %s\nReasoning:\n%s\n\nDoes the reasoning rest on what the image shows and lead to the verified "
    "answer? Reply with a JSON object: verdict (pass or fail), final_answer_matches, reasoning_grounded, has_contradiction, reason."
)
ONE_QUESTION = "Task %s: %s. Write one question about the figure that takes several steps. Allowed answer types: %s. Classifier: %s. Caption: %s. Reply with a JSON object: question, answer_type, difficulty, reasoning_steps_required, visual_elements_required, risk_notes."
#: Settings of the judges' and generators' calls.
ANSWER_JUDGE_CALL = {"max_tokens": 2048, "temperature": 0, "top_p": 1}
REASONING_JUDGE_CALL = {"max_tokens": 4096, "temperature": 0, "top_p": 1}
QUESTION_CALL = {"max_tokens": 8192, "temperature": 0.9, "top_p": 0.95}


def listed_answers(samples: F.Column) -> F.Column:
    """Numbered lines of the samples' answers."""
    return F.array_join(F.transform(samples, lambda s: F.concat(s["sample"].cast("string"), F.lit(". "), F.coalesce(s["answer"], F.lit("")))), "\n")


def task_lines(tasks: list[str]) -> str:
    """A line a task: its name in words and the answer types it allows."""
    return "\n".join(f"- {t}: {t.replace('_', ' ')}. Allowed answer types: {', '.join(C.TASKS[t][1])}." for t in tasks)


def _options(task: str, call_settings: dict, *fields: F.Column) -> F.Column:
    named = F.struct(*fields) if fields else F.struct(F.lit(None).cast("string").alias("none"))
    return F.to_json(F.struct(F.lit(task).alias("task"), *[F.lit(v).alias(k) for k, v in call_settings.items()], named.alias("fields")))


def _filled(template: str, *values: F.Column) -> F.Column:
    return F.format_string(template, *[F.coalesce(v.cast("string"), F.lit("")) for v in values])


def _is_object(reply: str) -> None:
    A.parse_object(reply)


def judge_answers(rows: DataFrame, factory: Callable[[], ModelClient], how: Calling = Calling(), template: str = ANSWER_JUDGE) -> DataFrame:  # noqa: B008
    """Answers with a text-only judge's verdict on whether they agree; see ``judged`` for what follows from it.

    Columns: id, question, task_type, answer_type, samples, answer, as ``answers`` gives them (rows with an error there
    are not judged and not verified). Adds answer, sample, answer_normalized, answer_verified, judge_verdict and judge_error. A reply that is no
    object is asked for again; when none comes, or the call fails, the row is a dead letter of the judge.
    """
    prompt = _filled(template, F.col("question"), F.col("task_type"), F.col("answer_type"), listed_answers(F.col("samples")))
    first = F.get(F.transform("samples", lambda s: s["answer"]), F.lit(0))
    ready = rows.withColumns({"judge prompt": prompt, "call settings": _options("judge_answers", ANSWER_JUDGE_CALL, first.alias("answer"), F.lit(True).alias("text_only"))})
    asked = ready.where(F.col("error").isNull())
    replied = call_model(asked, "judge prompt", factory, "call settings", how=how, check=_is_object).drop("call settings", "judge prompt", "attempts")
    verdict = replied.withColumn("judge verdict", F.try_parse_json(A.lenient_json("raw_response")))
    found = judged(verdict, "judge verdict")
    said = F.try_variant_get("judge verdict", "$.verdict", "string")
    passed = F.col("answer_verified")
    failed = F.coalesce("call_error", F.when(~passed, F.concat(F.lit("answer_consistency_failed:"), F.coalesce(said, F.lit("")))))
    found = found.withColumns({"judge_verdict": said, "judge_error": failed}).drop("judge verdict", "raw_response", "call_error")
    rest = rows.where(F.col("error").isNotNull())
    none = {n: F.lit(None).cast(found.schema[n].dataType) for n in found.columns if n not in rest.columns}
    return found.unionByName(rest.withColumns(none | {"answer_verified": F.lit(False)}))


def judge_reasoning(rows: DataFrame, factory: Callable[[], ModelClient], image: str | None = None, skip: bool = False, how: Calling = Calling(), template: str = REASONING_JUDGE) -> DataFrame:  # noqa: B008
    """Reasoning with a judge's verdict against the image: adds thinking_verified, judge_verdict and judge_error.

    Columns: id, question, task_type, answer_type, answer, response, final_answer, final_answer_matches. ``skip`` takes the match of
    the final answer for the verdict and asks nothing.
    """
    matches = F.coalesce("final_answer_matches", F.lit(False))
    if skip:
        return rows.withColumns({"thinking_verified": matches, "judge_verdict": F.lit("skipped"), "judge_error": F.lit(None).cast("string")})
    prompt = _filled(template, F.col("question"), F.col("task_type"), F.col("answer_type"), F.col("answer"), F.col("final_answer"), F.col("response"))
    ready = rows.withColumns({"judge prompt": prompt, "call settings": _options("judge_reasoning", REASONING_JUDGE_CALL, F.col("final_answer").alias("final_answer"), F.col("answer").alias("answer"))})
    replied = call_model(ready, "judge prompt", factory, "call settings", image, how, _is_object).drop("call settings", "judge prompt", "attempts")
    verdict = replied.withColumn("judge verdict", F.try_parse_json(A.lenient_json("raw_response")))
    get = lambda name, kind: F.try_variant_get("judge verdict", f"$.{name}", kind)
    passed = filters.thinking_passes(get("verdict", "string"), get("final_answer_matches", "boolean"), get("reasoning_grounded", "boolean"), get("has_contradiction", "boolean"), matches)
    error = F.coalesce("call_error", F.when(~passed, F.concat(F.lit("thinking_judge_failed:"), F.coalesce(get("verdict", "string"), F.lit("")))))
    return verdict.withColumns({"thinking_verified": F.coalesce(passed, F.lit(False)), "judge_verdict": get("verdict", "string"), "judge_error": error}).drop("judge verdict", "raw_response", "call_error")


_TEXT, _LIST = St.StringType(), St.ArrayType(St.StringType())
_QUESTION = (("question", _TEXT), ("answer_type", _TEXT), ("difficulty", _TEXT), ("steps", St.IntegerType()), ("visual_elements", _LIST), ("risk_notes", _LIST))


@F.pandas_udf(St.StructType([St.StructField(n, t) for n, t in _QUESTION]))
def _question_fields(reply: pd.Series) -> pd.DataFrame:
    def listed(value: object) -> list[str]:
        return [str(x) for x in ([value] if isinstance(value, str) else value or [])]

    def one(text: str | None) -> tuple:
        try:
            q = A.parse_object(text or "")
            return q.get("question") and str(q["question"]), q.get("answer_type"), q.get("difficulty"), int(q.get("reasoning_steps_required") or 1), listed(q.get("visual_elements_required")), listed(q.get("risk_notes"))
        except (ValueError, TypeError):
            return None, None, None, None, [], []

    return pd.DataFrame([one(t) for t in reply], columns=[n for n, _ in _QUESTION]).astype({"steps": "Int32"})


def single_questions(rows: DataFrame, factory: Callable[[], ModelClient], retries: int = 1, image: str | None = None, how: Calling = Calling(), template: str = ONE_QUESTION, prefix: str = "q") -> DataFrame:  # noqa: B008
    """One call for each (figure, task), asked again while its question is not valid.

    Columns: candidate_id, task_type, classifier, caption_latex, is_multi_panel, panel_count. Returns a row for each: the question's fields, ``id`` and
    ``reject``, the last reason why there is none: a failed call, no object, or the validation's. A round asks only for what
    the rounds before left without a question.
    """
    from ..sources.store import checkpoint

    about = {t: (t.replace("_", " "), ", ".join(a)) for t, (_, a) in C.TASKS.items()}
    look = lambda k: F.try_element_at(F.create_map(*[x for t, v in about.items() for x in (F.lit(t), F.lit(v[k]))]), F.col("task_type"))
    prompt = _filled(template, F.col("task_type"), look(0), look(1), F.col("classifier"), F.left("caption_latex", F.lit(C.PROMPT_CAPTION)))
    left, found = rows.withColumn("question prompt", prompt), None
    for attempt in range(retries + 1):
        options = _options("question", QUESTION_CALL, F.col("candidate_id").cast("string").alias("id"), F.col("task_type").alias("task"), F.lit(attempt).alias("attempt"))
        replied = call_model(left.withColumn("call settings", options), "question prompt", factory, "call settings", image, how).drop("call settings", "attempts")
        asked = replied.withColumn("fields of question", _question_fields("raw_response")).select(*left.columns, "call_error", F.col("task_type").alias("requested_task"), "fields of question.*")
        checked = filters.validate_questions(asked.drop("task_type"))
        conflict = T.conflicts_with_layout(F.col("question"), F.coalesce("is_multi_panel", F.lit(False)), F.col("panel_count"))
        reject = F.coalesce("call_error", "reject", F.when(conflict, "layout_conflict_question"))
        said = checkpoint(checked.withColumns({"reject": reject, "id": T.stable_id(prefix, F.concat_ws(":", F.col("candidate_id").cast("string"), "task_type", "question"))}).drop("call_error", "requested_task"))
        good, bad = said.where("reject IS NULL"), said.where("reject IS NOT NULL")
        found = good if found is None else found.unionByName(good)
        left = bad.select(*left.columns)
    return found.unionByName(bad).drop("question prompt")


def repair(
    existing: DataFrame, targets: DataFrame, key: str, providers: dict[str, Callable[[], ModelClient]], use: str, kind: str, prompt: str, image: str | None = None, how: Calling = Calling()  # noqa: B008
) -> tuple[DataFrame, DataFrame]:
    """(the table with its failed rows asked for again, dead letters of those that failed once more).

    ``targets`` holds the rows to repair (``key``, ``prompt`` and, for reasoning, answer and answer_type), ``providers`` the endpoints by name, of which
    ``use`` is asked. ``kind`` is reasoning (a row is repaired when its final answer matches) or caption (when it says
    anything). Rows that stay unrepaired keep what they had. Repaired rows have ``repaired`` set.
    """
    from ..sources.store import checkpoint
    from .joins import overlay

    if kind not in ("reasoning", "caption"):
        raise ValueError(f"no repair of {kind}")
    asked = targets.withColumn("call settings", _options("reason" if kind == "reasoning" else "caption", {"max_tokens": 8192, "temperature": 1, "top_p": 1}, F.lit(use).alias("provider")))
    replied = call_model(asked, prompt, providers[use], "call settings", image, how).drop("call settings", "attempts")
    if kind == "reasoning":
        said = with_reasoning(replied.withColumnRenamed("raw_response", "response"), "response", "answer", "answer_type")
        columns, good = ["response", "final_answer"], F.col("final_answer_matches") & ~F.col("final_answer_appended")
    else:
        reply = F.try_parse_json(A.caption_response("raw_response"))
        said = replied.withColumn("dense_caption", F.coalesce(F.try_variant_get(reply, "$.dense_caption", "string"), F.lit("")))
        columns, good = ["dense_caption"], ~filters.caption_failed(F.col("dense_caption"))
    said = checkpoint(said.withColumn("good", F.coalesce(good & F.col("call_error").isNull(), F.lit(False))))
    table = overlay(existing, said.where("good"), key, columns)
    failed = said.where("NOT good").select(key, F.coalesce("call_error", F.lit(f"{kind} is still not usable")).alias("error"))
    return table, failed
