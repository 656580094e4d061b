"""Judges, single questions, repairs, merges of stage outputs, and streams that run together, with a scripted client."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import answers as A
from ..operators import aggregates, documents, joins, model, verify
from ..sources.store import new_folder
from ..streaming import stages
from .tables import listed, read, spread

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


class Scripted:
    """Replies that follow from the call's fields: good ones, ones that are put right when asked again, and bad ones."""

    def complete(self, prompt: str, image: str | None, settings: dict) -> str:
        task, fields = settings["task"], settings.get("fields") or {}
        if task == "question":
            number, attempt = int(fields["id"]), int(fields["attempt"])
            if number % 10 == 0:
                return "no object"
            if number % 4 == 0 and attempt == 0:
                return json.dumps({"question": "What is the title of the figure?"})
            return json.dumps({"question": f"Compare {fields['task']} for {number}.", "answer_type": "boolean", "reasoning_steps_required": 2})
        if task == "judge_answers":
            answer = fields["answer"]
            return json.dumps({"verdict": "Consistent" if answer != "0" else "inconsistent", "all_answers_consistent": answer != "0", "canonical_answer": f" {answer} ", "canonical_answer_index": 2})
        if task == "judge_reasoning":
            good = len(fields["final_answer"]) % 2 == 0
            return json.dumps({"verdict": "PASS" if good else "fail", "final_answer_matches": True, "reasoning_grounded": True, "has_contradiction": False})
        if task == "reason":
            number = int(prompt.rpartition(" ")[2])
            wrong = number % 3 == 0 and settings.get("attempt") == 0
            return f"Seen in the figure.\nFinal answer: {'other' if wrong or number % 7 == 0 else f'value {number}'}"
        if task == "caption":
            return "{}" if prompt.endswith("0") else json.dumps({"dense_caption": f"About {prompt}", "uncertainty": []})
        raise ValueError(task)


_FIRST_TASKS = list(C.TASKS)[:2]


@query(f"""
SELECT doc_id AS candidate_id, task AS task_type, CASE WHEN doc_id % 10 = 0 THEN '' ELSE 'Compare ' || task || ' for ' || doc_id || '.' END AS question,
  CASE WHEN doc_id % 10 = 0 THEN 'empty question' END AS reject, CASE WHEN doc_id % 10 = 0 THEN 1 ELSE 2 END AS steps
FROM documents, (SELECT unnest({listed(_FIRST_TASKS)}) AS task)
""")
def model_stub_questions(spark, d):
    """One call for each figure and task; low-value questions are asked for again, bad replies are rejected."""
    rows = spread(read(spark, d, "documents")).select(
        F.col("doc_id").alias("candidate_id"), F.explode(F.array(*[F.lit(t) for t in _FIRST_TASKS])).alias("task_type"), F.lit("{}").alias("classifier"),
        F.col("text").alias("caption_latex"), F.lit(False).alias("is_multi_panel"), F.lit(1).alias("panel_count"),
    )
    found = verify.single_questions(rows, Scripted, how=model.Calling(sleep=0.0))
    return found.select("candidate_id", "task_type", "question", "reject", "steps")


_ANSWER = "(('0x' || left(sha1(text), 4))::INTEGER % 7)::VARCHAR"


@query(f"""
SELECT doc_id AS id, a AS answer, 2 AS sample, a <> '0' AS answer_verified, CASE WHEN a = '0' THEN 'answer_consistency_failed:inconsistent' END AS judge_error FROM (SELECT doc_id, {_ANSWER} AS a FROM documents)
""")
def model_stub_answer_judge(spark, d):
    """Three answers a question, then a judge of them: the canonical answer and the sample that it names."""
    rows = spread(read(spark, d, "documents")).select(F.col("doc_id").alias("id"), F.col("text").alias("question"), F.lit("integer").alias("answer_type"))
    answered = verify.answers(rows, model.StubClient).withColumn("task_type", F.lit("counting"))
    judged = verify.judge_answers(answered, Scripted)
    return judged.select("id", "answer", F.col("sample.sample").alias("sample"), "answer_verified", "judge_error")


@query("""
SELECT conv_id, turn, ok AND length(final) % 2 = 0 AS thinking_verified, CASE WHEN length(final) % 2 = 0 THEN 'PASS' ELSE 'fail' END AS judge_verdict
FROM (SELECT conv_id, turn, 'value ' || turn || CASE WHEN conv_id % 2 = 0 THEN 'x' ELSE '' END AS final, turn % 5 > 0 AS ok FROM conversations)
""")
def model_stub_reasoning_judge(spark, d):
    final = F.concat(F.lit("value "), F.col("turn").cast("string"), F.when(F.col("conv_id") % 2 == 0, "x").otherwise(""))
    rows = read(spark, d, "conversations").select(
        "conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("id"), F.lit("Which?").alias("question"), F.lit("trend").alias("task_type"), F.lit("short_phrase").alias("answer_type"),
        final.alias("answer"), F.col("text").alias("response"), final.alias("final_answer"), (F.col("turn") % 5 > 0).alias("final_answer_matches"),
    )
    return verify.judge_reasoning(rows, Scripted).select("conv_id", "turn", "thinking_verified", "judge_verdict")


@query("""
SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN 'other' ELSE 'value ' || doc_id END AS final_answer, CASE WHEN doc_id % 7 = 0 THEN 'final answer does not match' END AS error FROM documents
""")
def reasoning_rounds(spark, d):
    """Reasoning asked for again where its answer differs; what never matches is a dead letter."""
    rows = spread(read(spark, d, "documents")).select(
        F.col("doc_id").alias("id"), F.concat(F.lit("Explain "), F.col("doc_id").cast("string")).alias("prompt"), F.concat(F.lit("value "), F.col("doc_id").cast("string")).alias("answer"), F.lit("short_phrase").alias("answer_type")
    )
    return verify.reasoning(rows, Scripted).select("id", "final_answer", "error")


@query("""
SELECT d.doc_id AS id, CASE WHEN l.doc_id IS NOT NULL AND d.doc_id % 7 > 0 THEN 'value ' || d.doc_id ELSE 'old' END AS final_answer, l.doc_id IS NOT NULL AND d.doc_id % 7 > 0 AS repaired,
  CASE WHEN l.doc_id IS NOT NULL AND d.doc_id % 7 = 0 THEN 'reasoning is still not usable' END AS error FROM documents d LEFT JOIN (SELECT * FROM labels WHERE quality = 0) l USING (doc_id)
""")
def model_stub_repair(spark, d):
    """Failed rows are asked for again from another endpoint; those that fail once more keep what they had."""
    existing = read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit("old text").alias("response"), F.lit("old").alias("final_answer"))
    bad = read(spark, d, "labels").where("quality = 0").select(F.col("doc_id").alias("of"))
    targets = existing.join(bad, F.col("id") == F.col("of"), "left_semi").select(
        "id", F.concat(F.lit("Explain "), F.col("id").cast("string")).alias("prompt"), F.concat(F.lit("value "), F.col("id").cast("string")).alias("answer"), F.lit("short_phrase").alias("answer_type")
    )
    table, failed = verify.repair(existing, targets, "id", {"chat": model.StubClient, "messages": Scripted}, "messages", "reasoning", "prompt")
    failed = failed.withColumnRenamed("id", "of")
    return table.join(failed, F.col("id") == F.col("of"), "left").select("id", "final_answer", "repaired", "error")


_MERGED = """
t AS (SELECT * FROM conversations), s AS (SELECT doc_id FROM documents),
q AS (SELECT conv_id, max(turn) AS m, arg_max(text, turn) AS text FROM t WHERE role = 'user' GROUP BY conv_id),
a AS (SELECT conv_id, arg_max(text, turn) AS text FROM t WHERE role = 'assistant' GROUP BY conv_id),
c AS (SELECT conv_id, arg_max(text, turn) AS text FROM t WHERE role = 'system' GROUP BY conv_id)
"""


def _outputs(spark, d):
    turns = read(spark, d, "conversations")
    of = lambda role: turns.where(F.col("role") == role).select(F.col("conv_id").alias("candidate_id"), F.col("turn").alias("line"), "text", F.lit("choice").alias("task_type"), F.lit("hard").alias("difficulty"), F.lit("choice").alias("answer_type"))
    direct = of("user").withColumns({"question": F.col("text"), "answer": F.lit("direct")}).drop("text")
    thinking = of("assistant").withColumns({"question": F.col("text"), "answer": F.lit(None).cast("string"), "response": F.col("text"), "failed": F.lit(False)}).drop("text")
    captions = of("system").withColumns({"dense_caption": F.col("text"), "failed": F.lit(False)}).select("candidate_id", "line", "dense_caption", "failed")
    return read(spark, d, "documents").select(F.col("doc_id").alias("candidate_id"), "lang"), direct, thinking, captions


@query(f"""
WITH {_MERGED} SELECT 'g_' || doc_id AS id, coalesce(a.text, q.text) AS question, CASE WHEN a.conv_id IS NULL AND q.conv_id IS NOT NULL THEN 'direct' END AS answer, c.text AS dense_caption,
  q.conv_id IS NOT NULL AS has_direct, a.conv_id IS NOT NULL AS has_thinking, c.conv_id IS NOT NULL AS has_caption, FALSE AS qa_only
FROM s LEFT JOIN q ON doc_id = q.conv_id LEFT JOIN a ON doc_id = a.conv_id LEFT JOIN c ON doc_id = c.conv_id
UNION ALL SELECT 'g_' || doc_id, a.text, NULL, c.text, q.conv_id IS NOT NULL, TRUE, c.conv_id IS NOT NULL, TRUE
FROM s LEFT JOIN q ON doc_id = q.conv_id JOIN a ON doc_id = a.conv_id LEFT JOIN c ON doc_id = c.conv_id
""")
def merged_outputs(spark, d):
    """Samples with their direct answer, reasoning and caption; question fields from the reasoning row where there is one."""
    tables = _outputs(spark, d)
    shown = ["id", "question", "answer", "dense_caption", "has_direct", "has_thinking", "has_caption"]
    both = [joins.merge_outputs(*tables, "g", qa_only=only).select(*shown, F.lit(only).alias("qa_only")) for only in (False, True)]
    return both[0].union(both[1])


@query(f"""
WITH {_MERGED} SELECT doc_id AS candidate_id, q.text AS question, c.text AS dense_caption FROM s JOIN q ON doc_id = q.conv_id JOIN a ON doc_id = a.conv_id JOIN c ON doc_id = c.conv_id ORDER BY doc_id LIMIT 20
""")
def review_join(spark, d):
    """The first complete figures of a sample, as a review page shows them."""
    sample, direct, thinking, captions = _outputs(spark, d)
    last = lambda rows, *fields: joins.last_wins(rows.select("candidate_id", "line", *fields), ["candidate_id"], ["line"]).drop("line")
    rows = joins.review_rows(sample, last(direct, "question"), last(direct, "answer"), last(thinking, "response"), last(captions, "dense_caption"), 20, "candidate_id")
    return rows.select("candidate_id", "question", "dense_caption")


@query(f"""
WITH f AS (SELECT 'g' || doc_id % 3 AS g, lower((['.png', '.JPG', '.txt'])[doc_id % 3 + 1]) AS suffix FROM documents WHERE doc_id % 5 > 0 AND doc_id % 3 < 2)
SELECT g AS "group", suffix, count(*) AS n FROM f GROUP BY GROUPING SETS ((g, suffix), (suffix))
""")
def suffix_counts(spark, d):
    n = F.col("doc_id")
    paper = F.concat(F.lit("p"), (n % 40).cast("string"))
    folder = F.when(n % 5 == 0, "plain").when(n % 5 == 1, F.concat(paper, F.lit("_extracted_figs_merged"))).otherwise(F.concat(paper, F.lit("_extracted_figs")))
    suffix = F.element_at(F.array(F.lit(".png"), F.lit(".JPG"), F.lit(".txt")), (n % 3 + 1).cast("int"))
    path = F.concat(F.lit("/r/g"), (n % 3).cast("string"), F.lit("/arXiv_src_"), (n % 2).cast("string"), F.lit("/"), paper, F.lit("/"), folder, F.lit("/f"), n.cast("string"), suffix)
    return aggregates.suffix_counts(read(spark, d, "documents").select(path.alias("path")), F.col("path"))


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'c' || event_id WHEN event_id % 3 = 1 THEN 's' || event_id ELSE event_id::VARCHAR END AS row_id,
  CASE WHEN event_id % 2 = 0 THEN 'own' ELSE 'of source' END AS caption FROM events
""")
def row_ids(spark, d):
    n, text = F.col("event_id"), F.col("event_id").cast("string")
    rows = read(spark, d, "events").select(
        "event_id", n.alias("id"), F.when(n % 3 == 0, F.concat(F.lit("c"), text)).alias("candidate_id"), F.when(n % 2 == 0, " own ").alias("caption_latex"),
        F.struct(F.when(n % 3 == 1, F.concat(F.lit("s"), text)).alias("candidate_id"), F.lit("of source").alias("caption_latex")).alias("source"),
    )
    return rows.select("event_id", joins.row_id(rows).alias("row_id"), joins.caption_latex(rows).alias("caption"))


@query("""
SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'seen' WHEN 1 THEN 'inside' ELSE 'It rises.' END AS thinking, CASE turn % 3 WHEN 0 THEN 'a ' || conv_id ELSE 'b ' || conv_id END AS final_answer,
  CASE turn % 3 WHEN 0 THEN 'json' ELSE 'think_final' END AS format FROM conversations
""")
def thinking_answers(spark, d):
    """Replies as JSON, with a reasoning block, and with a marked last line."""
    conv = F.col("conv_id").cast("string")
    said = (
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit('{"reasoning": " seen ", "answer": "a '), conv, F.lit('"}')))
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("<think> inside </think>\nFINAL ANSWER: `b "), conv, F.lit("`")))
        .otherwise(F.concat(F.lit("It rises.\nFinal answer: b "), conv))
    )
    return read(spark, d, "conversations").select("conv_id", "turn", A.extract_thinking(said).alias("found")).select("conv_id", "turn", "found.*")


@query("SELECT conv_id, turn, '<image>' || chr(10) || text AS asked, 'user' AS first_role, 'reply ' || turn AS said, 'assistant' AS second_role FROM conversations")
def training_messages(spark, d):
    turns = verify.chat_messages(F.col("text"), F.concat(F.lit("reply "), F.col("turn").cast("string")))
    rows = read(spark, d, "conversations").select("conv_id", "turn", turns.alias("m"))
    return rows.select("conv_id", "turn", F.col("m")[0]["content"].alias("asked"), F.col("m")[0]["role"].alias("first_role"), F.col("m")[1]["content"].alias("said"), F.col("m")[1]["role"].alias("second_role"))


_BARE = "regexp_replace({}, '\\s+', '', 'g')"


@query(f"""
WITH b AS (SELECT doc_id % 4 AS p, doc_id::VARCHAR AS block_id, {_BARE.format("regexp_replace(text, '%[^' || chr(10) || ']*', '', 'g')")} AS t FROM documents),
r AS (SELECT item_id % 4 AS p, item_id::VARCHAR AS figure_id, {_BARE.format("regexp_replace(text, '%[^' || chr(10) || ']*', '', 'g')")} AS t FROM benchmark)
SELECT p AS paper, figure_id, block_id FROM b JOIN r USING (p) WHERE r.t <> '' AND (contains(b.t, r.t) OR contains(r.t, b.t) AND b.t <> '')
""")
def paragraph_references(spark, d):
    """Reference paragraphs and blocks of a paper of which one holds the other."""
    rows = spread(read(spark, d, "documents")).select((F.col("doc_id") % 4).alias("paper"), F.col("doc_id").cast("string").alias("id"), F.col("text").alias("raw"))
    paragraphs = read(spark, d, "benchmark").select((F.col("item_id") % 4).alias("paper"), F.col("item_id").cast("string").alias("figure_id"), F.col("text").alias("paragraph"))
    return documents.references(rows, paragraphs, "paper")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def stream_target(spark, d):
    """A stage that ends at a target, and again with a larger one: no event is lost."""
    folder = new_folder(spark, "target")
    events = read(spark, d, "events").select("event_id", "user_id")
    for lot in range(4):
        events.where(F.col("event_id") % 4 == lot).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    for target in (1, 10**9):
        stages.run_stage(spark, f"{folder}/in", events.schema, f"{folder}/out", f"{folder}/checkpoint", ["event_id"], files_a_batch=1, target=target).awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN 2 ELSE 3 END AS round FROM events WHERE event_id % 3 < 2 OR event_id % 2 = 0")
def stream_rounds(spark, d):
    """Rounds over what is missing; a round after the target is there does nothing."""
    table = f"{new_folder(spark, 'rounds')}/table"
    events = read(spark, d, "events").select("event_id")
    rounds = [lambda rows, k=k, rule=rule: rows.where(rule).withColumn("round", F.lit(k)) for k, rule in ((1, "event_id % 3 = 0"), (2, "event_id % 3 = 1"), (3, "event_id % 2 = 0"))]
    first = stages.complete_in_rounds(events, table, ["event_id"], rounds)
    if stages.is_complete(spark, table, first.count()):
        return stages.complete_in_rounds(events.limit(0), table, ["event_id"], rounds)
    raise ValueError("the table does not hold what it returned")


@query("SELECT event_id, upper(event_type) AS stage, event_id % 2 = 0 AS captioned FROM events")
def stream_together(spark, d):
    """Two chained stages and a branch of captions that run at the same time, until the producer is done."""
    folder = new_folder(spark, "together")
    events = read(spark, d, "events").select("event_id", "event_type")
    events.write.parquet(f"{folder}/in")
    spark.range(1).write.csv(f"{folder}/done")
    made = [
        ("first", None, ["event_id"], lambda rows: rows),
        ("second", "first", ["event_id"], lambda rows: rows.withColumn("stage", F.upper("event_type"))),
        ("captions", None, ["event_id"], lambda rows: rows.where("event_id % 2 = 0").select("event_id")),
    ]
    tables = stages.run_together(spark, f"{folder}/in", events.schema, folder, made, f"{folder}/done", every="200 milliseconds", quiet=1, timeout=600)
    marked = joins.mark(tables["second"], tables["captions"], "event_id", "captioned")
    return marked.select("event_id", "stage", "captioned")
