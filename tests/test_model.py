import json

import pytest
from pyspark.sql import functions as F

from siftwork import constants as C
from siftwork.operators import filters, joins, model, verify
from siftwork.sources.store import new_folder

FAST = model.Calling(retries=2, sleep=0.0, threads=2, pending=4)


class Flaky:
    """Fails as its prompt says: a status and how many times."""

    def __init__(self):
        self.seen = {}

    def complete(self, prompt, image, settings):
        status, times = map(int, prompt.split(":"))
        self.seen[prompt] = self.seen.get(prompt, 0) + 1
        if self.seen[prompt] <= times:
            raise model.ModelError(f"HTTP {status}", status)
        return f"ok after {self.seen[prompt]}"


def test_retries_and_dead_letters(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "500:0"), (2, "503:2"), (3, "500:9"), (4, "400:1"), (5, "")], "id int, prompt string")
    quick = model.Calling(retries=2, sleep=0.0)
    found = model.call_model(rows, "prompt", Flaky, how=quick)
    good, bad = model.split_outcome(found)
    assert {r.id: (r.raw_response, r.attempts) for r in good.collect()} == {1: ("ok after 1", 1), 2: ("ok after 3", 3)}
    dead = {r.id: r for r in bad.collect()}
    assert dead[3].attempts == 3 and "500" in dead[3].error and dead[4].attempts == 1 and 5 in dead


def test_waits():
    still = lambda: 0.0
    assert [model.wait_before(k, RuntimeError("x"), 2.0, still) for k in range(3)] == [2, 4, 8]
    assert model.wait_before(0, RuntimeError("Try again after 12.5 seconds"), 2.0, still) == 13.5
    assert model.wait_before(1, model.ModelError("slow", 429), 1.0, still) == 8
    limiter = model.RateLimiter(0)
    limiter.wait()
    assert set(C.RETRYABLE) >= {429, 503}


def test_a_stage_runs_a_row_once(spark):
    table = new_folder(spark, "stage")
    calls = spark.sparkContext.accumulator(0)

    def work(rows):
        def count(batches):
            for b in batches:
                calls.add(len(b))
                yield b.assign(reply="r")

        return rows.mapInPandas(count, "id long, reply string")

    model.run_stage(spark.range(5), work, table, ["id"])
    again = model.run_stage(spark.range(8), work, table, ["id"])
    assert sorted(r.id for r in again.collect()) == list(range(8)) and calls.value == 8


class Scripted:
    """Replies to a question by its own text."""

    def complete(self, prompt, image, settings):
        return prompt


def test_answers_agree_or_not(spark):
    rows = spark.createDataFrame([("a", "Final answer: 3", "integer"), ("b", "", "integer"), ("c", "final answer: 50%", "numeric_approx")], "id string, question string, answer_type string")
    got = {r.id: r for r in verify.answers(rows, Scripted, how=FAST).collect()}
    assert got["a"].consensus and got["a"].answer == "3" and len(got["a"].samples) == 3
    assert not got["b"].consensus and got["b"].error == "missing final answer"
    assert got["c"].samples[0].normal == "0.5"


def test_a_judge_replaces_the_answer(spark):
    rows = spark.createDataFrame([(1, '{"verdict": "Consistent", "all_answers_consistent": true, "canonical_answer": " B ", "canonical_answer_index": 2}'), (2, '{"verdict": "consistent", "all_answers_consistent": true, "canonical_answer": "", "canonical_answer_index": 9}'), (3, "{}")], "id int, v string")
    rows = rows.select("id", F.try_parse_json("v").alias("verdict"), F.array(F.lit("s1"), F.lit("s2")).alias("samples"), F.lit("a").alias("answer"), F.lit("short_phrase").alias("answer_type"))
    got = {r.id: (r.answer, r.sample, r.answer_normalized, r.answer_verified) for r in verify.judged(rows, "verdict").drop("verdict").collect()}
    assert got[1] == ("B", "s2", "b", True) and got[2] == got[3] == ("a", "s1", "", False)


def test_reasoning_and_messages(spark):
    rows = spark.createDataFrame([("so it is", "x"), ("so\nFinal answer: y", "x"), (None, "x")], "r string, a string").withColumn("t", F.lit("short_phrase"))
    got = [(r.r, r.final_answer, r.final_answer_appended, r.final_answer_matches) for r in verify.with_reasoning(rows, "r", "a", "t").collect()]
    assert got == [("so it is\n\nFinal answer: x", "x", True, True), ("so\nFinal answer: y", "y", False, False), ("\n\nFinal answer: x", "x", True, True)]
    turns = spark.range(1).select(verify.chat_messages(F.lit("q"), F.lit("a")).alias("m")).first().m
    assert [(t.role, t.content) for t in turns] == [("user", "<image>\nq"), ("assistant", "a")]


class Groups:
    def complete(self, prompt, image, settings):
        return json.dumps({"questions": [{"task_type": settings["fields"]["tasks"][0], "question": "What is the chart title?"}, {"task_type": settings["fields"]["tasks"][1], "question": "Which is larger?", "difficulty": "easy"}]})


def test_grouped_questions_say_what_is_missing(spark):
    rows = spark.createDataFrame([(1, t) for t in list(C.TASKS)[:3]], "candidate_id int, task_type string")
    got = {r.task_type: (r.reject, r.answer_type, r.difficulty) for r in verify.grouped_questions(rows, Groups, list(C.TASKS), how=FAST).collect()}
    first, second, third = sorted(got)
    assert got[first][0] == "low_value_question" and got[second] == (None, C.TASKS[second][1][0], "medium") and got[third][0] == "missing_from_grouped_response"


def test_classifier_repairs_and_accepts(spark):
    class Odd:
        def complete(self, prompt, image, settings):
            return prompt

    replies = [
        '{"is_real_chart": true, "chart_confidence": "0.8", "chart_types": ["bar_chart", "pie"], "primary_chart_type": "pie", "suitable_for_vqa": true, "suitable_for_dense_caption": true}',
        '{"is_real_chart": true, "chart_confidence": 0.6, "chart_types": []}', '{"is_real_chart": true, "chart_confidence": 0.75, "suitable_for_vqa": true, "suitable_for_dense_caption": true, "is_diagram": "false"}', "no json",
    ]
    rows = spark.createDataFrame([(k, r, 1) for k, r in enumerate(replies)], "candidate_id int, prompt string, score int")
    got = {r.candidate_id: (r.accepted, r.weak_accept, r.chart_types, r.primary_chart_type) for r in verify.classify(rows, Odd, FAST).collect()}
    assert got[0] == (True, False, ["bar_chart"], "bar_chart") and got[1] == (False, True, ["other_chart"], "other_chart")
    assert got[3] == (False, False, [], "other_chart") and got[2][1] is False


def test_done_sets(spark):
    raw = spark.createDataFrame([("a", "v1"), ("b", "v2"), (None, "v2")], "id string, s string")
    verified = spark.createDataFrame([("c", "v2")], "id string, s string")
    ids = lambda **k: sorted(r.id for r in filters.done(raw, verified, ["id"], **k).collect())
    assert ids(retry_failed=True) == ["c"] and ids(retry_failed=False) == ["a", "b", "c"] and ids(retry_failed=False, schema=("s", "v2")) == ["b", "c"]
    rows = spark.createDataFrame([("a",), (None,), ("z",)], "id string")
    assert sorted(str(r.id) for r in joins.exclude(rows, raw, "id").collect()) == ["None", "z"]


def test_status_default_only_where_absent(spark):
    rows = spark.createDataFrame([(1, "{}"), (2, '{"status": null}'), (3, '{"status": "bad"}')], "id int, j string").withColumn("record", F.try_parse_json("j"))
    assert {r.id: r.s for r in rows.select("id", filters.with_status(rows, "record").alias("s")).collect()} == {1: "success", 2: None, 3: "bad"}


@pytest.mark.parametrize(("values", "kind", "numbers", "agree"), [(["a", "a"], "choice", [None, None], True), (["a", "b"], "choice", [None, None], False), (["1", "1.04"], "numeric_approx", [1.0, 1.04], True), (["100", "104"], "numeric_approx", [100.0, 104.0], True), (["100", "120"], "numeric_approx", [100.0, 120.0], False), (["1", "x"], "numeric_approx", [1.0, None], False), ([], "choice", [], False)])
def test_consensus(spark, values, kind, numbers, agree):
    from siftwork.operators.aggregates import consensus

    rows = spark.createDataFrame([(values, numbers)], "v array<string>, n array<double>")
    assert rows.select(consensus(F.col("v"), F.lit(kind), F.col("n")).alias("c")).first().c is agree


class SecondTime:
    """The right answer, but for one question only when asked again, and never for another."""

    def complete(self, prompt, image, settings):
        right = prompt == "first" or (prompt == "second" and settings["attempt"] == 1)
        return f"Because.\nFinal answer: {'x' if right else 'y'}"


def test_reasoning_is_asked_again(spark):
    rows = spark.createDataFrame([(1, "first"), (2, "second"), (3, "third")], "id int, prompt string").withColumns({"answer": F.lit("x"), "answer_type": F.lit("short_phrase")})
    got = {r.id: (r.final_answer, r.error) for r in verify.reasoning(rows, SecondTime, how=FAST).collect()}
    assert got == {1: ("x", None), 2: ("x", None), 3: ("y", "final answer does not match")}


def test_prompts_and_paths(spark):
    from siftwork.functions import text as T

    row = spark.createDataFrame([("q", None, "c" * 9)], "a string, b string, c string")
    assert row.select(T.prompt("A {a}{b}!", F.col("c"), 4, a=F.col("a"), b=F.col("b")).alias("p")).first().p == "A q!\n\ncccc"
    paths = spark.createDataFrame([("/d/x",), ("/dd/x",), ("/d/../e",), ("/d",), (None,)], "p string")
    assert [r.v for r in paths.select(T.within(F.col("p"), ["/d"]).alias("v")).collect()] == [True, False, False, True, False]
