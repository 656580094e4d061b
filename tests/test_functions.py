import math

import pytest
from pyspark.sql import functions as F

from siftwork import constants as C
from siftwork.functions import answers as A
from siftwork.functions import text as T


def one(spark, expression, **values):
    ddl = ", ".join(f"{k} {kind}" for k, (_, kind) in values.items()) or "x int"
    return spark.createDataFrame([tuple(v for v, _ in values.values()) or (1,)], ddl).select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    ("value", "kind", "fixed", "compat"),
    [
        ("0.5", "numeric_approx", "0.5", "5"), ("-3", "integer", "-3", "3"), ("50%", "numeric_approx", "0.5", "50"), ("1e-3", "numeric_exact", "0.001", "1000"),
        ("1,234.5", "numeric_approx", "1234.5", "12345"), ("Yes", "boolean", "yes", "yes"), ("incorrect.", "boolean", "no", "no"), ("maybe", "boolean", "maybe", "maybe"),
        ("１２", "integer", "12", "12"), ("The <b>Red</b>, line!", "short_phrase", "red line", "red line"), (None, "integer", "", ""), ("2.5", "integer", "2", "25"),
        (["X b", None, "the C"], "ranked_list", "x b|c", "x b|c"), (["X b", "c"], "choice", "x b c", "x b c"),
    ],
)
def test_normalize(value, kind, fixed, compat):
    assert A.normalize(value, kind) == fixed
    assert A.normalize(value, kind, compat=True) == compat


def test_native_text_normalisation_is_the_same(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.col("text").rlike(r"^[\x00-\x7F]*$"))
    both = docs.select(T.normalize_ascii(F.col("text")).alias("native"), A.normalize_answer("text", F.lit("short_phrase")).alias("python"))
    assert both.where("native <> python").count() == 0


def test_format_float():
    assert [A.float_text(x) for x in (3.0, 0.1 + 0.2, 1e20, 1234567.891, -2.0000000000001)] == ["3", "0.3", "100000000000000000000", "1234567.9", "-2"]
    assert A.float_text(math.inf) == "inf"


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ('{"a": 1}', {"a": 1}), ('x ```json\n{"a": 2}\n``` y', {"a": 2}), ('<think>{"a": 0}</think>{"a": 3}', {"a": 3}), ('so {"a": "\\d"} end', {"a": "\\d"}),
        ("{'a': True}", {"a": True}), ('```\n{"a": 4}', {"a": 4}), ("[1, 2]", None), ('{"a": 1', None), ("", None), ("plain", None), ("{1, 2}", None),
    ],
)
def test_parse_object(text, wanted):
    if wanted is None:
        with pytest.raises(ValueError):
            A.parse_object(text)
    else:
        assert A.parse_object(text) == wanted


def test_thinking_and_answer():
    assert A.thinking_and_answer('{"reasoning": "r", "answer": "x"}') == ("r", "x", "json")
    assert A.thinking_and_answer("<think> a </think>\nFinal answer: `B`\nmore") == ("a", "B", "think_final")
    assert A.thinking_and_answer("steps\nfinal answer: 7") == ("steps", "7", "think_final")
    assert A.thinking_and_answer("  ") is None
    # A marker inside the reasoning block does not win over the real last line.
    assert A.thinking_and_answer("<think>Final answer: 1</think> Final answer: 2")[1] == "2"


def test_final_answers(spark):
    text = lambda t: {"t": (t, "string")}
    assert one(spark, T.final_answer(F.col("t")), **text("a\nFinal Answer: <answer>“x”</answer>\nb")) == "x"
    assert one(spark, T.final_answer(F.col("t")), **text("a\nlast 'line'")) == "last 'line"
    assert one(spark, T.final_answer(F.col("t")), **text(None)) == ""
    quoted = "<think>final answer: 1</think>\nfinal answer: 2"
    assert one(spark, T.final_answer(F.col("t")), **text(quoted)) == "2"
    assert one(spark, T.final_answer(F.col("t"), compat=True), **text(quoted)) == "1</think>"
    assert one(spark, T.final_answer_to_end(F.col("t")), **text("x final answer: 1\n2 ")) == "1\n2"
    assert one(spark, T.short_answer(F.col("t")), **text("Final answer: a. FINAL ANSWER: b ")) == "b"
    assert one(spark, T.short_answer(F.col("t")), **text('# head\n"yes"\n```\n**note**')) == "yes"


def test_captions_and_groups():
    assert A.caption_fields("<think>t</think>plain")["dense_caption"] == "plain"
    assert A.caption_fields('{"dense_caption": "d"}')["caption_thinking"] == ""
    reply = '{"questions": {"x": {"task_type": "b", "question": "1"}, "y": {"task_type": "a"}, "z": {"task_type": "b", "question": "2"}}}'
    assert list(A.grouped_questions(reply, ["a", "b", "c"])) == ["a", "b"] and A.grouped_questions(reply, ["b"])["b"]["question"] == "1"
    assert list(A.grouped_questions('{"q1": {"task_type": "a"}, "n": 3}', ["a"])) == ["a"]
    assert A.model_text({"content": [{"text": "a"}, "b", {"other": 1}]}) == "ab"


def test_numbers(spark):
    got = one(spark, T.parse_numbers(F.col("t")), t=("-1,234.5 and 50% of 2e3, 1 %, none", "string"))
    assert got == [-1234.5, 0.5, 2000.0, 0.01]
    assert A.numbers_in("-1,234.5 and 50% of 2e3, 1 %, none") == got
    assert one(spark, T.parse_numbers(F.col("t")), t=(None, "string")) == []


def test_scores_and_tokens(spark):
    got = one(spark, T.keyword_score(F.col("t")), t=("A Loss curve, UI screenshot of the ui here: LATEST", "string"))
    assert (got.score, got.positive, got.negative) == (-2, ["loss", "test"], ["screenshot", "ui"])
    assert one(spark, T.question_tokens(F.col("t")), t=("Which value of X-rays is the mean? rays RAYS", "string")) == ["rays"]
    assert one(spark, T.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b")))) == 0.5


def test_ids_and_paths(spark):
    assert one(spark, T.stable_id("q", F.col("t")), t=("é é", "string")).startswith("q_") is True
    assert one(spark, T.stable_id("q", F.col("t")), t=("  ", "string")).count("_") == 1
    args = F.lit("2001.1"), F.lit(7), F.lit(False), F.lit(0)
    assert one(spark, T.candidate_id(*args)) == "2001.1_fig0007_img01"
    got = one(spark, T.year_month_from_path(F.col("t")), t=("/a/arxiv_2103/x", "string"))
    assert (got.month, got.year, got.bucket) == ("2103", 2021, "arxiv_2103")
    assert one(spark, T.year_month_from_path(F.col("t")), t=("/a/arxiv_21035/x", "string")).month is None
    assert one(spark, T.graphics_stem(F.col("t")), t=("././A\\B//c.PDF", "string")) == "a/b/c"
    assert one(spark, T.figure_key(F.col("t")), t=("other.json", "string")) == "other"
    assert one(spark, T.safe_int(F.col("t")), t=("x1", "string")) == 0
    assert one(spark, T.hamming_hex(F.lit("ffffffffffffffff"), F.lit("0000000000000001"))) == 63
    assert one(spark, T.html_escape(F.col("t")), t=("<a href='x'>&\"", "string")) == "&lt;a href=&#x27;x&#x27;&gt;&amp;&quot;"


def test_truthiness(spark):
    assert one(spark, T.truthy(F.lit("false"), "string")) is True
    assert one(spark, T.truthy(F.lit(""), "string")) is False and one(spark, T.truthy(F.lit(None).cast("boolean"), "boolean")) is False
    assert one(spark, T.truthy(F.lit(0), "int")) is False and one(spark, T.truthy(F.array(), "array<int>")) is False


def test_layout_conflicts(spark):
    ask = lambda multi, n: one(spark, T.conflicts_with_layout(F.lit("In panel (b), top left?"), F.lit(multi), F.lit(n)))
    assert ask(False, None) and ask(True, 1) and not ask(True, None) and not ask(True, 4) and ask(None, 4)
    assert sum(w for w, _ in C.TASKS.values()) == 100 and sum(n for _, n in C.CYCLE) == 95
