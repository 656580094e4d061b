"""Clients of the model protocols against a local server."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from siftwork.operators import endpoints, model, verify

IMAGE = "data:image/png;base64,QUJD"
SEEN: list[tuple[str, dict, dict]] = []
FAILURES = {"left": 0}


def sse(*events):
    return "".join(f"data: {e if isinstance(e, str) else json.dumps(e)}\n\n" for e in events)


class Handler(BaseHTTPRequestHandler):
    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        SEEN.append((self.path, dict(self.headers), body))
        status, reply = 200, ""
        if self.path == "/busy" and FAILURES["left"]:
            FAILURES["left"] -= 1
            status, reply = 429, "rate limit; try again after 0 seconds"
        elif self.path in ("/generate", "/busy"):
            said = body["contents"][0]["parts"][-1]["text"]
            reply = json.dumps({"candidates": [{"content": {"parts": [{"text": " Final answer: "}, {"text": said}]}}]})
        elif self.path == "/chat" and body["stream"]:
            reply = ": comment\n\n" + sse({"choices": [{"delta": {"reasoning_content": "because "}}]}, "{torn", {"choices": [{"delta": {"reasoning": "so"}}]}, {"choices": [{"delta": {"content": [{"text": "yes"}]}}, {"text": "!"}]}, {}, "[DONE]", {"choices": [{"delta": {"content": "late"}}]})
        elif self.path == "/chat":
            reply = json.dumps({"choices": [{"message": {"content": "plain", "reasoning": None}, "reasoning_details": [{"text": "deep"}]}]})
        elif self.path == "/messages":
            reply = json.dumps({"content": [{"type": "text", "text": "one "}, "odd", {"type": "text", "text": "two"}]})
        elif self.path == "/odd":
            reply = json.dumps({"nothing": 1})
        else:
            status, reply = 400, "bad request " + "x" * 5000
        data = reply.encode()
        self.send_response(status)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def url():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def client(protocol, url, **more):
    return endpoints.provider(protocol, endpoints.Endpoint(url, "a-model", "a-token", 10, **more))()


def test_generate(url):
    said = client("generate", f"{url}/generate").complete("5", IMAGE, {"max_tokens": 9, "temperature": 0, "extra": {"more": {"k": 1}}})
    path, headers, body = SEEN[-1]
    assert said == "Final answer: 5" and headers["X-Goog-Api-Key".lower().title()] == "a-token"
    assert body["generationConfig"] == {"maxOutputTokens": 9, "temperature": 0} and body["more"] == {"k": 1}
    assert body["contents"][0]["parts"] == [{"inlineData": {"mimeType": "image/png", "data": "QUJD"}}, {"text": "5"}]


def test_chat_streams_and_not(url):
    chat = client("chat", f"{url}/chat", settings=(("top_p", 0.95),))
    assert chat.complete("q", IMAGE, {"temperature": 1}) == "<think>\nbecause so\n</think>\n\nyes!"
    _, headers, body = SEEN[-1]
    assert headers["Authorization"] == "Bearer a-token" and body["stream"] is True and body["top_p"] == 0.95 and body["model"] == "a-model"
    assert body["messages"][0]["content"][0] == {"type": "image_url", "image_url": {"url": IMAGE}}
    assert chat.complete("q", None, {"stream": False}) == "<think>\ndeep\n</think>\n\nplain"
    assert SEEN[-1][2]["messages"][0]["content"] == "q"


def test_messages(url):
    assert client("messages", f"{url}/messages").complete("q", IMAGE, {"max_tokens": 7}) == "one two"
    _, headers, body = SEEN[-1]
    assert headers["Anthropic-Version"] == endpoints.MESSAGES_VERSION and body["max_tokens"] == 7
    assert body["messages"][0]["content"][0]["source"] == {"type": "base64", "media_type": "image/png", "data": "QUJD"}


def test_failures(url):
    with pytest.raises(model.ModelError) as failed:
        client("messages", f"{url}/none").complete("q", None, {})
    assert failed.value.status == 400 and len(str(failed.value)) < 1100
    with pytest.raises(model.ModelError, match="unexpected reply"):
        client("generate", f"{url}/odd").complete("q", None, {})
    with pytest.raises(model.ModelError, match="no data URL"):
        client("messages", f"{url}/messages").complete("q", "/a/path.png", {})
    assert "a-token" not in repr(endpoints.Endpoint("u", "m", "a-token"))
    with pytest.raises(KeyError):
        endpoints.provider("other", endpoints.Endpoint(url))


def test_reply_texts():
    assert endpoints.reply_text([{"content": [{"text": "a"}, "b"]}, None, {"none": 1}, 3]) == "ab3"
    assert endpoints.reply_text({"text": "", "output_text": "z"}) == "z"


def test_a_stage_over_an_endpoint(spark, url):
    FAILURES["left"] = 2
    rows = spark.createDataFrame([(k, str(k), "integer") for k in range(6)], "id long, question string, answer_type string")
    point = endpoints.provider("generate", endpoints.Endpoint(f"{url}/busy", timeout=10))
    found = verify.answers(rows, point, how=model.Calling(retries=3, sleep=0.0, threads=3, pending=5))
    got = {r.id: (r.answer, r.consensus, r.error) for r in found.collect()}
    assert got == {k: (str(k), True, None) for k in range(6)}


def test_judges_ask_again_and_keep_dead_letters(spark):
    class Judge:
        def __init__(self):
            self.asked = 0

        def complete(self, prompt, image, settings):
            self.asked += 1
            if self.asked == 1:
                return "no object at all"
            if "never" in prompt:
                raise model.ModelError("HTTP 400", 400)
            return '{"verdict": "consistent", "all_answers_consistent": true, "canonical_answer": "8", "canonical_answer_index": 99}'

    sample = "array<struct<sample: int, answer: string>>"
    rows = spark.createDataFrame(
        [(1, "q", "t", "integer", [(1, "7"), (2, None)], "7", None), (2, "never", "t", "integer", [(1, "7")], "7", None), (3, "q", "t", "integer", [], None, "call failed")],
        f"id int, question string, task_type string, answer_type string, samples {sample}, answer string, error string",
    ).coalesce(1)
    quick = model.Calling(retries=1, sleep=0.0, threads=1, pending=1)
    got = {r.id: r for r in verify.judge_answers(rows, Judge, quick).collect()}
    assert got[1].answer_verified and got[1].answer == "8" and got[1].sample.answer == "7"
    assert not got[2].answer_verified and "400" in got[2].judge_error and got[2].answer == "7"
    assert not got[3].answer_verified and got[3].judge_verdict is None


def test_skipped_reasoning_judge(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, final_answer_matches boolean")
    got = {r.id: (r.thinking_verified, r.judge_verdict) for r in verify.judge_reasoning(rows, None, skip=True).collect()}
    assert got == {1: (True, "skipped"), 2: (False, "skipped"), 3: (False, "skipped")}


def test_caption_repair(spark):
    class Caption:
        def complete(self, prompt, image, settings):
            return {"a": '{"dense_caption": "new a"}', "b": "{}", "c": "just text"}[prompt]

    existing = spark.createDataFrame([(k, f"old {k}") for k in "abcd"], "id string, dense_caption string")
    targets = existing.where("id <> 'd'").select("id", F.col("id").alias("prompt"))
    table, failed = verify.repair(existing, targets, "id", {"chat": Caption}, "chat", "caption", "prompt")
    assert {r.id: (r.dense_caption, r.repaired) for r in table.collect()} == {"a": ("new a", True), "b": ("old b", False), "c": ("just text", True), "d": ("old d", False)}
    assert [r.id for r in failed.collect()] == ["b"]
    with pytest.raises(ValueError):
        verify.repair(existing, targets, "id", {}, "chat", "other", "prompt")


def test_calls_are_refilled_at_once(spark):
    import time

    class Slow:
        def complete(self, prompt, image, settings):
            time.sleep(0.6 if prompt == "slow" else 0.01)
            return prompt

    rows = spark.createDataFrame([(k, "slow" if k == 0 else "quick") for k in range(60)], "id int, prompt string").coalesce(1)
    how = model.Calling(threads=3, pending=3)
    began = time.time()
    got = model.call_model(rows, "prompt", Slow, how=how).collect()
    assert sorted(r.id for r in got) == list(range(60)) and got[-1].id == 0  # one slow call holds up no other
    assert time.time() - began < 30
