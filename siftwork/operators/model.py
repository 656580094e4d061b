"""The model-call operator: one external call a row, with retries, a rate limit and dead letters.

A ``ModelClient`` is built once a worker from a picklable factory and called from a bounded pool of threads; rows
stream through, at most ``pending`` in flight, and leave as their calls end. A call has an outside effect, so its result must be
written before it is used twice; ``run_stage`` does that and skips what is already done.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C


class ModelClient(Protocol):
    """Any endpoint: a prompt and an optional image reference in, text out."""

    def complete(self, prompt: str, image: str | None, settings: dict) -> str: ...


class ModelError(RuntimeError):
    """A failed call; ``status`` is the endpoint's, where it gave one."""

    def __init__(self, message: str, status: int | None = None) -> None:
        super().__init__(message)
        self.status = status


class StubClient:
    """Deterministic replies for tests and dry runs: a function of the prompt's fields alone."""

    def complete(self, prompt: str, image: str | None, settings: dict) -> str:
        task = settings.get("task", "echo")
        fields = settings.get("fields", {})
        if task == "classify":
            score = float(fields.get("score") or 0)
            chart = score > 0
            return json.dumps({
                "is_real_chart": chart, "chart_confidence": 0.8 if chart else 0.4, "chart_types": [], "primary_chart_type": None,
                "is_diagram": False, "is_table_screenshot": False, "is_photo_or_qualitative_image": False, "is_multi_panel": False,
                "suitable_for_vqa": chart, "suitable_for_dense_caption": chart,
            })
        if task == "questions":
            asked = fields.get("tasks", [])
            return json.dumps({"questions": [{"task_type": t, "question": f"Compare the two largest values for {fields.get('id')} ({t}).", "difficulty": "medium"} for t in asked]})
        if task == "answer":
            digest = int(hashlib.sha1(prompt.encode()).hexdigest()[:4], 16)
            return f"Final answer: {digest % 7}"
        if task == "caption":
            return json.dumps({"dense_caption": f"A figure about {prompt[:60]}", "uncertainty": []})
        return prompt


class RateLimiter:
    """At most so many calls a second in this worker: the cluster's budget divided by its partitions."""

    def __init__(self, per_second: float) -> None:
        self.gap, self.next = (1 / per_second if per_second else 0.0), 0.0

    def wait(self) -> None:
        now = time.monotonic()
        self.next = max(now, self.next) + self.gap
        if self.next - self.gap > now:
            time.sleep(self.next - self.gap - now)


@dataclass(frozen=True)
class Calling:
    """How calls are made."""

    retries: int = 2
    sleep: float = 2.0
    threads: int = 4
    pending: int = 16
    per_second: float = 0.0


def wait_before(attempt: int, error: Exception, base: float, noise: Callable[[], float] = random.random) -> float:
    """Seconds before the next attempt: doubling with jitter, what the endpoint asks for, and a floor on rate limits."""
    wait = base * 2**attempt + noise()
    said = str(error).lower()
    asked = re.search(r"try again after (\d+(?:\.\d+)?) seconds", said)
    if asked:
        wait = max(wait, float(asked.group(1)) + 1)
    if getattr(error, "status", None) == 429 or "429" in said or "rate limit" in said:
        wait = max(wait, 5 + 3 * attempt + noise())
    return wait


def call(client: ModelClient, prompt: str, image: str | None, settings: dict, how: Calling, limiter: RateLimiter, check: Callable[[str], None] | None = None) -> tuple[str | None, str | None, int]:
    """(reply, error, attempts). Statuses that cannot get better are not tried again; ``check`` may refuse a reply."""
    error: Exception | None = None
    for attempt in range(how.retries + 1):
        try:
            limiter.wait()
            reply = client.complete(prompt, image, settings)
            if check:
                check(reply)
            return reply, None, attempt + 1
        except Exception as caught:  # noqa: BLE001  any failure of a call is the row's, not the job's
            error = caught
            status = getattr(caught, "status", None)
            if attempt == how.retries or (status is not None and status not in C.RETRYABLE):
                return None, repr(caught), attempt + 1
            time.sleep(wait_before(attempt, caught, how.sleep))
    return None, repr(error), how.retries + 1


def call_model(rows: DataFrame, prompt: str, factory: Callable[[], ModelClient], settings: str | None = None, image: str | None = None, how: Calling = Calling(), check: Callable[[str], None] | None = None) -> DataFrame:  # noqa: B008
    """Adds raw_response, call_error and attempts to every row.

    ``settings`` names a column with a JSON object for the client. At most ``how.pending`` calls are in flight; rows leave as
    their calls end, not in the order they came.
    """
    from pyspark.sql import types as St

    added = [St.StructField("raw_response", St.StringType()), St.StructField("call_error", St.StringType()), St.StructField("attempts", St.IntegerType())]
    schema = St.StructType([*rows.schema.fields, *added])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, limiter = factory(), RateLimiter(how.per_second)

        def waiting() -> Iterator[tuple[pd.DataFrame, int, tuple]]:
            for batch in batches:
                options = batch[settings] if settings else [None] * len(batch)
                pictures = batch[image] if image else [None] * len(batch)
                for k, given in enumerate(zip(batch[prompt], pictures, options, strict=True)):
                    yield batch, k, given

        def done(landed: list[tuple[pd.DataFrame, int, tuple]]) -> Iterator[pd.DataFrame]:
            of: dict[int, tuple[pd.DataFrame, list, list]] = {}
            for batch, k, result in landed:
                _, places, results = of.setdefault(id(batch), (batch, [], []))
                places.append(k)
                results.append(result)
            for batch, places, results in of.values():
                yield batch.iloc[places].assign(**{f.name: [r[j] for r in results] for j, f in enumerate(added)})

        with ThreadPoolExecutor(how.threads) as pool:
            # A call that ends makes room for the next row at once, whichever it was; what has ended goes on.
            flying: dict[Future, tuple[pd.DataFrame, int]] = {}
            rows_left, more = waiting(), True
            landed: list[tuple[pd.DataFrame, int, tuple]] = []
            while more or flying:
                while more and len(flying) < how.pending:
                    row = next(rows_left, None)
                    if row is None:
                        more = False
                        break
                    batch, k, (text, picture, options) = row
                    flying[pool.submit(call, client, text or "", picture, json.loads(options) if options else {}, how, limiter, check)] = batch, k
                if flying:
                    ended, _ = wait(flying, return_when=FIRST_COMPLETED)
                    landed += [(*flying.pop(f), f.result()) for f in ended]
                if len(landed) >= how.pending or not flying:
                    yield from done(landed)
                    landed = []

    return rows.mapInPandas(run, schema)


def split_outcome(rows: DataFrame, failed: F.Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(successes, dead letters with their error) of one materialised stage."""
    bad = F.col("call_error").isNotNull() if failed is None else failed
    return rows.where(~bad).drop("call_error"), rows.where(bad).withColumnRenamed("call_error", "error")


def run_stage(rows: DataFrame, work: Callable[[DataFrame], DataFrame], table: str, key: list[str]) -> DataFrame:
    """Run a stage on the rows whose key its table does not hold, append them in one commit, return the table.

    A run after a crash, or on the same input, calls the model for nothing that was written.
    """
    from ..sources.tables import read_or_none

    spark = rows.sparkSession
    before = read_or_none(spark, table)
    todo = rows if before is None else rows.join(before.select(*key).distinct(), key, "left_anti")
    work(todo).write.mode("append").parquet(table)
    return spark.read.parquet(table)
