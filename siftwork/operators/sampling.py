"""Samples under quotas and caps.

Greedy acceptance in one fixed order under caps that nest (a paper lies in one month, a month in one year) equals
ranks taken one inside another: keep the paper's first rows, among those the month's, among those the year's. Samplers
whose caps do not nest run as rounds of such steps, each over the rows that are left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C


def seeded_order(seed: int, *keys: Column | str) -> Column:
    """A shuffle's sort key: a digest of the seed and the row's id, the same on every run and in any engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]))


def nested_caps(rows: DataFrame, caps: list[tuple[list[str], Column | int]], order: list[Column], used: dict[int, str] | None = None) -> DataFrame:
    """Rows that greedy acceptance in ``order`` keeps under nested caps, innermost first.

    ``caps`` are (key columns, most rows); every key must hold the next one's columns, so that ranks nest. ``used`` names
    a column with the rows of that key that were taken before, by the cap's place.
    """
    for place, (key, most) in enumerate(caps):
        taken = F.coalesce(F.col(used[place]), F.lit(0)) if used and place in used else F.lit(0)
        rank = f"rank {place}"
        rows = rows.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(rank) + taken <= most).drop(rank)
    return rows


def year_quotas(target: int, years: range = range(2020, 2026)) -> dict[int, int]:
    """Equal shares, the remainder to the last year."""
    share = {y: target // len(years) for y in years}
    share[years[-1]] += target - sum(share.values())
    return share


def _lookup(values: dict, key: Column, default: int = 0) -> Column:
    if not values:
        return F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))]), key), F.lit(default))


def pilot_selection(rows: DataFrame, target: int, order: str, min_score: int = 2) -> DataFrame:
    """A pilot of ``target`` rows: quotas a year, two rows a paper, a cap a month; then any row of score 1.

    Columns: candidate_id, paper_id, year, month, score.
    """
    quotas = year_quotas(target)
    quota = _lookup(quotas, F.col("year"))
    month_cap = F.greatest(F.lit(1), (F.floor(quota / 12) + 10).cast("int"))
    good = rows.where((F.col("score") >= min_score) & (quota > 0))
    caps = [(["paper_id", "month", "year"], 2), (["month", "year"], month_cap), (["year"], quota)]
    first = nested_caps(good, caps, [F.col(order)]).withColumn("phase", F.lit(1))
    first = first.orderBy(order).limit(target)
    left = rows.join(first.select(F.col("candidate_id").alias("taken")), F.col("candidate_id") == F.col("taken"), "left_anti").where(F.col("score") >= 1)
    both = first.unionByName(left.withColumn("phase", F.lit(2)))
    return both.orderBy("phase", order).limit(target)


def group_sample(pool: DataFrame, target: int, per_paper: int = 2, eval_first: bool = True, compat: bool = False) -> DataFrame:
    """The four-phase sample; adds ``phase`` and ``sample_index``.

    Columns: candidate_id, paper_id, month (its text holds the year), year, bucket, confidence, is_eval. Phase 1 takes rows of
    evaluation papers; 2 each year in turn, rare buckets first; 3 the rest under all caps; 4 the rest under the cap a paper.
    Rows already taken do not come again unless ``compat``. Rounds are bounded (a dozen), each a few windows over what is left.
    """
    from .rounds import Rounds

    quotas = year_quotas(target)
    caps = {y: math.ceil(q / 12 * 1.3) for y, q in quotas.items()}
    sure = -F.coalesce(F.col("confidence").cast("double"), F.lit(0.0))
    rounds = Rounds(pool, "candidate_id", compat)
    month_cap = _lookup(caps, F.col("year"), target)
    papers, months = ("paper_id", F.lit(per_paper)), ("month", month_cap)
    if eval_first:
        rounds.take(pool.where("is_eval"), [sure, F.col("candidate_id")], [papers, months], target)
    for year, quota in quotas.items():
        taken = rounds.count(F.col("year") == year)
        counts = {r["bucket"]: r["n"] for r in rounds.taken.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        order = [_lookup(counts, F.col("bucket")), sure, F.col("candidate_id")]
        rounds.take(pool.where(F.col("year") == year), order, [papers, months], min(target, rounds.total + max(0, quota - taken)))
    order = [sure, F.col("candidate_id")]
    rounds.take(rounds.left(), order, [papers, months], target)
    rounds.take(rounds.left(), order, [papers], target)
    return rounds.result()


def apportion(target: int, weights: dict[str, int]) -> dict[str, int]:
    """Whole quotas by weight: rounded half to even, at least 1; the largest lose and the heaviest gains the difference."""
    total = sum(weights.values())
    quota = {k: max(1, round(target * w / total)) for k, w in weights.items()}
    while sum(quota.values()) > target:
        quota[max(quota, key=quota.__getitem__)] -= 1
    quota[max(weights, key=weights.__getitem__)] += target - sum(quota.values())
    return quota


def task_sample(rows: DataFrame, target: int, weights: dict[str, int], per_image: int = 3, seed: int = 20260611, text: str | None = None) -> DataFrame:
    """Quotas a task, a cap an image over all tasks, hard questions first; leftovers fill up to the target.

    Columns: id, task_type, image_id, difficulty_score. ``text`` names a question column to refuse near-duplicates of
    an image by. A target of 0, or one that the rows do not exceed, returns every row as it is.
    """
    from .rounds import Rounds

    if not target or target >= rows.count():
        return rows.withColumns({"phase": F.lit(0), "sample_index": F.lit(None).cast("long")})
    rounds = Rounds(rows, "id", False)
    order = [-F.col("difficulty_score"), seeded_order(seed, "id"), F.col("id")]
    cap = [("image_id", F.lit(per_image))] if per_image else []
    for task, quota in apportion(target, weights).items():
        rounds.take(rows.where(F.col("task_type") == task), order, cap, rounds.total + quota, text=text)
    rounds.take(rounds.left(), order, cap, target, text=text)
    return rounds.result()


def cyclic_tasks(rows: DataFrame, order: list[Column], runs: tuple[tuple[str, int], ...] = C.CYCLE) -> DataFrame:
    """Adds ``task_type``: the tasks' runs laid end to end, again and again along the order.

    The row's number comes from range-partitioned counts, so no task numbers all rows.
    """
    sequence = [task for task, n in runs for _ in range(n)]
    numbered = number_rows(rows, order)
    cycle = F.array(*[F.lit(t) for t in sequence])
    return numbered.withColumn("task_type", F.element_at(cycle, (F.col("row_index") % len(sequence) + 1).cast("int")))


def number_rows(rows: DataFrame, order: list[Column], name: str = "row_index") -> DataFrame:
    """Adds the row's place, from 0, in the global order.

    Rows are range-partitioned; each partition numbers its own and the counts of those before are added, one row a partition.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    # The id's upper bits are the partition and its lower 33 bits the place in it.
    low = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = counts.select(F.col("part").alias("of"), (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("start"))
    return placed.join(F.broadcast(starts), part == F.col("of")).withColumn(name, F.col("start") + low).drop("of", "start", "place")


def shard_targets(target: int, shards: int) -> list[int]:
    """Equal whole shares, the first ones one larger."""
    return [target // shards + (k < target % shards) for k in range(shards)]
