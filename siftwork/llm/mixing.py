"""Mixing sources to target weights by weighted fair queueing.

Every document gets a place in its source's shuffled order. Its virtual finish time is the
source's tokens up to and including it, divided by the source's target, so all sources reach
virtual time 1 with their targets taken; a document that time 1 falls in is split there. The
schedule is range-sorted by finish time over all sources, and its running total is truncated
where the total budget is spent.

Scale: texts are read once, for their sizes; the rest works on a narrow table. A source is never
gathered in one task. Its order is a hash of the id and the text, so the hash's leading digits cut each
source into cells; cell totals (a partial aggregation) give each cell its start, and the running sum
runs inside a cell only. The global running total does the same with slots of virtual time, which are
even shares of the mix, and are what it is range-partitioned by. A table with a row a source is sorted in one
task; a table with a row a slot is broadcast.

Defined results: a null or empty text has size 0, is taken 0 times and takes no budget; a null
source is a source of its own, last in order; repeated rows and equal ids each get their own place
(ties by size); an empty table gives an empty mix. Extra columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, checkpoint, partitions, table

#: Slots of virtual time: a fixed number, each an even share of the mix.
SLOTS = 1 << 15


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """One row a source: source, source_size, target (words), and the budget of all.

    ``sizes`` has (source, size). Sources in code-point order, null last, get the weights in turn
    and share the total; a target stops at ``max_epochs`` times its source's size and the excess
    is shared again by weight. That fixed point is water-filling: ordered by cap / weight, the
    capped sources are a prefix, so one running sum over the sources (one row each) finds it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cyclic = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", cyclic).withColumn("cap", F.col("source_size") * float(max_epochs))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    every = Window.partitionBy()
    per = (
        per.withColumn("budget", F.sum("source_size").over(every).cast("double"))
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("capped_before")) / F.col("weight_left"))
    )
    # The first source that its cap does not stop sets the water level for itself and all after it.
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("level")))
    level = F.min(free).over(every)["level"]
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return per.select("source", "source_size", target.alias("target"), F.col("budget").cast("long").alias("budget"))


def sized(rows: DataFrame, text: str = "text", seed: int = 17) -> DataFrame:
    """(rid, doc_id, source, size, place) of each row of ``rows`` (rid, doc_id, source, text): place orders a source's rows.

    The texts are read once, here; what follows works on this narrow table.
    """
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), named, F.md5(F.coalesce(F.col(text), F.lit("")))))
    return checkpoint(rows.select("rid", F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col(text)).alias("size"), place.alias("place")))


def schedule(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """The mix as one global order: ``rows`` as ``sized`` gives them, a row a copy.

    Returns rid, doc_id, source, size, source_size, target, epoch (from 0), virtual_finish, and words, which is
    what the mix takes of the copy. A copy that virtual time 1 falls in is split there and offers its first part, which
    finishes at 1. All offers are range-sorted by finish time; the running total over that order is
    cut at the total budget. Every row's first copy is there, with no words if none are taken.
    """
    digits = 3
    rows = rows.withColumn("cell", F.substring("place", 1, digits))
    targets = checkpoint(source_targets(rows, weights, max_epochs))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    # At most 16 ** digits rows a source, whatever the number of documents.
    starts = cells.withColumn("cell_start", F.sum("cell_size").over(Window.partitionBy("source").orderBy("cell")) - F.col("cell_size"))
    starts = starts.withColumnRenamed("source", "s").withColumnRenamed("cell", "c").drop("cell_size")
    starts = starts.join(targets, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    placed = rows.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))).drop("s", "c")
    inside = Window.partitionBy("source", "cell").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("before", F.col("cell_start") + F.sum("size").over(inside) - F.col("size"))
    copies = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    start = F.col("before") + F.col("epoch") * F.col("source_size")
    offered = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.round("target").cast("long") - start))
    finish = F.least(F.lit(1.0), F.try_divide((start + F.col("size")).cast("double"), F.col("target")))
    copies = copies.withColumns({"offered": offered, "virtual_finish": F.coalesce(finish, F.lit(1.0))}).where((F.col("offered") > 0) | (F.col("epoch") == 0))
    # Virtual time passes evenly in words, so slots of it are even shares of the mix; they are the ranges of the sort.
    # Copies of which nothing is offered count for nothing, so they may lie in any slot.
    slot = F.when(F.col("offered") > 0, F.floor(F.col("virtual_finish") * SLOTS)).otherwise(F.pmod(F.xxhash64("place", "rid"), F.lit(SLOTS)))
    copies = copies.withColumn("slot", slot.cast("int"))
    order = ["virtual_finish", F.col("source").isNull(), "source", "place", "epoch", "size"]
    ranged = copies.repartitionByRange(partitions(rows.sparkSession), "slot").sortWithinPartitions("slot", *order)
    # One row a slot.
    slots = copies.groupBy("slot").agg(F.sum("offered").alias("slot_words"))
    before = F.sum("slot_words").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("slot_words")
    slots = slots.select(F.col("slot").alias("k"), before.alias("slot_before"))
    line = Window.partitionBy("slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumn("served", F.sum("offered").over(line) - F.col("offered"))
    # At most SLOTS + 1 rows.
    summed = summed.join(F.broadcast(slots), F.col("slot") == F.col("k"))
    words = F.greatest(F.lit(0).cast("long"), F.least(F.col("offered"), F.col("budget") - F.col("slot_before") - F.col("served")))
    return summed.select("rid", "doc_id", "source", "size", "source_size", "target", "epoch", "virtual_finish", words.alias("words"))


def mix_documents(docs: DataFrame, text: str = "text", weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """``docs`` (doc_id, source, text and others) as mixed: a row a copy, the copy at the cut shortened.

    All columns of ``docs`` come back, whatever their names, in the order of the schedule.
    """
    # The row travels whole, so that no column is named as one of the schedule's. Its number must not change.
    named = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    named = checkpoint(named)
    taken = schedule(sized(named.select("rid", "doc_id", "source", F.col("row")[text].alias("text")), seed=seed), weights, max_epochs)
    taken = taken.where("words > 0").select(F.col("rid").alias("taken"), "size", "words", "epoch", "virtual_finish")
    joined = named.join(taken, F.col("rid") == F.col("taken"))
    keys = ["virtual_finish", "source", "doc_id", "epoch", "rid"]
    placed = joined.repartitionByRange(partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys)
    pieces = F.regexp_extract_all(F.col("row")[text], F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    first = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    shown = F.when(F.col("words") < F.col("size"), first).otherwise(F.col("row")[text])
    return placed.select(*[(shown if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text").withColumn("rid", F.monotonically_increasing_id())
    copies = schedule(sized(docs))
    whole = ["doc_id", "size", "source_size", "target"]
    return copies.groupBy("rid", *whole).agg(F.sum("words").alias("taken")).select(*whole, "taken")


OP5_SQL = r"""
WITH sized AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS place
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size)::DOUBLE AS cap,
         ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE
     - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
     / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per),
water AS (SELECT min_by(level, cap / weight) AS level FROM levels WHERE level * weight <= cap),
targets AS (SELECT source, source_size, least(cap, coalesce(w.level * weight, cap)) AS target FROM levels LEFT JOIN water w ON true),
placed AS (
  SELECT s.rid, s.doc_id, s.source, s.place, s.size, t.source_size, t.target,
         (sum(s.size) OVER (PARTITION BY s.source ORDER BY place, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - s.size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, greatest(0, least(size, round(target)::BIGINT - before - epoch * source_size)) AS offered,
         coalesce(least(1.0::DOUBLE, (before + epoch * source_size + size)::DOUBLE / nullif(target, 0)), 1.0) AS virtual_finish
  FROM placed, (SELECT unnest([0, 1, 2]) AS epoch)),
served AS (
  SELECT *, (sum(offered) OVER (ORDER BY virtual_finish, source IS NULL, source, place, epoch, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS until,
         (SELECT sum(size) FROM sized)::BIGINT AS budget
  FROM copies WHERE offered > 0 OR epoch = 0)
SELECT doc_id, size, source_size, target, sum(greatest(0, least(offered, budget - until + offered)))::BIGINT AS taken
FROM served GROUP BY rid, doc_id, size, source_size, target
"""
