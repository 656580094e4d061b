"""Samples in rounds: what earlier rounds took counts against the caps of later ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import accept_in_order


class Rounds:
    """Rows taken so far from a pool. Every round's rows are cut from their lineage by a checkpoint."""

    def __init__(self, pool: DataFrame, key: str, again: bool) -> None:
        self.pool, self.key, self.again = pool, key, again
        self.phase = self.total = 0
        self.taken = pool.limit(0).withColumns({"phase": F.lit(0), "sample_index": F.lit(0).cast("long")})

    def left(self) -> DataFrame:
        taken = self.taken.select(F.col(self.key).alias("taken key")).distinct()
        return self.pool.join(taken, F.col(self.key) == F.col("taken key"), "left_anti")

    def count(self, condition: Column) -> int:
        return self.taken.where(condition).count()

    def take(self, rows: DataFrame, order: list[Column], caps: list[tuple[str, Column]], until: int, text: str | None = None) -> None:
        """Take rows in order while each cap's key has room, until so many are taken in all.

        With several caps, a row refused by one does not use up another; the caps here nest (a paper lies
        in one month), so the ranks are taken one inside another.
        """
        self.phase += 1
        room = until - self.total
        if room <= 0:
            return
        if not self.again:
            taken = self.taken.select(F.col(self.key).alias("taken key")).distinct()
            rows = rows.join(taken, F.col(self.key) == F.col("taken key"), "left_anti")
        if text and caps:
            key, most = caps[0]
            rows = self._dissimilar(rows, key, order, text, most)
            caps = []
        for key, most in caps:
            before = self.taken.groupBy(F.col(key).alias("used key")).agg(F.count("*").alias("used"))
            rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
            rows = rows.join(before, F.col(key) == F.col("used key"), "left").withColumn("rank in key", rank + F.coalesce("used", F.lit(0)))
            rows = rows.where(F.col("rank in key") <= most).drop("used key", "used", "rank in key")
        # TakeOrdered: each task keeps its best rows only; the sample's size bounds what meets in one.
        chosen = rows.withColumn("order in round", F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)])).orderBy("order in round").limit(room)
        place = F.row_number().over(Window.orderBy("order in round")) - 1 + self.total
        chosen = chosen.withColumns({"phase": F.lit(self.phase), "sample_index": place.cast("long")}).drop("order in round")
        chosen = _saved(chosen.select(*self.taken.columns))
        self.taken = self.taken.unionByName(chosen)
        self.total += chosen.count()

    def _dissimilar(self, rows: DataFrame, key: str, order: list[Column], text: str, most: Column) -> DataFrame:
        """Rows that a cap and the similarity test accept, after the rows taken from the same key."""
        named = {f"sort {k}": o for k, o in enumerate(order)}
        held = self.taken.select(*self.pool.columns).withColumns({"new": F.lit(0)} | {n: F.lit(None).cast(rows.select(o).schema[0].dataType) for n, o in named.items()})
        fresh = rows.select(*self.pool.columns).withColumns({"new": F.lit(1)} | named)
        cap = rows.sparkSession.range(1).select(most).first()[0]
        kept = accept_in_order(held.unionByName(fresh), key, ["new", *named], F.col(text), cap)
        return kept.where("new = 1").select(*self.pool.columns)

    def result(self) -> DataFrame:
        return self.taken


def _saved(rows: DataFrame) -> DataFrame:
    from ..sources.store import checkpoint

    return checkpoint(rows)
