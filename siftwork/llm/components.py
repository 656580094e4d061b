"""Connected components of a link table by alternating star contractions.

Every round points each node's larger neighbours at its smallest neighbour, then each node at its
smallest smaller neighbour, until no link changes; links then are (node, smallest node of its
component). Only minima and equi-joins are used, so a node with very many links is pre-aggregated
and its join split by AQE; nothing is gathered to the driver but a checksum a round. Rounds are
cut by checkpoints in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _apart(least: DataFrame) -> DataFrame:
    """The minima as a table of their own: joined as they come from their aggregation, they would tie the join to its
    partitions, and AQE could not split a node that most links share."""
    return checkpoint(least)


def _larger_to_smallest(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours, linked to the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _apart(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")))
    return both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _smaller_to_smallest(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked to the smallest of them."""
    least = _apart(links.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w"))
    joined = links.join(least, F.col("u") == F.col("w"))
    moved = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v: two columns of one ordered type).

    root is the component's smallest node and is itself listed. Null ends and self-links are
    ignored; repeated links count once; no links give no rows.
    """
    links = checkpoint(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct())
    before = None
    while True:
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
        links = checkpoint(_smaller_to_smallest(_larger_to_smallest(links)))
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
