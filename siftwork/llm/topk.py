"""Exact top-k inner products by a three-phase uniform threshold.

A vector's score is the sum of its partial scores over a few lists, each a block of dimensions.
Phase 1 orders every local list that weighs most for a query (its longest part), takes the list's best
entries and gathers their scores; the k-th best of a query over all workers is a cutoff that no result
can fall below. Phase 2 sends the cutoff back and shares it evenly over the lists (each counted from its
local least score, so shares are never negative): an entry below its share in every list sums to less
than the cutoff and is left. Phase 3 drops entries whose upper bound is below the cutoff and resolves the
others exactly.

Scale: queries go in blocks and candidates in slices of ``SIDE`` rows alike, by hash, so that neither is copied more
often than the other; a task scores one slice against one block. Components travel in as few bytes as they
need. Phase 1 multiplies one list of a query, phase 2 all of them, and neither does so where the lengths of
a slice's longest parts keep every score below the cutoff. Each phase returns at most k entries a query and slice, and partial
scores are held for a few queries at a time. Scores are whole numbers and exact: in doubles while
they are below 2 ** 53, else in 64-bit integers, which they must fit.

Defined results: vectors that are null or hold a null or non-finite component, and null ids, take
no part; vectors of another length than the query's are no candidates; rows that share the query's
vec_id count as its own; repeated query ids are asked once; ties go to the smaller vec_id; fewer
than k candidates are all returned; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, table

LISTS = 4
SIDE = 32_768
#: Partial scores of one list that a task holds at once.
CELLS = 1 << 21


def packed(rows: np.ndarray) -> list[bytes]:
    """Each row of whole numbers as the bytes of one number, then its components, in as many as they need."""
    most = np.maximum(rows.max(axis=1, initial=0), -1 - rows.min(axis=1, initial=0))
    sizes = 1 << np.searchsorted([1 << 7, 1 << 15, 1 << 31], most, side="right")
    out: list[bytes] = [b""] * len(rows)
    for size in np.unique(sizes).tolist():
        of = np.flatnonzero(sizes == size)
        data, step = rows[of].astype(f"<i{size}").tobytes(), rows.shape[1] * size
        for k, row in enumerate(of.tolist()):
            out[row] = bytes([size]) + data[k * step : (k + 1) * step]
    return out


def quantize(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """(vec_id, data): floor(factor * x) of each component, packed. Components beyond 64 bits take no part."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, data = [], []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = vector.values
                if vec_id is None or values is None or values.null_count:
                    continue
                x = np.floor(factor * values.to_numpy(zero_copy_only=False).astype(np.float64))
                if (np.abs(x) < 2.0**63).all():  # and so finite
                    ids.append(vec_id)
                    data += packed(x.astype(np.int64)[None, :])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(data, pa.binary())], ["vec_id", "data"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(build, "vec_id long, data binary")


def _matrices(block: pa.Table, name: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (rows of the block, matrix)."""
    found: dict[tuple[int, int], list[int]] = {}
    data = block[name].to_pylist()
    for row, x in enumerate(data):
        found.setdefault(((len(x) - 1) // x[0], x[0]), []).append(row)
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for n in {n for n, _ in found}:
        parts = [(np.array(rows), np.frombuffer(b"".join([data[r][1:] for r in rows]), f"<i{size}").reshape(len(rows), n).astype(np.int64)) for (m, size), rows in found.items() if m == n]
        out[n] = np.concatenate([r for r, _ in parts]), np.concatenate([x for _, x in parts])
    return out


def _lists(candidates: pa.Table, queries: pa.Table) -> Iterator[tuple]:
    """(candidate ids, query rows, a pair of matrices for each list): candidates and queries of one length."""
    theirs = _matrices(queries, "data")
    ids = candidates["vec_id"].to_numpy()
    for length, (rows, c) in _matrices(candidates, "data").items():
        if length not in theirs or not length:
            continue
        asked, q = theirs[length]
        exact = float(np.abs(c.astype(np.float64)).max()) * float(np.abs(q.astype(np.float64)).max()) * length < 1 << 53
        kind = np.float64 if exact else np.int64
        parts = np.array_split(np.arange(length), min(LISTS, length))
        yield ids[rows], asked, [(np.ascontiguousarray(c[:, p].T.astype(kind)), q[:, p].astype(kind)) for p in parts]


def _best(of: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's k best entries: higher scores, then smaller ids."""
    order = np.lexsort((ids, -scores, of))
    groups = of[order]
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.empty(0, np.int64)
    rank = np.arange(len(groups)) - np.repeat(starts, np.diff(np.r_[starts, len(groups)]))
    return order[rank < k]


def _norms(x: np.ndarray, axis: int) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=axis))


def _seeds(queries: pa.Table, candidates: pa.Table, k: int) -> Iterator[tuple]:
    """Phase 1 over one slice and block: (query rows, candidate ids, scores) of the best entries of each query's lead list."""
    names = queries["query_id"].to_numpy()
    for ids, asked, lists in _lists(candidates, queries):
        lead = np.argmax(np.stack([_norms(q, 1) for _, q in lists]), axis=0)
        # The k + 1 best of the list: one of them may be the query's own row.
        take = min(k + 1, len(ids))
        step = max(1, CELLS // len(ids))
        for n, (c, q) in enumerate(lists):
            of = np.flatnonzero(lead == n)
            for at in range(0, len(of), step):
                some = of[at : at + step]
                top = np.argpartition(-(q[some] @ c), take - 1, axis=1)[:, :take]
                scores = sum(np.einsum("qd,dqt->qt", b[some], a[:, top]) for a, b in lists)
                rows, place = np.nonzero(ids[top] != names[asked[some]][:, None])
                yield asked[some][rows], ids[top[rows, place]], scores[rows, place]


def _survivors(queries: pa.Table, candidates: pa.Table) -> Iterator[tuple]:
    """Phases 2 and 3 over one slice and block: (query rows, candidate ids, scores) of all that reach the cutoff."""
    names = queries["query_id"].to_numpy()
    limits = queries["cutoff"].to_numpy(zero_copy_only=False).astype(np.float64)
    for ids, asked, lists in _lists(candidates, queries):
        # No score of the slice is above the products of the longest parts.
        most = sum(_norms(q, 1) * _norms(c, 0).max() for c, q in lists)
        asked_here = np.flatnonzero(most * (1 + 1e-9) + 1 >= limits[asked])
        step = max(1, CELLS // len(ids))
        for at in range(0, len(asked_here), step):
            some = asked_here[at : at + step]
            limit = limits[asked[some]]
            partial = np.stack([q[some] @ c for c, q in lists])
            least = partial.min(axis=2)
            share = np.where(np.isfinite(limit), (limit - least.sum(axis=0)) / len(partial), -np.inf)
            bounds = least + share[None, :]
            high = partial >= bounds[:, :, None] - 1e-6
            seen = high.any(axis=0) & (names[asked[some]][:, None] != ids[None, :])
            # The upper bound is looked at where an entry is high in some list.
            rows, place = np.nonzero(seen)
            upper = np.where(high[:, rows, place], partial[:, rows, place], bounds[:, rows]).sum(axis=0)
            kept = upper >= limit[rows] - 1e-3
            rows, place = rows[kept], place[kept]
            scores = partial[:, rows, place].sum(axis=0)
            kept = scores >= limit[rows]
            yield asked[some][rows[kept]], ids[place[kept]], scores[kept]


def _entries(queries: pa.Table, candidates: pa.Table, k: int, cutoff: bool) -> pa.Table:
    """The k best entries of every query in one slice: query_id, vec_id, score."""
    names = queries["query_id"].to_numpy()
    out: list[list[np.ndarray]] = [[], [], []]
    for q, c, scores in _survivors(queries, candidates) if cutoff else _seeds(queries, candidates, k):
        scores = scores.astype(np.int64)
        best = _best(q, c, scores, k)
        for column, value in zip(out, (names[q[best]], c[best], scores[best]), strict=True):
            column.append(value)
    joined = [np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in out]
    return pa.table(dict(zip(["query_id", "vec_id", "score"], joined, strict=True)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """Each query's k best other rows: query_id, rank, vec_id, score.

    Both inputs have (vec_id, data) as ``quantize`` returns them.
    """
    spark = vectors.sparkSession
    queries = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("data").alias("data"))
    blocks = max(1, -(-queries.count() // SIDE))
    tasks = partitions(spark)
    slices = max(tasks, min(4 * tasks, 64), -(-vectors.count() // SIDE))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    slice_ = F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int")
    sliced = vectors.select(slice_.alias("s"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), "vec_id", "data")

    def scored(asked: DataFrame, cutoff: bool) -> DataFrame:
        spread = asked.select(block.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("s"), *asked.columns)
        both = sliced.groupBy("s", "b").cogroup(spread.groupBy("s", "b"))

        def score(candidates: pa.Table, block_rows: pa.Table) -> pa.Table:
            return _entries(block_rows, candidates, k, cutoff)

        return both.applyInArrow(score, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    gathered = scored(queries, False).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    # Fewer than k entries anywhere give no cutoff: all candidates of that query are resolved.
    cutoffs = gathered.where(F.col("n") == k).select(F.col("query_id").alias("q"), F.col("score").cast("double").alias("cutoff"))
    limited = queries.join(cutoffs, F.col("query_id") == F.col("q"), "left").select("query_id", "data", F.coalesce("cutoff", F.lit(float("-inf"))).alias("cutoff"))
    resolved = scored(limited, True).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return resolved.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantize(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
