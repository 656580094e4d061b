"""Order-dependent deduplication as windows.

A group may hold a large share of all rows (blank images share one hash), so the first row of each group is a
minimum by a partial aggregation, and rows are compared with it by an equi-join that AQE can split; no group is
gathered or sorted in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from .. import constants as C
from ..functions import text as T
from ..rarity import cell_counts, cells


def _with_first(rows: DataFrame, keys: list[Column], order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: the least ``order`` struct among the rows of equal keys. Null keys are keys."""
    keyed = rows.withColumns({f"key {k}": c for k, c in enumerate(keys)}).withColumn("order of row", F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)]))
    names = [f"key {k}" for k in range(len(keys))]
    least = keyed.groupBy(*names).agg(F.min("order of row").alias(name)).withColumnsRenamed({n: f"first {n}" for n in names})
    same = [keyed[n].eqNullSafe(least[f"first {n}"]) for n in names]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return keyed.join(least, condition).drop(*names, *[f"first {n}" for n in names])


def two_level(rows: DataFrame, keys: list[str], content_hash: str, confidence: str, row_id: str) -> DataFrame:
    """Adds duplicate_reason and duplicate_of; rows kept have neither.

    Rows are visited by falling confidence (null as 0), then id. A later row of an equal key is a
    ``key_duplicate``; among the others, a later row of an equal non-null hash is a ``hash_duplicate`` of
    the first. Equal order (repeated rows) counts as one visit, and all of them stay.
    """
    order = [-F.coalesce(F.col(confidence).cast("double"), F.lit(0.0)), F.col(row_id)]
    first = _with_first(rows, [F.col(k) for k in keys], order, "first of key")
    first = first.withColumn("survives", F.col("order of row").eqNullSafe(F.col("first of key")))
    kept = first.where("survives").drop("order of row", "first of key", "survives")
    hashed = _with_first(kept.where(F.col(content_hash).isNotNull()), [F.col(content_hash)], order, "first of hash")
    later = ~F.col("order of row").eqNullSafe(F.col("first of hash"))
    hashed = hashed.withColumns({
        "duplicate_reason": F.when(later, "hash_duplicate"),
        "duplicate_of": F.when(later, F.col("first of hash.o1")),
    }).drop("order of row", "first of hash")
    empty = F.lit(None).cast("string")
    of_type = rows.schema[row_id].dataType
    plain = kept.where(F.col(content_hash).isNull()).withColumns({"duplicate_reason": empty, "duplicate_of": F.lit(None).cast(of_type)})
    by_key = first.where(~F.col("survives")).drop("order of row", "first of key", "survives")
    by_key = by_key.withColumns({"duplicate_reason": F.lit("key_duplicate"), "duplicate_of": F.lit(None).cast(of_type)})
    return hashed.unionByName(plain).unionByName(by_key)


def first_seen(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the given order (file priority, then position)."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("row")).select(key, "row.*").select(*rows.columns)


def last_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the given order, as a table load that overwrites does."""
    others = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("row")).select(*key, "row.*").select(*rows.columns)


#: Shared words by which two sets must meet, where their heads allow so many, and pairs that a task counts at once.
MEETINGS, STEP = 4, 1 << 20


class _WordHashes(dict):
    """Hashes of words; so many of them are held."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < 1 << 18:
            self[word] = value
        return value


def _word_sets(rows: DataFrame) -> DataFrame:
    """(g, id, digest, words) of ``rows`` (g, id, text) that have words: those of ``question_tokens``, sorted and compressed.

    The dotted capital I is an i in SQL's lower case. Equal sets have equal digests (128 bits).
    """
    stop = frozenset(C.QUESTION_STOP_WORDS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, packer = re.compile("[a-z0-9]{3,}").findall, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            joined = [" ".join(sorted(set(find((text.as_py() or "").replace("\u0130", "i").lower())) - stop)).encode() for text in batch.column(2)]
            some = pa.array([bool(x) for x in joined], pa.bool_())
            digests = pa.array([xxhash.xxh3_128_digest(x) for x in joined if x], pa.binary())
            packed = pa.array([packer.compress(x) for x in joined if x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(some), batch.column(1).filter(some), digests, packed], ["g", "id", "digest", "words"])

    return rows.mapInArrow(build, StructType([*rows.schema.fields[:2], StructField("digest", BinaryType()), StructField("words", BinaryType())]))


def _hashes_of_words():
    """A function that gives the word hashes of each set of a batch, whose last column has the words."""
    unpacker, hashes = zstandard.ZstdDecompressor(), _WordHashes()

    def of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for packed in batch.columns[-1].to_pylist():
            words = unpacker.decompress(packed).split()
            yield np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))

    return of


def _kept(sizes, share: Fraction):
    """Words of a set that are its head: one more than it may have besides those it shares with a similar set."""
    return sizes - -(-share.numerator * sizes // share.denominator) + 1


def _heads(classes: DataFrame, counts: np.ndarray, share: Fraction) -> DataFrame:
    """(key, node, n, place) of the words of each head, rare ones first; words that no other set has are left out."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _hashes_of_words()
        for batch in batches:
            salts, nodes = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            found = []
            for own, salt in zip(of(batch), salts, strict=True):
                seen = counts[cells(own)]
                first = np.lexsort((own, seen))[: _kept(len(own), share)]
                place = np.flatnonzero(seen[first] > 1)
                found.append((own[first[place]] + salt, np.full(len(place), len(own), np.int32), place.astype(np.int32)))
            if found:
                keys, sizes, places = (np.concatenate(x) for x in zip(*found, strict=True))
                owner = np.repeat(nodes, [len(x[0]) for x in found]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(owner), pa.array(sizes), pa.array(places)], ["key", "node", "n", "place"])

    return classes.select(F.xxhash64("g").alias("salt"), "node", "words").mapInArrow(build, "key long, node long, n int, place int")


def _meeting(heads: DataFrame, share: Fraction) -> DataFrame:
    """(u, v): pairs of sets that may be similar.

    Two similar sets share ``need`` words at least. A word counts where ``need`` less ``least`` and one more are left from it on in
    both; the words that don't count are ``need`` less ``least`` at most, so ``least`` words count. All keys are visited at once by the
    distance of rows in order of size, so memory stays in proportion to the rows.
    """
    a, b = share.numerator, share.denominator

    def counted(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        u, v, least = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        order = np.lexsort((v, u))
        u, v, least = u[order], v[order], least[order]
        start = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])]))
        met = np.diff(np.append(start, len(u)))
        return pa.RecordBatch.from_arrays([pa.array(u[start]), pa.array(v[start]), pa.array(least[start]), pa.array(met)], ["u", "v", "least", "met"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [x for x in batches if x.num_rows]
        if not batches:
            return
        key, node, n, place = (c.to_numpy() for c in pa.Table.from_batches(batches).columns)
        order = np.lexsort((node, n, key))
        key, node, n, place = key[order], node[order], n[order].astype(np.int64), place[order]
        left, hidden = n - place, n - _kept(n, share)
        rows, shift, found, held = np.arange(len(key)), 1, [], 0
        while len(rows):
            rows = rows[rows + shift < len(key)]
            other = rows + shift
            # Sizes rise within a key: a row that is too small for this one is so for all that follow.
            rows = rows[(key[rows] == key[other]) & (n[rows] * b >= n[other] * a)]
            for k in range(0, len(rows), STEP):
                x = rows[k : k + STEP]
                y = x + shift
                need = -(-a * (n[x] + n[y]) // (a + b))
                least = np.minimum(MEETINGS, need - np.maximum(hidden[x], hidden[y]))
                fits = (np.minimum(left[x], left[y]) > need - least) & (node[x] != node[y])
                u, v = node[x[fits]], node[y[fits]]
                found.append((np.minimum(u, v), np.maximum(u, v), least[fits].astype(np.int32)))
                held += len(u)
                if held >= STEP:
                    yield counted(found)
                    held = 0
            shift += 1
        if held:
            yield counted(found)

    parts = int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = heads.repartition(parts, "key").mapInArrow(find, "u long, v long, least int, met long")
    return met.groupBy("u", "v").agg(F.sum("met").alias("met"), F.min("least").alias("least")).where("met >= least").select("u", "v")


def _overlaps(pairs: DataFrame) -> DataFrame:
    """(g, left, right, overlap) of ``pairs`` (g, left, right, a, b: the words of both)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, last, words = zstandard.ZstdDecompressor(), None, set()
        for batch in batches:
            out = []
            for a, b in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if b != last:
                    last, words = b, set(unpacker.decompress(b).split())
                others = unpacker.decompress(a).split()
                both = len(words.intersection(others))
                out.append(both / (len(words) + len(others) - both))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.float64())], ["g", "left", "right", "overlap"])

    return pairs.mapInArrow(compare, StructType([*pairs.schema.fields[:3], StructField("overlap", DoubleType())]))


def similar_pairs(rows: DataFrame, group: str, row_id: str, text: Column, threshold: float = C.SIMILAR) -> DataFrame:
    """Pairs of one group whose word sets overlap by the threshold: (group, left, right, overlap).

    Prefix filtering: with words in one order, two sets that overlap by t share words among the first
    n - ceil(t n) + 1 of each, so rows meet only under their rare words and no group is crossed with itself.
    The order is by counts over all sets. Rows of one word set are compared once, through its smallest id; the others
    are paired with that id. A null group or id is in no pair.
    """
    from ..sources.store import checkpoint

    share = Fraction(str(threshold))
    plain = rows.select(F.col(group).alias("g"), F.col(row_id).alias("id"), text.alias("text")).where("g IS NOT NULL AND id IS NOT NULL")
    sets = checkpoint(_word_sets(plain))
    classes = sets.groupBy("g", "digest").agg(F.min("id").alias("rep"), F.first("words").alias("words"))
    classes = checkpoint(classes.withColumn("node", F.xxhash64("g", "digest")))
    reps = classes.select(F.col("g").alias("of"), F.col("digest").alias("as"), "rep")
    members = sets.join(reps, (F.col("g") == F.col("of")) & (F.col("digest") == F.col("as")) & (F.col("id") > F.col("rep")))
    members = members.select("g", F.col("rep").alias("left"), F.col("id").alias("right"), F.lit(1.0).alias("overlap"))
    pairs = checkpoint(_meeting(_heads(classes, cell_counts(classes.select("words"), _hashes_of_words), share), share))
    # Each pair once gets its sets and is compared in full.
    side = lambda n: classes.select(F.col("node").alias(n), F.struct("g", "rep", "words").alias(f"class {n}"))
    met = pairs.join(side("u"), "u").join(side("v"), "v").where("`class u`.g = `class v`.g AND `class u`.rep <> `class v`.rep")
    met = met.select("class u.g", F.least("class u.rep", "class v.rep").alias("left"), F.greatest("class u.rep", "class v.rep").alias("right"), F.col("class u.words").alias("a"), F.col("class v.words").alias("b"))
    return _overlaps(met).where(F.col("overlap") >= threshold).union(members).withColumnRenamed("g", group)


def too_similar(words: set[str], accepted: list[set[str]], threshold: float = C.SIMILAR) -> bool:
    """Whether a question's words overlap with an accepted one's; a question without words is too similar."""
    return not words or any(old and len(words & old) >= threshold * len(words | old) for old in accepted)


def accept_in_order(rows: DataFrame, group: str, order: list[str], text: Column, cap: int = 0, threshold: float = C.SIMILAR) -> DataFrame:
    """Rows of each group that are accepted one after another: not similar to an accepted one, at most ``cap``.

    Groups are images with a handful of questions; each group's state is held while its rows stream past in order.
    """
    columns = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, accepted = object(), []
        for batch in batches:
            keep = []
            for key, words in zip(batch["group of row"], batch["words of row"], strict=True):
                if key != current:
                    current, accepted = key, []
                own = set(words)
                fits = (not cap or len(accepted) < cap) and not too_similar(own, accepted, threshold)
                if fits:
                    accepted.append(own)
                keep.append(fits)
            yield batch.loc[keep, columns]

    marked = rows.withColumns({"group of row": F.coalesce(F.col(group).cast("string"), F.lit("")), "words of row": T.question_tokens(text)})
    placed = marked.repartition(F.col("group of row")).sortWithinPartitions("group of row", *order)
    return placed.mapInPandas(run, rows.schema)


def ranked(rows: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
