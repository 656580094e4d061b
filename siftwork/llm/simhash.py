"""SimHash near-duplicates by pivot distance tables.

Fingerprints have 64 bits, a majority vote of the texts' shingle hashes. Each distinct fingerprint
once gets its Hamming distances to fixed reference fingerprints (pivots). By the triangle
inequality two fingerprints within d bits differ by at most d in every coordinate of that table,
so a pair whose largest coordinate difference exceeds d is discarded; only survivors are compared.

Pairs are looked for where they can exist: the 64 bits are cut into d + 2 blocks, and two
fingerprints within d bits agree on two whole blocks at least, so each fingerprint is dealt to the
(d + 2)(d + 1) / 2 keys of its block pairs. There is no cap on a key. Inside a key's task, pairs
that are already connected need no test, keys that have become one component are dropped, and
only a spanning forest of links leaves the task, so a group of near copies costs links in
proportion to its size. Copies share a fingerprint and are one node throughout.

Defined results: null, empty and blank texts have fingerprint zero, linked as any other; a null
doc_id is kept and is no component's id unless all its members' are null; rows of one doc_id are
each returned; an empty table gives no rows. Extra columns of the input are not read.

``one_of_each`` wants the Jaccard of the texts' distinct shingles. Texts meet under keys of a prefix filter,
which misses no pair; wide fingerprints of the distinct shingles, compared through the same kind of
pivot table, discard the pairs that are too far apart, and survivors are computed in full: within groups
by matrix products over blocks, between groups pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..rarity import cell_counts, cells
from .common import checkpoint, partitions, table
from .components import components

SEED = 42
#: Reference fingerprints of the distance table, from a fixed generator.
MOST_WORDS = 16
PIVOTS = np.random.Generator(np.random.PCG64(2024)).integers(0, (1 << 64) - 1, (16, MOST_WORDS), dtype=np.uint64, endpoint=True)
#: Shingle hashes held at once.
STEP = 1 << 20


def shingle_hashes(text: str | None, width: int) -> list[int]:
    """XXH64 of each run of ``width`` words (fewer words: all of them; none: no hash)."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only; white space 09-0D and 20
    if not words:
        return []
    joined, ends = b" ".join(words), (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, SEED)]
    starts = [0] + [e + 1 for e in ends[:-width]]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=True)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of each consecutive run of ``counts`` hashes: bits set in over half.

    Eight bits are counted at once in the bytes of a word, over at most 255 hashes, then widened.
    """
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    runs = counts[full]
    starts = np.cumsum(runs) - runs
    pieces = -(-runs // 255)
    first = np.cumsum(pieces) - pieces
    within = np.arange(pieces.sum()) - np.repeat(first, pieces)
    cuts = np.repeat(starts, pieces) + 255 * within
    ones = np.uint64(0x0101010101010101)
    for b in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(b)) & ones, cuts)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8), first, axis=0, dtype=np.int64)
        more = 2 * sums > runs[:, None]
        for k in range(8):
            out[full] |= more[:, k].astype(np.uint64) << np.uint64(8 * k + b)
    return out


def with_fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, fp) of every row of ``docs`` (doc_id, text); fp is the fingerprint as a signed long."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts, hashes, held = [], [], [], 0

            def flush(found=found, counts=counts, hashes=hashes):
                if counts:
                    joined = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
                    found.append(majority(joined, np.array(counts, np.int64)))
                counts.clear()
                hashes.clear()

            for text in batch.column(1):
                own = np.array(shingle_hashes(text.as_py(), width), np.uint64)
                counts.append(len(own))
                hashes.append(own)
                held += len(own)
                if held >= STEP:
                    flush()
                    held = 0
            flush()
            fps = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, "doc_id long, fp long")


def _blocks(count: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``count`` blocks of 64 bits."""
    edges = [round(64 * k / count) for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


class _Forest:
    """Components of the nodes 0 .. n - 1 under links found so far."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
        """Join the ends of links; returns those links that joined two components."""
        used: tuple[list[int], list[int]] = ([], [])
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := parent.get(x, x)) != x:
                parent[x] = parent.get(y, y)
                x = y
            return x

        for x, y, i, j in zip(self.label[a].tolist(), self.label[b].tolist(), a.tolist(), b.tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                used[0].append(i)
                used[1].append(j)
        if parent:
            roots = np.arange(len(self.label))
            for x in parent:
                roots[x] = find(x)
            self.label = roots[self.label]
        return used


def near_links(keys: np.ndarray, names: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``bits`` among fingerprints that share a key.

    The rows are sorted by (key, name). ``names`` identify the nodes and ``fps`` has a row of
    64-bit words for each. Pairs are visited by their distance in that order, all keys at once, so
    memory stays in proportion to the rows.
    """
    nodes, place, node = np.unique(names, return_index=True, return_inverse=True)
    words = fps[place]
    pivots = PIVOTS[:, : words.shape[1]]
    # The distance table: each node's Hamming distance to every reference fingerprint.
    table_ = np.stack([np.bitwise_count(words ^ p).sum(axis=1, dtype=np.int16) for p in pivots], axis=1)
    forest, links = _Forest(len(nodes)), ([], [])
    _, group = np.unique(keys, return_inverse=True)
    rows, shift = np.arange(len(keys)), 1
    while len(rows):
        # rows: places whose key may still have a pair at this shift.
        rows = rows[rows + shift < len(keys)]
        rows = rows[group[rows] == group[rows + shift]]
        a, b = node[rows], node[rows + shift]
        apart = forest.label[a] != forest.label[b]
        a, b = a[apart], b[apart]
        for p in range(0, len(pivots), 4):
            keep = (np.abs(table_[a, p : p + 4] - table_[b, p : p + 4]) <= bits).all(axis=1)
            a, b = a[keep], b[keep]
        near = np.bitwise_count(words[a] ^ words[b]).sum(axis=1, dtype=np.int16) <= bits
        for side, new in zip(links, forest.link(a[near], b[near]), strict=True):
            side.extend(new)
        if shift & (shift - 1) == 0 and len(rows):
            # Keys whose fingerprints are one component need no more pairs.
            low, high = np.full(group[-1] + 1, len(nodes)), np.full(group[-1] + 1, -1)
            np.minimum.at(low, group, forest.label[node])
            np.maximum.at(high, group, forest.label[node])
            rows = rows[(low != high)[group[rows]]]
        shift += 1
    return nodes[links[0]] if links[0] else nodes[:0], nodes[links[1]] if links[1] else nodes[:0]


def linked(fps: DataFrame, bits: int = 4) -> DataFrame:
    """Links (u, v) that connect all fingerprints (column fp, distinct) within ``bits`` of each other."""
    pairs = list(combinations(_blocks(bits + 2), 2))
    part = lambda block: F.shiftrightunsigned("fp", block[0]).bitwiseAND(F.lit((1 << block[1]) - 1))
    keys = [F.shiftleft(part(x), y[1]).bitwiseOR(part(y)) * F.lit(len(pairs)) + F.lit(k) for k, (x, y) in enumerate(pairs)]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if tables:
            both = pa.Table.from_batches(tables)
            key, fp = both["key"].to_numpy(), both["fp"].to_numpy().view(np.uint64)
            order = np.lexsort((fp, key))
            u, v = near_links(key[order], fp[order], fp[order][:, None], bits)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    dealt = fps.select(F.explode(F.array(*keys)).alias("key"), "fp").repartition(partitions(fps.sparkSession), "key")
    return dealt.mapInArrow(find, "u long, v long")


def near_duplicates(docs: DataFrame, width: int = 4, bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links of at most ``bits`` bits reach.
    """
    marked = checkpoint(with_fingerprints(docs, width))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(linked(nodes.select("fp"), bits)).withColumnRenamed("node", "n")
    nodes = nodes.join(roots, F.col("fp") == F.col("n"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # The minima and the nodes are tables of their own: so AQE can split a root that very many nodes share.
    nodes = checkpoint(nodes)
    smallest = checkpoint(nodes.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r"))
    classes = nodes.join(smallest, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    return marked.join(classes, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


#: A wide fingerprint's 64-bit words, and the bits beyond which two texts cannot be 0.8 similar: of sets of 16 shingles or
#: more, and of smaller ones. Two sets of distinct shingles of that similarity differ in a bit with probability 0.152
#: (at most 0.159 of the larger, 0.1875 of the smaller), so a pair is lost with probability 4e-8 (at most 3e-7, 6e-7).
WIDE, MANY, FAR, FAR_OF_FEW = 4, 16, 72, 80
#: Reference fingerprints whose distances travel with a wide fingerprint, 16 bits each.
COORDINATES = 4
#: Count, beside twice a cell's mean, up to which the rows of a key are gathered in one task.
OFTEN = 64
#: Nodes of a block of a group, and owners up to which an element's pairs are counted one by one.
BLOCK, FEW_OWNERS = 256, 12
#: Words whose hashes a task holds.
KNOWN = 1 << 18
#: Orders by which a key's leader is chosen, so that a group's members meet several leaders.
ORDERS = 4


class WordHashes(dict):
    """Hashes of words; so many of them are held."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, SEED)
        if len(self) < KNOWN:
            self[word] = value
        return value


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], width: int, hashes: WordHashes) -> np.ndarray:
    """The distinct hashes of runs of ``width`` words (fewer words: all of them), sorted.

    A run's hash is made of its words' hashes, each times an odd number of its place.
    """
    if not words:
        return np.empty(0, np.uint64)
    of = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(of))
    runs = len(of) - width + 1
    total = np.full(runs, width, np.uint64)
    for k in range(width):
        total += of[k : k + runs] * np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64))
    return np.unique(_mixed(total, WIDE))


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Other 64 bits of each hash (SplitMix64 of it and the word's number)."""
    if not word:
        return hashes
    z = hashes + np.uint64(word * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingle_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How many texts of ``docs`` (text), all of them, hold the shingles of each cell.

    They only set the order in which shingles are taken as keys, never which pairs are found.
    """

    def of_batches():
        hashes = WordHashes()
        return lambda batch: (shingle_set(words_of(text.as_py()), width, hashes) for text in batch.column(0))

    return cell_counts(docs.select("text"), of_batches)


def signed(docs: DataFrame, width: int, share: Fraction, counted: np.ndarray) -> DataFrame:
    """Each row of ``docs`` (doc_id, key, text) with what near-duplicate search needs of its text.

    Returns doc_id, key, node (a hash of the text's words, so copies are one node), n (distinct
    shingles), f0 .. (the wide fingerprint of the distinct shingles), coordinates (its distances to
    the reference fingerprints), words (compressed), and the keys, ``hot`` (of a cell that counts far more
    than most) and ``rare``: shingles that two sets of Jaccard ``share`` cannot both be without. All rows sort
    their n shingles alike, by the counts of their cells (``counted``, over all rows); two sets that share at
    least share * n have one of the first n - ceil(share * n) + 1 in common. A shingle whose cell counts one
    is in no other text and is no key.
    """
    names = ["doc_id", "key", "node", "n", *[f"f{w}" for w in range(WIDE)], "coordinates", "words", "hot", "rare"]
    pivots = PIVOTS[:COORDINATES, :WIDE]
    often = OFTEN + 2 * int(counted.mean())

    def split(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kept = len(own) and len(own) + 1 - math.ceil(share * len(own))
        seen = counted[cells(own)]
        first = np.argsort(seen, kind="stable")[:kept]
        seen = seen[first]
        return own[first[seen > often]], own[first[(seen > 1) & (seen <= often)]]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, hashes = zstandard.ZstdCompressor(level=1), WordHashes()
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                start, held, nodes, packed, sets = at, 0, [], [], []
                while at < batch.num_rows and held < STEP:
                    words = words_of(batch.column(2)[at].as_py())
                    joined = b" ".join(words)
                    nodes.append(xxhash.xxh64_intdigest(joined, SEED))
                    packed.append(packer.compress(joined))
                    sets.append(shingle_set(words, width, hashes))
                    held += len(sets[-1])
                    at += 1
                counts = np.array([len(x) for x in sets], np.int64)
                every = np.concatenate(sets)
                wide = np.stack([majority(_mixed(every, w), counts) for w in range(WIDE)], axis=1)
                far = np.zeros(len(sets), np.int64)
                for k, p in enumerate(pivots):
                    far |= np.bitwise_count(wide ^ p).sum(axis=1, dtype=np.int64) << (16 * k)
                keys = [split(x) for x in sets]
                lists = [pa.array([x[side].view(np.int64) for x in keys], pa.list_(pa.int64())) for side in (0, 1)]
                columns = [batch.column(0).slice(start, at - start), batch.column(1).slice(start, at - start), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(counts)]
                columns += [pa.array(np.ascontiguousarray(wide[:, w]).view(np.int64)) for w in range(WIDE)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(far), pa.array(packed, pa.binary()), *lists], names)

    kinds = ["long"] * (5 + WIDE) + ["binary", "array<long>", "array<long>"]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "key", "text").mapInArrow(build, schema)


def shared_keys(marked: DataFrame) -> DataFrame:
    """(key, node) of all keys that several nodes have.

    Keys of cells that count much go on as they are; only the others, none of which has many texts, are
    gathered by key.
    """
    exploded = lambda column: marked.select(F.explode(column).alias("key"), "node")
    by_key = Window.partitionBy("key")
    rare = exploded("rare").select("key", "node", F.min("node").over(by_key).alias("low"), F.max("node").over(by_key).alias("high")).where("low < high")
    return rare.select("key", "node").distinct().union(exploded("hot").distinct())


def may_be_similar(a: str, b: str, share: Fraction) -> Column:
    """Whether rows a and b may reach ``share``: by sizes, by distances to the reference fingerprints, by their own distance."""
    x, y = (lambda side: lambda c: F.col(f"{side}.{c}"))(a), (lambda side: lambda c: F.col(f"{side}.{c}"))(b)
    fits = (F.least(x("n"), y("n")) * F.lit(share.denominator)) >= (F.greatest(x("n"), y("n")) * F.lit(share.numerator))
    far = F.when(F.greatest(x("n"), y("n")) < MANY, FAR_OF_FEW).otherwise(FAR)
    for k in range(COORDINATES):
        at = lambda c: F.shiftrightunsigned(c, 16 * k).bitwiseAND(F.lit(0xFFFF))  # noqa: B023, E731
        fits &= F.abs(at(x("coordinates")) - at(y("coordinates"))) <= far
    return fits & (sum(F.bit_count(x(f"f{w}").bitwiseXOR(y(f"f{w}"))) for w in range(WIDE)) <= far)


def leader_pairs(shared: DataFrame, share: Fraction) -> DataFrame:
    """(u, v): under every key of ``shared`` its leader and each row that may be similar.

    The leader is the least row of one of a few orders of all nodes, so it costs a partial
    aggregation; rows meet it in a join that can be split, whatever the key's size.
    """
    rank = F.xxhash64("node", F.pmod("key", F.lit(ORDERS)))
    rest = [c for c in shared.columns if c not in ("key", "rank")]
    leaders = checkpoint(shared.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), *rest)).alias("leader")).select("key", "leader.*"))
    met = shared.alias("a").join(leaders.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.node") != F.col("b.node")) & may_be_similar("a", "b", share))
    return met.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()


def cross_pairs(rooted: DataFrame, share: Fraction) -> DataFrame:
    """(u, v): all pairs that may be similar under a key of ``rooted`` and are in different groups (root).

    Rows outside the group that a key's least root names meet all rows of the key, so a key that is
    nearly one group costs little. The join's condition drops the other pairs.
    """
    least = checkpoint(rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most"))
    mixed = checkpoint(rooted.join(least.select(F.col("key").alias("k"), "least"), F.col("key") == F.col("k")).drop("k"))
    outside = mixed.where("root <> least").alias("a")
    once = (F.col("b.root") == F.col("b.least")) | (F.col("a.node") < F.col("b.node"))
    met = outside.join(mixed.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.root") != F.col("b.root")) & once & may_be_similar("a", "b", share))
    return met.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements any two of the sets have in common (their sizes on the diagonal are not kept)."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    _, of, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(of, kind="stable")
    owner, start = owner[order], np.cumsum(count) - count
    common = np.zeros((n, n), np.float32)
    places = []
    for c in np.unique(count[(count > 1) & (count <= FEW_OWNERS)]).tolist():
        held = owner[start[count == c][:, None] + np.arange(c)]
        places += [held[:, i] * n + held[:, j] for i in range(c) for j in range(i + 1, c)]
    if places:
        common += np.bincount(np.concatenate(places), minlength=n * n).reshape(n, n)
        common += common.T
    often = np.flatnonzero(count > FEW_OWNERS)
    for k in range(0, len(often), 4096):
        some = often[k : k + 4096]
        has = np.zeros((n, len(some)), np.float32)
        held = np.repeat(np.arange(len(some)), count[some])
        has[owner[np.repeat(start[some], count[some]) + np.arange(len(held)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])], held] = 1
        common += has @ has.T
    return common


def groups_among(sets: list[np.ndarray], share: Fraction) -> np.ndarray:
    """Each set's group: the least place that links of Jaccard ``share`` reach from it."""
    sizes = np.array([len(x) for x in sets], np.int64)
    near = (share.numerator + share.denominator) * overlaps(sets).astype(np.int64) >= share.numerator * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(near, True)
    group = np.arange(len(sets))
    while True:
        least = np.where(near, group[None, :], len(sets)).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == group).all():
            return group
        group = least


def links_within(members: DataFrame, texts: DataFrame, width: int, share: Fraction) -> DataFrame:
    """Links (u, v) that connect what is similar within each group of ``members`` (node, root).

    A group goes in blocks of at most ``BLOCK`` nodes, and every two blocks meet in a task of their own, where all
    pairs are computed by matrix products and only a tree of each component leaves.
    """
    sizes = checkpoint(members.groupBy("root").count().select(F.col("root").alias("r"), F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    sized = members.join(sizes, F.col("root") == F.col("r")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = sized.select("node", "root", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("node", "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    rows = met.withColumnRenamed("node", "member").join(texts, F.col("member") == F.col("node")).select("root", "i", "j", "node", "words")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, hashes = zstandard.ZstdDecompressor(), WordHashes()
        current, nodes, sets, out = None, [], [], []

        def ended() -> None:
            if len(sets) > 1:
                group = groups_among(sets, share)
                for k in np.flatnonzero(group != np.arange(len(group))).tolist():
                    out.append((nodes[k], nodes[group[k]]))
            nodes.clear()
            sets.clear()

        def links() -> pa.RecordBatch:
            columns = [pa.array([link[side] for link in out], pa.int64()) for side in (0, 1)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["u", "v"])

        for batch in batches:
            for root, i, j, node, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (root, i, j) != current:
                    ended()
                    current = root, i, j
                nodes.append(node)
                sets.append(shingle_set(unpacker.decompress(words).split(), width, hashes))
            if out:
                yield links()
        ended()
        if out:
            yield links()

    dealt = rows.repartition(partitions(rows.sparkSession), "root", "i", "j").sortWithinPartitions("root", "i", "j", "node")
    return dealt.mapInArrow(find, "u long, v long")


def similar(pairs: DataFrame, texts: DataFrame, width: int, share: Fraction) -> DataFrame:
    """Those of ``pairs`` (u, v) whose distinct shingles have a Jaccard of at least ``share``, computed in full."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, held, hashes = zstandard.ZstdDecompressor(), {}, WordHashes()

        def shingles(node: int, words: pa.Scalar) -> np.ndarray:
            if node not in held:
                if len(held) >= 64:
                    held.pop(next(iter(held)))
                held[node] = shingle_set(unpacker.decompress(words.as_py()).split(), width, hashes)
            return held[node]

        for batch in batches:
            good = []
            for u, v, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                x, y = shingles(u, a), shingles(v, b)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(share.denominator * both >= share.numerator * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], ["u", "v"])

    side = lambda name, words: texts.select(F.col("node").alias(name), F.col("words").alias(words))
    joined = pairs.join(side("u", "words u"), "u").join(side("v", "words v"), "v")
    return joined.select("u", "v", "words u", "words v").mapInArrow(check, "u long, v long")


def similar_links(marked: DataFrame, nodes: DataFrame, width: int, share: Fraction) -> DataFrame:
    """Links (u, v) that connect all ``nodes`` of Jaccard at least ``share``, and no others.

    Pairs of a key's leader and another row that may be similar make groups, within which all pairs are computed;
    pairs under a key that are in different groups are computed one by one. So a group of near copies sends
    its members, not its pairs.
    """
    keys = shared_keys(marked).withColumnRenamed("node", "at")
    shared = checkpoint(keys.join(nodes.drop("least"), F.col("at") == F.col("node")).drop("at"))
    members = checkpoint(components(leader_pairs(shared, share)))
    roots = members.select(F.col("node").alias("member"), "root")
    rooted = checkpoint(shared.join(roots, F.col("node") == F.col("member"), "left").select(*shared.columns, F.coalesce("root", "node").alias("root")))
    pairs = checkpoint(cross_pairs(rooted, share))
    # Only the words of nodes in a group or pair travel, of one row each.
    wanted = members.select(F.col("node").alias("wanted")).union(pairs.select("u")).union(pairs.select("v")).distinct()
    rows = checkpoint(nodes.join(wanted, F.col("node") == F.col("wanted")).select(F.col("least.key").alias("row")))
    texts = checkpoint(marked.select("key", "node", "words").join(rows, F.col("key") == F.col("row"), "left_semi").dropDuplicates(["node"]).select("node", "words"))
    return links_within(members, texts, width, share).union(similar(pairs, texts, width, share))


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each near-duplicate group does.

    The one with the smallest doc_id stays (null first; of equal ids, the smallest text hash, once).
    Texts are linked when the Jaccard of their distinct shingles is at least ``similarity``, 0.8 or more.
    """
    share = Fraction(str(similarity))
    if share < Fraction(4, 5):
        raise ValueError("the distance limit of the wide fingerprints is for a similarity of 0.8 or more")
    keyed = docs.withColumn("row key", F.xxhash64("doc_id", "text"))
    counted = shingle_counts(docs, width)
    marked = checkpoint(signed(keyed.select("doc_id", F.col("row key").alias("key"), "text"), width, share, counted))
    wide = ["n", *[f"f{w}" for w in range(WIDE)], "coordinates"]
    least = marked.groupBy("node").agg(F.min(F.struct("doc_id", "key", *wide)).alias("least"))
    nodes = checkpoint(least.select("node", F.struct("least.doc_id", "least.key").alias("least"), *[F.col(f"least.{c}").alias(c) for c in wide]))
    roots = components(similar_links(marked, nodes, width, share)).withColumnRenamed("node", "member")
    grouped = nodes.select("node", "least").join(roots, F.col("node") == F.col("member"), "left")
    least = grouped.groupBy(F.coalesce("root", "node")).agg(F.min("least").alias("least"))
    kept = least.select(F.col("least.doc_id").alias("kept id"), F.col("least.key").alias("kept key"))
    same = F.col("doc_id").eqNullSafe(F.col("kept id")) & (F.col("row key") == F.col("kept key"))
    stay = keyed.join(kept, same, "left_semi")
    twice = marked.groupBy("doc_id", "key").count().where("count > 1")
    if not twice.isEmpty():  # rows listed again: of equal rows one stays
        stay = stay.dropDuplicates(["doc_id", "row key"])
    return stay.drop("row key")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
