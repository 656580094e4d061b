"""Document fingerprints: Merkle trees over paragraphs and sections.

A paragraph is a line; its leaves are pieces whose ends its own characters set (where a hash of the
last few is least among the ``REACH`` places on either side), so that an edit inside a long
paragraph, also one that moves what follows, changes the leaves about it only. A section is a run of
paragraphs that ends after a paragraph whose hash says so: an edit moves no other section's border.
Equal roots mean equal texts; where roots differ, only differing branches are descended, down to the
edited leaves.

A fingerprint is text: the root (32 hex digits), ``:``, then the tree in base 64: sections by ``;``,
each ``hash=paragraph,paragraph`` with 8 digits a hash, a paragraph of several leaves followed by
their first 24 bits, 4 digits a leaf (of the one leaf of a short paragraph its hash's first 4 digits).

Scale of the edited-neighbour query: documents move once, to shards by ranges of doc_id that hold
like numbers of bytes. Each shard also gets the document that follows its last one, found from a few ids a shard, so
no window over all rows is needed. A document's tree is built once. Rows of one doc_id are in one shard.

Defined results: a null text is empty, one empty paragraph; equal ids are ordered by text; a null
doc_id comes last in descending order; a table of one row is its own next; an empty table gives no
rows. Extra columns of the input are not read.
"""

from __future__ import annotations

from base64 import urlsafe_b64encode
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, table

#: Places on either side of a leaf's end at which no other leaf of the paragraph ends by content.
REACH = 12
#: Characters of a leaf at most: runs of one character have no ends of their own.
MOST = 256
#: A section ends after one paragraph in so many, on average.
SECTION = 8
#: Ranges of ids whose bytes are counted, a shard.
RANGES = 8
#: Digits of a section's or paragraph's hash, and of a leaf among several.
HASH, LEAF = 8, 4
_ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
_NONE = np.uint32(0xFFFFFFFF)

#: A paragraph: (digest, leaf digests).
Paragraph = tuple[bytes, tuple[bytes, ...]]


def _node(children: list[bytes] | tuple[bytes, ...]) -> bytes:
    return blake2b(b"\x01" + b"".join(children), digest_size=16).digest()


def _leaf(text: str) -> bytes:
    return blake2b(b"\x00" + text.encode(), digest_size=16).digest()


def leaf_ends(lines: list[str]) -> list[list[int]]:
    """For each line the places where its leaves end, its own end last."""
    apart = "\n" * REACH  # so no place sees another line
    codes = np.frombuffer((apart + apart.join(lines) + apart).encode("utf-32-le"), np.uint32)
    mixed = codes * np.uint32(_ODD[0])
    for k in (1, 2, 3):
        mixed[k:] += codes[:-k] * np.uint32(_ODD[k])
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(_ODD[1])
    mixed[codes == 10] = _NONE
    least = mixed.copy()  # of the REACH places from each one on
    step = 1
    while step < REACH:
        more = min(step, REACH - step)
        least[:-more] = np.minimum(least[:-more], least[more:])
        step += more
    inner = slice(REACH, len(mixed) - REACH)
    ends = np.flatnonzero((mixed[inner] < least[: len(mixed) - 2 * REACH]) & (mixed[inner] <= least[REACH + 1 : len(mixed) - REACH + 1]) & (mixed[inner] != _NONE)) + 1
    starts = np.cumsum([0, *[len(x) + REACH for x in lines]])
    cuts = np.searchsorted(ends, starts)
    found = []
    for line, start, a, b in zip(lines, starts[:-1].tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own, last = [], 0
        for end in [*(ends[a:b] - start).tolist(), len(line)]:
            own += range(last + MOST, end, MOST)
            if end > last:
                own.append(end)
            last = end
        found.append(own)
    return found


def paragraphs(text: str) -> list[Paragraph]:
    lines = text.split("\n")
    long = [x for x in lines if len(x) > 2 * REACH]
    ends = iter(leaf_ends(long)) if long else iter(())
    found = []
    for line in lines:
        if len(line) <= 2 * REACH:
            leaf = _leaf(line)
            found.append((leaf, (leaf,)))
        else:
            own = next(ends)
            leaves = tuple(_leaf(line[a:b]) for a, b in zip([0, *own], own, strict=False))
            found.append((_node(leaves) if len(leaves) > 1 else leaves[0], leaves))
    return found


def _shown(digests: list[bytes] | tuple[bytes, ...], digits: int) -> str:
    """The first digits of each digest in base 64, one after another."""
    size = digits * 3 // 4
    return urlsafe_b64encode(b"".join([d[:size] for d in digests])).decode()


def fingerprint(tree: list[Paragraph]) -> str:
    sections, digests, held = [], [], []
    for digest, leaves in tree:
        held.append((digest, leaves))
        if digest[0] % SECTION == 0:
            sections.append(held)
            held = []
    if held:
        sections.append(held)
    shown = []
    for section in sections:
        digests.append(_node([d for d, _ in section]))
        parts = [_shown([d], HASH) + (_shown(leaves, LEAF) if len(leaves) > 1 else "") for d, leaves in section]
        shown.append(f"{_shown(digests[-1:], HASH)}={','.join(parts)}")
    return f"{_node(digests).hex()}:{';'.join(shown)}"


def _sections(fp: str) -> list[tuple[str, list[str]]]:
    return [(s[:HASH], s[HASH + 1 :].split(",")) for s in fp[33:].split(";")]


def _leaves(paragraph: str) -> list[str]:
    return [paragraph[k : k + LEAF] for k in range(HASH, len(paragraph), LEAF)] or [paragraph[:LEAF]]


def locate_edits(fp: str, other: str) -> list[tuple[int, int, int]]:
    """(section, paragraph, leaf) of ``fp`` that ``other`` has not: the differing branches."""
    if fp[:32] == other[:32]:
        return []
    theirs = _sections(other)
    same, known = Counter(s for s, _ in theirs), Counter(p for _, ps in theirs for p in ps)
    open_sections = []
    for i, (section, inside) in enumerate(_sections(fp)):
        if same[section] > 0:
            same[section] -= 1
            known.subtract(inside)
        else:
            open_sections.append((i, inside))
    left = []
    for i, inside in open_sections:
        for j, paragraph in enumerate(inside):
            if known[paragraph] > 0:
                known[paragraph] -= 1
            else:
                left.append((i, j, paragraph))
    leaves = Counter(x for p, n in known.items() for x in _leaves(p) * max(0, n))
    places = []
    for i, j, paragraph in left:
        for k, leaf in enumerate(_leaves(paragraph)):
            if leaves[leaf] > 0:
                leaves[leaf] -= 1
            else:
                places.append((i, j, k))
    return places


def likeness(fp: str, other: str) -> float:
    """Shared leaves, as a share of both documents' leaves; equal roots need no look at them."""
    if fp[:32] == other[:32]:
        return 1.0
    mine, theirs = _sections(fp), _sections(other)
    same = Counter(s for s, _ in mine) & Counter(s for s, _ in theirs)
    shared = total = 0
    rest: list[Counter] = []
    for side in (mine, theirs):
        left, leaves = Counter(same), []
        for section, inside in side:
            own = [x for p in inside for x in _leaves(p)]
            total += len(own)
            if left[section] > 0:  # an equal branch: not descended
                left[section] -= 1
                shared += len(own)
            else:
                leaves += own
        rest.append(Counter(leaves))
    return (shared + 2 * sum((rest[0] & rest[1]).values())) / total


def edited(text: str, tree: list[Paragraph], following: str) -> tuple[str, list[Paragraph]]:
    """The text with its last third replaced, and its tree; paragraphs before the cut are kept."""
    keep = len(text) - len(text) // 3
    start = text.rfind("\n", 0, keep) + 1
    new = text[:keep] + following[: len(text) // 3]
    return new, tree[: text.count("\n", 0, start)] + paragraphs(new[start:])


def _shard(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds lie below the id; two short scans, not one over all bounds."""
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    below = lambda array: F.size(F.filter(array, lambda b: b < doc_id))
    if not groups:
        return F.lit(0)
    array = lambda x: F.array(*[F.lit(v).cast("long") for v in x])
    group = below(array([g[-1] for g in groups]))
    inside = F.coalesce(F.get(F.array(*[array(g) for g in groups]), group), array([]))
    return F.when(doc_id.isNull(), F.lit(0)).otherwise(F.least(F.lit(len(bounds)), group * step + below(inside))).cast("int")


def with_following(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (shard, extra, doc_id, text): each shard's documents and, as extra, the next one's."""
    spark = docs.sparkSession
    shards = partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Ranges of ids, several a shard: of each its bytes and its first document in descending order.
    ranges = RANGES * shards
    found = docs.select(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 10 * ranges)).first()[0]
    cuts = sorted(set(found or []))
    sizes = docs.groupBy(_shard(F.col("doc_id"), cuts).alias("range")).agg(F.sum(F.octet_length("text") + 64).alias("bytes"), F.max("doc_id").alias("head")).orderBy("range").collect()
    share = sum(r["bytes"] for r in sizes) / shards
    bounds, heads, held = [], {}, 0.0
    for r in sizes:  # a shard is a run of ranges that has reached its share
        if held >= share:
            bounds.append(cuts[r["range"] - 1])
            held = 0.0
        held += r["bytes"]
        heads[len(bounds)] = r["head"]
    order = sorted(heads, reverse=True)
    follows = [(heads[after], shard) for shard, after in zip(order, order[1:] + order[:1], strict=True)]
    needed = spark.createDataFrame(follows, "head long, shard int")
    extra = docs.join(F.broadcast(needed), F.col("doc_id").eqNullSafe(F.col("head"))).select("shard", F.lit(1).alias("extra"), "doc_id", "text")
    own = docs.select(_shard(F.col("doc_id"), bounds).alias("shard"), F.lit(0).alias("extra"), "doc_id", "text")
    return own.union(extra), shards


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` (doc_id, text), its fingerprint, and how near an edited copy stays.

    The edited copy has the last floor(n_chars / 3) code points replaced by the first as many of
    the next document in descending order of doc_id (after the last, the first).
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    batch_of = lambda held: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        before = None
        for batch in batches:
            for shard, extra, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if before and before[0] != shard:
                    raise ValueError("a shard has no following document")
                if extra and not before:
                    continue
                tree = paragraphs(text)
                fp = fingerprint(tree)
                if before:
                    _, last_id, last, last_tree, last_fp = before
                    new, new_tree = edited(last, last_tree, text)
                    new_fp = fingerprint(new_tree)
                    yield last_id, len(last), sha256(new.encode()).hexdigest(), last_fp, new_fp, likeness(last_fp, new_fp), likeness(last_fp, fp)
                before = None if extra else (shard, doc_id, text, tree, fp)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in rows(batches):
            held.append(row)
            if len(held) >= 2048:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    both, shards = with_following(docs)
    order = ["shard", "extra", F.col("doc_id").desc_nulls_last(), "text"]
    return both.repartitionById(shards, F.col("shard")).sortWithinPartitions(*order).mapInArrow(build, schema)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))
