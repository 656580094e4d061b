"""Token-id files by fixed-width bit packing.

Every id takes the bits that the largest id of the vocabulary needs. Blocks of ``BLOCK`` ids are
packed with numpy, and the footer has each block's byte offset and each document's first id, so a
reader unpacks whole blocks by vector operations or fetches one document alone.

File: blocks, then the footer arrays (block offsets u64, document starts u64 and one more for the
end, document ids i64, null flags u8), then the trailer (magic, bits, block size, counts).

Scale: documents are range-sorted by doc_id and each partition streams into one file, with one
Arrow batch of text in memory; the global position of a file is the running sum over the manifest,
one row a file. Files are written under temporary names and renamed; the manifest lists only what
was renamed, so lost executors leave nothing behind that is read.

Defined results: null and empty texts have only the end id; a null doc_id sorts first; repeated
ids and rows are each written, in order of text; an empty table gives no rows. Extra columns of
the input are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_dir, partitions, table
from .files import committed, open_file
from .tokens import ChunkEncoder

BLOCK = 1 << 16
MAGIC = b"SWTOKEN1"
TRAILER = struct.Struct("<8sIIQQQ")  # magic, bits, ids a block, ids, documents, blocks


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits`` bits each, lowest first; eight ids make ``bits`` bytes."""
    groups = -(-len(ids) // 8)
    padded = np.zeros((groups, 8), np.uint64)
    padded.reshape(-1)[: len(ids)] = ids
    out = np.zeros((groups, bits + 8), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = padded[:, j] << np.uint64(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out[:, :bits].tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, bits)
    out = np.empty((len(rows), 8), np.uint32)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = np.zeros(len(rows), np.uint64)
        for k in range((shift + bits + 7) // 8):
            value |= rows[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[:count]


class TokenFileWriter:
    def __init__(self, out, bits: int) -> None:
        self.out, self.bits, self.at = out, bits, 0
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0
        self.offsets: list[int] = []
        self.starts: list[int] = [0]
        self.docs: list[int | None] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.ids += len(ids)
        self.starts.append(self.ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 16 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([*self.waiting, np.empty(0, np.uint32)])
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for k in range(0, whole, BLOCK):
            data = pack(ids[k : min(k + BLOCK, whole)], self.bits)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        self.out.write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array([x or 0 for x in self.docs], "<i8").tobytes())
        self.out.write(np.array([x is None for x in self.docs], "u1").tobytes())
        self.out.write(TRAILER.pack(MAGIC, self.bits, BLOCK, self.ids, len(self.docs), len(self.offsets)))


class TokenFile:
    """A token file opened for whole or random reading."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - TRAILER.size)
        magic, self.bits, self.block, self.ids, docs, blocks = TRAILER.unpack(source.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        footer = 8 * (blocks + 1) + 8 * (docs + 1) + 9 * docs
        source.seek(size - TRAILER.size - footer)
        data = source.read(footer)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1)
        self.starts = np.frombuffer(data, "<u8", docs + 1, 8 * (blocks + 1))
        ids = np.frombuffer(data, "<i8", docs, 8 * (blocks + docs + 2))
        null = np.frombuffer(data, "u1", docs, 8 * (blocks + docs + 2) + 8 * docs)
        self.docs = [None if n else int(x) for x, n in zip(ids, null, strict=True)]

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids first to last - 1: only the blocks that hold them are read."""
        if first >= last:
            return np.empty(0, np.uint32)
        a, b = first // self.block, -(-last // self.block)
        self.source.seek(int(self.offsets[a]))
        data = self.source.read(int(self.offsets[b] - self.offsets[a]))
        held = min(self.ids, b * self.block) - a * self.block
        parts = [unpack(data[int(self.offsets[k] - self.offsets[a]) : int(self.offsets[k + 1] - self.offsets[a])], self.bits, min(self.block, held - (k - a) * self.block)) for k in range(a, b)]
        return np.concatenate(parts)[first - a * self.block : last - a * self.block]

    def documents(self, step: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id's position, ids), in file order, about ``step`` ids in memory."""
        k, n = 0, len(self.docs)
        while k < n:
            end = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + np.uint64(step), "right")) - 1)
            at = int(self.starts[k])
            ids = self.read(at, int(self.starts[end]))
            for d in range(k, end):
                yield self.docs[d], int(self.starts[d]), ids[int(self.starts[d]) - at : int(self.starts[d + 1]) - at]
            k = end


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files in ascending doc_id order.

    Returns the manifest (also kept in ``folder``): shard, path, first (ids before the file), n_docs, n_ids.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = ChunkEncoder.of(tokenizer), TaskContext.get().partitionId()
        bits, path = bits_for(max(encoder.vocabulary, end_id + 1)), f"{folder}/shard-{shard:06d}.tok"
        first = next(batches, None)
        if first is None:
            return
        with committed(path) as out:
            writer = TokenFileWriter(out, bits)
            for batch in (b for bs in ([first], batches) for b in bs):
                ends = np.array([end_id], np.uint32)
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(x.as_py() for x in batch.column(1)), strict=True):
                    writer.add(doc_id, np.concatenate([np.frombuffer(ids, "<u4"), ends]))
            writer.close()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "n_docs": [len(writer.docs)], "n_ids": [writer.ids]})

    placed = docs.select("doc_id", "text").repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    placed.mapInArrow(write, "shard long, path string, n_docs long, n_ids long").write.parquet(f"{folder}/manifest")
    manifest = spark.read.parquet(f"{folder}/manifest")
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return manifest.withColumn("first", F.sum("n_ids").over(order) - F.col("n_ids"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Every document of the files a manifest lists: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as source:
                    rows: list[list] = [[], [], [], []]
                    for doc_id, at, ids in TokenFile(source).documents():
                        for column, value in zip(rows, (doc_id, row["first"] + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                            column.append(value)
                        if len(rows[0]) >= 50_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], ["doc_id", "start", "n_tokens", "ids_crc32"])
                            rows = [[], [], [], []]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.select("path", "first", "shard").repartitionByRange(partitions(manifest.sparkSession), "shard").select("path", "first")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = fresh_dir(spark, "tokens")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return read_tokens(write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json")))
