"""Packing by harmonic classes.

A tail of length r belongs to class j where capacity / (j + 1) < r <= capacity / j, and a bin of
class j is filled with exactly j pieces, whatever their documents. Documents may be cut, so a tail
well below its class's reciprocal length gives up a piece of the next class's exact length and the
rest goes on to the classes below: bins then close full but for a few positions. Every worker fills
its classes' bins alone; nothing is shuffled and no count is exchanged.

What the bins still hold when a worker's rows end is laid end to end, cut where a sequence is
full, so a worker leaves one partly filled sequence at most.

Scale: one pass over the scan's partitions, memory bounded by the open bins (a few thousand pieces
of at most ``capacity`` ids each). A partition that runs again gives the same sequences.

Defined results: null and empty texts are one end id; repeated rows are packed each; a null doc_id
stays null; an empty table gives no pieces. Extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokens import ChunkEncoder

#: A piece this share of its class's length, or more, is not cut.
FILL = 63 / 64
FIELDS = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


class HarmonicPacker:
    """Bins of one worker. Pieces are (doc_id, start, length, ids, doc_tokens)."""

    def __init__(self, capacity: int, first_sequence: int, fill: float = FILL) -> None:
        self.capacity, self.next, self.fill = capacity, first_sequence, fill
        self.open: dict[int, list[tuple]] = {}

    def cut(self, length: int) -> Iterator[tuple[int, int]]:
        """Lengths of the pieces of a document and their classes."""
        yield from ((self.capacity, 1) for _ in range(length // self.capacity))
        rest = length % self.capacity
        while rest:
            held = self.capacity // rest
            if rest < self.fill * (self.capacity // held):
                held += 1
            piece = min(rest, self.capacity // held)
            yield piece, held
            rest -= piece

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        """Take a document (4 bytes an id); yields the pieces of the sequences that it closes."""
        total, at = len(ids) // 4, 0
        for length, held in self.cut(total):
            pieces = self.open.setdefault(held, [])
            pieces.append((doc_id, at, length, ids[4 * at : 4 * (at + length)], total))
            at += length
            if len(pieces) == held:
                yield from self._close(self.open.pop(held))

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for piece in pieces:
            yield (*piece, self.next, offset)
            offset += piece[2]
        self.next += 1

    def finish(self) -> Iterator[tuple]:
        """What the open bins hold, end to end."""
        left, room = [], self.capacity
        for held in sorted(self.open):
            for doc_id, start, length, ids, total in self.open[held]:
                while length:
                    n = min(length, room)
                    left.append((doc_id, start, n, ids[: 4 * n], total))
                    start, length, ids, room = start + n, length - n, ids[4 * n :], room - n
                    if not room:
                        yield from self._close(left)
                        left, room = [], self.capacity
        if left:
            yield from self._close(left)
        self.open = {}


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 1024) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): the columns of ``FIELDS``.

    ids holds the piece's ids as little-endian unsigned 32-bit integers; sequence_id is unique over
    all workers; offset is the piece's place in its sequence.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = ChunkEncoder.of(tokenizer), HarmonicPacker(capacity, TaskContext.get().partitionId() << 40)
        end = end_id.to_bytes(4, "little")

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(x.as_py() for x in batch.column(1)), strict=True):
                    yield from packer.add(doc_id, ids + end)
            yield from packer.finish()

        rows: list[tuple] = []
        for piece in pieces():
            rows.append(piece)
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)

    return docs.select("doc_id", "text").mapInArrow(pack, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return digest(pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")))
