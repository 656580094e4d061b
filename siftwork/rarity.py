"""How often words or shingles occur, counted over all rows in an array of fixed size.

An order of rarity needs a count of every element. Elements are counted in cells by their hash, so the array has the
same size whatever the table's, no row is left out and no element is below a limit; elements of one cell share a count,
which is never less than an element's own. Any order by (count, hash) is one order for all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

#: Bits of a hash that name its cell, and cells that travel in one row.
CELL_BITS, STRETCH = 22, 1 << 14


def cells(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - CELL_BITS)


def cell_counts(rows: DataFrame, hashes_of: Callable[[], Callable[[pa.RecordBatch], Iterator[np.ndarray]]]) -> np.ndarray:
    """Each cell's count over all ``rows``. Each task calls ``hashes_of`` for its function, which gives a batch's hashes, an array a row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = hashes_of(), np.zeros(1 << CELL_BITS, np.uint32)
        for batch in batches:
            for hashes in of(batch):
                np.add.at(total, cells(hashes), 1)
        packer = zstandard.ZstdCompressor(level=1)
        for k, stretch in enumerate(total.reshape(-1, STRETCH)):
            if stretch.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packer.compress(stretch.tobytes())])], ["stretch", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, sums = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(unpacker.decompress(counts), np.uint32).astype(np.uint64)
        packed = [np.minimum(x, (1 << 32) - 1).astype(np.uint32).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], ["stretch", "counts"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "stretch int, counts binary"
    found = rows.mapInArrow(count, schema).repartition(parts, "stretch").mapInArrow(add, schema).toArrow()
    total = np.zeros(((1 << CELL_BITS) // STRETCH, STRETCH), np.uint32)
    for k, counts in zip(found["stretch"].to_pylist(), found["counts"].to_pylist(), strict=True):
        total[k] = np.frombuffer(counts, np.uint32)
    return total.reshape(-1)
