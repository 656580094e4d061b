"""Suffix-array dedup by deep-shallow sorting.

Every byte that a string of ``LENGTH`` bytes covers is removed if the same string starts earlier:
in a document of smaller id, or earlier in the same one. Strings never cross documents.

A full suffix array would hold one suffix a byte. Instead the strings are reached through anchors:
the leftmost least of the K-gram hashes in a window of LENGTH bytes. Equal windows have their
anchor in the same place, so only windows whose anchor's K-gram occurs again can repeat; K-grams are counted first, and only
their surroundings (context: all windows with that anchor, a run of starts) are shipped. In the
task of a K-gram, the contexts and then the suffixes at every window start are put in a suffix
array by ``deepshallow``, to a depth of LENGTH bytes; equal neighbours are the repeats, and all but
the earliest are removed. Hashes choose candidates and never decide.

The passes:
1. documents -> anchors, by the K-gram's task. Within a batch a K-gram is sent once; if it occurs
   again there, the others are known to be shared and go straight to their document's task.
2. K-gram tasks -> shared anchors, back to their document's task; the few names of hot K-grams.
3. documents and their shared anchors -> contexts, by the K-gram's task. Contexts that repeat within
   a batch are sent once (the earliest); the others are removed already. Contexts of a hot K-gram go window by
   window, by the window's own hash.
4. K-gram tasks: suffix arrays -> removed windows, by the document's task.
5. documents and their removed windows -> what is kept.

Scale: rows between passes are packed columns, one a batch and task. A passage in any share of
the documents sends one entry a batch to its task, and a short line in any share of them, amid different
text, is spread window by window. The text moves twice (passes 3 and 5). Memory
is bounded by a partition's share of anchors or contexts and one batch of text; texts of any
length are worked through in pieces.

Defined results: a null text is empty; a null doc_id is smaller than any other; rows that repeat
both doc_id and text are one document listed again: each keeps what the one would keep; rows of one doc_id and
different texts are ordered by a hash of the text (documents are told apart by 64 bits of doc_id and text: two
that agree in them, one pair in 2 ** 64, would be cut alike); an empty table gives no rows. Columns other
than doc_id, text and those named to be carried are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, table, tasks_for
from .deepshallow import first_of_class, sort_strings

LENGTH, K = 100, 36
#: Bytes of text whose windows are hashed at once.
PIECE = 1 << 20
#: Bytes of contexts that pass 3 sorts at once.
CONTEXTS = 8 << 20
#: Window starts that are sorted at once, unless one gram has more.
WINDOWS = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2 ** 64."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k bytes of ``data``: differences of one running sum."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * up[: len(data)], dtype=np.uint64, out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[: len(data) - k + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of the leftmost least (by its upper 57 bits)."""
    low = np.uint64(127)
    assert width <= 128
    n = len(hashes)
    rows = -(-n // width)
    keys = np.full(rows * width, ~np.uint64(0))
    keys[:n] = hashes
    keys = (keys.reshape(rows, width) & ~low) | np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(keys, axis=1).reshape(-1)
    p = np.arange(n - width + 1)
    a, b = ahead[p], behind[p + width - 1]
    first = (a & ~low) <= (b & ~low)
    block = np.where(first, p, p + width - 1) // width * width
    return block + (np.where(first, a, b) & low).astype(np.int64)


def anchor_runs(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (piece, first window, windows, hash of the anchor's K-gram)."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.array([len(x) for x in pieces])
    if len(data) < LENGTH:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    hashes = gram_hashes(data, K)
    anchor = anchors_of(hashes, LENGTH - K + 1)
    starts = np.cumsum(lengths) - lengths
    windows = np.maximum(lengths - LENGTH + 1, 0)
    piece = np.repeat(np.arange(len(pieces)), windows)
    inside = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = anchor[starts[piece] + inside]
    if not len(at):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    lead = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])])
    return piece[lead], inside[lead], np.diff(np.r_[lead, len(at)]), hashes[at[lead]] * np.uint64(0x94D049BB133111EB)


def pack(*columns: np.ndarray, data: bytes = b"", level: int = 1) -> bytes:
    """Columns of one length and free bytes as one compressed value; bytes of equal weight together."""
    parts = [np.array([len(columns[0])], "<u8").tobytes()]
    parts += [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=level).compress(b"".join([*parts, data]))


def unpack(blob: bytes, *types: str) -> tuple:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, columns = int(np.frombuffer(raw, "<u8", 1)[0]), 8, []
    for kind in map(np.dtype, types):
        size = n * kind.itemsize
        columns.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n).T).view(kind).reshape(n))
        at += size
    return (*columns, raw[at:])


def _split(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(task, rows for it)."""
    if not len(to):
        return
    order = np.argsort(to, kind="stable")
    tasks, begins = np.unique(to[order], return_index=True)
    yield from zip(tasks.tolist(), np.split(order, begins[1:]), strict=True)


ANCHOR = ("<i8", "<u4", "u1", "<u4", "<u4")  # key, first window, windows, gram (of the task), times in the batch
SHARED = ("<i8", "<u4", "u1", "<u8")  # key, first window, windows, task and gram
CONTEXT = ("<u4", "<i8", "<i8", "<u4", "u1")  # gram, doc_id, key, first window, windows
REMOVED = ("<i8", "<u4", "<u4")  # key, first byte, last byte + 1
BLOB = "bucket int, kind int, blob binary"
NONE_ID = -(1 << 63)


class _Out:
    """Rows (bucket, kind, blob) as Arrow batches."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, bucket: int, kind: int, blob: bytes) -> None:
        self.rows.append((bucket, kind, blob))

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            types = (pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), types, strict=True)], ["bucket", "kind", "blob"])
            self.rows = []


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """(kind, blob) of rows (bucket, kind, blob), one blob in memory beside its batch."""
    for batch in batches:
        for kind, blob in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            yield kind, blob.as_py()


def _deal_documents(tasks: int):
    """Documents (doc_id, key, text, carried columns) to their tasks, a compressed Arrow stream a batch and task (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        out = _Out()
        for batch in batches:
            for t, part in _split(_home(batch.column(1).to_numpy(), tasks)):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                    writer.write_batch(batch.take(pa.array(part)))
                out.add(t, 1, sink.getvalue().to_pybytes())
            yield from out.batches()

    return run


def _documents(blob: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(blob)))


def _home(key: np.ndarray, tasks: int) -> np.ndarray:
    """The task of a document, by the low half of its key."""
    return ((key.astype(np.uint64) & np.uint64(0xFFFFFFFF)) % np.uint64(tasks)).astype(np.int64)


def _anchors_in(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, first window, windows, gram hash) of the anchors of a batch (key, text), piece by piece."""
    keys, firsts, pieces, held = [], [], [], 0

    def flush() -> tuple[np.ndarray, ...]:
        piece, first, count, gram = anchor_runs(pieces)
        found = np.array(keys, np.int64)[piece], first + np.array(firsts, np.int64)[piece], count, gram
        for x in (keys, firsts, pieces):
            x.clear()
        return found

    for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        data = (text.as_py() or "").encode()
        for at in range(0, max(0, len(data) - LENGTH + 1), PIECE):
            keys.append(key)
            firsts.append(at)
            pieces.append(data[at : at + PIECE + LENGTH - 1])
            held += len(pieces[-1])
            if held >= PIECE:
                yield flush()
                held = 0
    if pieces:
        yield flush()


def _pass1(tasks: int):
    """Anchors by gram task: 0 alone in the batch, 1 the word of a gram that the batch shares; 2 the shared, by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out()
        for batch in batches:
            found = list(_anchors_in(batch))
            if not found:
                continue
            key, first, count, gram = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.argsort(gram, kind="stable")
            lead = np.r_[True, gram[order][1:] != gram[order][:-1]][: len(order)]
            shared = ~(lead & np.r_[lead[1:], True][: len(order)])
            times = np.empty(len(order), np.uint32)
            times[order] = np.bincount(np.cumsum(lead) - 1)[np.cumsum(lead) - 1]
            task = ((gram & np.uint64(0xFFFFFFFF)) % np.uint64(tasks)).astype(np.int64)
            high = (gram >> np.uint64(32)).astype(np.uint32)
            code = (task.astype(np.uint64) << np.uint64(32)) | high
            home = _home(key, tasks)
            first, count = first.astype(np.uint32), count.astype(np.uint8)
            for kind, rows, to, name in ((0, order[~shared], task, high), (1, order[lead & shared], task, high), (2, order[shared], home, code)):
                rows = np.sort(rows)
                for t, part in _split(to[rows]):
                    part = rows[part]
                    out.add(t, kind, pack(key[part], first[part], count[part], name[part], *([] if kind == 2 else [times[part]])))
            yield from out.batches()

    return run


def _window_names(data: bytes, starts: np.ndarray) -> np.ndarray:
    """A hash of the LENGTH bytes from each start, by its 8-byte words (the last one overlaps)."""
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    name = np.zeros(len(starts), np.uint64)
    for at in (*range(0, LENGTH - 7, 8), LENGTH - 8):
        name = (name ^ words[starts + at]) * np.uint64(0x94D049BB133111EB)
        name ^= name >> np.uint64(29)
    return name


#: A gram with more anchors than this, and more than this share of its task's, is dealt window by window.
HOT, HOT_A_TASK = 2000, 20


def _pass2(tasks: int):
    """Of a gram task's anchors, those whose gram came more than once, to their document's task (0); names of hot grams (2).

    A task names fewer than ``HOT_A_TASK`` hot grams, so all their names together have a bound.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, columns, words, mine = _Out(), [], [], 0
        for batch in batches:
            for bucket, kind, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 2:
                    out.add(bucket, 0, blob)
                else:
                    mine = bucket
                    columns.append(unpack(blob, *ANCHOR)[:5])
                    words.append(np.full(len(columns[-1][0]), kind, bool))
            yield from out.batches()
        if columns:
            key, first, count, gram, times = (np.concatenate(c) for c in zip(*columns, strict=True))
            names, group, sent = np.unique(gram, return_inverse=True, return_counts=True)
            code = (np.uint64(mine) << np.uint64(32)) | gram.astype(np.uint64)
            total = np.bincount(group, times)
            hot = np.flatnonzero(total > max(HOT, total.sum() / HOT_A_TASK))
            if len(hot):
                out.add(mine, 2, ((np.uint64(mine) << np.uint64(32)) | names[hot].astype(np.uint64)).tobytes())
            # Words only count here: their anchors are with their documents since pass 1.
            rows = np.flatnonzero((sent[group] > 1) & ~np.concatenate(words))
            for t, part in _split(_home(key[rows], tasks)):
                part = rows[part]
                out.add(t, 0, pack(key[part], first[part], count[part], code[part]))
            yield from out.batches()

    return run


def _ranks(doc_id: np.ndarray, key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places in the order of documents and, within one, of bytes."""
    order = np.lexsort((at, key, doc_id))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def _send_removed(out: _Out, kind: int, tasks: int, key: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
    for t, part in _split(_home(key, tasks)):
        out.add(t, kind, pack(key[part].astype(np.int64), begin[part].astype(np.uint32), end[part].astype(np.uint32)))


def _pass3(tasks: int, hot: np.ndarray):
    """Contexts of shared anchors by gram task (0); removed bytes already certain, by document's task (1).

    The contexts of a hot gram would meet in one task, so each of their windows goes alone, as a context of
    one window, to a task by its own hash: equal windows still meet, different ones spread.
    """

    def flush(out: _Out, held: list[tuple], data: list[bytes]) -> None:
        code, doc_id, key, first, count = (np.concatenate(c) for c in zip(*held, strict=True))
        lengths = count.astype(np.int64) + LENGTH - 1
        starts, joined = np.cumsum(lengths) - lengths, b"".join(data)
        leader = first_of_class(*sort_strings(joined, starts, lengths), _ranks(doc_id, key, first))
        again = np.flatnonzero(leader != np.arange(len(leader)))
        _send_removed(out, 1, tasks, key[again], first[again], first[again].astype(np.int64) + lengths[again])
        rows = np.flatnonzero(leader == np.arange(len(leader)))
        spread = np.isin(code[rows], hot)
        send(out, rows[~spread], joined, starts, lengths, code, doc_id, key, first, count)
        rows = rows[spread]
        # Some windows at a time: equal ones that are sent apart meet in their task.
        while len(rows):
            part = rows[: max(1, int(np.searchsorted(np.cumsum(count[rows].astype(np.int64)), WINDOWS // 2, "right")))]
            rows = rows[len(part) :]
            n = count[part].astype(np.int64)
            of = np.repeat(part, n)
            inside = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            begin, whole, place = starts[of] + inside, np.full(len(of), LENGTH), first[of].astype(np.int64) + inside
            leader = first_of_class(*sort_strings(joined, begin, whole), _ranks(doc_id[of], key[of], place))
            again = np.flatnonzero(leader != np.arange(len(leader)))
            _send_removed(out, 1, tasks, key[of][again], place[again], place[again] + LENGTH)
            own = np.flatnonzero(leader == np.arange(len(leader)))
            name = _window_names(joined, begin[own])
            task = (name & np.uint64(0xFFFFFFFF)) % np.uint64(tasks)
            name = (task << np.uint64(32)) | (name >> np.uint64(32))
            send(out, np.arange(len(own)), joined, begin[own], whole[own], name, doc_id[of][own], key[of][own], place[own].astype(np.uint32), np.ones(len(own), np.uint8))

    def send(out: _Out, rows: np.ndarray, joined: bytes, starts: np.ndarray, lengths: np.ndarray, code: np.ndarray, *columns: np.ndarray) -> None:
        for t, part in _split((code[rows] >> np.uint64(32)).astype(np.int64)):
            part = rows[part]
            own = b"".join([joined[a:b] for a, b in zip(starts[part].tolist(), (starts[part] + lengths[part]).tolist(), strict=True)])
            out.add(t, 0, pack((code[part] & np.uint64(0xFFFFFFFF)).astype(np.uint32), *[c[part] for c in columns], data=own, level=3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, columns, shared = _Out(), [], None
        held, data, size = [], [], 0
        done: set[int] = set()
        for kind, blob in _blobs(batches):
            if not kind:
                columns.append(unpack(blob, *SHARED)[:4])
                continue
            if shared is None:
                shared = [np.concatenate(c) for c in zip(*columns, strict=True)] if columns else [np.empty(0, t) for t in SHARED]
                order = np.lexsort((shared[1], shared[0]))
                # A row listed again brings its anchors again; runs of one document start at different windows.
                new = np.r_[True, (np.diff(shared[0][order]) != 0) | (np.diff(shared[1][order]) != 0)][: len(order)]
                shared, columns = [c[order[new]] for c in shared], []
            docs = _documents(blob)
            for doc_id, key, text in zip(docs.column(0).to_pylist(), docs.column(1).to_pylist(), docs.column(2), strict=True):
                a, b = np.searchsorted(shared[0], key, "left"), np.searchsorted(shared[0], key, "right")
                if a == b or key in done:
                    continue
                done.add(key)
                raw = text.as_py().encode()
                first, count, code = (c[a:b] for c in shared[1:])
                fits = first.astype(np.int64) + count + LENGTH - 1 <= len(raw)
                first, count, code = first[fits], count[fits], code[fits]
                held.append((code, np.full(len(first), NONE_ID if doc_id is None else doc_id, np.int64), np.full(len(first), key, np.int64), first, count))
                own = [raw[x : x + n + LENGTH - 1] for x, n in zip(first.tolist(), count.tolist(), strict=True)]
                data += own
                size += sum(map(len, own))
                if size >= CONTEXTS:
                    flush(out, held, data)
                    held, data, size = [], [], 0
                    yield from out.batches()
        if held:
            flush(out, held, data)
            yield from out.batches()

    return run


def repeats_among(data: bytes, gram: np.ndarray, doc_id: np.ndarray, key: np.ndarray, first: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, first byte, last byte + 1) of the windows of contexts that start earlier elsewhere.

    ``data`` holds the contexts, each count + LENGTH - 1 bytes, in the order of the columns.
    """
    lengths = count.astype(np.int64) + LENGTH - 1
    starts = np.cumsum(lengths) - lengths
    first = first.astype(np.int64)
    leader = first_of_class(*sort_strings(data, starts, lengths), _ranks(doc_id, key, first))
    own = leader == np.arange(len(leader))
    again = np.flatnonzero(~own)
    yield key[again], first[again], first[again] + lengths[again]
    # Different contexts of one gram may still share windows: suffixes at all their window starts.
    rows = np.flatnonzero(own)
    rows = rows[np.argsort(gram[rows], kind="stable")]
    _, group, times = np.unique(gram[rows], return_inverse=True, return_counts=True)
    rows, group = rows[times[group] > 1], group[times[group] > 1]
    if not len(rows):
        return
    ends = np.flatnonzero(np.r_[group[1:] != group[:-1], True]) + 1
    total, at = np.cumsum(count[rows].astype(np.int64)), 0
    while at < len(rows):
        before = total[at - 1] if at else 0
        fit = ends[(total[ends - 1] - before <= WINDOWS) & (ends > at)]
        end = int(fit[-1]) if len(fit) else int(ends[ends > at][0])
        part = rows[at:end]
        n = count[part].astype(np.int64)
        context = np.repeat(np.arange(len(part)), n)
        inside = np.arange(len(context)) - np.repeat(np.cumsum(n) - n, n)
        place = first[part][context] + inside
        found = sort_strings(data, starts[part][context] + inside, np.full(len(context), LENGTH))
        leader = first_of_class(*found, _ranks(doc_id[part][context], key[part][context], place))
        gone = np.flatnonzero(leader != np.arange(len(leader)))
        if len(gone):
            lead = np.flatnonzero(np.r_[True, (np.diff(gone) != 1) | (context[gone][1:] != context[gone][:-1])])
            last = np.r_[lead[1:], len(gone)] - 1
            yield key[part][context[gone[lead]]], place[gone[lead]], place[gone[last]] + LENGTH
        at = end


def _pass4(tasks: int):
    """Suffix arrays of a gram task's contexts; removed bytes, by document's task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, columns, data = _Out(), [], []
        for batch in batches:
            for bucket, kind, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind:
                    out.add(bucket, 0, blob)
                else:
                    *found, own = unpack(blob, *CONTEXT)
                    columns.append(found)
                    data.append(own)
            yield from out.batches()
        if columns:
            for removed in repeats_among(b"".join(data), *(np.concatenate(c) for c in zip(*columns, strict=True))):
                _send_removed(out, 0, tasks, *removed)
                yield from out.batches()

    return run


def _merged(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes: (first, last + 1)."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    lead = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
    return list(zip(begin[lead].tolist(), end[np.r_[lead[1:], len(begin)] - 1].tolist(), strict=True))


def _whole(piece: bytes) -> bytes:
    """A piece of UTF-8 text without what its ends hold of characters that a cut has split."""
    return piece.decode("utf-8", "ignore").encode()


def _pass5(carry: int, characters: bool):
    """What is kept of each document: doc_id, carried columns, n_bytes, spans, kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, removed = [], None
        for kind, blob in _blobs(batches):
            if not kind:
                columns.append(unpack(blob, *REMOVED)[:3])
                continue
            if removed is None:
                removed = [np.concatenate(c) for c in zip(*columns, strict=True)] if columns else [np.empty(0, t) for t in REMOVED]
                order = np.argsort(removed[0], kind="stable")
                removed, columns = [c[order] for c in removed], []
            own = _documents(blob)
            sizes, spans, kept = [], [], []
            for key, text in zip(own.column(1).to_pylist(), own.column(2), strict=True):
                raw = text.as_py().encode()
                a, b = np.searchsorted(removed[0], key, "left"), np.searchsorted(removed[0], key, "right")
                runs = _merged(removed[1][a:b].astype(np.int64), removed[2][a:b].astype(np.int64)) if a < b else []
                sizes.append(len(raw))
                spans.append([{"start": x, "length": y - x} for x, y in runs])
                edges = [0, *(e for run in runs for e in run), len(raw)]
                pieces = [raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)]
                kept.append(raw if not runs else b"".join([_whole(x) for x in pieces] if characters else pieces))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            arrays = [own.column(0), *own.columns[3 : 3 + carry], pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *own.schema.names[3 : 3 + carry], "n_bytes", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = (), characters: bool = False) -> DataFrame:
    """Each row of ``docs`` (doc_id, text): doc_id, the carried columns, n_bytes, spans, kept.

    spans are the maximal removed runs (start, length), in bytes; kept is what remains, joined. With
    ``characters`` the rest of a character that a cut has split is not kept either, so kept is UTF-8.
    """
    tasks = tasks_for(docs)
    # Carried columns travel under numbers, so that none is named as one of these.
    named = {c: f"carried {k}" for k, c in enumerate(carry)}
    kinds = {c: docs.schema[c].dataType for c in carry}
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("text"), *[F.col(c).alias(n) for c, n in named.items()])

    def deal(rows: DataFrame) -> DataFrame:
        return rows.repartitionById(tasks, F.col("bucket"))

    def beside(blobs: DataFrame, *more: str) -> DataFrame:
        """A document task's packed rows (0), then its documents (1)."""
        own = docs.select("doc_id", "key", "text", *more).mapInArrow(_deal_documents(tasks), BLOB)
        return deal(blobs.withColumn("kind", F.lit(0)).union(own)).sortWithinPartitions("kind")

    anchors = deal(docs.select("key", "text").mapInArrow(_pass1(tasks), BLOB))
    shared = checkpoint(anchors.mapInArrow(_pass2(tasks), BLOB))
    names = shared.where("kind = 2").select("blob").collect()
    hot = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(r.blob, np.uint64) for r in names)])
    contexts = deal(beside(shared.where("kind = 0")).mapInArrow(_pass3(tasks, hot), BLOB))
    removed = contexts.mapInArrow(_pass4(tasks), BLOB)
    carried = "".join(f"`{n}` {kinds[c].simpleString()}, " for c, n in named.items())
    kept = beside(removed, *named.values()).mapInArrow(_pass5(len(carry), characters), f"doc_id long, {carried}n_bytes long, spans array<struct<start: long, length: long>>, kept binary")
    return kept.withColumnsRenamed({n: c for c, n in named.items()})


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["length"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
