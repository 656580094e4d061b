"""WARC archives by a deterministic sharded writer.

Pages are range-sorted by page_id; each partition writes its own files, every record a gzip member
of its own, and rolls to a new file when the compressed size passes a limit. Headers and digests
are made anew from the payload. A file is written under a temporary name and renamed; only then is
it listed in the manifest, so lost or repeated tasks leave no file that is read, and a rerun
writes the same bytes under the same names.

Of equal payloads only the one with the largest page_id is stored; the others are revisits. The
largest id a digest is a partial aggregation over digests, and only the revisits' small rows are
joined back: they travel with the pages' range sort, so the html moves once.

Defined results: a null html is an empty payload; a null page_id sorts first and is never larger
than another id; of rows with one page_id and payload the first is stored and the rest are
revisits of that id; a null url has no target header; an empty table writes no file. Extra columns
of the input are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from contextlib import ExitStack
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, fresh_dir, partitions, table
from .files import committed, open_file

#: Compressed bytes after which a file is closed.
ROLL_BYTES = 64 << 20
#: Fixed values of the format.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<{URN}{'null' if page_id is None else page_id}>"


def _page_id(urn: str) -> int | None:
    value = urn.strip("<>").removeprefix(URN)
    return None if value == "null" else int(value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    headers += [("WARC-Payload-Digest", f"sha1:{_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{_sha1(block)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose bytes depend on the data alone (no time, no name)."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive; block digests are checked."""
    with gzip.GzipFile(fileobj=stream) as data:
        while line := data.readline():
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a record: {line[:40]!r}")
            headers = {}
            while (line := data.readline().rstrip(b"\r\n")):
                key, _, value = line.decode().partition(": ")
                headers[key] = value
            block = data.read(int(headers["Content-Length"]))
            if headers["WARC-Block-Digest"] != f"sha1:{_sha1(block)}" or data.read(4) != b"\r\n\r\n":
                raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
            yield headers, block


def plan_records(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Rows for the writer: the pages (kind 1) and, before them, what revisits refer to (kind 0)."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keys = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size")).where(F.col("size") >= revisit_bytes)
    # A table of its own: so AQE can split a digest that very many pages share.
    groups = checkpoint(keys.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1"))
    revisits = keys.join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("response")))
    shown = revisits.select("page_id", F.lit(0).alias("kind"), "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), F.col("response").alias("refers_to"))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("digest"), "url", F.coalesce("html", F.lit("")).alias("html"), F.lit(None).cast("long").alias("refers_to"))
    return own.union(shown)


def write_warc(pages: DataFrame, folder: str, revisit_bytes: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html); returns the manifest: path, shard, part, records, bytes."""

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        current, refers, seen = object(), {}, set()
        for batch in batches:
            for page_id, kind, digest, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if page_id != current:
                    current, refers, seen = page_id, {}, set()
                if not kind:
                    refers[digest] = refers_to
                    continue
                payload = html.encode()
                digest = hashlib.sha1(payload).hexdigest()
                again = digest in seen and len(payload) >= revisit_bytes
                seen.add(digest)
                yield record(page_id, url, payload, refers.get(digest, page_id), digest in refers or again)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, size, count = TaskContext.get().partitionId(), 0, 0, 0
        done, stack, out = [], ExitStack(), None
        path = lambda: f"{folder}/shard-{shard:06d}-{part:04d}.warc.gz"
        with ExitStack() as guard:
            guard.push(lambda *error: stack.__exit__(*error))
            for data in planned(batches):
                if out is None:
                    out = stack.enter_context(committed(path()))
                packed = member(data)
                out.write(packed)
                size, count = size + len(packed), count + 1
                if size >= roll_bytes:
                    stack.close()
                    done.append((path(), shard, part, count, size))
                    out, size, count, part = None, 0, 0, part + 1
        if count:
            done.append((path(), shard, part, count, size))
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(["path", "shard", "part", "records", "bytes"], map(list, zip(*done, strict=True)), strict=True)))

    spark = pages.sparkSession
    placed = plan_records(pages, revisit_bytes).repartitionByRange(partitions(spark), "page_id").sortWithinPartitions("page_id", "kind", "digest", "url", "html")
    placed.mapInArrow(write, "path string, shard long, part long, records long, bytes long").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """Every record of a manifest's archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with open_file(path) as stream:
                    for headers, block in read_records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        stated = int(http.rpartition(b"Content-Length: ")[2])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = headers["WARC-Type"] == "revisit"
                        if not revisit and (len(payload) != stated or _sha1(payload) != digest):
                            raise ValueError(f"damaged payload {headers['WARC-Record-ID']}")
                        rows.append((_page_id(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), stated, digest, headers["WARC-Type"], _page_id(headers["WARC-Refers-To"]) if revisit else None))
                        if len(rows) >= 20_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    spread = manifest.select("path").repartitionByRange(partitions(manifest.sparkSession), "path")
    return spread.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return read_warc(write_warc(pages, fresh_dir(spark, "warc"))).drop("url")
