import base64
import gzip
import hashlib

import pytest

from siftwork.llm import warc
from siftwork.llm.common import fresh_dir
from siftwork.llm.files import open_file, store

SCHEMA = "page_id long, url string, html string, kind int, digest string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(i, u, h, 9, "clash") for i, u, h in rows], SCHEMA)


ROWS = [(k, f"http://x/{k}?é a", f"<p>{k % 7}</p>" * (k % 5)) for k in range(60)] + [(100, None, None), (101, "u\r\nv", ""), (102, "u", "日本" * 9000)]


def test_round_trip(spark, pages):
    manifest = warc.write_warc(pages(ROWS), fresh_dir(spark, "w"), roll_bytes=2000)
    assert manifest.count() > 4 and manifest.where("bytes > 2000 + 30000").count() == 0
    largest = {}
    for i, _, h in ROWS:
        largest[h or ""] = max(largest.get(h or "", -1), i)
    want = sorted((i, len((h or "").encode()), digest(h), "response" if largest[h or ""] == i else "revisit", None if largest[h or ""] == i else largest[h or ""]) for i, _, h in ROWS)
    got = sorted(tuple(r) for r in warc.read_warc(manifest).drop("url").collect())
    assert got == want


def test_small_payloads_are_all_responses(spark, pages):
    manifest = warc.write_warc(pages(ROWS), fresh_dir(spark, "w"), revisit_bytes=20)
    rows = {r.page_id: r for r in warc.read_warc(manifest).collect()}
    assert rows[0].record_type == rows[5].record_type == "response" and any(r.record_type == "revisit" for r in rows.values())
    assert all(r.payload_bytes >= 20 for r in rows.values() if r.record_type == "revisit")


def test_reruns_write_the_same_bytes(spark, pages):
    def contents():
        manifest = warc.write_warc(pages(ROWS), fresh_dir(spark, "w"), roll_bytes=3000)
        return {r.path.rpartition("/")[2]: open_file(r.path).readall() for r in manifest.collect()}

    assert contents() == contents()


def test_nulls_and_repeats(spark, pages):
    rows = [(None, "u", "same"), (5, "u", "same"), (5, "u", "same"), (5, "v", "other"), (3, "u", "same"), (None, None, None)]
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in warc.read_warc(warc.write_warc(pages(rows), fresh_dir(spark, "w"))).collect())
    assert got == sorted([("None", "revisit", "5"), ("5", "response", "None"), ("5", "revisit", "5"), ("5", "response", "None"), ("3", "revisit", "5"), ("None", "response", "None")])
    assert warc.read_warc(warc.write_warc(pages([]), fresh_dir(spark, "w"))).count() == 0


def test_damage_is_found(spark, pages):
    path = warc.write_warc(pages(ROWS[:3]).coalesce(1), fresh_dir(spark, "w")).first().path
    data = gzip.decompress(open_file(path).readall())
    system, local = store(path)
    with system.open_output_stream(local) as out:
        out.write(gzip.compress(data.replace(b"<p>1</p>", b"<p>9</p>", 1)))
    with pytest.raises(ValueError), open_file(path) as stream:
        list(warc.read_records(stream))


def test_failed_write_leaves_nothing_behind(spark):
    from siftwork.llm.files import committed

    uri = f"{fresh_dir(spark, 'w')}/x"
    with pytest.raises(RuntimeError), committed(uri) as out:
        out.write(b"half")
        raise RuntimeError
    system, path = store(uri.rpartition("/")[0])
    from pyarrow import fs

    assert system.get_file_info(fs.FileSelector(path)) == []
