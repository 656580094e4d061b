import json

import pytest
from pyspark.sql import functions as F

from siftwork.operators import layout
from siftwork.sources import files, sinks, tables
from siftwork.sources.store import new_folder


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return f"file://{path}"


def test_lines(spark, tmp_path):
    good = write(tmp_path / "good.jsonl", '{"a": 1, "b": "x"}\n\n{"a": 2}\n')
    assert [(r.a, r.b) for r in tables.read_lines(spark, good, "a int, b string").collect()] == [(1, "x"), (2, None)]
    torn = write(tmp_path / "torn.jsonl", '{"a": 1}\n[1]\n{"a": 2\n  \n"x"\n{"a": 3}')
    with pytest.raises(Exception, match="torn.jsonl"):
        tables.read_lines(spark, torn, "a int").collect()
    fine, broken = tables.repair_lines(spark, torn)
    assert sorted(r.value for r in fine.collect()) == ['{"a": 1}', '{"a": 3}'] and broken.count() == 3
    assert tables.read_open(spark, torn).where("value IS NOT NULL").count() == 4
    listed = write(tmp_path / "list.json", '[{"a": 1},\n {"a": 2}]')
    assert tables.read_object(spark, listed, "a int").count() == 2


def test_text_of_any_encoding(spark, tmp_path):
    write(tmp_path / "t/a.tex", "é")
    write(tmp_path / "t/b.tex", "é".encode("latin-1"))
    assert [r.text for r in tables.read_text(spark, f"file://{tmp_path}/t", ".tex").collect()] == ["é", "é"]


def test_first_seen_over_patterns(spark, tmp_path):
    write(tmp_path / "b/1.jsonl", '{"id": "x", "v": 1}\n{"id": "y", "v": 1}\n')
    write(tmp_path / "a/1.jsonl", '{"id": "x", "v": 2}\n{"id": "z", "v": 2}\n{"id": "z", "v": 3}\n')
    patterns = [f"file://{tmp_path}/{d}/*.jsonl" for d in "ba"]
    got = tables.first_seen_files(spark, patterns, "id string, v int", "id")
    assert sorted((r.id, r.v) for r in got.collect()) == [("x", 1), ("y", 1), ("z", 2)]
    assert tables.first_seen_files(spark, patterns, "id string, v int", "id", target=2).count() == 2
    with pytest.raises(ValueError):
        tables.first_seen_files(spark, patterns, "id string, v int", "id", F.col("v") == 1, target=3)


def figure(**more):
    return json.dumps({"paper_id": "2101.00001", "figure_index": 3, "image_index_in_figure": 2, "caption_latex": "A caption", "labels": "fig:a", "output_image": "/gone/fig.png"} | more)


def test_figure_scan(spark, tmp_path):
    base = tmp_path / "arxiv_2101/arXiv_src_1/2101.00001"
    write(base / "2101.00001_extracted_figs/fig_3.json", figure())
    write(base / "2101.00001_extracted_figs/fig_3.png", b"x")
    write(base / "2101.00001_extracted_figs/torn.json", "{")
    write(base / "2101.00001_extracted_figs_merged/fig_0003_merged_.json", figure(record_type="merged_figure", status=None, merged_panel_count=3, merge_layout={"rows": 2}))
    write(tmp_path / "arxiv_1901/arXiv_src_1/1901.1/1901.1_extracted_figs/f.json", figure(paper_id="1901.1"))
    write(base / "2101.00001_extracted_figs/old.json", figure(paper_id="1901.00009"))
    rows, broken = files.figure_records(spark, f"file://{tmp_path}", range(2019, 2022))
    got = {r.candidate_id: r for r in rows.collect()}
    assert set(got) == {"2101.00001_fig0003_img02", "2101.00001_fig0003_merged"} and broken.count() == 1
    single, merged = got["2101.00001_fig0003_img02"], got["2101.00001_fig0003_merged"]
    assert (single.year, single.month, single.source_bucket, single.labels, single.status) == (2021, "2101", "arxiv_2101", ["fig:a"], "success")
    assert (merged.image_kind, merged.status, merged.merged_panel_count, merged.merge_layout) == ("merged", None, 3, '{"rows":2}')
    listing = files.listing(spark, f"file://{tmp_path}")
    placed = files.resolve_image(rows, listing.withColumn("path", F.replace("path", F.lit("file:///"), F.lit("file:/"))), rows.declared_image, F.replace(rows.json_path, F.lit("file:///"), F.lit("file:/")))
    found = {r.candidate_id: r.image_path for r in placed.collect()}
    assert found["2101.00001_fig0003_img02"].endswith("_extracted_figs/fig_3.png") and found["2101.00001_fig0003_merged"] == "/gone/fig.png"
    assert layout.figure_directories(listing, "path", ("skip",)).count() == 2
    assert files.directories(listing, "_extracted_figs_merged$").count() == 1
    assert files.merged_directories(listing, "none", "_merged$", 99).count() == 1
    assert files.with_suffix(listing).count() == 1


def test_image_folder(spark, tmp_path):
    for name in ("2103.00002_x.png", "2104.1.jpg", "readme.txt"):
        write(tmp_path / "im" / name, b"x")
    rows = files.image_folder(spark, f"file://{tmp_path}/im", expected=2).collect()
    assert [(r.paper_id, r.month, r.year) for r in rows] == [("2103.00002", "2103", 2021), ("2104.1", "2104", 2021)]
    with pytest.raises(ValueError):
        files.image_folder(spark, f"file://{tmp_path}/im", expected=1000)


def test_eval_records(spark):
    meta = spark.createDataFrame([("val", 1, " p "), ("val", 2, ""), ("test", 1, "q"), ("test", None, "r")], "split string, figure_id int, paper_id string")
    types = spark.createDataFrame([("val", 1, None, ["", "x"], "bar"), ("test", 1, "line", ["z"], None)], "split string, figure_id int, chart_type string, chart_types array<string>, label string")
    got = sorted((r.split, r.paper_id, r.chart_types) for r in files.eval_records(meta, types).collect())
    assert got == [("test", "q", ["line"]), ("test", "r", []), ("val", "p", ["bar"])]


def test_tables_and_backups(spark):
    path = new_folder(spark, "lines")
    rows = spark.createDataFrame([(2, "b"), (1, None)], "k int, a string")
    assert sinks.write_lines(rows, path, ["k"]) == 2
    sinks.append_lines(rows.limit(1), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert sorted(lines) == ['{"a":"b","k":2}', '{"a":"b","k":2}', '{"a":null,"k":1}']
    copy = sinks.backup(spark, path)
    assert spark.read.text(copy).count() == 3 and sinks.backup(spark, path + "-none") is None
    table = new_folder(spark, "table")
    sinks.replace_table(rows, table)
    sinks.replace_table(spark.read.parquet(table).withColumn("k", F.col("k") + 1), table)
    assert sorted(r.k for r in spark.read.parquet(table).collect()) == [2, 3]
    assert tables.read_or_none(spark, table + "-none") is None


def test_shards_and_outcomes(spark):
    path = new_folder(spark, "shards")
    sinks.write_shards(spark.range(10), path, 4, [F.col("id")])
    got = {}
    for r in spark.read.parquet(path).collect():
        got.setdefault(r.shard, set()).add(r.id)
    assert got == {0: {0, 4, 8}, 1: {1, 5, 9}, 2: {2, 6}, 3: {3, 7}}
    good, bad = new_folder(spark, "good"), new_folder(spark, "bad")
    sinks.split_writes(spark.range(4), {good: F.col("id") < 3, bad: F.col("id") >= 3})
    assert spark.read.parquet(good).count() == 3 and spark.read.parquet(bad).count() == 1


def test_reports(spark):
    path = f"{new_folder(spark, 'report')}/r.md"
    text = sinks.sampling_markdown("Sample", {"inclusive": [{"name": "year", "value": "2021", "n": 3}]}, {"inclusive": 2})
    sinks.write_text(spark, path, text)
    sinks.write_text(spark, path, text)
    assert "- year 2021: 3" in spark.read.text(path, wholetext=True).first().value
    assert json.loads(sinks.as_json(sinks.report(spark.range(2)))) == [{"id": 0}, {"id": 1}]
    with pytest.raises(ValueError):
        sinks.report(spark.range(20), limit=10)
    page = sinks.review_page([{"q": "<b>", "i": "file:///a b.png", "x": {"k": 1}}], ["q", "x"], image="i")
    assert "&lt;b&gt;" in page and "{&quot;k&quot;: 1}" in page
    moved, missing = sinks.rewrite_images('<img src="file:///a%20b.png"><img src="file:///c.png">', {"/a b.png": "assets/1.png"})
    assert 'src="assets/1.png"' in moved and missing == ["/c.png"]


def test_a_lost_swap_is_put_back(spark):
    path = f"{new_folder(spark, 'swap')}/table"
    sinks.replace_table(spark.range(3), path)
    fs, target = sinks.filesystem(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.rename(target, at(f"{path}.old"))  # the driver was lost between the two renames
    assert sinks.recover_table(spark, path) and spark.read.parquet(path).count() == 3
    assert not sinks.recover_table(spark, path)
    sinks.replace_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and not fs.exists(at(f"{path}.old"))


def test_pages_and_their_export(spark, tmp_path):
    picture = write(tmp_path / "p/a b.png", b"\x89PNG")
    rows = [{"id": "<x>", "long": ["é"] * 900, "image": picture.replace(" ", "%20"), "path": "/v/1", "messages": [{"role": "user", "content": "<image>"}, {"role": "assistant", "content": "a & b"}]}, {"id": "y", "image": "file:///gone.png"}]
    page = sinks.review_page(rows, ["id", "long"], "image", links={"path": "open"})
    assert "&lt;x&gt;" in page and page.count("é") == 900 and '<a href="/v/1">open</a>' in page and "2 rows" in page
    assert sinks.review_page(rows, ["long"], most=50).count("é") < 50
    assert "a &amp; b" in sinks.chat_page(rows, "messages", "image") and "<td>y</td>" in sinks.table_page(rows, ["id"])
    missing = sinks.export_page(spark, page, f"file://{tmp_path}/out")
    written = (tmp_path / "out/index.html").read_text()
    assert missing == ["/gone.png"] and written.count('src="assets/') == 1
    assert [f.read_bytes() for f in (tmp_path / "out/assets").glob("*.png")] == [b"\x89PNG"]
