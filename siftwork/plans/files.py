"""Sources and sinks: each query writes files from a table, reads them back through the readers and returns what they give."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import images as I
from ..functions import text as T
from ..operators import filters, layout
from ..sources import files, sinks, tables
from ..sources.store import filesystem, new_folder
from ..streaming import stages
from .tables import read

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def write_bytes(spark, path: str, data: bytes) -> None:
    fs, target = filesystem(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(data))
    out.close()


@query("SELECT doc_id, lang, n_chars, text, len(text) AS length FROM documents")
def json_lines(spark, d):
    """Even ids replace a JSON-line table, odd ids are appended; the table is read back."""
    folder = new_folder(spark, "lines")
    rows = read(spark, d, "documents").select("doc_id", "lang", "n_chars", "text")
    sinks.write_lines(rows.where("doc_id % 2 = 0"), f"{folder}/table")
    sinks.append_lines(rows.where("doc_id % 2 = 1"), f"{folder}/table")
    return tables.read_lines(spark, f"{folder}/table", rows.schema).withColumn("length", F.length("text").cast("long"))


@query("SELECT n_nationkey AS id, n_name AS name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def json_objects(spark, d):
    """A whole-file JSON list of a dimension table."""
    path = f"{new_folder(spark, 'objects')}/nations.json"
    rows = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    listed = sinks.report(rows.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("r_name").alias("region")))
    sinks.write_text(spark, path, sinks.as_json(listed))
    return tables.read_object(spark, path, "id int, name string, region string")


_TORN = "CASE WHEN turn % 5 = 4 THEN '{\"conv_id\": ' || conv_id WHEN turn % 5 = 3 THEN '[' || conv_id || ']' ELSE '{\"conv_id\": ' || conv_id || ', \"turn\": ' || turn || '}' END"


@query(f"SELECT line, count(*) AS n, 'good' AS kind FROM (SELECT {_TORN} AS line, turn FROM conversations) WHERE turn % 5 < 3 GROUP BY line UNION ALL SELECT 'lines', count(*), 'broken' FROM conversations WHERE turn % 5 >= 3")
def json_repair(spark, d):
    """A table with torn lines and lists is rewritten with its good lines; a copy of it is kept."""
    path = f"{new_folder(spark, 'torn')}/table"
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    line = F.when(F.col("turn") % 5 == 4, F.concat(F.lit('{"conv_id": '), conv)).when(F.col("turn") % 5 == 3, F.concat(F.lit("["), conv, F.lit("]")))
    line = line.otherwise(F.concat(F.lit('{"conv_id": '), conv, F.lit(', "turn": '), turn, F.lit("}")))
    read(spark, d, "conversations").select(line.alias("value")).write.text(path)
    copy, _, broken = tables.repair_table(spark, path)
    if copy and spark.read.text(copy).count() != spark.read.text(path).count() + broken:
        raise ValueError("the copy is not the table before its repair")
    good = spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("good"))
    return good.union(spark.createDataFrame([("lines", broken, "broken")], "line string, n long, kind string"))


@query("SELECT n_nationkey AS id, CASE WHEN n_nationkey % 3 = 0 THEN 'second' ELSE 'first' END AS found_by FROM nation")
def torn_line_tail(spark, d):
    """Files that end in a torn line: the whole lines first; when the rest has come, the others."""
    folder = new_folder(spark, "tail")
    names = [r.n_nationkey for r in read(spark, d, "nation").select("n_nationkey").orderBy("n_nationkey").collect()]
    late = [n for n in names if n % 3 == 0]
    whole = "".join(f"{n}\n" for n in names if n % 3) + "\n"
    torn = "".join(f"{n}\n" for n in late)
    write_bytes(spark, f"{folder}/in/a.jsonl", (whole + torn[:1]).encode())
    listing = files.listing(spark, f"{folder}/in")
    tables.tail_lines(listing).write.parquet(f"{folder}/first")
    first = spark.read.parquet(f"{folder}/first")
    write_bytes(spark, f"{folder}/in/a.jsonl", (whole + torn).encode())
    second = tables.tail_lines(listing, first.select("path", "until"))
    shown = lambda rows, by: rows.select(F.trim("value").cast("int").alias("id"), F.lit(by).alias("found_by"))
    return shown(first, "first").union(shown(second, "second"))


@query("SELECT n_nationkey || CASE WHEN n_nationkey % 3 = 0 THEN '.PNG' WHEN n_nationkey % 3 = 1 THEN '.jpeg' ELSE '.txt' END AS name, n_nationkey % 3 < 2 AS image, (n_nationkey + 1)::BIGINT AS length FROM nation")
def file_listing(spark, d):
    """Files of several suffixes: the listing, and which of them are images."""
    folder = new_folder(spark, "listing")
    for (key,) in read(spark, d, "nation").select("n_nationkey").collect():
        write_bytes(spark, f"{folder}/sub{key % 4}/{key}{('.PNG', '.jpeg', '.txt')[key % 3]}", b"x" * (key + 1))
    listed = files.listing(spark, folder)
    images = files.with_suffix(listed).select(F.col("path").alias("of image"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return listed.join(images, F.col("path") == F.col("of image"), "left").select(name.alias("name"), F.col("of image").isNotNull().alias("image"), "length")


@query("SELECT n_nationkey AS id, 'Übergröße – ' || CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'é' END AS text FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT n_nationkey, 'Ü' || n_name || 'é' FROM nation WHERE n_nationkey % 2 = 1")
def encoding_ladder(spark, d):
    """Files in UTF-8 and, the odd ones, in Latin-1."""
    folder = new_folder(spark, "encodings")
    for key, name in read(spark, d, "nation").select("n_nationkey", "n_name").collect():
        data = f"Übergröße – {name}".encode() if key % 2 == 0 else f"Ü{name}é".encode("latin-1")
        write_bytes(spark, f"{folder}/{key}.tex", data)
    found = tables.read_text(spark, folder, ".tex")
    return found.select(F.regexp_extract("path", r"([0-9]+)\.tex$", 1).cast("int").alias("id"), "text")


def _pictures(spark, d) -> str:
    """A folder with a picture a nation: grey or, every third, in colour; dark on the left, light on the right."""
    folder = new_folder(spark, "pictures")
    for (key,) in read(spark, d, "nation").select("n_nationkey").collect():
        pixels = np.zeros((16 + key, 2 * (8 + key)), np.uint8)
        pixels[:, 8 + key :] = 200
        write_bytes(spark, f"{folder}/24{key % 12 + 1:02d}.{key:05d}.png", I.encode_png(np.repeat(pixels[..., None], 3, axis=2) if key % 3 == 0 else pixels))
    return folder


@query("""
SELECT n_nationkey AS id, 2 * (8 + n_nationkey) AS width, 16 + n_nationkey AS height, 'PNG' AS format, printf('24%02d', n_nationkey % 12 + 1) AS month, 2024 AS year, '0f0f0f0f0f0f0f0f' AS hash, TRUE AS inlined FROM nation
""")
def picture_scan(spark, d):
    """Pictures of a flat folder: ids and months from their names, sizes from their headers, hashes, inline parts."""
    folder = _pictures(spark, d)
    named = files.image_folder(spark, folder, expected=read(spark, d, "nation").count())
    raw = spark.read.format("binaryFile").load(folder).select("path", I.image_header("content").alias("head"), I.data_url(F.col("content"), F.col("path")).alias("url"))
    image = spark.read.format("image").load(folder).select("image.*")
    hashed = image.select(F.col("origin").alias("of"), I.image_hash("height", "width", "nChannels", "data").alias("hash"))
    name = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    rows = named.join(raw, name("image_path") == name("path")).join(hashed, name("path") == name("of"))
    return rows.select(
        F.regexp_extract("paper_id", r"\.([0-9]+)$", 1).cast("int").alias("id"), "head.width", "head.height", "head.format", "month", "year", "hash", F.col("url").startswith("data:image/png;base64,iVBOR").alias("inlined")
    )


@query("SELECT n_nationkey AS id, CASE WHEN w * h > 400 THEN greatest(1, floor(w * sqrt(400.0 / (w * h))))::INTEGER ELSE w END AS width, CASE WHEN w * h > 400 THEN greatest(1, floor(h * sqrt(400.0 / (w * h))))::INTEGER ELSE h END AS height FROM (SELECT n_nationkey, 2 * (8 + n_nationkey) AS w, 16 + n_nationkey AS h FROM nation)")
def picture_copies(spark, d):
    """Copies shrunk to 400 pixels, kept under their cache names and made once."""
    folder = _pictures(spark, d)
    listed = files.listing(spark, folder, "*.png")
    first = files.resized_images(listed, f"{folder}-copies", 400)
    first.write.parquet(f"{folder}-made")
    made = spark.read.parquet(f"{folder}-made")
    again = files.resized_images(listed, f"{folder}-copies", 400).where("made")
    if not again.isEmpty():
        raise ValueError("a copy was made twice")
    copies = spark.read.format("binaryFile").load(f"{folder}-copies").select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), I.image_header("content").alias("head"))
    joined = made.join(copies, F.regexp_extract("copy", r"([^/]+)$", 1) == F.col("name"))
    return joined.select(F.regexp_extract("path", r"\.([0-9]+)\.png$", 1).cast("int").alias("id"), "head.width", "head.height")


_PANELS = "(doc_id % 5 + 2)"


@query(f"""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN (({_PANELS} + 1) // 2)::INTEGER WHEN 1 THEN {_PANELS}::INTEGER ELSE 1 END AS row_count, {_PANELS}::INTEGER AS panels,
  printf('fig_%04d_merged', doc_id % 50 + 1) AS stem FROM documents
""")
def figure_rows(spark, d):
    """Figures of two to six panels: half a line each, one a row by a break, or all in one row."""
    k = (F.col("doc_id") % 5 + 2).cast("int")
    names = F.transform(F.sequence(F.lit(1), k), lambda n: F.format_string("p%d", n))
    option = F.when(F.col("doc_id") % 3 == 0, F.lit("[width=0.5\\textwidth]")).otherwise("")
    between = F.when(F.col("doc_id") % 3 == 1, F.lit("\\\\ ")).otherwise(" ")
    commands = F.transform(names, lambda n: F.concat(F.lit("\\includegraphics"), option, F.lit("{./"), n, F.lit(".pdf}")))
    rows = read(spark, d, "documents").select("doc_id", F.array_join(commands, "\u0001").alias("tex"), between.alias("between"), F.posexplode(names).alias("place", "panel"))
    panels = rows.select(
        F.col("doc_id").cast("string").alias("directory"), F.lit("f").alias("figure_key"), (F.col("doc_id") % 50 + 1).cast("int").alias("figure_index"), (F.col("place") + 1).alias("image_index"),
        F.concat("panel", F.lit(".png")).alias("image_name"), F.concat("panel", F.lit(".json")).alias("json_name"), F.concat("panel", F.lit(".pdf")).alias("original_path"),
        F.lit(None).cast("string").alias("output_path"), F.replace(F.col("tex"), F.lit("\u0001"), F.col("between")).alias("figure_tex"),
    )
    merged = layout.merge_figures(panels)
    return merged.select(F.col("directory").cast("long").alias("doc_id"), F.col("merge_layout.row_count").alias("row_count"), F.col("merged_panel_count").alias("panels"), F.col("merged_stem").alias("stem"))


@query("SELECT doc_id, lang, 'second' AS written FROM documents WHERE lang <> 'fr'")
def replaced_table(spark, d):
    """A table is replaced by rows that are computed from itself; the backup keeps what it was."""
    path = f"{new_folder(spark, 'replaced')}/table"
    rows = read(spark, d, "documents").select("doc_id", "lang")
    sinks.replace_table(rows.withColumn("written", F.lit("first")), path)
    copy = sinks.backup(spark, path)
    sinks.replace_table(spark.read.parquet(path).where("lang <> 'fr'").withColumn("written", F.lit("second")), path)
    if copy is None or spark.read.parquet(copy).where("written = 'first'").count() != rows.count():
        raise ValueError("the backup is not the table it was made of")
    return spark.read.parquet(path)


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'failed' WHEN doc_id % 3 = 1 THEN 'extraction' ELSE 'good' END AS part FROM documents")
def split_outcomes(spark, d):
    """Successes, failures and failures of a kind, each to a table of its own."""
    folder = new_folder(spark, "outcomes")
    error = F.when(F.col("doc_id") % 3 == 0, "timeout").when(F.col("doc_id") % 3 == 1, "answer_extraction_failed")
    rows = read(spark, d, "documents").select("doc_id", error.alias("error"))
    extraction = F.coalesce(F.col("error").startswith("answer_extraction"), F.lit(False))
    sinks.split_writes(rows, {f"{folder}/good": F.col("error").isNull(), f"{folder}/failed": F.col("error").isNotNull() & ~extraction, f"{folder}/extraction": extraction})
    parts = [spark.read.parquet(f"{folder}/{n}").select("doc_id", F.lit(n).alias("part")) for n in ("good", "failed", "extraction")]
    return parts[0].union(parts[1]).union(parts[2])


@query("SELECT source, count(*) AS n, (SELECT count(*) FROM labels l JOIN documents e USING (doc_id) WHERE e.source = d.source AND l.quality = 0) AS bad FROM documents d GROUP BY source")
def written_report(spark, d):
    """A JSON report and a Markdown one from one aggregate; the JSON one is read back."""
    folder = new_folder(spark, "report")
    bad = read(spark, d, "labels").where("quality = 0").select(F.col("doc_id").alias("of"))
    rows = read(spark, d, "documents").join(bad, F.col("doc_id") == F.col("of"), "left").groupBy("source").agg(F.count("*").alias("n"), F.count("of").alias("bad"))
    found = sinks.report(rows)
    sinks.write_text(spark, f"{folder}/report.json", sinks.as_json(found))
    sinks.write_text(spark, f"{folder}/report.md", sinks.sampling_markdown("Sources", {"all": [{"name": "source", "value": r["source"], "n": r["n"]} for r in found]}, {"all": 0}))
    return tables.read_object(spark, f"{folder}/report.json", "source string, n long, bad long")


@query("SELECT event_id, user_id FROM events")
def compacted_shards(spark, d):
    """Events dealt to shards by a stream, then rewritten as a few files."""
    folder = new_folder(spark, "shards")
    events = read(spark, d, "events").select("event_id", "user_id")
    events.write.parquet(f"{folder}/in")
    stages.dispatch(spark, f"{folder}/in", events.schema, f"{folder}/out", f"{folder}/checkpoint", "event_id", 4).awaitTermination()
    stages.compact(spark, f"{folder}/out", ["event_id"], 2)
    return spark.read.parquet(f"{folder}/out").select("event_id", "user_id")


@query("SELECT n_nationkey AS id, n_nationkey % 4 AS parts FROM nation WHERE n_nationkey % 4 > 0")
def figure_folders(spark, d):
    """Folders of extracted figures below a tree: each paper's, as often as it holds files."""
    folder = new_folder(spark, "tree")
    for (key,) in read(spark, d, "nation").select("n_nationkey").collect():
        for part in range(key % 4):
            write_bytes(spark, f"{folder}/src/{key}/{key}_extracted_figs/f{part}.json", b"{}")
        write_bytes(spark, f"{folder}/src/{key}/notes.txt", b"x")
        write_bytes(spark, f"{folder}/skip/{key}/{key}_extracted_figs/f.json", b"{}")
    listed = files.listing(spark, folder)
    found = layout.figure_directories(listed, "path", ("skip",))
    inside = files.directories(listed, "_extracted_figs$").join(found, "directory").join(listed.where(F.col("path").endswith(".json")), F.col("path").startswith(F.concat("directory", F.lit("/"))))
    return inside.groupBy(F.regexp_extract("directory", r"([0-9]+)_extracted_figs$", 1).cast("int").alias("id")).agg(F.count("*").cast("int").alias("parts"))


@query("""
SELECT n_nationkey AS id, printf('24%02d.%05d', n_nationkey % 12 + 1, n_nationkey) AS paper_id, CASE WHEN n_nationkey % 3 = 0 THEN 'merged' ELSE 'single' END AS image_kind,
  CASE WHEN n_nationkey % 4 = 0 THEN NULL WHEN n_nationkey % 4 = 1 THEN 'success' ELSE 'failed' END AS status, 'caption of ' || n_name AS caption_latex, (n_nationkey % 4 <> 1)::INTEGER AS labels FROM nation WHERE n_nationkey % 5 <> 4
""")
def figure_scan(spark, d):
    """The hierarchical scan of figure records: years pruned by path, fields with fallbacks, broken files apart."""
    folder = new_folder(spark, "figures")
    broken = 0
    for key, name in read(spark, d, "nation").select("n_nationkey", "n_name").collect():
        paper = f"24{key % 12 + 1:02d}.{key:05d}"
        at = f"{folder}/arxiv_{paper[:4]}/arXiv_src_1/{paper}/{paper}_extracted_figs{'_merged' if key % 3 == 0 else ''}"
        record = {"paper_id": paper, "figure_index": key, "caption_latex": f"caption of {name}", "output_image": "x.png"}
        record |= {0: {"status": None, "labels": ["l"]}, 1: {}, 2: {"status": "failed", "labels": "l"}, 3: {"status": "failed", "labels": ["l"]}}[key % 4]
        record |= {"record_type": "merged_figure"} if key % 3 == 0 else {}
        broken += key % 5 == 4
        sinks.write_text(spark, f"{at}/fig_{key}.json", "{" if key % 5 == 4 else sinks.as_json(record))
        sinks.write_text(spark, f"{folder}/arxiv_18{paper[2:4]}/arXiv_src_1/{paper}/{paper}_extracted_figs/old.json", sinks.as_json(record))
    rows, errors = files.figure_records(spark, folder)
    if errors.count() != broken:
        raise ValueError("a broken record was lost")
    return rows.select(F.col("figure_index").alias("id"), "paper_id", "image_kind", "status", "caption_latex", F.size("labels").alias("labels"))


@query("SELECT n_nationkey AS id, sha1(n_name) AS digest, TRUE AS held FROM nation")
def file_digests(spark, d):
    folder = new_folder(spark, "digests")
    for key, name in read(spark, d, "nation").select("n_nationkey", "n_name").collect():
        write_bytes(spark, f"{folder}/{key}.bin", name.encode())
    found = spark.read.format("binaryFile").load(folder)
    held = T.within(F.regexp_replace("path", "^file:", ""), [f"{folder.removeprefix('file://')}/"])
    return found.select(F.regexp_extract("path", r"([0-9]+)\.bin$", 1).cast("int").alias("id"), T.sha1_file(F.col("content")).alias("digest"), held.alias("held"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id % 7 <> 3")
def seen_over_patterns(spark, d):
    """The first row of each id over three patterns of JSON-line files that overlap."""
    folder = new_folder(spark, "patterns")
    rows = read(spark, d, "documents").select("doc_id", "lang")
    for k in range(3):
        sinks.write_lines(rows.where(F.col("doc_id") % 3 >= k).withColumn("lang", F.col("lang") if k == 0 else F.lit("later")), f"{folder}/{k}")
    return tables.first_seen_files(spark, [f"{folder}/{k}" for k in range(3)], rows.schema, "doc_id", F.col("doc_id") % 7 != 3).select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents WHERE doc_id % 10 >= 3 OR doc_id % 10 = 1")
def accept_switch(spark, d):
    """Accepted rows, and with the switch the weakly accepted ones."""
    rows = read(spark, d, "documents").select("doc_id", "lang", (F.col("doc_id") % 10 >= 3).alias("accepted"), (F.col("doc_id") % 10 == 1).alias("weak_accept"))
    strict = filters.accepted(rows).select("doc_id", "lang")
    weak = filters.accepted(rows, include_weak=True).select("doc_id", "lang")
    return strict.union(weak).distinct()
