"""Row-wise operators: filters, scores, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import answers as A
from ..functions import text as T
from ..operators import aggregates, filters
from .tables import listed, quoted, read, spread

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def figures(spark, d):
    """Documents as figure records: the text as caption, its length as width."""
    ext = F.element_at(F.array(*[F.lit(x) for x in (".png", ".JPG", ".gif", ".tiff")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return spread(read(spark, d, "documents")).select(
        "doc_id", F.lit("single").alias("image_kind"), F.when(F.col("lang") == "fr", "failed").otherwise("success").alias("status"),
        F.when(F.col("doc_id") % 50 == 0, "").otherwise(F.concat(F.lit("/img/"), F.col("doc_id").cast("string"), ext)).alias("image_path"),
        F.when(F.col("doc_id") % 7 == 0, F.left("text", F.lit(8))).otherwise(F.col("text")).alias("caption_latex"),
        F.when(F.col("doc_id") % 31 != 0, F.col("n_chars")).cast("int").alias("width"), (F.col("doc_id") * 37 % 900 + 1).cast("int").alias("height"),
    )


_FIGURES = """
figures AS (
  SELECT doc_id, CASE WHEN lang = 'fr' THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN doc_id % 50 = 0 THEN '' ELSE '/img/' || doc_id || (['.png', '.JPG', '.gif', '.tiff'])[doc_id % 4 + 1] END AS image_path,
    CASE WHEN doc_id % 7 = 0 THEN left(text, 8) ELSE text END AS caption, CASE WHEN doc_id % 31 <> 0 THEN n_chars END AS w, doc_id * 37 % 900 + 1 AS h
  FROM documents),
reasons AS (
  SELECT doc_id, CASE WHEN image_path = '' THEN list_filter([CASE WHEN status <> 'success' THEN 'status_not_success' END, 'image_missing'], lambda x: x IS NOT NULL)
    ELSE list_filter([
      CASE WHEN status <> 'success' THEN 'status_not_success' END,
      CASE WHEN NOT regexp_matches(lower(image_path), '\\.(png|jpg|jpeg|webp|bmp|tif|tiff)$') THEN 'unsupported_image_suffix' END,
      CASE WHEN length(trim(caption)) < 10 THEN 'caption_too_short' END,
      CASE WHEN w IS NULL THEN 'image_decode_failed' END,
      CASE WHEN least(w, h) < 256 AND w IS NOT NULL THEN 'short_side_too_small' END,
      CASE WHEN w * h < 80000 THEN 'area_too_small' END,
      CASE WHEN w / h < 0.15 OR w / h > 8.0 THEN 'aspect_ratio_out_of_range' END], lambda x: x IS NOT NULL) END AS reasons
  FROM figures)
"""


@query(f"WITH {_FIGURES} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM reasons) GROUP BY reason")
def hard_filter_reasons(spark, d):
    return aggregates.reason_histogram(filters.hard_filter(figures(spark, d)), "reasons")


@query(f"WITH {_FIGURES} SELECT doc_id FROM reasons WHERE len(reasons) = 0")
def hard_filter_kept(spark, d):
    return filters.hard_filter(figures(spark, d)).where(F.size("reasons") == 0).select("doc_id")


_SCORE = f"""
hits AS (
  SELECT doc_id, list_filter({listed(C.POSITIVE_TERMS)}, lambda k: contains(' ' || lower(text) || ' ', k)) AS p,
    list_filter({listed(C.NEGATIVE_TERMS)}, lambda k: contains(' ' || lower(text) || ' ', k)) AS n FROM documents),
scores AS (SELECT doc_id, (2 * len(p) - 3 * len(n))::INTEGER AS score, p, n FROM hits)
"""


@query(f"WITH {_SCORE} SELECT doc_id, score, array_to_string(p, '|') AS positive, array_to_string(list_transform(n, lambda k: trim(k)), '|') AS negative FROM scores")
def keyword_score(spark, d):
    hit = T.keyword_score(F.col("text"))
    rows = spread(read(spark, d, "documents")).select("doc_id", hit.alias("hit"))
    return rows.select("doc_id", F.col("hit.score").alias("score"), F.array_join("hit.positive", "|").alias("positive"), F.array_join("hit.negative", "|").alias("negative"))


@query("""
SELECT item, n FROM (SELECT 'accepted' AS item, count(*) FILTER (c >= 0.75 AND s AND NOT r) AS n FROM (
  SELECT (n_chars % 100) / 100.0 AS c, n_chars > 500 AS s, lang = 'es' AS r FROM documents)
UNION ALL SELECT 'weak_accept', count(*) FILTER ((n_chars % 100) / 100.0 >= 0.6 AND (n_chars % 100) / 100.0 < 0.75 AND n_chars > 500) FROM documents
UNION ALL SELECT 'all', count(*) FROM documents)
""")
def accept_rules(spark, d):
    sure, suits, reject = (F.col("n_chars") % 100) / 100, F.col("n_chars") > 500, F.col("lang") == "es"
    counts = read(spark, d, "documents").agg(
        F.count_if(filters.accept(suits, sure, suits, suits, [reject])).alias("accepted"), F.count_if(filters.weak_accept(suits, sure)).alias("weak_accept"), F.count("*").alias("all")
    )
    return counts.select(F.expr("stack(3, 'accepted', accepted, 'weak_accept', weak_accept, 'all', `all`) AS (item, n)"))


@query(f"""
WITH t AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN []::VARCHAR[] ELSE [event_type, ({listed(C.CHART_TYPES)})[event_id % 19 + 1]] END AS types,
  CASE WHEN event_id % 3 = 0 THEN 'bar_chart' ELSE event_type END AS prim, event_id % 2 = 0 AS real FROM events),
k AS (SELECT event_id, prim, CASE WHEN len(list_filter(types, lambda x: list_contains({listed(C.CHART_TYPES)}, x))) = 0 AND real THEN ['other_chart']
  ELSE list_filter(types, lambda x: list_contains({listed(C.CHART_TYPES)}, x)) END AS kept FROM t)
SELECT event_id, array_to_string(kept, '|') AS chart_types, CASE WHEN list_contains({listed(C.CHART_TYPES)}, prim) THEN prim ELSE coalesce(kept[1], 'other_chart') END AS prim FROM k
""")
def enum_repair(spark, d):
    own = F.element_at(F.array(*[F.lit(t) for t in C.CHART_TYPES]), (F.col("event_id") % 19 + 1).cast("int"))
    types = F.when(F.col("event_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array("event_type", own))
    primary = F.when(F.col("event_id") % 3 == 0, "bar_chart").otherwise(F.col("event_type"))
    fixed = filters.clean_types(types, primary, F.col("event_id") % 2 == 0)
    rows = read(spark, d, "events").select("event_id", fixed.alias("fixed"))
    return rows.select("event_id", F.array_join("fixed.chart_types", "|").alias("chart_types"), F.col("fixed.primary").alias("prim"))


_PHRASES = (
    "What is the title of the figure?", "Compare the title of the chart across panels", "Which panel is labeled (a)?", "What is shown in the plot",
    "What does the legend represent?", "In the top-left panel (b), which curve is highest?", "", "   ",
)


def _questions(rows):
    return rows.withColumn("question", F.element_at(F.array(*[F.lit(p) for p in _PHRASES]), (F.col("event_id") % len(_PHRASES) + 1).cast("int")))


_LOW = " OR ".join(f"regexp_matches(q, {quoted('(?i)' + p)})" for p in C.LOW_VALUE)


@query(f"""
WITH t AS (SELECT event_id, trim(({listed(_PHRASES)})[event_id % {len(_PHRASES)} + 1]) AS q FROM events)
SELECT event_id, q = '' OR (({_LOW}) AND NOT regexp_matches(q, {quoted("(?i)" + C.REASONING)})) AS low FROM t
""")
def low_value_text(spark, d):
    return _questions(read(spark, d, "events")).select("event_id", T.is_low_value(F.col("question")).alias("low"))


@query(f"""
WITH t AS (SELECT event_id, ({listed(_PHRASES)})[event_id % {len(_PHRASES)} + 1] AS q, event_type = 'view' AS multi, (event_id % 3)::INTEGER AS c FROM events)
SELECT event_id, regexp_matches(q, {quoted("(?i)" + C.PANELS)}) AND (NOT multi OR coalesce(nullif(c, 0), CASE WHEN multi THEN 2 ELSE 1 END) <= 1) AS conflict FROM t
""")
def layout_conflict(spark, d):
    rows = _questions(read(spark, d, "events"))
    return rows.select("event_id", T.conflicts_with_layout(F.col("question"), F.col("event_type") == "view", (F.col("event_id") % 3).cast("int")).alias("conflict"))


_TASKS = ", ".join(f"({quoted(t)}, {listed(types)})" for t, (_, types) in C.TASKS.items())


@query(f"""
WITH allowed(task, types) AS (VALUES {_TASKS}),
t AS (SELECT event_id, trim(({listed(_PHRASES)})[event_id % {len(_PHRASES)} + 1]) AS q, ({listed(C.TASKS)})[event_id % 8 + 1] AS task,
  ({listed(C.ANSWER_TYPES)})[event_id % 7 + 1] AS answer, CASE WHEN event_id % 3 = 0 THEN 'hard' ELSE event_type END AS diff, (event_id % 4)::INTEGER - 1 AS steps FROM events)
SELECT event_id, task AS task_type, CASE WHEN q = '' THEN 'empty question' WHEN ({_LOW}) AND NOT regexp_matches(q, {quoted("(?i)" + C.REASONING)}) THEN 'low_value_question' END AS reject,
  CASE WHEN list_contains(types, answer) THEN answer ELSE types[1] END AS answer_type, CASE WHEN diff IN ('medium', 'hard') THEN diff ELSE 'medium' END AS difficulty, greatest(1, steps) AS steps
FROM t JOIN allowed USING (task)
""")
def question_validation(spark, d):
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("event_id") % n + 1).cast("int"))
    none = F.array().cast("array<string>")
    rows = _questions(read(spark, d, "events")).withColumns({
        "requested_task": pick(C.TASKS, 8), "answer_type": pick(C.ANSWER_TYPES, 7), "difficulty": F.when(F.col("event_id") % 3 == 0, "hard").otherwise(F.col("event_type")),
        "steps": (F.col("event_id") % 4).cast("int") - 1, "visual_elements": none, "risk_notes": none,
    })
    return filters.validate_questions(rows).select("event_id", "task_type", "reject", "answer_type", "difficulty", "steps")


@query("""
SELECT conv_id, turn, (lower(v) = 'consistent' AND ok AND trim(text) <> '') AS answer_passes, (lower(v) = 'consistent' AND FALSE) AS thinking_passes,
  (trim(c) = '' OR contains(c, 'Automatic dense caption generation failed')) AS caption_failed
FROM (SELECT *, CASE WHEN turn % 2 = 0 THEN 'Consistent' ELSE 'inconsistent' END AS v, role = 'user' AS ok,
  CASE WHEN turn = 1 THEN 'Automatic dense caption generation failed for it' WHEN turn = 3 THEN ' ' ELSE text END AS c FROM conversations)
""")
def judge_predicates(spark, d):
    verdict = F.when(F.col("turn") % 2 == 0, "Consistent").otherwise("inconsistent")
    caption = F.when(F.col("turn") == 1, "Automatic dense caption generation failed for it").when(F.col("turn") == 3, " ").otherwise(F.col("text"))
    ok, no = F.col("role") == "user", F.lit(False)
    return read(spark, d, "conversations").select(
        "conv_id", "turn", filters.answers_pass(verdict, ok, F.col("text")).alias("answer_passes"), filters.thinking_passes(verdict, ok, ok, no, ok).alias("thinking_passes"),
        filters.caption_failed(caption).alias("caption_failed"),
    )


@query("""
SELECT doc_id, 'doc' || CASE WHEN safe <> '' THEN '_' || safe ELSE '' END || '_' || left(sha1(text), 16) AS id
FROM (SELECT doc_id, text, trim(left(regexp_replace(text, '[^A-Za-z0-9_.-]+', '_', 'g'), 80), '_') AS safe FROM documents)
""")
def stable_ids(spark, d):
    return spread(read(spark, d, "documents")).select("doc_id", T.stable_id("doc", F.col("text")).alias("id"))


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, CASE WHEN l_returnflag = 'R' THEN printf('%d_fig%04d_merged', l_orderkey, l_linenumber)
  ELSE printf('%d_fig%04d_img%02d', l_orderkey, l_linenumber, CASE WHEN l_quantity::INTEGER = 0 THEN 1 ELSE l_quantity::INTEGER END) END AS id FROM lineitem
""")
def candidate_ids(spark, d):
    key = T.candidate_id(F.col("l_orderkey").cast("string"), F.col("l_linenumber"), F.col("l_returnflag") == "R", F.col("l_quantity").cast("int"))
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", key.alias("id"))


_PRICED = "printf('%s costs %.2f, or 1,234.5%% of %d; -3e2 and +7', lang, n_chars / 100.0, doc_id)"


@query(f"""
WITH t AS (SELECT doc_id, regexp_extract_all({_PRICED} || ' ' || text, {quoted(C.NUMBER)}) AS m FROM documents),
v AS (SELECT doc_id, list_filter(list_transform(m, lambda x: CASE WHEN x LIKE '%\\%' ESCAPE '\\' THEN try_cast(regexp_replace(x, '[,%\\s]', '', 'g') AS DOUBLE) / 100
  ELSE try_cast(regexp_replace(x, '[,%\\s]', '', 'g') AS DOUBLE) END), lambda x: x IS NOT NULL) AS v FROM t)
SELECT doc_id, len(v)::INTEGER AS n, round(v[1], 6) AS first_number, round(v[2], 6) AS second_number, round(v[4], 6) AS fourth_number FROM v
""")
def parse_numbers(spark, d):
    text = F.concat(F.format_string("%s costs %.2f, or 1,234.5%% of %d; -3e2 and +7", F.col("lang"), F.col("n_chars") / 100, F.col("doc_id")), F.lit(" "), F.col("text"))
    rows = spread(read(spark, d, "documents")).select("doc_id", T.parse_numbers(text).alias("v"))
    at = lambda k: F.round(F.get("v", F.lit(k)), 6)
    return rows.select("doc_id", F.size("v").alias("n"), at(0).alias("first_number"), at(1).alias("second_number"), at(3).alias("fourth_number"))


_WORDS_MARKED = "regexp_replace(regexp_replace(lower(trim(nfc_normalize(text))), '<[^>]+>', ' ', 'g'), '([\\p{L}\\p{N}_]+)', chr(1) || '\\1' || chr(2), 'g')"
_NO_ARTICLES = f"replace(replace(replace({_WORDS_MARKED}, chr(1) || 'the' || chr(2), ' '), chr(1) || 'an' || chr(2), ' '), chr(1) || 'a' || chr(2), ' ')"


@query(f"""
SELECT doc_id, trim(regexp_replace(translate({_NO_ARTICLES}, chr(1) || chr(2) || {quoted(C.ASCII_MARKS + C.CJK_MARKS)}, ''), '\\s+', ' ', 'g')) AS answer FROM documents
""")
def normalize_answers(spark, d):
    """Every document's text as an answer. The SQL has canonical composition only; the tables hold no compatibility characters."""
    rows = spread(read(spark, d, "documents"))
    return rows.select("doc_id", A.normalize_answer(F.col("text"), F.lit("short_phrase")).alias("answer"))


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CASE WHEN value % 2 < 1 THEN 'yes' ELSE 'no' END
  WHEN event_id % 3 = 1 THEN round_even(value, 0)::BIGINT::VARCHAR ELSE replace(event_type, '_', '') END AS answer FROM events
""")
def typed_answers(spark, d):
    id_, value = F.col("event_id"), F.col("value")
    said = F.when(id_ % 3 == 0, F.when(value % 2 < 1, "Yes.").otherwise("FALSE")).when(id_ % 3 == 1, F.concat(F.lit("about "), value.cast("string"))).otherwise(F.concat(F.lit("the "), "event_type"))
    kind = F.when(id_ % 3 == 0, "boolean").when(id_ % 3 == 1, "integer").otherwise("short_phrase")
    return read(spark, d, "events").select("event_id", A.normalize_answer(said, kind).alias("answer"))


@query("""
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'value ' || conv_id ELSE trim(list_last(string_split(trim(text, chr(10) || ' '), chr(10))), '`"''“”‘’') END AS answer,
  CASE WHEN turn % 2 = 0 THEN 'value ' || conv_id || chr(10) || 'more' ELSE trim(list_last(string_split(trim(text, chr(10) || ' '), chr(10)))) END AS to_end FROM conversations
""")
def final_answer_extract(spark, d):
    marked = F.concat("text", F.lit("\nFINAL Answer : `value "), F.col("conv_id").cast("string"), F.lit("`\nmore"))
    plain = F.concat("text", F.lit("\nfinal answer: value "), F.col("conv_id").cast("string"), F.lit("\nmore"))
    even = F.col("turn") % 2 == 0
    shown = T.final_answer(F.when(even, marked).otherwise(F.col("text")))
    to_end = T.final_answer_to_end(F.when(even, plain).otherwise(F.col("text")))
    return read(spark, d, "conversations").select("conv_id", "turn", shown.alias("answer"), to_end.alias("to_end"))


@query("""
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'b' || conv_id ELSE trim(list_last(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)),
  lambda x: x <> '' AND NOT starts_with(x, '**') AND NOT starts_with(x, '#'))), '"') END AS answer FROM conversations
""")
def short_answer_extract(spark, d):
    text = F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit("\nFinal answer: a\nfinal Answer: b"), F.col("conv_id").cast("string"))).otherwise(F.concat("text", F.lit("\n# end\n**note**\n")))
    return read(spark, d, "conversations").select("conv_id", "turn", T.short_answer(text).alias("answer"))


@query("""SELECT event_id, 'json' AS format, '{"k":' || json_extract_string(props, '$.k') || '}' AS fixed FROM events""")
def lenient_json(spark, d):
    k = F.col("event_id") % 5
    said = (
        F.when(k == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```")))
        .when(k == 1, F.concat(F.lit("<think>{not json}</think> Here: "), "props"))
        .when(k == 2, F.replace("props", F.lit('"'), F.lit("'")))
        .when(k == 3, F.concat(F.lit("so "), "props", F.lit(" is it")))
        .otherwise(F.col("props"))
    )
    return spread(read(spark, d, "events")).select("event_id", F.lit("json").alias("format"), A.lenient_json(said).alias("fixed"))


@query("SELECT doc_id, (('0x' || left(sha1(doc_id::VARCHAR), 12))::BIGINT % 8)::INTEGER AS shard FROM documents")
def shard_assignment(spark, d):
    return read(spark, d, "documents").select("doc_id", T.shard_of(F.col("doc_id"), 8).alias("shard"))


@query("""
SELECT p_partkey, CASE WHEN contains(t, 'line') OR contains(t, 'curve') THEN 'line_chart' WHEN contains(t, 'bar') THEN 'bar_chart' WHEN contains(t, 'scatter') THEN 'scatter_plot'
  WHEN contains(t, 'heatmap') OR contains(t, 'confusion') OR contains(t, 'matrix') THEN 'heatmap_confusion_matrix'
  WHEN contains(t, 'histogram') OR contains(t, 'density') OR contains(t, 'distribution') THEN 'histogram_density_distribution'
  WHEN contains(t, 'box') OR contains(t, 'violin') OR contains(t, 'area') THEN 'box_violin_area' WHEN p_size > 25 THEN 'multi_panel_chart' ELSE 'other' END AS bucket
FROM (SELECT p_partkey, p_size, lower(p_type || ' ' || CASE WHEN p_partkey % 20 = 0 THEN '' ELSE (%s)[p_partkey %% 19 + 1] END) AS t FROM part)
""".replace("% 20 =", "%% 20 =") % listed(C.CHART_TYPES))
def bucket_rules(spark, d):
    kind = F.when(F.col("p_partkey") % 20 == 0, "").otherwise(F.element_at(F.array(*[F.lit(t) for t in C.CHART_TYPES]), (F.col("p_partkey") % 19 + 1).cast("int")))
    return read(spark, d, "part").select("p_partkey", T.chart_bucket(F.array("p_type", kind), F.col("p_size") > 25).alias("bucket"))


@query("""
SELECT event_id, ((CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 2 ELSE 1 END) + coalesce(nullif((event_id % 4)::INTEGER, 0), 1))::INTEGER AS difficulty FROM events
""")
def difficulty_scores(spark, d):
    level = F.when(F.col("event_type") == "click", "Hard").when(F.col("event_type") == "view", "medium")
    return read(spark, d, "events").select("event_id", T.difficulty_score(F.coalesce(level, F.lit("")), (F.col("event_id") % 4).cast("int")).alias("difficulty"))


@query("SELECT page_id AS file, min(n) AS line FROM (SELECT page_id, unnest(range(len(l))) AS n, unnest(l) AS t FROM (SELECT page_id, string_split(html || CASE WHEN page_id % 10 = 0 THEN chr(10) || 'data:image/png;base64,AA' ELSE '' END, chr(10)) AS l FROM pages)) WHERE regexp_matches(t, 'base64|data:image/') GROUP BY 1")
def image_byte_guard(spark, d):
    html = F.concat("html", F.when(F.col("page_id") % 10 == 0, "\ndata:image/png;base64,AA").otherwise(""))
    lines = read(spark, d, "pages").select(F.col("page_id").alias("file"), F.posexplode(F.split(html, "\n")).alias("line", "text"))
    return filters.image_bytes_lines(lines.withColumn("line", F.col("line").cast("long")), "file", "line", "text")


@query("""
SELECT doc_id, 'arxiv_' || m AS bucket, m AS month, (2000 + left(m, 2)::INTEGER)::INTEGER AS year, 'fig_' || doc_id AS stem, doc_id::VARCHAR AS figure_key
FROM (SELECT doc_id, printf('%02d%02d', 20 + doc_id % 6, 1 + doc_id % 12) AS m FROM documents)
""")
def path_fields(spark, d):
    month = F.format_string("%02d%02d", 20 + F.col("doc_id") % 6, 1 + F.col("doc_id") % 12)
    path = F.concat(F.lit("/data/arxiv_"), month, F.lit("/arXiv_src_1/x.json"))
    found = T.year_month_from_path(path)
    stem = T.graphics_stem(F.concat(F.lit(".\\./Fig_"), F.col("doc_id").cast("string"), F.lit(".PDF")))
    key = T.figure_key(F.concat(F.lit("fig_000"), F.col("doc_id").cast("string"), F.lit("_img_01_x.json")))
    return read(spark, d, "documents").select("doc_id", found["bucket"].alias("bucket"), found["month"].alias("month"), found["year"].alias("year"), stem.alias("stem"), key.alias("figure_key"))


@query("SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM pages")
def html_escape(spark, d):
    return read(spark, d, "pages").select("page_id", T.html_escape(F.col("html")).alias("escaped"))


_DIGITS = " + ".join(f"bit_count(xor(('0x' || substr(lpad(md5(text), 40, '0'), {k}, {n}))::BIGINT, ('0x' || substr(sha1(text), {k}, {n}))::BIGINT))" for k, n in ((1, 15), (16, 15), (31, 10)))


@query(f"SELECT doc_id, ({_DIGITS})::INTEGER AS bits FROM documents")
def hash_distance(spark, d):
    """All digits of both digests, the shorter one filled with zeros."""
    raw = F.col("text").cast("binary")
    return read(spark, d, "documents").select("doc_id", T.hamming_hex(F.md5(raw), F.sha1(raw)).alias("bits"))


@query("""
SELECT doc_id, regexp_matches(id, '^(20|21|22|23|24|25)[0-9]{2}\\.[0-9]+') AND y BETWEEN 2020 AND 2025 AS wanted, n_chars > 3000 OR lang = 'fr' OR contains(source, '_merged_') AS merged
FROM (SELECT *, printf('%d%02d.%d', 18 + doc_id % 10, doc_id % 12, doc_id) AS id, 2018 + doc_id % 10 AS y FROM documents)
""")
def paper_filter(spark, d):
    n = F.col("doc_id")
    paper = F.format_string("%d%02d.%d", 18 + n % 10, n % 12, n)
    merged = filters.is_merged(F.col("n_chars") > 3000, F.when(F.col("lang") == "fr", "merged_figure"), F.col("source"))
    return read(spark, d, "documents").select("doc_id", T.is_wanted_paper(paper, 2018 + n % 10).alias("wanted"), merged.alias("merged"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'success' WHEN event_id % 3 = 1 THEN NULL ELSE event_type END AS status FROM events")
def status_default(spark, d):
    absent, null, given = F.lit("{}"), F.lit('{"status": null}'), F.to_json(F.struct(F.col("event_type").alias("status")))
    k = F.col("event_id") % 3
    rows = read(spark, d, "events").select("event_id", F.try_parse_json(F.when(k == 0, absent).when(k == 1, null).otherwise(given)).alias("record"))
    return rows.select("event_id", filters.with_status(rows, "record").alias("status"))


@query("SELECT doc_id, 'Classify ' || doc_id || ' in ' || lang || '.' || chr(10) || chr(10) || left(text, 5000) AS prompt, lang || ' ' || source AS joined, CASE WHEN doc_id % 2 = 0 THEN doc_id::INTEGER ELSE 0 END AS whole FROM documents")
def prompt_templates(spark, d):
    asked = T.prompt("Classify {id} in {lang}.", F.col("text"), id=F.col("doc_id"), lang=F.col("lang"))
    whole = T.safe_int(F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).otherwise("x"))
    return read(spark, d, "documents").select("doc_id", asked.alias("prompt"), T.clean_text(F.array("lang", "source"), array=True).alias("joined"), whole.alias("whole"))


@query("SELECT page_id, page_id % 4 IN (0, 1) AS inside FROM pages")
def path_guard(spark, d):
    tail = F.element_at(F.array(F.lit("/data/figs/a.png"), F.lit("/data/./figs//b/c.png"), F.lit("/data/figs/../x"), F.lit("/data/figs2/a")), (F.col("page_id") % 4 + 1).cast("int"))
    return read(spark, d, "pages").select("page_id", T.within(tail, ["/data/figs/"]).alias("inside"))
