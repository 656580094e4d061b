"""Deduplication, joins, aggregation and samples over whole tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import aggregates, dedup, filters, joins, sampling
from .tables import listed, quoted, read, spread

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query("""
WITH r AS (SELECT doc_id, source, lang, n_chars, sha1(text) AS h, row_number() OVER (PARTITION BY source, lang, n_chars ORDER BY n_chars % 100 / 100.0 DESC, doc_id) AS k FROM documents),
s AS (SELECT *, row_number() OVER w AS m, first_value(doc_id) OVER w AS lead FROM r WHERE k = 1 WINDOW w AS (PARTITION BY h ORDER BY n_chars % 100 / 100.0 DESC, doc_id))
SELECT doc_id, 'key_duplicate' AS duplicate_reason, NULL::BIGINT AS duplicate_of FROM r WHERE k > 1
UNION ALL SELECT doc_id, CASE WHEN m > 1 THEN 'hash_duplicate' END, CASE WHEN m > 1 THEN lead END FROM s
""")
def dedup_two_level(spark, d):
    rows = read(spark, d, "documents").select("doc_id", "source", "lang", "n_chars", F.sha1(F.col("text").cast("binary")).alias("hash"), ((F.col("n_chars") % 100) / 100).alias("confidence"))
    return dedup.two_level(rows, ["source", "lang", "n_chars"], "hash", "confidence", "doc_id").select("doc_id", "duplicate_reason", "duplicate_of")


@query("SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations WHERE role = 'assistant' GROUP BY conv_id")
def last_wins_lookup(spark, d):
    rows = read(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", "text")
    return dedup.last_wins(rows, ["conv_id"], ["turn"])


_PRIORITY = "CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END"


@query(f"SELECT h AS hash, arg_min(doc_id, p * 1000000000000 + doc_id) AS doc_id, arg_min(lang, p * 1000000000000 + doc_id) AS lang FROM (SELECT sha1(text) AS h, doc_id, lang, {_PRIORITY} AS p FROM documents) GROUP BY h")
def first_seen_union(spark, d):
    rows = read(spark, d, "documents").select(F.sha1(F.col("text").cast("binary")).alias("hash"), "doc_id", "lang")
    parts = [rows.where(F.col("lang") == lang).withColumn("priority", F.lit(k)) for k, lang in enumerate(("en", "fr", "de"))]
    union = rows.where(~F.col("lang").isin("en", "fr", "de")).withColumn("priority", F.lit(3))
    for part in parts:
        union = union.unionByName(part)
    return dedup.first_seen(union, "hash", ["priority", "doc_id"]).drop("priority")


@query(f"""
WITH t AS (SELECT doc_id, source, list_sort(list_filter(list_distinct(regexp_split_to_array(regexp_replace(lower(text), '[^a-z0-9\\s]', ' ', 'g'), '\\s+')),
  lambda w: length(w) > 2 AND NOT list_contains({listed(C.QUESTION_STOP_WORDS)}, w))) AS words FROM documents),
c AS (SELECT source, words, min(doc_id) AS rep FROM t WHERE len(words) > 0 GROUP BY ALL)
SELECT source, rep AS "left", doc_id AS "right", 1.0::DOUBLE AS overlap FROM t JOIN c USING (source, words) WHERE doc_id > rep
UNION ALL SELECT * FROM (SELECT a.source, a.rep, b.rep, len(list_intersect(a.words, b.words)) / len(list_distinct(list_concat(a.words, b.words))) AS o
  FROM c a JOIN c b ON a.source = b.source AND a.rep < b.rep) WHERE o >= {C.SIMILAR}
""")
def near_duplicate_pairs(spark, d):
    return dedup.similar_pairs(spread(read(spark, d, "documents")), "source", "doc_id", F.col("text"))


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS m, year(o_orderdate) AS y, o_totalprice AS p FROM orders),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, m, y ORDER BY p DESC, o_orderkey) AS k FROM o) WHERE k <= 2),
b AS (SELECT * EXCLUDE (k) FROM (SELECT * EXCLUDE (k), row_number() OVER (PARTITION BY m, y ORDER BY p DESC, o_orderkey) AS k FROM a) WHERE k <= 13),
c AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY p DESC, o_orderkey) AS k FROM b)
SELECT o_orderkey, m AS month, y::INTEGER AS year FROM c WHERE k <= 100
""")
def nested_cap_sampling(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.year("o_orderdate").alias("year"), "o_totalprice")
    order = [F.desc("o_totalprice"), F.col("o_orderkey")]
    return sampling.nested_caps(rows, [(["o_custkey", "month", "year"], 2), (["month", "year"], 13), (["year"], 100)], order).select("o_orderkey", "month", "year")


_PILOT = 600


@query(f"""
WITH o AS (SELECT o_orderkey AS id, o_custkey AS paper, strftime(o_orderdate, '%Y-%m') AS m, (2020 + o_orderkey % 7) AS y, (o_orderkey % 4)::INTEGER AS s FROM orders),
g AS (SELECT * FROM o WHERE s >= 2 AND y <= 2025),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper, m, y ORDER BY id) AS k FROM g) WHERE k <= 2),
b AS (SELECT * EXCLUDE (k) FROM (SELECT * EXCLUDE (k), row_number() OVER (PARTITION BY m, y ORDER BY id) AS k FROM a) WHERE k <= greatest(1, {_PILOT // 6} // 12 + 10)),
c AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY y ORDER BY id) AS k FROM b) WHERE k <= {_PILOT // 6} ORDER BY id LIMIT {_PILOT}),
l AS (SELECT id FROM o WHERE s >= 1 AND id NOT IN (SELECT id FROM c))
SELECT id AS candidate_id, phase FROM (SELECT id, 1 AS phase FROM c UNION ALL SELECT id, 2 FROM l) ORDER BY phase, id LIMIT {_PILOT}
""")
def pilot_selection(spark, d):
    rows = read(spark, d, "orders").select(
        F.col("o_orderkey").alias("candidate_id"), F.col("o_custkey").alias("paper_id"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        (2020 + F.col("o_orderkey") % 7).cast("int").alias("year"), (F.col("o_orderkey") % 4).cast("int").alias("score"),
    )
    return sampling.pilot_selection(rows, _PILOT, "candidate_id").select("candidate_id", "phase")


def _rounds(pool: str, rounds: list[tuple[str, str, list[tuple[str, str]], str]]) -> str:
    """SQL of a sample taken in rounds: (condition, order, caps as (key, most), rows in all after the round)."""
    parts = [f"pool AS ({pool})", "t0 AS (SELECT *, 0 AS phase, 0 AS sample_index FROM pool WHERE false)"]
    for k, (where, order, caps, until) in enumerate(rounds, 1):
        rows = f"SELECT * FROM pool WHERE ({where}) AND id NOT IN (SELECT id FROM t{k - 1})"
        for key, most in caps:
            used = f"SELECT {key} AS used_key, count(*) AS used FROM t{k - 1} GROUP BY 1"
            rows = f"SELECT * EXCLUDE (used_key, used, r) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) + coalesce(used, 0) AS r FROM ({rows}) LEFT JOIN ({used}) ON {key} = used_key) WHERE r <= {most}"
        chosen = f"SELECT *, {k} AS phase, row_number() OVER (ORDER BY {order}) - 1 + (SELECT count(*) FROM t{k - 1}) AS sample_index FROM ({rows})"
        parts.append(f"t{k} AS MATERIALIZED (SELECT * FROM t{k - 1} UNION ALL SELECT * FROM ({chosen}) WHERE sample_index < {until.replace('TAKEN', f't{k - 1}')})")
    return f"WITH {', '.join(parts)} SELECT * FROM t{len(rounds)}"


_SAMPLE = 120
_QUOTAS = sampling.year_quotas(_SAMPLE)
_POOL = """SELECT doc_id AS id, concat_ws('-', source, lang, doc_id % 7) AS paper, printf('20%02d-%02d', doc_id % 6, doc_id % 7) AS month, (2020 + doc_id % 6)::INTEGER AS year, lang AS bucket,
  (n_chars % 100) / 100.0 AS sure, coalesce(quality, 1) = 0 AS is_eval FROM documents LEFT JOIN labels USING (doc_id)"""
_MONTH_CAP = "CASE year " + " ".join(f"WHEN {y} THEN {math.ceil(q / 12 * 1.3)}" for y, q in _QUOTAS.items()) + " END"
_CAPS = [("paper", "2"), ("month", _MONTH_CAP)]


def _by_year() -> list[tuple[str, str, list[tuple[str, str]], str]]:
    first = [("is_eval", "-sure, id", _CAPS, str(_SAMPLE))]
    for k, (year, quota) in enumerate(_QUOTAS.items(), 1):
        held = f"coalesce(map_extract((SELECT map_from_entries(list((bucket, n))) FROM (SELECT bucket, count(*) AS n FROM t{k} GROUP BY bucket)), bucket)[1], 0)"
        first.append((f"year = {year}", f"{held}, -sure, id", _CAPS, f"least({_SAMPLE}, (SELECT count(*) + greatest(0, {quota} - count(*) FILTER (year = {year})) FROM TAKEN))"))
    return [*first, ("true", "-sure, id", _CAPS, str(_SAMPLE)), ("true", "-sure, id", _CAPS[:1], str(_SAMPLE))]


@query(f"SELECT id AS candidate_id, phase, sample_index FROM ({_rounds(_POOL, _by_year())})")
def group_sampling(spark, d):
    labels = read(spark, d, "labels").select(F.col("doc_id").alias("of"), "quality")
    pool = read(spark, d, "documents").join(labels, F.col("doc_id") == F.col("of"), "left").select(
        F.col("doc_id").alias("candidate_id"), F.concat_ws("-", "source", "lang", F.col("doc_id") % 7).alias("paper_id"),
        F.concat(F.lit("20"), F.format_string("%02d", F.col("doc_id") % 6), F.lit("-"), F.format_string("%02d", F.col("doc_id") % 7)).alias("month"),
        (2020 + F.col("doc_id") % 6).cast("int").alias("year"), F.col("lang").alias("bucket"), ((F.col("n_chars") % 100) / 100).alias("confidence"),
        (F.coalesce("quality", F.lit(1)) == 0).alias("is_eval"),
    )
    return sampling.group_sample(pool, _SAMPLE).select("candidate_id", "phase", "sample_index")


@query()
def task_quota_sampling(spark, d):
    rows = read(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("role").alias("task_type"), F.col("conv_id").alias("image_id"), (F.length("text") % 6).alias("difficulty_score"), F.col("text").alias("question")
    )
    return sampling.task_sample(rows, 200, {"user": 3, "assistant": 2, "system": 1}, text="question").select("id", "task_type", "phase", "sample_index")


_WEIGHTS = {"user": 3, "assistant": 2, "system": 1}
_TURN_POOL = "SELECT concat_ws('-', conv_id, turn) AS id, role AS task, conv_id AS image, (length(text) % 6)::INTEGER AS hard FROM conversations"
_TURN_ORDER = "-hard, md5('20260611:' || id), id"


@query(f"""
SELECT id, task AS task_type, phase, sample_index FROM ({_rounds(_TURN_POOL, [
    *[(f"task = '{t}'", _TURN_ORDER, [("image", "3")], f"(SELECT count(*) + {q} FROM TAKEN)") for t, q in sampling.apportion(40, _WEIGHTS).items()],
    ("true", _TURN_ORDER, [("image", "3")], "40")])})
""")
def task_quotas(spark, d):
    """Quotas a task and a cap an image, hard questions first, without the test of similarity."""
    rows = read(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("role").alias("task_type"), F.col("conv_id").alias("image_id"), (F.length("text") % 6).alias("difficulty_score"))
    return sampling.task_sample(rows, 40, _WEIGHTS).select("id", "task_type", "phase", "sample_index")


@query("SELECT doc_id, (row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) - 1)::BIGINT AS shuffled FROM documents")
def seeded_shuffle(spark, d):
    return sampling.number_rows(read(spark, d, "documents").select("doc_id"), [sampling.seeded_order(7, "doc_id"), F.col("doc_id")], "shuffled")


@query(f"""
SELECT doc_id, ({listed([t for t, n in C.CYCLE for _ in range(n)])})[(row_number() OVER (ORDER BY doc_id) - 1) % {sum(n for _, n in C.CYCLE)} + 1] AS task_type FROM documents
""")
def cyclic_tasks(spark, d):
    return sampling.cyclic_tasks(read(spark, d, "documents").select("doc_id"), [F.col("doc_id")]).select("doc_id", "task_type")


_BARE = "regexp_replace({}, '\\s+', '', 'g')"


@query(f"SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains({_BARE.format('d.text')}, {_BARE.format('b.text')}) AND {_BARE.format('b.text')} <> ''")
def reference_containment(spark, d):
    passages = read(spark, d, "benchmark").select("item_id", F.col("text").alias("passage"))
    return joins.containing(spread(read(spark, d, "documents")).select("doc_id", "text"), passages, "text", "passage").select("doc_id", "item_id")


@query(f"SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE contains({_BARE.format('d.text')}, {_BARE.format('b.text')}))")
def eval_exclusion(spark, d):
    docs = read(spark, d, "documents")
    return joins.exclude(docs.select("doc_id"), reference_containment(spark, d).select("doc_id"), "doc_id")


@query("SELECT doc_id, l.doc_id IS NOT NULL AS labelled FROM documents LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)".replace("SELECT doc_id, l", "SELECT documents.doc_id, l"))
def eval_marks(spark, d):
    return joins.mark(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels"), "doc_id", "labelled")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark, d):
    labels = read(spark, d, "labels").select("doc_id", F.lit("v2").alias("schema"))
    finished = filters.done(labels.limit(0), labels, ["doc_id"], False, ("schema", "v2"))
    return joins.exclude(read(spark, d, "documents").select("doc_id"), finished, "doc_id")


def _turns(spark, d):
    rows = read(spark, d, "conversations")
    asked = rows.where("role = 'user'").select(F.concat_ws("-", "conv_id", "turn").alias("candidate_id"), F.col("text").alias("question"))
    said = rows.where("role = 'assistant'").select(F.concat_ws("-", "conv_id", F.col("turn") - 1).alias("candidate_id"), F.col("text").alias("caption"), "turn")
    return asked, said


_TURNS = "q AS (SELECT conv_id || '-' || turn AS candidate_id, text AS question FROM conversations WHERE role = 'user'), a AS (SELECT conv_id || '-' || (turn - 1) AS candidate_id, text AS caption FROM conversations WHERE role = 'assistant')"


@query(f"WITH {_TURNS} SELECT candidate_id, question, caption FROM q LEFT JOIN a USING (candidate_id)")
def left_merge(spark, d):
    asked, said = _turns(spark, d)
    return joins.lookup(asked, said, "candidate_id", ["turn"]).drop("turn")


@query(f"WITH {_TURNS} SELECT candidate_id, question, caption FROM q JOIN a USING (candidate_id)")
def require_caption_join(spark, d):
    asked, said = _turns(spark, d)
    return joins.lookup(asked, said, "candidate_id", ["turn"], required=True).drop("turn")


@query("""
WITH s AS (SELECT lang, count(*) AS lang_docs FROM documents GROUP BY lang), p AS (SELECT source, max(n_chars) AS longest FROM documents GROUP BY source)
SELECT d.doc_id, coalesce(l.quality, -1) AS quality, s.lang_docs, p.longest FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN s USING (lang) LEFT JOIN p USING (source)
""")
def four_way_merge(spark, d):
    docs = read(spark, d, "documents")
    rows = joins.lookup(docs.select("doc_id", "lang", "source"), read(spark, d, "labels").select("doc_id", "quality", "toxic"), "doc_id", ["toxic"])
    rows = rows.join(docs.groupBy("lang").agg(F.count("*").alias("lang_docs")), "lang", "left").join(docs.groupBy("source").agg(F.max("n_chars").alias("longest")), "source", "left")
    return rows.select("doc_id", joins.prefer(F.col("quality"), F.lit(-1)).alias("quality"), "lang_docs", "longest")


@query("""
WITH l AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'merged' ELSE 'single' END AS kind FROM lineitem),
k AS (SELECT l_orderkey, bool_or(kind = 'merged' AND l_linenumber BETWEEN 2 AND 8) AS has, count(*) FILTER (kind = 'single') AS singles FROM l GROUP BY 1)
SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN kind = 'single' AND singles > 1 THEN 'single_panel' ELSE kind END AS kind FROM l JOIN k USING (l_orderkey) WHERE CASE WHEN kind = 'single' THEN NOT has ELSE has END
""")
def merged_preferred(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", "merged").otherwise("single").alias("kind"))
    return filters.prefer_merged(rows, ["l_orderkey"], "kind", "l_linenumber")


@query(f"""
SELECT doc_id, task AS task_type FROM documents, (SELECT unnest({listed(C.TASKS)}) AS task)
WHERE NOT (task = {quoted(next(iter(C.TASKS)))} AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))
""")
def record_task_cross(spark, d):
    finished = read(spark, d, "labels").where("quality = 1").select("doc_id", F.lit(next(iter(C.TASKS))).alias("task_type"))
    return joins.with_tasks(read(spark, d, "documents").select("doc_id"), list(C.TASKS), finished, "doc_id")


@query("""
SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'repaired' ELSE lang END AS lang, CASE WHEN l.doc_id IS NOT NULL THEN l.toxic ELSE n_chars END AS n_chars, l.doc_id IS NOT NULL AS repaired
FROM documents d LEFT JOIN (SELECT * FROM labels WHERE quality = 0) l USING (doc_id)
""")
def overlay_repair(spark, d):
    repaired = read(spark, d, "labels").where("quality = 0").select("doc_id", F.lit("repaired").alias("lang"), F.col("toxic").cast("long").alias("n_chars"))
    return joins.overlay(read(spark, d, "documents").select("doc_id", "lang", "n_chars"), repaired, "doc_id", ["lang", "n_chars"])


@query("SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR toxic = 1")
def repair_targets(spark, d):
    rows = joins.lookup(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels"), "doc_id", ["toxic"])
    return rows.where(F.col("quality").isNull() | (F.col("toxic") == 1)).select("doc_id")


@query("SELECT * FROM (SELECT 'lang' AS name, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source)")
def grouped_counters(spark, d):
    return aggregates.counters(read(spark, d, "documents"), ["lang", "source"])


@query("SELECT lang, source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY GROUPING SETS ((lang, source), (lang), (source), ())")
def grouping_sets_report(spark, d):
    sets = [[F.col("lang"), F.col("source")], [F.col("lang")], [F.col("source")], []]
    return read(spark, d, "documents").groupingSets(sets, "lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT CASE WHEN least(n_chars // 100, 20) >= 20 THEN '2000+' ELSE (n_chars // 100 * 100)::VARCHAR || '-' || (n_chars // 100 * 100 + 99)::VARCHAR END AS bucket, count(*) AS n FROM documents GROUP BY 1")
def caption_length_histogram(spark, d):
    return aggregates.length_histogram(read(spark, d, "documents"), F.col("n_chars"))


@query("""
SELECT r_name, n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)
""")
def partial_rollup(spark, d):
    # Customers are counted by nation before any join; the rollup adds few rows.
    per = read(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("b"))
    named = per.join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.rollup("r_name", "n_name").agg(F.sum("n").alias("customers"), F.round(F.sum("b"), 2).alias("balance"))


_PATHS = "'/root/arxiv_' || printf('%02d01', 20 + doc_id % 6) || '/arXiv_src_' || (doc_id % 3) || '/p' || (doc_id % 97) || '/p' || (doc_id % 97 + CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END) || CASE doc_id % 3 WHEN 0 THEN '_extracted_figs' WHEN 1 THEN '_extracted_figs_merged' ELSE '_src' END || '/f' || doc_id || CASE WHEN doc_id % 5 = 0 THEN '.json' ELSE '.PNG' END"


@query(f"""
WITH f AS (SELECT string_split({_PATHS}, '/') AS p FROM documents),
r AS (SELECT p[3] AS g, p[4] || '/' || p[5] AS paper, CASE WHEN p[6] = p[5] || '_extracted_figs' THEN 'extracted' WHEN p[6] = p[5] || '_extracted_figs_merged' THEN 'merged' WHEN regexp_matches(p[6], '_extracted_figs(_merged)?$') THEN 'other' END AS kind, p[7] LIKE '%.PNG' AS image FROM f)
SELECT g AS "group", count(DISTINCT paper) AS papers, count(DISTINCT paper) FILTER (kind = 'extracted') AS with_extracted, count(DISTINCT paper) FILTER (kind = 'merged') AS with_merged,
  count(*) FILTER (kind = 'extracted' AND image) AS extracted_images, count(*) FILTER (kind = 'merged' AND image) AS merged_images, count(*) FILTER (kind = 'other' AND image) AS other_images
FROM r GROUP BY ROLLUP (g)
""")
def directory_rollup(spark, d):
    n = F.col("doc_id")
    s = lambda c: c.cast("string")
    own = n % 97 + F.when(n % 11 == 0, 1).otherwise(0)
    folder = F.when(n % 3 == 0, "_extracted_figs").when(n % 3 == 1, "_extracted_figs_merged").otherwise("_src")
    path = F.concat(F.lit("/root/arxiv_"), F.format_string("%02d01", 20 + n % 6), F.lit("/arXiv_src_"), s(n % 3), F.lit("/p"), s(n % 97), F.lit("/p"), s(own), folder, F.lit("/f"), s(n), F.when(n % 5 == 0, ".json").otherwise(".PNG"))
    return aggregates.directory_rollup(read(spark, d, "documents").select(path.alias("path")), "path")


@query("SELECT lang, count(DISTINCT source) AS sources, count(DISTINCT sha1(text)) AS texts FROM documents GROUP BY lang")
def distinct_counts(spark, d):
    return read(spark, d, "documents").groupBy("lang").agg(F.count_distinct("source").alias("sources"), F.count_distinct(F.sha1(F.col("text").cast("binary"))).alias("texts"))


@query("SELECT source, count(quality) AS labelled, coalesce(sum(quality)::BIGINT, 0) AS good, CASE WHEN count(quality) > 0 THEN round(sum(quality) / count(quality), 9) ELSE 0.0 END AS rate FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def guarded_rates(spark, d):
    rows = joins.lookup(read(spark, d, "documents").select("doc_id", "source"), read(spark, d, "labels"), "doc_id", ["toxic"])
    per = rows.groupBy("source").agg(F.count("quality").alias("labelled"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"))
    return per.withColumn("rate", F.round(aggregates.rate(F.col("good"), F.col("labelled")), 9))


@query("""
WITH e AS (SELECT user_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 3 AS t FROM events),
g AS (SELECT user_id, t, max(value) - min(value) AS s, greatest(max(abs(value)), 1.0) AS scale, count(DISTINCT value) AS k FROM e GROUP BY 1, 2 HAVING count(*) = 3)
SELECT user_id, t AS triple, k = 1 OR s <= greatest(0.02 * scale, 0.05) OR s / scale <= 0.05 AS agrees FROM g
""")
def answer_consensus(spark, d):
    rows = dedup.ranked(read(spark, d, "events"), ["user_id"], [F.col("event_id")])
    per = rows.groupBy("user_id", F.floor((F.col("rank") - 1) / 3).alias("triple")).agg(F.collect_list("value").alias("numbers")).where(F.size("numbers") == 3)
    said = F.transform("numbers", lambda x: x.cast("string"))
    return per.select("user_id", "triple", aggregates.consensus(said, F.lit("numeric_approx"), F.col("numbers")).alias("agrees"))


@query("""
SELECT e.split, e.figure_id, e.paper_id, array_to_string(coalesce(t.types, []), '|') AS chart_types
FROM (SELECT CASE WHEN doc_id % 2 = 0 THEN 'val' ELSE 'test' END AS split, doc_id AS figure_id, source AS paper_id FROM documents WHERE doc_id % 9 <> 0) e
LEFT JOIN (SELECT doc_id, CASE WHEN quality = 1 THEN ['line'] WHEN toxic = 1 THEN ['bar'] END AS types FROM labels) t ON t.doc_id = e.figure_id AND e.split = 'val'
""")
def eval_records(spark, d):
    from ..sources.files import eval_records as load

    docs = read(spark, d, "documents").select(F.when(F.col("doc_id") % 2 == 0, "val").otherwise("test").alias("split"), F.col("doc_id").alias("figure_id"), F.when(F.col("doc_id") % 9 == 0, "  ").otherwise(F.col("source")).alias("paper_id"))
    empty = F.array().cast("array<string>")
    types = read(spark, d, "labels").select(F.lit("val").alias("split"), F.col("doc_id").alias("figure_id"), F.when(F.col("quality") == 1, "line").otherwise("").alias("chart_type"), F.when(F.col("toxic") == 1, F.array(F.lit("bar"))).otherwise(empty).alias("chart_types"))
    return load(docs, types).select("split", "figure_id", "paper_id", F.array_join("chart_types", "|").alias("chart_types"))


@query("SELECT doc_id, text FROM (SELECT doc_id, text FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100)")
def top_rows(spark, d):
    return read(spark, d, "documents").orderBy(F.desc("n_chars"), "doc_id").limit(100).select("doc_id", "text")


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) % 8)::INTEGER AS shard FROM documents")
def round_robin_shards(spark, d):
    numbered = sampling.number_rows(read(spark, d, "documents").select("doc_id"), [F.col("doc_id")])
    return numbered.select("doc_id", (F.col("row_index") % 8).cast("int").alias("shard"))



@query("""
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '/own/' || doc_id || '.png' WHEN doc_id % 5 = 1 THEN '/json/' || doc_id || '.png' WHEN doc_id % 5 = 2 THEN '/json/x' || doc_id || '.png'
  WHEN doc_id % 5 = 3 THEN '/json/x' || doc_id || '.webp' ELSE '/own/' || doc_id || '.png' END AS image_path FROM documents
""")
def image_resolution(spark, d):
    """Each record's image: as declared, beside its JSON, or by its JSON's stem; a few are nowhere."""
    from ..sources.files import resolve_image

    n, s = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    rows = read(spark, d, "documents").select("doc_id", F.concat(F.lit("/own/"), s, F.lit(".png")).alias("declared"), F.concat(F.lit("/json/x"), s, F.lit(".json")).alias("json"))
    there = F.when(n == 0, F.concat(F.lit("/own/"), s, F.lit(".png"))).when(n == 1, F.concat(F.lit("/json/"), s, F.lit(".png"))).when(n == 2, F.concat(F.lit("/json/x"), s, F.lit(".png"))).when(n == 3, F.concat(F.lit("/json/x"), s, F.lit(".webp")))
    files = read(spark, d, "documents").select(there.alias("path")).where("path IS NOT NULL")
    return resolve_image(rows, files, F.col("declared"), F.col("json")).select("doc_id", "image_path")


@query("SELECT value, n, row_number() OVER (ORDER BY n DESC, first)::INTEGER AS place FROM (SELECT source AS value, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY source)")
def counter_order(spark, d):
    """Counts, largest first, ties by first occurrence."""
    per = read(spark, d, "documents").groupBy(F.col("source").alias("value")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    return sampling.number_rows(per, [F.desc("n"), F.col("first")]).select("value", "n", (F.col("row_index") + 1).cast("int").alias("place"))


@query("""
SELECT d.doc_id, f.images, coalesce(f.caption, 'own ' || d.lang) AS caption FROM documents d
LEFT JOIN (SELECT doc_id, 'a' || quality || ',b' || toxic AS images, 'label ' || quality AS caption FROM labels) f USING (doc_id)
""")
def figure_blocks(spark, d):
    """Blocks and the figures of their paper and number."""
    from ..operators.documents import with_figures

    blocks = read(spark, d, "documents").select("doc_id", F.lit(1).alias("figure_index"), F.concat(F.lit("own "), "lang").alias("caption"))
    labels = read(spark, d, "labels").withColumn("label", F.concat(F.lit("label "), F.col("quality").cast("string")))
    figures = labels.select("doc_id", F.lit(1).alias("figure_index"), F.lit("1.json").alias("json_name"), F.concat(F.lit("a"), F.col("quality").cast("string")).alias("image_name"), F.col("label").alias("caption_text"))
    more = labels.select("doc_id", F.lit(1), F.lit("2.json"), F.concat(F.lit("b"), F.col("toxic").cast("string")), F.lit("second"))
    found = with_figures(blocks, figures.union(more), "doc_id")
    return found.select("doc_id", F.nullif(F.array_join("images", ","), F.lit("")).alias("images"), "caption")
