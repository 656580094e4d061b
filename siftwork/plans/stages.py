"""Model stages with the stub client, documents as blocks and pages, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators import documents, model, verify
from ..sources.store import new_folder
from ..streaming import stages
from .rows import _SCORE
from .tables import listed, read, spread

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query(f"""
WITH {_SCORE} SELECT doc_id AS candidate_id, score > 0 AS accepted, FALSE AS weak_accept, CASE WHEN score > 0 THEN 'other_chart' ELSE '' END AS chart_types, 'other_chart' AS primary_chart_type FROM scores
""")
def model_stub_classify(spark, d):
    rows = spread(read(spark, d, "documents")).select(F.col("doc_id").alias("candidate_id"), T.keyword_score(F.col("text"))["score"].alias("score"), F.left("text", F.lit(5000)).alias("prompt"))
    found = verify.classify(rows, model.StubClient)
    return found.select("candidate_id", "accepted", "weak_accept", F.array_join("chart_types", "|").alias("chart_types"), "primary_chart_type")


@query(f"""
SELECT doc_id AS candidate_id, task AS task_type, 'Compare the two largest values for ' || doc_id || ' (' || task || ').' AS question, NULL::VARCHAR AS reject,
  'q_' || trim(left(regexp_replace(k, '[^A-Za-z0-9_.-]+', '_', 'g'), 80), '_') || '_' || left(sha1(k), 16) AS id
FROM (SELECT *, doc_id || ':' || task || ':Compare the two largest values for ' || doc_id || ' (' || task || ').' AS k FROM documents, (SELECT unnest({listed(C.TASKS)}) AS task))
""")
def model_stub_grouped(spark, d):
    rows = read(spark, d, "documents").select(F.col("doc_id").alias("candidate_id"), F.explode(F.array(*[F.lit(t) for t in C.TASKS])).alias("task_type"))
    return verify.grouped_questions(rows, model.StubClient, list(C.TASKS)).select("candidate_id", "task_type", "question", "reject", "id")


@query("""
SELECT doc_id AS id, (('0x' || left(sha1(text), 4))::INTEGER % 7)::VARCHAR AS answer, TRUE AS consensus, 3 AS samples FROM documents
""")
def model_stub_answers(spark, d):
    rows = spread(read(spark, d, "documents")).select(F.col("doc_id").alias("id"), F.col("text").alias("question"), F.lit("integer").alias("answer_type"))
    return verify.answers(rows, model.StubClient).select("id", "answer", "consensus", F.size("samples").alias("samples"))


@query("SELECT doc_id AS candidate_id, 'A figure about ' || left(text, 60) AS dense_caption, 'caption_' || doc_id AS caption_id, TRUE AS caption_verified FROM documents")
def model_stub_captions(spark, d):
    rows = read(spark, d, "documents").select(F.col("doc_id").alias("candidate_id"), F.col("text").alias("prompt"))
    return verify.captions(rows, model.StubClient).select("candidate_id", "dense_caption", "caption_id", "caption_verified")


@query("""
SELECT conv_id, turn, turn % 2 = 1 AS final_answer_appended, turn % 2 = 1 OR conv_id % 3 = 0 AS final_answer_matches FROM conversations
""")
def reasoning_final_line(spark, d):
    verified = F.concat(F.lit("value "), F.col("conv_id").cast("string"))
    said = F.when(F.col("conv_id") % 3 == 0, verified).otherwise("another")
    response = F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit("\nFinal answer: "), said)).otherwise(F.col("text"))
    rows = read(spark, d, "conversations").select("conv_id", "turn", response.alias("response"), verified.alias("answer"), F.lit("short_phrase").alias("answer_type"))
    return verify.with_reasoning(rows, "response", "answer", "answer_type").select("conv_id", "turn", "final_answer_appended", "final_answer_matches")


@query("""
WITH RECURSIVE b AS (SELECT doc_id, unnest(range(len(l))) AS place, unnest(l) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
c AS (SELECT doc_id, place, greatest(56, 24 + length(t) // 2) AS cost FROM b),
p AS (SELECT doc_id, place, 1 AS page, cost AS used FROM c WHERE place = 0
  UNION ALL SELECT c.doc_id, c.place, CASE WHEN p.used + c.cost > 2200 THEN p.page + 1 ELSE p.page END, CASE WHEN p.used + c.cost > 2200 THEN c.cost ELSE p.used + c.cost END
  FROM p JOIN c ON c.doc_id = p.doc_id AND c.place = p.place + 1)
SELECT doc_id, place::INTEGER AS place, cost::INTEGER AS cost, page FROM p JOIN c USING (doc_id, place)
""")
def paginate_blocks(spark, d):
    rows = read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "text"))
    cost = documents.block_cost(F.lit("paragraph"), F.col("text"), F.lit(0), F.lit(0))
    return documents.paginate(rows.select("doc_id", "place", cost.alias("cost")), "doc_id", "place", "cost")


@query("""
WITH l AS (SELECT doc_id, unnest(range(len(x))) AS k, unnest(x) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)),
p AS (SELECT doc_id, k, trim(regexp_replace(regexp_replace(t, '%.*$', ''), '\\s+', ' ', 'g')) AS text FROM l),
b AS (SELECT doc_id, k + 2 AS o, 'paragraph' AS type, text FROM p WHERE length(text) >= 2 UNION ALL SELECT doc_id, 0, 'title', 'On ' || lang FROM documents
  UNION ALL SELECT doc_id, 1, 'heading', 'First' FROM documents UNION ALL SELECT doc_id, 1000000000, 'figure', 'A plot' FROM documents)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY o) - 1)::INTEGER AS place, type, text FROM b
""")
def latex_blocks(spark, d):
    doc = F.concat(F.lit("\\title{On \\emph{"), "lang", F.lit("}}\n\\begin{document}\n\\section{First}\n"), F.replace("text", F.lit("\n"), F.lit("\n\n")), F.lit("\n\\begin{figure}\\caption{A \\textbf{plot}}\\end{figure}\n\\end{document}\n"))
    rows = spread(read(spark, d, "documents")).select("doc_id", doc.alias("tex"))
    return documents.blocks(rows, "doc_id", "tex").select("doc_id", "place", "type", "text")


@query("SELECT doc_id, length(text) AS total_tex_chars, length(text) - (len(string_split(text, chr(10))) - 1) AS block_raw_chars, length(text) - (len(string_split(text, chr(10))) - 1) AS block_text_chars, len(string_split(text, chr(10))) AS num_blocks FROM documents")
def document_stats(spark, d):
    papers = read(spark, d, "documents").select("doc_id", "text")
    lines = papers.select("doc_id", F.explode(F.split("text", "\n")).alias("raw")).withColumn("text", F.col("raw"))
    return documents.stats(papers, lines, "doc_id", "text")


@query("SELECT event_id, event_type, upper(event_type) AS stage FROM events")
def stream_resume(spark, d):
    """Events arrive in two lots of files; every lot is drained twice. Each event is in the last table once."""
    folder = new_folder(spark, "stream")
    events = read(spark, d, "events").select("event_id", "event_type")
    chain = [("first", ["event_id"], lambda rows: rows), ("second", ["event_id"], lambda rows: rows.withColumn("stage", F.upper("event_type")))]
    for lot in range(2):
        # Neighbouring lots overlap, as a producer's repeat would.
        events.where((F.col("event_id") % 2 == lot) | (F.col("event_id") % 10 == 0)).write.mode("append").parquet(f"{folder}/in")
        for _ in range(2):
            last = stages.run_chain(spark, f"{folder}/in", events.schema, folder, chain)
    return last


@query("SELECT event_id, (('0x' || left(sha1(event_id::VARCHAR), 12))::BIGINT % 4)::INTEGER AS shard FROM events")
def stream_dispatch(spark, d):
    folder = new_folder(spark, "dispatch")
    events = read(spark, d, "events").select("event_id")
    events.write.parquet(f"{folder}/in")
    stages.dispatch(spark, f"{folder}/in", events.schema, f"{folder}/shards", f"{folder}/checkpoint", "event_id", 4).awaitTermination()
    return spark.read.parquet(f"{folder}/shards").select("event_id", "shard")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_day(spark, d):
    found = stages.tumbling_counts(read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return found.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""
WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM g GROUP BY user_id, k
""")
def session_30m(spark, d):
    found = stages.sessions(read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return found.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")
