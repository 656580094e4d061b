"""License scans by diagonal voting.

All rolling 2-word grams of a document are joined, by hash, to the positions the same grams hold in
the license templates. A hit at word p of the document and word t of the template votes for the
diagonal p - t. Words inserted or left out shift the diagonal, so neighbouring diagonals are merged
into a band; a band is never wider than its template's ``drift``, however many diagonals adjoin.

A band is verified over its words: its hits are read in the document's order, and only those count
that go on in the template (t beyond every t before). A span's cover is their share of the template's
grams; spans of 0.7 or more stay. So reversed text, scattered grams and fillers between them are no span.
Base phrases are templates of drift 0 and cover 1: a phrase stands where its diagonal has every gram.

Scale: the templates are fixed, so their gram table has a proven bound (a few thousand rows) and is
broadcast; the documents' grams are never shuffled, only their hits, by document. A text without
any of the ``MARKS`` cannot reach the cover of any template (that is how they are chosen), so its
grams are not built. Each document also sends one marker row, so that the result needs no second scan.

Defined results: null and empty texts have no words, null positions, empty labels and score 0;
rows that repeat a doc_id and text are each returned; rows of one doc_id with different texts are
scanned apart; a null doc_id is a key as any other. Extra columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Texts that state a license, as (label, words): sentences by which files name one, then whole texts and notices.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages "
        "or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever "
        "resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of "
        "source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is "
        "provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
        "and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special "
        "exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
        "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this "
        "software even if advised of the possibility of such damage",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http "
        "www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without "
        "even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details you should have received a copy "
        "of the gnu general public license along with this program if not see",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this "
        "software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to "
        "the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software "
        "in a product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions must be plainly marked as such and must "
        "not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in "
        "source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or "
        "authors of this software dedicate any and all copyright interest in the software to the public domain",
    ),
)

#: Words of the templates that stand in many other texts.
EVERYDAY = frozenset("by following general including subject original particular performance conditions connection distribution published".split())
#: Share of a template's grams that a verified span holds.
MIN_COVER = 0.7
#: A vote and a diagonal in one whole number: votes above, the smaller diagonal first below.
_HIGH, _MIDDLE = 1 << 32, 1 << 31
#: Width of the widest band; diagonals are scaled so that every template's band is that wide.
_BAND = 32


def _drift(grams: int) -> int:
    """Shift between the diagonals of one occurrence: 4 words, and up to an eighth of a long template."""
    return next(w for w in (32, 16, 8, 4) if w == 4 or 8 * w <= grams)


def _templates() -> list[tuple]:
    """(template, base, label, words, grams needed, scale) of the base phrases and the license texts."""
    both = [(x.split(), y, True) for x, y in BASE] + [(y.split(), x, False) for x, y in TEMPLATES]
    sized = [(n, base, label, words, len(words) - 1) for n, (words, label, base) in enumerate(both)]
    return [(n, base, label, words, grams if base else math.ceil(MIN_COVER * grams - 1e-9), _BAND + 1 if base else _BAND // _drift(grams)) for n, base, label, words, grams in sized]


def _marks() -> list[str]:
    """Words of which every text with a span has one.

    For each template they touch so many of its grams that the others cannot make its cover; long words
    are taken first, as they are rare elsewhere, and everyday ones last.
    """
    marks: set[str] = set()
    for _, _, _, words, needed, _ in _templates():
        for word in sorted(set(words), key=lambda w: (w not in marks, w in EVERYDAY, -len(w), w)):
            if sum(1 for x, y in zip(words, words[1:], strict=False) if x not in marks and y not in marks) < needed:
                break
            marks.add(word)
    return sorted(marks)


MARKS = _marks()


def gram_table(spark: SparkSession) -> DataFrame:
    """Template grams: template, base, label, grams (of the template), needed, scale, t, w1, w2."""
    rows = [(n, base, label, len(words) - 1, needed, scale, t, words[t], words[t + 1]) for n, base, label, words, needed, scale in _templates() for t in range(len(words) - 1)]
    # The marker that every document sends: it keeps documents without hits.
    rows.append((-1, False, "", 1, 1, _BAND + 1, 0, "", ""))
    grams = spark.createDataFrame(rows, "template int, base boolean, label string, grams int, needed int, scale int, t int, w1 string, w2 string")
    return grams.withColumn("gram", F.xxhash64("w1", "w2"))


def scan(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its license finds.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and spans:
    the verified spans as structs (label, base, first word, words, cover). score is the best cover
    of a span, 1 where a base phrase stands.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)).alias("words"))
    gram = "array<struct<w1: string, w2: string>>"
    marker = F.array(F.struct(F.lit("").alias("w1"), F.lit("").alias("w2"))).cast(gram)
    marked = F.arrays_overlap("words", F.array(*[F.lit(m) for m in MARKS]))
    pairs = F.when(marked, F.arrays_zip(F.col("words").alias("w1"), F.slice("words", F.lit(2), F.size("words")).alias("w2")).cast(gram)).otherwise(F.array().cast(gram))
    grams = words.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), F.posexplode(F.concat(pairs, marker)).alias("p", "g"))
    grams = grams.select("doc_id", "text_hash", "n_words", "p", F.col("g.w1").alias("w1"), F.col("g.w2").alias("w2"))
    grams = grams.where(F.col("w2").isNotNull()).withColumn("gram", F.xxhash64("w1", "w2"))
    # The join is on the hash; the words themselves then rule out collisions.
    known = gram_table(spark).withColumnsRenamed({"w1": "v1", "w2": "v2"})
    hits = grams.join(F.broadcast(known), "gram").where((F.col("w1") == F.col("v1")) & (F.col("w2") == F.col("v2")))
    doc = ["doc_id", "text_hash"]
    of = [*doc, "n_words", "template", "base", "label", "grams", "needed"]
    diagonal = F.when(F.col("template") == -1, F.lit(0)).otherwise(F.col("p") - F.col("t")).cast("long")
    votes = hits.groupBy(*of, "scale", diagonal.alias("diagonal")).agg(F.count_if(F.col("t") == 0).alias("copies"), F.collect_set("t").alias("at"))
    # The votes of the band that starts at each diagonal; then each diagonal joins the best band over it.
    line = Window.partitionBy(*doc, "template").orderBy(F.col("diagonal") * F.col("scale"))
    band = votes.withColumn("votes", F.sum(F.size("at").cast("long")).over(line.rangeBetween(Window.currentRow, _BAND)))
    weight = F.when(F.col("votes") >= F.col("needed"), F.col("votes") * F.lit(_HIGH) + F.lit(_MIDDLE) - F.col("diagonal"))
    band = band.withColumn("weight", weight).withColumn("best", F.max("weight").over(line.rangeBetween(-_BAND, Window.currentRow))).where(F.col("best").isNotNull())
    # A diagonal has each t once, so that a band's hits are bounded by its width and the template.
    each = F.transform("at", lambda t: F.struct((F.col("diagonal") + t).alias("p"), t.alias("t")))
    merged = band.groupBy(*of, "best").agg(F.max("copies").alias("copies"), F.array_sort(F.flatten(F.collect_list(each))).alias("hits"))
    start = F.struct(F.lit(-1).alias("top"), F.lit(0).alias("n"))
    step = lambda s, h: F.struct(F.greatest(s["top"], h["t"]).alias("top"), (s["n"] + (h["t"] > s["top"]).cast("int")).alias("n"))
    spans = merged.withColumn("ascending", F.aggregate("hits", start, step, lambda s: s["n"])).where(F.col("ascending") >= F.col("needed"))
    spans = spans.withColumns({"cover": F.col("ascending") / F.col("grams"), "first": F.get("hits", F.lit(0))["p"], "last": F.element_at("hits", -1)["p"]})
    found = F.col("template") >= 0
    phrase = found & F.col("base")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per = spans.groupBy(*doc, "n_words").agg(
        F.max(F.when(~found, F.col("copies"))).alias("copies"),
        F.count_if(phrase).alias("n_base"),
        F.min(F.when(phrase, F.col("first"))).alias("first_word"),
        F.max(F.when(phrase, F.col("first"))).alias("last_word"),
        joined(F.when(phrase, F.col("label"))).alias("base_labels"),
        joined(F.when(found, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(found, F.col("cover"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(found, F.struct("label", "base", F.col("first").alias("first_word"), (F.col("last") - F.col("first") + 2).alias("words"), "cover")))).alias("spans"),
    )
    return per.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("text_hash", "copies", "copy")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", "doc_id", "text")).drop("spans")


_SQL_SCAN = """
words AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
grams AS (
  SELECT rid, unnest(range(len(w) - 1)) AS p, unnest(list_zip(w[:len(w) - 1], w[2:])) AS g FROM words WHERE len(w) > 1),
hits AS (
  SELECT rid, p, p - t AS diagonal, t.* FROM grams JOIN templates t ON g[1] = t.w1 AND g[2] = t.w2),
votes AS (
  SELECT rid, template, needed, diagonal, diagonal * scale AS line, count(*) AS n FROM hits GROUP BY ALL),
bands AS (
  SELECT *, sum(n) OVER (PARTITION BY rid, template ORDER BY line RANGE BETWEEN CURRENT ROW AND 32 FOLLOWING)::BIGINT AS votes FROM votes),
best AS (
  SELECT rid, template, diagonal, max(CASE WHEN votes >= needed THEN votes * 4294967296 + 2147483648 - diagonal END) OVER (PARTITION BY rid, template ORDER BY line RANGE BETWEEN 32 PRECEDING AND CURRENT ROW) AS best
  FROM bands),
ordered AS (
  SELECT h.*, best, coalesce(t > max(t) OVER (PARTITION BY rid, template, best ORDER BY p, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS ascends
  FROM hits h JOIN best b USING (rid, template, diagonal) WHERE best IS NOT NULL),
spans AS (
  SELECT rid, base, label, min(p) AS first, count(*) FILTER (ascends) / n_grams AS cover
  FROM ordered GROUP BY rid, template, base, label, n_grams, needed, best HAVING count(*) FILTER (ascends) >= needed)
SELECT doc_id, len(any_value(w))::BIGINT AS n_words, count(*) FILTER (base) AS n_base,
       min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (label IS NOT NULL), '') AS labels,
       coalesce(max(cover), 0.0)::DOUBLE AS score
FROM words LEFT JOIN spans USING (rid) GROUP BY rid, doc_id
"""


def _oracle() -> str:
    rows = [f"({n}, {base}, '{label}', {len(words) - 1}, {needed}, {scale}, {t}, '{words[t]}', '{words[t + 1]}')" for n, base, label, words, needed, scale in _templates() for t in range(len(words) - 1)]
    return f"WITH templates(template, base, label, n_grams, needed, scale, t, w1, w2) AS (VALUES {', '.join(rows)}),{_SQL_SCAN}"


OP6_SQL = _oracle()
