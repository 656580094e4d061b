import random
import re

import duckdb

from siftwork.llm import licenses

WORDS = re.compile(licenses.WORD)


def base_places(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(low)
    places = [(k, label) for phrase, label in licenses.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    return len(words), sorted(k for k, _ in places), ",".join(sorted({x for _, x in places}))


def test_base_matches_brute_force(frame, odd_pairs):
    more = [
        (100, "Released under the MIT License. MIT-license; mit  license mit"), (101, "cc by cc by cc/by 4.0 ccby"), (102, "GNU General Public gnu general public License"),
        (103, "apache license " * 50), (104, "APACHE\x00LICENSE é apache license"), (105, "the Kelvin sign K is no k: apache licensK"),
    ]
    pairs = [*odd_pairs, *more, more[0]]
    rows = licenses.scan(frame(pairs)).collect()
    assert len(rows) == len(pairs)
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
    want = []
    for i, t in pairs:
        n, at, labels = base_places(t)
        want.append((str(i), n, len(at), min(at, default=None), max(at, default=None), labels))
    assert got == sorted(want, key=str) or sorted(got, key=str) == sorted(want, key=str)


def test_spans_bear_edits(frame):
    sentence = licenses.TEMPLATES[2][1].split()
    edited = [*sentence[:9], "really", "truly", *sentence[9:20], *sentence[21:]]
    pairs = [(1, " ".join(["before"] * 5 + edited)), (2, " ".join(sentence[:8])), (3, "permission is hereby denied")]
    rows = {r.doc_id: r for r in licenses.scan(frame(pairs)).collect()}
    assert rows[1].labels == "mit" and rows[1].base_labels == "" and 0.7 <= rows[1].score < 1
    span = rows[1].spans[0]
    assert span.first_word == 5 and abs(span.words - len(edited)) <= 1
    assert rows[2].labels == rows[3].labels == "" and rows[3].score == 0


def test_words_out_of_order_are_no_span(frame):
    sentence, whole = licenses.TEMPLATES[2][1].split(), licenses.TEMPLATES[12][1].split()
    pairs = []
    for words in (sentence, whole):
        grams = list(zip(words, words[1:], strict=False))
        pairs.append(" ".join(w for g in reversed(grams) for w in g))  # every gram, from the last to the first
        pairs += [" ".join(f"{x} {y} {'filler ' * k}" for x, y in grams) for k in (1, 2, 4, 7)]  # every gram, apart
        pairs.append(" ".join(w for g in random.Random(1).sample(grams, len(grams)) for w in g))
    pairs += [" ".join(whole), " ".join(whole[:80] + ["acme", "corporation"] * 4 + whole[80:])]
    rows = {r.doc_id: r for r in licenses.scan(frame(list(enumerate(pairs)))).collect()}
    assert all(rows[k].labels == "" and rows[k].score == 0 and not rows[k].spans for k in range(12))
    assert all(rows[k].labels == "mit" for k in (12, 13)) and rows[12].score == 1
    lengths = {s.words for s in rows[13].spans if s.cover < 1}
    assert len(whole) + 8 in lengths


def test_texts_without_marks_cannot_have_a_span():
    for _, _, _, words, needed, _ in licenses._templates():
        rest = [w if w not in licenses.MARKS else None for w in words]
        assert sum(1 for x, y in zip(rest, rest[1:], strict=False) if x and y) < needed


def test_sql_agrees_on_made_up_texts(spark, frame, tmp_path):
    rng = random.Random(4)
    templates = [t.split() for _, t in licenses.TEMPLATES]
    made = []
    for k in range(120):
        words = list(rng.choice(templates))
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(words) + 1)
            words[at : at + rng.randint(0, 3)] = rng.choice([["x"] * rng.randint(0, 5), rng.choice(templates)[:9], ["the", "license"]])
        made.append((k, " ".join(words)))
    docs = frame(made)
    docs.select("doc_id", "text").write.parquet(f"file://{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    columns = "doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score"
    got = sorted(tuple(r) for r in licenses.scan(docs).select(*columns.split(", ")).collect())
    assert got == sorted(con.execute(f"SELECT {columns} FROM ({licenses.OP6_SQL})").fetchall())


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    columns = "doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score"
    got = sorted(tuple(r) for r in licenses.op6_licenses(spark, sf).select(*columns.split(", ")).collect())
    assert got == sorted(con.execute(f"SELECT {columns} FROM ({licenses.OP6_SQL})").fetchall())


def test_no_python_in_the_plan(frame):
    plan = licenses.scan(frame([(1, "mit license")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_empty_table(frame):
    assert licenses.scan(frame([])).count() == 0
