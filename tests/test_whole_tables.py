"""Queries over whole tables against plain Python."""

import hashlib
import re
import unicodedata

from siftwork import constants as C
from siftwork.plans import rows


def plain_answer(text):
    text = unicodedata.normalize("NFKC", text).strip().lower()
    text = re.sub(r"\b(the|a|an)\b", " ", re.sub(r"<[^>]+>", " ", text))
    return " ".join("".join(c for c in text if c not in C.ASCII_MARKS + C.CJK_MARKS).split())


def test_answers_of_all_documents(spark, tmp_path):
    texts = ["The Ångström, ﬁne <b>ＡＢＣ</b>", "Éléphant a été l\u2019an", "plain, an answer", "１２３ straße", "（日本語）テキスト。", "e\u0301 a\u00a0b"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r.doc_id: r.answer for r in rows.QUERIES["normalize_answers"](spark, f"file://{tmp_path}").collect()}
    assert got == {k: plain_answer(t) for k, t in enumerate(texts)}


def test_distance_of_whole_digests(spark, sf):
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.bits for r in rows.QUERIES["hash_distance"](spark, sf).collect()}
    assert got == {k: (int(hashlib.md5(t).hexdigest(), 16) ^ int(hashlib.sha1(t).hexdigest(), 16)).bit_count() for k, t in texts.items()}
