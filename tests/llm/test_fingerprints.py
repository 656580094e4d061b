import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftwork.llm import fingerprints as fp


def tree(text):
    return fp.fingerprint(fp.paragraphs(text))


def test_matches_brute_force(spark, frame, odd_pairs):
    pairs = [p for p in odd_pairs if p[0] is not None]
    unique = list({i: t for i, t in pairs}.items())
    rows = {r.doc_id: r for r in fp.fingerprints(frame(unique)).collect()}
    order = sorted(unique, reverse=True)
    assert len(rows) == len(order)
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        new = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (tree(t), tree(new))
        assert r.near_next == fp.likeness(tree(t), tree(following))
        assert (r.near_edited == 1) == (t == new)


def test_nulls_and_repeats(spark, frame, odd_pairs):
    rows = fp.fingerprints(frame(odd_pairs)).collect()
    assert len(rows) == len(odd_pairs)
    assert fp.fingerprints(frame([])).count() == 0
    only = fp.fingerprints(frame([(7, "abc")])).collect()[0]
    assert only.near_next == 1 and only.edited_sha256 == hashlib.sha256(b"aba").hexdigest()
    nothing = fp.fingerprints(frame([(None, None), (None, None)])).collect()
    assert [r.near_next for r in nothing] == [1.0, 1.0]


def test_likeness_and_edits():
    lines = [f"paragraph number {k} says something of its own" for k in range(60)]
    a = tree("\n".join(lines))
    b = tree("\n".join([*lines[:30], "an edit", *lines[31:]]))
    assert 0.95 < fp.likeness(a, b) < 1 and fp.likeness(a, a) == 1
    places = fp.locate_edits(a, b)
    assert len({p[:2] for p in places}) == 1 and fp.locate_edits(a, a) == []
    section, paragraph, leaf = places[0]
    assert fp._sections(a)[section][1][paragraph] == fp._sections(tree(lines[30]))[0][1][0] and leaf == 0
    assert fp.likeness(a, tree("nothing alike")) == 0 and fp.likeness(tree(""), tree("")) == 1


def leaf_texts(text):
    """The leaves' texts by a plain reading of the rule: an end where a hash is least among its neighbours."""
    odd, word = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F), (1 << 32) - 1
    out = []
    for line in text.split("\n"):
        if len(line) <= 2 * fp.REACH:
            out.append(line)
            continue
        codes = [10, 10, 10, *map(ord, line)]
        h = [sum(codes[k + 3 - j] * odd[j] for j in range(4)) & word for k in range(len(line))]
        h = [(x ^ x >> 15) * odd[1] & word for x in h]
        ends = [k + 1 for k, x in enumerate(h) if all(x < y for y in h[max(0, k - fp.REACH) : k]) and all(x <= y for y in h[k + 1 : k + 1 + fp.REACH])]
        last = 0
        for end in [*ends, len(line)]:
            out += [line[k : min(end, k + 256)] for k in range(last, end, 256)]
            last = max(last, end)
    return out


def share_of(a, b):
    x, y = Counter(leaf_texts(a)), Counter(leaf_texts(b))
    return 2 * sum((x & y).values()) / (sum(x.values()) + sum(y.values()))


def test_likeness_is_the_share_of_common_leaves():
    rng = random.Random(5)
    say = lambda n: "".join(rng.choice(["w", "ö", " ", "abc", "\n", ". ", "日"]) + rng.choice("aeiou ") for _ in range(n))
    for _ in range(40):
        a = say(rng.randint(0, 600)) + "z" * rng.choice([0, 700])
        at = rng.randint(0, len(a))
        b = rng.choice([a[:at] + say(rng.randint(0, 50)) + a[at + rng.randint(0, 30) :], say(200), a[at:] + a[:at]])
        assert fp.likeness(tree(a), tree(b)) == pytest.approx(1.0 if a == b else share_of(a, b))


@pytest.mark.parametrize("edit", ["X", "", "XY", "inserted words of some length"])
def test_edits_in_a_long_paragraph_stay_local(edit):
    rng = random.Random(7)
    text = " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(400))
    for at in (0, 900, len(text) - 2):
        other = text[:at] + edit + text[at + (edit != "inserted words of some length") * (edit in ("", "X")) :]
        assert fp.likeness(tree(text), tree(other)) > 0.9
        places = fp.locate_edits(tree(text), tree(other))
        assert 1 <= len(places) <= 4 and all(p[:2] == (0, 0) for p in places)
    assert len(tree(text)) < 0.21 * len(text)


def test_runs_of_one_character_have_bounded_leaves():
    leaves = fp.paragraphs("x" * 3000)[0][1]
    assert 11 <= len(leaves) <= 13


def test_shards_hold_like_bytes(spark, frame):
    rng = random.Random(3)
    pairs = [(k, "x y " * (2000 if k < 40 else rng.randint(1, 20))) for k in range(600)]
    both, _ = fp.with_following(frame(pairs))
    sizes = [r.n for r in both.where("extra = 0").groupBy("shard").agg(F.sum(F.length("text")).alias("n")).collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_edited_tree_equals_a_fresh_one():
    text = "one\ntwo " * 40 + "three\n" + "x" * 300
    new, made = fp.edited(text, fp.paragraphs(text), "other\ntext " * 50)
    assert made == fp.paragraphs(new)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 31, 95])
def test_shards_count_the_bounds_below(spark, n):
    bounds = [3 * k for k in range(n)]
    rows = spark.range(-2, 3 * n + 5).select("id", fp._shard(F.col("id"), bounds).alias("s")).collect()
    assert all(r.s == sum(b < r.id for b in bounds) for r in rows)


def test_last_range_may_open_a_shard(spark, frame):
    pairs = [(k, "a" * 5000 if k >= 95 else "b") for k in range(100)]
    rows = fp.fingerprints(frame(pairs)).collect()
    assert len(rows) == 100 and all(r.near_next == (0 if r.doc_id == 95 or r.doc_id == 0 else 1) for r in rows)
