import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siftwork.llm import deepshallow, suffixes


def brute(pairs):
    """doc_id, text -> (n_bytes, n_removed, n_spans, sha256), documents in order of id."""
    seen, out = set(), []
    for doc_id, text in sorted(pairs, key=lambda p: p[0]):
        b = (text or "").encode()
        covered = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                covered[k : k + 100] = b"\1" * 100
            else:
                seen.add(b[k : k + 100])
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        spans = sum(1 for k, c in enumerate(covered) if c and (not k or not covered[k - 1]))
        out.append((doc_id, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    return sorted(tuple(r) for r in df.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect())


def texts(rng, n):
    passage = [rng.randbytes(rng.choice([99, 100, 101, 130, 400])).hex() for _ in range(3)]
    periodic = ["ab" * 120, "x" * 350, "the cat sat. " * 40]
    made = []
    for _ in range(n):
        parts = [rng.randbytes(rng.randint(0, 120)).hex() for _ in range(rng.randint(0, 3))] + rng.choices(passage + periodic, k=rng.randint(0, 3))
        rng.shuffle(parts)
        made.append("é".join(parts))
    return made


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(frame, seed):
    rng = random.Random(seed)
    pairs = list(enumerate(texts(rng, 60)))
    rng.shuffle(pairs)
    assert found(suffixes.remove_repeats(frame(pairs))) == brute(pairs)


def test_text_longer_than_a_piece(frame, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 512)
    rng = random.Random(9)
    long = rng.randbytes(3000).hex()
    pairs = [(1, long), (2, long[700:1900] + "tail"), (3, "head" + long[511:640] + long[3:9])]
    assert found(suffixes.remove_repeats(frame(pairs))) == brute(pairs)


def test_odd_rows(frame, odd_pairs):
    got = suffixes.remove_repeats(frame(odd_pairs), carry=("size", "key")).collect()
    assert len(got) == len(odd_pairs)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[1][0].n_bytes == 0 and by_id[2][0].spans == []
    assert by_id[5][0].kept == by_id[5][1].kept  # a row listed again is cut alike
    plain = [p for p in odd_pairs if p[0] is not None and p[0] != 20]
    alone = {r[0]: r for r in brute([p for k, p in enumerate(plain) if p not in plain[:k]])}
    nothing_before = -3  # the null id comes first and shares nothing
    assert hashlib.sha256(by_id[nothing_before][0].kept).hexdigest() == alone[nothing_before][4]
    assert all(hashlib.sha256(by_id[i][0].kept).hexdigest() == alone[i][4] for i in (6, 7, 8, 9, 11, 12, 15))


def test_empty_table(frame):
    assert suffixes.remove_repeats(frame([])).count() == 0


def test_trie_orders_long_common_prefixes():
    rng = random.Random(2)
    data = b"".join(bytes(rng.choices(b"ab", k=40)) for _ in range(30)) * 2
    starts = np.arange(0, len(data) - 90, 7)
    lengths = np.full(len(starts), 90)
    order, classes = deepshallow.sort_strings(data, starts, lengths)
    strings = [data[s : s + 90] for s in starts]
    assert [strings[k] for k in order] == sorted(strings)
    assert len(set(classes.tolist())) == len(set(strings))


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    shared = rng.randbytes(164)
    a, b = rng.randbytes(50) + shared, rng.randbytes(77) + shared + rng.randbytes(9)
    width = suffixes.LENGTH - suffixes.K + 1
    places = [suffixes.anchors_of(suffixes.gram_hashes(np.frombuffer(x, np.uint8), suffixes.K), width) for x in (a, b)]
    for k in range(65):
        assert places[0][50 + k] - (50 + k) == places[1][77 + k] - (77 + k)


@pytest.mark.parametrize("seed", range(2))
def test_hot_lines_are_spread(frame, monkeypatch, seed):
    monkeypatch.setattr(suffixes, "HOT", 3)
    monkeypatch.setattr(suffixes, "HOT_A_TASK", 10**9)
    rng = random.Random(seed)
    line = "a line that very many documents share, of sixty-odd bytes in all"
    passage = rng.randbytes(90).hex()
    pairs = [(k, rng.choice([line, passage]).join(rng.randbytes(rng.choice([10, 40])).hex() for _ in range(3))) for k in range(60)]
    pairs += [(100 + k, pairs[k][1][: 60 + k]) for k in range(20)]
    assert found(suffixes.remove_repeats(frame(pairs))) == brute(pairs)


def test_keys_with_equal_low_halves(frame):
    rng = random.Random(6)
    one, two = rng.randbytes(50).hex(), rng.randbytes(50).hex()
    key = lambda i, text: xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42))  # noqa: E731  Spark's xxhash64
    low = {key(i, one) & 0xFFFFFFFF: i for i in range(300_000)}
    i, j = next((low[k], j) for j in range(300_000) if (k := key(j, two) & 0xFFFFFFFF) in low and low[k] != j)
    pairs = [(i, one), (j, two), (10**6, one), (10**6 + 1, two)]
    df = frame(pairs)
    keys = {r.doc_id: r.key for r in df.select("doc_id", F.xxhash64("doc_id", "text").alias("key")).collect()}
    assert keys[i] % 2**32 == keys[j] % 2**32
    assert found(suffixes.remove_repeats(df)) == brute(pairs)


@pytest.mark.parametrize("seed", range(2))
def test_rows_listed_again_keep_what_one_keeps(frame, seed):
    rng = random.Random(seed)
    pairs = list(enumerate(texts(rng, 30)))
    pairs += [(100, rng.randbytes(90).hex()), (101, pairs[3][1] + rng.randbytes(60).hex())]
    wanted = {r[0]: r for r in brute(pairs)}
    again = [*pairs, *rng.choices(pairs, k=20), pairs[-1], pairs[-2]]
    rng.shuffle(again)
    assert found(suffixes.remove_repeats(frame(again))) == sorted(wanted[i] for i, _ in again)


def test_odd_rows_listed_again(frame, odd_pairs):
    plain = [p for p in odd_pairs if p[0] is not None and p[0] != 20]
    wanted = {r[0]: r for r in brute([p for k, p in enumerate(plain) if p not in plain[:k]])}
    assert found(suffixes.remove_repeats(frame(plain))) == sorted(wanted[i] for i, _ in plain)


def test_whole_characters_lose_only_split_ones(frame):
    rng = random.Random(12)
    passage = "é" + rng.randbytes(60).hex() + "日"
    pairs = [(1, passage), (2, "keep � here " + passage.encode()[1:].decode("utf-8", "ignore") + "é�"), (3, "x�Ã" + passage[:100] + "ü" + passage + "�")]
    kept = {r.doc_id: r.kept.decode() for r in suffixes.remove_repeats(frame(pairs), characters=True).collect()}
    assert kept[1] == passage and kept[2].startswith("keep � here ") and kept[2].endswith("�")
    assert kept[3].startswith("x�") and kept[3].endswith("�")
