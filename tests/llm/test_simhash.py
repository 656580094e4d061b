import random
import re

import numpy as np
import pytest
import xxhash

from siftwork.llm import components, simhash


def fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, bits=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


def test_matches_brute_force(frame, odd_pairs):
    pairs = [p for p in odd_pairs if p[0] is not None]
    rows = simhash.near_duplicates(frame(odd_pairs)).collect()
    assert len(rows) == len(odd_pairs)
    wanted = {(i, fingerprint(t)) for i, t in odd_pairs}
    assert {(r.doc_id, r.fp % 2**64) for r in rows} == wanted
    texts = [t for _, t in odd_pairs]
    label = groups([fingerprint(t) for t in texts])
    least = {}
    for (i, _), g in zip(odd_pairs, label, strict=True):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    expected = {(i, fingerprint(t), least[g]) for (i, t), g in zip(odd_pairs, label, strict=True)}
    assert {(r.doc_id, r.fp % 2**64, r.component_id) for r in rows} == expected
    assert pairs


@pytest.mark.parametrize("seed", range(3))
def test_links_of_near_fingerprints(spark, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)]
    fps = {0, *centres}
    for c in centres:
        for _ in range(25):
            f = c
            for b in rng.sample(range(64), rng.randint(0, 7)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    roots = components.components(simhash.linked(nodes)).collect()
    got = {r.node % 2**64: r.root for r in roots}
    label = groups(fps)
    together = {}
    for f, g in zip(fps, label, strict=True):
        together.setdefault(g, set()).add(got.get(f, f"alone {f}"))
    assert all(len(s) == 1 for s in together.values())
    assert len({next(iter(s)) for s in together.values()}) == len(together)


def test_more_than_255_shingles_count_right():
    hashes = np.array([xxhash.xxh64_intdigest(str(k)) for k in range(1000)], np.uint64)
    got = simhash.majority(hashes, np.array([0, 999, 0, 1]))
    wanted = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes[:999]) > 999)
    assert [int(x) for x in got] == [0, wanted, 0, int(hashes[999])]


def test_components_of_chains_and_cycles(spark):
    rng = random.Random(8)
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in (100, 101, 102)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_table(frame):
    assert simhash.near_duplicates(frame([])).count() == 0


def test_one_of_each_keeps_one(frame):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    near = [*base[:150], "changed", *base[151:]]
    other = [rng.choice(words) for _ in range(300)]
    pairs = [(3, " ".join(near)), (1, " ".join(base)), (2, " ".join(base)), (4, " ".join(other)), (None, None), (5, ""), (4, " ".join(other))]
    docs = frame(pairs)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, 1, 4]
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def jaccard(a, b, width=5):
    x, y = (set(simhash.shingle_hashes(t, width)) for t in (a, b))
    return len(x & y) / len(x | y)


def one_of_each_by_brute_force(pairs):
    parent = {i: i for i, _ in pairs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(pairs):
        for j, b in pairs[:k]:
            if jaccard(a, b) >= 0.8:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted({find(i) for i in parent})


def test_one_of_each_computes_similarity(frame):
    rng = random.Random(3)
    say = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    repeated = "one line that both of the texts repeat many times over\n" * 200
    pairs = [(1, " ".join(say(500)) + "\n" + repeated), (2, " ".join(say(500)) + "\n" + repeated)]
    base = say(400)
    pairs += [(3, " ".join(base)), (4, " ".join([*base[:340], *say(60)]))]  # about 0.74 similar
    assert [r.doc_id for r in simhash.one_of_each(frame(pairs)).orderBy("doc_id").collect()] == [1, 2, 3, 4]


@pytest.mark.parametrize("seed", range(2))
def test_one_of_each_misses_no_pair(frame, seed):
    rng = random.Random(seed)
    say = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line = say(12)
    pairs = []
    for _ in range(60):  # pairs about the limit, amid a line that all share
        base = [*say(rng.randint(60, 200)), *line]
        cut = rng.uniform(0.08, 0.14)
        pairs += [base, [*base[: -max(1, int(cut * len(base)))], *say(max(1, int(cut * len(base))))]]
    group = say(100)
    for _ in range(30):  # a group whose members are linked in chains
        at = rng.randrange(90)
        pairs.append([*group[:at], *say(rng.randint(1, 9)), *group[at + rng.randint(0, 6) :]])
    pairs = [(k, " ".join(w)) for k, w in enumerate(pairs)]
    assert [r.doc_id for r in simhash.one_of_each(frame(pairs)).orderBy("doc_id").collect()] == one_of_each_by_brute_force(pairs)


def test_overlaps_are_counted(monkeypatch):
    rng = np.random.default_rng(3)
    core = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(core, rng.integers(1, 60), replace=False), rng.integers(0, 40, 9).astype(np.uint64)])) for _ in range(40)]
    for few in (1, 5, 50):
        monkeypatch.setattr(simhash, "FEW_OWNERS", few)
        got = simhash.overlaps(sets)
        assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(40) for j in range(40) if i != j)


def test_groups_in_blocks(frame, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    pairs = []
    for k in range(60):  # near copies of one text, of which many are not similar to each other
        words = list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        pairs.append((k, " ".join(words)))
    assert [r.doc_id for r in simhash.one_of_each(frame(pairs)).orderBy("doc_id").collect()] == one_of_each_by_brute_force(pairs)
