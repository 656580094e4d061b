"""The order of rarity in near-dedup comes from all texts, not from a sample of them."""

from collections import Counter
from fractions import Fraction

import numpy as np

from siftwork import rarity
from siftwork.llm import simhash


def shingles(text, width=5):
    return simhash.shingle_set(simhash.words_of(text), width, simhash.WordHashes())


def test_all_texts_are_counted(spark):
    """Beyond the 20,000 texts that were sampled before; a shingle counts once a text, copies count each."""
    texts = ["one two three four five", "one two three four five six", "one two three four five one two three four five", None, "", "seven"]
    docs = spark.range(45_000).selectExpr("id AS doc_id", f"element_at(array({', '.join('NULL' if t is None else repr(t) for t in texts)}), CAST(id % 6 AS INT) + 1) AS text")
    counts = simhash.shingle_counts(docs, 5)
    want = Counter(h for t in texts for h in shingles(t).tolist())
    hashes = np.array(sorted(want), np.uint64)
    assert counts[rarity.cells(hashes)].tolist() == [7500 * want[h] for h in hashes.tolist()]
    assert counts.sum() == 7500 * sum(want.values())
    assert simhash.shingle_counts(docs.limit(0), 5).sum() == 0


def test_rare_shingles_are_keys_first(spark):
    """A shingle of all texts is a key of none that has enough others; one of a single text is none at all."""
    common = "a b c d e "
    texts = [common + " ".join(f"w{k // 2}x{j}" for j in range(20)) + (" end" if k % 2 else "") for k in range(400)]
    docs = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "doc_id long, key long, text string")
    counts = simhash.shingle_counts(docs, 5)
    marked = simhash.signed(docs, 5, Fraction(4, 5), counts).collect()
    of_all = int(shingles(common.strip()).view(np.int64)[0])
    ends = {int(h) for t in texts[1::2] for h in shingles(" ".join(t.split()[-5:])).view(np.int64)}
    assert counts[rarity.cells(shingles(common.strip()))][0] >= 400
    assert all(r.rare and of_all not in r.rare + r.hot and not ends & set(r.rare + r.hot) for r in marked)
