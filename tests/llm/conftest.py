import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, fp string, node string, target string"


def rows_of(texts, first=0):
    return [(first + k, t, "en", f"s{k % 3}", len(t or ""), 1, "k", "f", "n", "t") for k, t in enumerate(texts)]


@pytest.fixture
def frame(spark):
    """Rows (doc_id, text) as a documents table with columns that clash with the operators' own names."""

    def make(pairs):
        return spark.createDataFrame([(i, t, "en", None if i is None else f"s{i % 3}", len(t or ""), 1, "k", "f", "n", "t") for i, t in pairs], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_pairs():
    """Nulls, empty and blank texts, ties, repeated rows, one very long text, other scripts."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    common = say(60)
    pairs = [
        (1, None), (2, ""), (3, "   \n\t"), (4, say(5)), (5, common), (6, common), (7, say(20) + " " + common), (8, common + " " + say(30)),
        (9, say(30_000)), (10, "ünïcode — “quoted” 日本語テキスト " + say(40) + "\r\n\x1c\x0b" + say(3)), (11, "of " * 400), (12, "of " * 400 + "end"),
        (13, "a"), (14, "a b c"), (-3, say(50)), (15, say(12) + "\n" + common + "\n" + say(12)), (16, "\x00\x01 odd \U0001f600 " + say(10)), (None, say(25)),
    ]
    return [*pairs, (5, common), (4, pairs[3][1]), (20, "same id"), (20, "another text")]
