"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins. Boosting goes round the features again and again; each
turn fits a shallow tree of one feature to the residuals and adds it to that feature's lookup
table. Then the pairs whose joint bins explain most of what is left get two-dimensional tables, fitted
the same way. A score is the logistic of an intercept and one table entry a feature and a pair:
bin numbers, look-ups and additions, vectorised over a batch.

Training rows are the labelled ones outside the held-out remainder, at most ``max_rows`` of them
(those with the smallest hash of their id, a documented bound): their ids are broadcast to the scan
and only their features come to the driver. Everything else covers all documents. The model is a
few thousand numbers and travels in the task. One pass over the texts scores them; nothing is
shuffled. The text alone is an input of a score.

Defined results: null, empty and blank texts have the features of an empty text and are scored as
any other; a null doc_id is never held out nor labelled; labels with a null label or id are not
learnt from, and an id labelled more than once counts with its smallest label; without labels of
both kinds every score is the share of label 1, or 0.5 without any; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: At most so many labelled rows are learnt from.
MAX_ROWS = 20_000
FEATURES = (
    "log_words", "word_length", "distinct", "top_word", "repeated_pairs", "letters", "upper", "digits", "marks", "rare_marks",
    "spaces", "non_ascii", "sentence_ends", "line_words", "repeated_lines", "bare_ends", "long_words", "shouted_words", "marked_words", "lone_marks",
)

_CLASS = np.zeros(256, np.int64)
_CLASS[[*range(0x61, 0x7B)]] = 1
_CLASS[[*range(0x41, 0x5B)]] = 2
_CLASS[[*range(0x30, 0x3A)]] = 3
_CLASS[[ord(c) for c in ".,;:'\"-()"]] = 4
_CLASS[[ord(c) for c in "!?#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_CLASS[[0x20, *range(0x09, 0x0E)]] = 6
_CLASS[0x80:] = 7


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text, in the order of ``FEATURES``."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    size, n = len(data), len(words)
    kinds = np.bincount(_CLASS, np.bincount(np.frombuffer(data, np.uint8), minlength=256), 8) / size
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = data.split(b"\n")
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    ends = sum(data.count(c) for c in (b". ", b".\n", b"? ", b"! ")) + data.endswith(b".")
    letters = kinds[1] + kinds[2] + kinds[7]
    distinct = list(counts)
    share = lambda test: sum(counts[w] for w in distinct if test(w)) / n
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        len(counts) / n,
        max(counts.values()) / n,
        repeats / n,
        letters,
        kinds[2] / max(letters, 1e-9),
        kinds[3],
        kinds[4],
        kinds[5],
        kinds[6],
        kinds[7],
        ends / n,
        float(np.log1p(n / len(lines))),
        1 - len(set(lines)) / len(lines),
        sum(1 for x in lines if x and x[-1:] not in b".!?") / len(lines),
        share(lambda w: len(w) > 14),
        share(lambda w: len(w) > 1 and w.isupper()),
        share(lambda w: w[-1] in b"!#$%&*"),
        share(lambda w: len(w) == 1 and not w.isalnum()),
    ]


@dataclass
class AdditiveModel:
    """Lookup tables: one a feature, one a chosen pair of features."""

    edges: list[np.ndarray]  # borders of each feature's bins
    coarse: list[np.ndarray]  # for each feature, the pair bin of each bin
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)

    def logits(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.intercept)
        for j, t in enumerate(self.tables):
            total += t[bins[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[self.coarse[i][bins[:, i]], self.coarse[j][bins[:, j]]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(self.bins(x)), -30, 30)))


def _shallow_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """A step function over ordered bins: a tree of at most ``leaves`` leaves, best split first."""
    g, w = np.r_[0, np.cumsum(gradient)], np.r_[0, np.cumsum(weight)]
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (w[b] - w[a] + 1.0)
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            cuts = np.arange(a + 1, b)
            cuts = cuts[(w[cuts] - w[a] >= least) & (w[b] - w[cuts] >= least)]
            if len(cuts):
                gains = worth(a, cuts) + worth(cuts, b) - worth(a, b)
                m = int(np.argmax(gains))
                if gains[m] > best[0]:
                    best = (gains[m], k, int(cuts[m]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + 1.0)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a pair's bins into four: what it explains, and its values."""
    g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    w = np.pad(weight.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    best, table_ = (0.0, (0, 0)), np.zeros(gradient.shape)
    rows, cols = gradient.shape

    def quarter(s: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
        a = s[i, j]
        return a, s[i, cols] - a, s[rows, j] - a, s[rows, cols] - s[i, cols] - s[rows, j] + a

    i, j = np.meshgrid(np.arange(1, rows), np.arange(1, cols), indexing="ij")
    if i.size:
        gain = sum(x**2 / (y + 1.0) for x, y in zip(quarter(g, i, j), quarter(w, i, j), strict=True)) - g[-1, -1] ** 2 / (w[-1, -1] + 1.0)
        m = np.unravel_index(int(np.argmax(gain)), gain.shape)
        best = float(gain[m]), (int(i[m]), int(j[m]))
        values = [x / (y + 1.0) for x, y in zip(quarter(g, *best[1]), quarter(w, *best[1]), strict=True)]
        a, b = best[1]
        table_[:a, :b], table_[:a, b:], table_[a:, :b], table_[a:, b:] = values
    return best[0], table_


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, rounds: int = 150, rate: float = 0.1, leaves: int = 4, pairs: int = 8, pair_bins: int = 8, pair_rounds: int = 60) -> AdditiveModel:
    """Cyclic boosting on the logistic loss, single features first, then the strongest pairs."""
    share = float(y.mean()) if len(y) else 0.5
    empty = not len(y) or share in (0.0, 1.0)
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], quantiles)) if len(x) else np.empty(0) for j in range(x.shape[1])]
    coarse = [np.arange(len(e) + 1) * min(pair_bins, len(e) + 1) // (len(e) + 1) for e in edges]
    start = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6))))
    model = AdditiveModel(edges, coarse, start, [np.zeros(len(e) + 1) for e in edges])
    if empty:
        return model
    b = model.bins(x)
    logit = np.full(len(y), start)
    residual = lambda: (p := 1 / (1 + np.exp(-logit)), y - p, p * (1 - p))[1:]
    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            r, h = residual()
            step = rate * _shallow_tree(np.bincount(b[:, j], r, len(t)), np.bincount(b[:, j], h, len(t)), leaves, 1.0)
            t += step
            logit += step[b[:, j]]
    r, h = residual()
    joint, found = {}, []
    for i, j in combinations(range(len(edges)), 2):
        shape = int(coarse[i][-1]) + 1, int(coarse[j][-1]) + 1
        joint[i, j] = (coarse[i][b[:, i]] * shape[1] + coarse[j][b[:, j]], shape)
        cell, size = joint[i, j][0], shape[0] * shape[1]
        found.append((-_quadrants(np.bincount(cell, r, size).reshape(shape), np.bincount(cell, h, size).reshape(shape))[0], (i, j)))
    model.pairs = [p for _, p in sorted(found)[:pairs]]
    model.pair_tables = [np.zeros(joint[p][1]) for p in model.pairs]
    for _ in range(pair_rounds):
        for p, t in zip(model.pairs, model.pair_tables, strict=True):
            cell, shape = joint[p]
            r, h = residual()
            step = rate * _quadrants(np.bincount(cell, r, t.size).reshape(shape), np.bincount(cell, h, t.size).reshape(shape))[1]
            t += step
            logit += step.reshape(-1)[cell]
    # Tables are centred, so that each says how far its feature moves a text from the average.
    for j, t in enumerate(model.tables):
        mean = float(t[b[:, j]].mean())
        t -= mean
        model.intercept += mean
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def with_features(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and the features of column text."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([features(t.as_py()) for t in batch.column(0)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(list(found), pa.list_(pa.float64()))], [*columns, "features"])

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in columns)
    return docs.select("text", *columns).mapInArrow(build, schema + "features array<double>")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> AdditiveModel:
    """A model of ``label`` (0 or 1) from the labelled rows that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    known = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_rows).withColumnRenamed("doc_id", "labelled")
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("labelled"))
    # A doc_id that the documents list several times is learnt from once, so the bound holds.
    single = with_features(rows, "doc_id", "label").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("features").alias("features"))
    found = single.toPandas().sort_values("doc_id")
    x = np.array(found["features"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, found["label"].to_numpy(np.float64))


def classify(docs: DataFrame, model: AdditiveModel, *columns: str) -> DataFrame:
    """The named columns of every row of ``docs`` and the score of its whole text."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(read.index("text"))]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(model.score(x))], [*columns, "score"])

    read = [*columns, *(["text"] if "text" not in columns else [])]
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in columns)
    return docs.select(*read).mapInArrow(build, schema + "score double")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    scored = classify(docs, model, "doc_id")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
