"""Quality scores by a generalised additive model with pairwise interactions.

Every feature has a lookup table over its bins, and a few pairs of features have one over both. The tables are
learned by boosting shallow trees on one feature, or pair, after the other, round by round. A score adds
up one entry per table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clearspan.llm.batches import Words, chunks, windows
from clearspan.llm.common import key_hash

#: Labelled rows the model is fitted on at most, chosen by a hash of the id. The sample is bounded; scores cover all rows.
MAX_TRAINING_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 120, 60, 0.1, 2.0
THRESHOLD = 0.3

FEATURES = (
    "words", "word_bytes", "symbols", "capitals", "digits", "exclamations", "bars", "punctuation", "lines", "high_bytes",
    "different_words", "repeated_windows", "repeated_lines",
)
SYMBOLS, PUNCTUATION = b"#*$%&<>", b".,;:?'\"()-"


def _share(data: np.ndarray, members, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)
    table[list(members)] = 1
    sums = np.concatenate([[0], np.cumsum(table[data])])
    return (sums[starts + sizes] - sums[starts]) / np.maximum(sizes, 1)


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text, one column per feature, from the whole text alone."""
    words = Words(texts)
    starts, sizes = words.text_starts, words.text_ends - words.text_starts
    hashes = words.hashes()
    grams = windows(hashes, 3)
    different, repeated, lines = np.ones(len(texts)), np.zeros(len(texts)), np.zeros(len(texts))
    for i, (first, n) in enumerate(zip(words.first, words.counts, strict=False)):
        if n:
            different[i] = len(np.unique(hashes[first : first + n])) / n
        if n > 3:
            repeated[i] = 1 - len(np.unique(grams[first : first + n - 2])) / (n - 2)
        split = [line for line in texts[i].split(b"\n") if line.strip()]
        lines[i] = 1 - len(set(split)) / max(len(split), 1)
    of = lambda members: _share(words.data, members, starts, sizes)
    spaces = of(b" \t\n\r\x0b\x0c")
    return np.column_stack(
        [
            np.log1p(words.counts), (1 - spaces) * sizes / np.maximum(words.counts, 1), of(SYMBOLS), of(range(65, 91)), of(range(48, 58)),
            of(b"!"), of(b"|"), of(PUNCTUATION), of(b"\n") * sizes / np.maximum(words.counts, 1), of(range(128, 256)), different, repeated, lines,
        ]
    )


@dataclass
class Model:
    """Bin edges and tables per feature, and per pair of features on coarser bins."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)] * len(FEATURES))
    coarse: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)] * len(FEATURES))
    tables: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1)] * len(FEATURES))
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1, by adding up the entries of the bins."""
        total = np.full(len(x), self.start)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="left")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.coarse[a], x[:, a], side="left"), np.searchsorted(self.coarse[b], x[:, b], side="left")]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cut points, half at equal numbers of rows and half at equal numbers of distinct values.

    A value belongs to the bin that ends at it, so one that most rows share has a bin apart from the rest.
    """
    cuts = np.linspace(0, 1, bins // 2 + 1)[:-1]
    return np.unique([np.quantile(v, cuts, method="lower") for v in (values, np.unique(values))])


def _leaf(g, h):
    return -g / (h + RIDGE)


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree that cuts the bins ``depth`` times, each cut where it gains most."""
    whole_g, whole_h = g.sum(), h.sum()
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = _gain(left_g, left_h) + _gain(whole_g - left_g, whole_h - left_h) - _gain(whole_g, whole_h)
        cut = int(np.argmax(gains)) + 1
        if gains[cut - 1] > 1e-9:
            return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])
    return np.full(len(g), _leaf(whole_g, whole_h))


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best single cut of both features of a pair: its gain and the value of each cell."""
    sums = [np.cumsum(np.cumsum(v, 0), 1) for v in (g, h)]
    best, values = 0.0, np.zeros_like(g)
    whole = [s[-1, -1] for s in sums]
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            parts = []
            for s, w in zip(sums, whole, strict=True):
                a, b, c = s[i, j], s[i, -1] - s[i, j], s[-1, j] - s[i, j]
                parts.append((a, b, c, w - a - b - c))
            gain = sum(_gain(x, y) for x, y in zip(*parts, strict=True)) - _gain(*whole)
            if gain > best:
                best = gain
                leaves = [_leaf(x, y) for x, y in zip(*parts, strict=True)]
                values = np.empty_like(g)
                values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = leaves
    return best, values


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Learn the tables from feature rows and labels 0 or 1. Without rows every score is 0.5."""
    model = Model()
    if not len(y):
        return model
    model.start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    n = x.shape[1]
    model.edges, model.coarse = [_edges(x[:, f], BINS) for f in range(n)], [_edges(x[:, f], PAIR_BINS) for f in range(n)]
    bins = [np.searchsorted(model.edges[f], x[:, f], side="left") for f in range(n)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.start)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(n):
            g, h = slopes()
            size = len(model.tables[f])
            step = RATE * _tree(np.bincount(bins[f], g, size), np.bincount(bins[f], h, size))
            model.tables[f] += step
            total += step[bins[f]]

    coarse = [np.searchsorted(model.coarse[f], x[:, f], side="left") for f in range(n)]
    shape = {f: len(model.coarse[f]) + 1 for f in range(n)}

    def cells(a: int, b: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * shape[b] + coarse[b], values, shape[a] * shape[b]).reshape(shape[a], shape[b])

    g, h = slopes()
    gains = {(a, b): _quadrants(cells(a, b, g), cells(a, b, h))[0] for a, b in combinations(range(n), 2) if min(shape[a], shape[b]) > 1}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    model.pair_tables = [np.zeros((shape[a], shape[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _quadrants(cells(a, b, g), cells(a, b, h))[1]
            model.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return model


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the CRC-32 of the id's text is 0 modulo ``folds``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def with_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and one column ``x`` with the features of the text."""
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField("x", T.ArrayType(T.DoubleType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches):
            x = features(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), lists], [*keep, "x"])

    return docs.select(*keep, docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold, chosen by a hash of the id.

    Ids or labels that are null are not learned from; of several labels of one id the highest counts, of several texts
    the one with the least hash.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("__quality"))
    chosen = chosen.orderBy(key_hash(F.col("__id")), "__id").limit(max_rows)
    # Broadcast: at most max_rows rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    # One row per id, however often it is repeated.
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    rows = rows.withColumn("__n", F.row_number().over(one)).where("__n = 1")
    found = with_features(rows.select("doc_id", "text", "__quality"), ["doc_id", "__quality"]).orderBy("doc_id", "x").toArrow()
    y = found["__quality"].to_numpy().astype(np.float64)
    x = np.array(found["x"].to_pylist(), dtype=np.float64).reshape(len(y), len(FEATURES))
    return fit(x, y)


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Null and empty texts are scored like any other, from features that are 0. Repeated rows are scored
    each; a null ``doc_id`` stays null and is not held out. Nothing but the text enters a score, and other columns
    are neither read nor returned. Texts of any length are scored whole; an empty table gives no rows.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(model.score(features(texts)))], ["doc_id", "score"])

    scored = docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least ``threshold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches):
            yield rows.filter(pa.array(model.score(features(texts)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
