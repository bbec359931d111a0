"""Language of documents by hierarchical discrimination.

The family of languages is decided first, then the language within it. Both levels are linear support vector
machines, one for each pair of families and for each pair of languages of a family, on hashed runs of two to four
bytes of the text. Each machine is trained in a task of its own on a bounded sample of texts, so closely related languages
are told apart by a machine that has seen nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clearspan.llm.batches import chunks
from clearspan.llm.common import HASH_RANGE, kept_once, key_hash

#: Families of languages by ISO 639-1 code. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi".split(),
    "romance": "ca es fr gl it la oc pt ro".split(),
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk".split(),
    "baltic": "lt lv".split(),
    "celtic": "br cy ga gd".split(),
    "uralic": "et fi hu".split(),
    "turkic": "az kk ky tr tt uz".split(),
    "indic": "as bn gu hi mr ne or pa sd si ur".split(),
    "iranian": "fa ku ps tg".split(),
    "semitic": "am ar he mt".split(),
    "dravidian": "kn ml ta te".split(),
    "malayic": "id jv ms su".split(),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

#: A machine learns from at most so many texts of each side, chosen by a hash.
MAX_TEXTS = 2_000
#: Hashed features, and the lengths of the runs of bytes.
BINS, RUNS = 8_192, (2, 3, 4)
#: Cost of an error and passes of the training.
COST, PASSES = 4.0, 12
#: Texts whose features are held at once as full rows.
BLOCK = 256
#: Long texts are counted piece by piece.
PIECE_BYTES = 4_000_000

UNDETERMINED = "und"
_FACTORS = np.random.default_rng(11).integers(1, 2**31, max(RUNS), dtype=np.uint32) | np.uint32(1)
#: ASCII outside of letters separates words; other bytes stay.
_LETTERS = bytes(c if chr(c).isalpha() or c >= 0x80 else 0x20 for c in range(256))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the CRC-32 of the id's text is ``fold`` modulo ``folds``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language.lower().replace("_", "-").split("-")[0], language)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _runs(data: bytes) -> Iterator[np.ndarray]:
    """Bins of the runs of bytes of one text, each word between spaces, piece by piece."""
    cleaned = b" " + b" ".join(data.translate(_LETTERS).split()) + b" "
    for start in range(0, max(len(cleaned) - 1, 1), PIECE_BYTES):
        part = np.frombuffer(cleaned[start : start + PIECE_BYTES + max(RUNS) - 1], dtype=np.uint8).astype(np.uint32) + np.uint32(1)
        total = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, max(RUNS) + 1):
            total = total[: len(part) - n + 1] + part[n - 1 :] * _FACTORS[n - 1] if len(part) >= n else total[:0]
            # Runs that begin in the next piece are its own.
            if n in RUNS:
                mixed = (total[:PIECE_BYTES] ^ (total[:PIECE_BYTES] >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)
                yield (mixed >> np.uint32(32 - (BINS - 1).bit_length())).astype(np.int64)


def features(texts: list[str]) -> np.ndarray:
    """One row per text: the logarithm of the count of each bin, scaled to length 1; rows of 0 for texts without runs."""
    x = np.zeros((len(texts), BINS), dtype=np.float32)
    for row, text in zip(x, texts, strict=True):
        for bins in _runs(text.lower().encode("utf-8", "surrogatepass")):
            row += np.bincount(bins, minlength=BINS).astype(np.float32)
    np.log1p(x, out=x)
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(size > 0, size, 1)


def train_machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> np.ndarray:
    """Weights and offset of a linear support vector machine with squared hinge loss, by dual coordinate descent.

    ``rows`` are sparse, as bins and values; ``y`` is 1 or -1. The rarer side weighs as much as the other.
    """
    w = np.zeros(BINS + 1)
    share = {s: len(y) / (2 * max((y == s).sum(), 1)) for s in (-1, 1)}
    slack = np.array([1 / (2 * COST * share[s]) for s in y.tolist()])
    alpha = np.zeros(len(y))
    size = np.array([float(v @ v) + 1 for _, v in rows]) + slack
    order = np.random.default_rng(5)
    for _ in range(PASSES):
        for i in order.permutation(len(y)).tolist():
            bins, values = rows[i]
            slope = y[i] * (w[bins] @ values + w[BINS]) - 1 + slack[i] * alpha[i]
            new = max(alpha[i] - slope / size[i], 0.0)
            step = (new - alpha[i]) * y[i]
            if step:
                w[bins] += step * values
                w[BINS] += step
                alpha[i] = new
    return w


@dataclass
class Model:
    """Machines by level: ``(left, right)`` and weights, positive for left."""

    families: dict[str, list[str]] = field(default_factory=dict)
    machines: dict[tuple[str, str, str], np.ndarray] = field(default_factory=dict)

    def _choose(self, x: np.ndarray, level: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The name with most votes for each row, ties by the summed margins, and its mean probability over its machines."""
        if len(names) == 1:
            return np.zeros(len(x), dtype=int), np.ones(len(x))
        votes, margins, sure = (np.zeros((len(x), len(names))) for _ in range(3))
        for a, left in enumerate(names):
            for b, right in enumerate(names[a + 1 :], a + 1):
                w = self.machines[level, left, right]
                margin = x @ w[:BINS].astype(np.float32) + w[BINS]
                p = 1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))
                votes[:, a] += margin >= 0
                votes[:, b] += margin < 0
                margins[:, a] += margin
                margins[:, b] -= margin
                sure[:, a] += p
                sure[:, b] += 1 - p
        order = np.lexsort((-margins, -votes), axis=1)[:, 0]
        return order, sure[np.arange(len(x)), order] / (len(names) - 1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores; the score is that of the family times that of the language within it."""
        found, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.families else []
        names = sorted(self.families)
        for start in range(0, len(known), BLOCK):
            rows = np.array(known[start : start + BLOCK])
            x = features([texts[i] for i in rows.tolist()])
            family, sure = self._choose(x, "", names)
            for k, name in enumerate(names):
                inside = np.flatnonzero(family == k)
                if len(inside):
                    language, p = self._choose(x[inside], name, self.families[name])
                    scores[rows[inside]] = sure[inside] * p
                    for i, which in zip(rows[inside].tolist(), language.tolist()):
                        found[i] = self.families[name][which]
        return found, scores


def _sparse_features(rows: DataFrame) -> DataFrame:
    """``lang, family, pick`` and the bins and values that are not 0 of the text."""
    schema = "lang string, family string, pick long, bins array<int>, values array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            languages, picks = part.column("lang").to_pylist(), part.column("pick")
            bins, values = [], []
            for start in range(0, len(texts), BLOCK):
                for row in features([t.decode() for t in texts[start : start + BLOCK]]):
                    bins.append(np.flatnonzero(row).astype(np.int32))
                    values.append(row[bins[-1]])
            columns = [part.column("lang"), pa.array([family_of(x) for x in languages]), picks, pa.array(bins, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "family", "pick", "bins", "values"])

    return rows.select("lang", "pick", "text").mapInArrow(run, schema)


def sampled(docs: DataFrame, max_texts: int) -> DataFrame:
    """``lang, pick, text`` of about ``max_texts`` texts of each language, the least by a hash of id and text.

    How many rows a language has is counted first, so that only about twice the sample is read and shuffled.
    """
    usable = docs.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id"), docs["text"].cast("string").alias("text"))
    usable = usable.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Broadcast: one row per language. Joined by shuffle, all texts would be dealt by language first.
    share = usable.groupBy("lang").agg(F.least(F.lit(2.0) * max_texts / F.count("*"), F.lit(1.0)).alias("share"))
    pick = key_hash(F.col("doc_id"), 13)
    chosen = usable.withColumn("pick", pick).join(F.broadcast(share.withColumnRenamed("lang", "__lang")), F.col("lang") == F.col("__lang"))
    chosen = chosen.where(F.col("pick") < F.col("share") * HASH_RANGE).select("lang", "pick", "text")
    best = Window.partitionBy("lang").orderBy("pick", F.xxhash64("text"), "text")
    return chosen.withColumn("__n", F.row_number().over(best)).where(F.col("__n") <= max_texts).drop("__n")


def train(docs: DataFrame, max_texts: int = MAX_TEXTS) -> Model:
    """Machines for all pairs of families, and of languages within a family, from the rows of ``docs``.

    Rows without language, letters or text teach nothing. A side of a machine has at most ``max_texts`` texts;
    for a family they are the least by hash over its languages, an equal number of each.
    """
    rows = kept_once(_sparse_features(sampled(docs, max_texts)))
    # One row per language, then one per machine: the driver gets no texts.
    languages = sorted((r["family"], r["lang"]) for r in rows.select("family", "lang").distinct().collect())
    model = Model()
    for family, language in languages:
        model.families.setdefault(family, []).append(language)
    names = sorted(model.families)
    pairs = [("", a, b) for k, a in enumerate(names) for b in names[k + 1 :]]
    pairs += [(f, a, b) for f in names for k, a in enumerate(model.families[f]) for b in model.families[f][k + 1 :]]
    if not pairs:
        return model
    spark = docs.sparkSession
    table = spark.createDataFrame([(n, *p) for n, p in enumerate(pairs)], "machine int, level string, left string, right string")
    in_turn = Window.partitionBy("lang").orderBy("pick", F.xxhash64("bins", "values"))
    by_family = Window.partitionBy("family").orderBy("turn", "pick", "lang")
    ranked = rows.withColumn("turn", F.row_number().over(in_turn)).withColumn("place", F.row_number().over(by_family))
    sides = ranked.where(F.col("place") <= max_texts).withColumns({"level": F.lit(""), "side": F.col("family")}).unionByName(
        ranked.withColumns({"level": F.col("family"), "side": F.col("lang")})
    ).drop("lang", "family", "place")
    pair = F.broadcast(table.withColumnRenamed("level", "__level"))
    taught = sides.join(pair, (F.col("level") == F.col("__level")) & F.col("side").isin(F.col("left"), F.col("right")))
    taught = taught.select("machine", F.when(F.col("side") == F.col("left"), 1).otherwise(-1).alias("y"), "turn", "pick", "bins", "values")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["y", "turn", "pick"], kind="stable")
        sparse = [(np.asarray(b), np.asarray(v, dtype=np.float64)) for b, v in zip(rows["bins"], rows["values"])]
        return pd.DataFrame({"machine": [rows["machine"].iloc[0]], "weights": [train_machine(sparse, rows["y"].to_numpy())]})

    for row in taught.groupBy("machine").applyInPandas(fit, "machine int, weights array<double>").toLocalIterator():
        model.machines[pairs[row["machine"]]] = np.array(row["weights"])
    return model


def predict_languages(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Null texts and texts without a letter are ``und`` with score 0, as is every text where no language was
    learned. Repeated rows are judged each; a null ``doc_id`` stays null and is not held out. Whole texts
    count, whatever their length. An empty table gives no rows. Nothing but the text enters a prediction, and other columns
    are neither read nor returned.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches):
            languages, scores = model.predict([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(languages, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    found = docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, schema)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
