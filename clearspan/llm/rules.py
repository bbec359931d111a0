"""Quality rules as weak supervision.

Each rule votes good or bad on a document or abstains. The votes of all documents are counted by pattern;
expectation-maximisation over the counts estimates how often each rule votes which way on good and on
bad documents; a document is kept if its posterior probability of being good is high enough.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.llm.common import SPACE, kept_once, let, text_of, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEATED_PER_CENT = 50
WINDOW = 3

GOOD, BAD, ABSTAIN = 1, -1, 0

#: A vote is a comparison of two integer expressions of the base values: (rule, bad if, good if).
#: The same text is valid in Spark and in the SQL the query is checked against.
#: A rule that finds no fault abstains, unless having none of it speaks for a document.
RULES = {
    "symbols_per_word": ("n_symbols * 4 > n_words", "n_symbols * 20 <= n_words"),
    "symbols_per_char": ("n_symbols * 20 > word_chars", "n_symbols * 100 <= word_chars"),
    "repetition": ("n_repeat_words * 100 > 30 * n_words", "n_repeat_words * 100 <= 5 * n_words"),
    "dup_lines": ("n_dup_lines >= 3 AND n_dup_lines * 200 > n_words", "FALSE"),
    "word_length": ("word_chars > 14 * n_words OR word_chars < 2 * n_words", "FALSE"),
    "length": ("n_words < 60 AND n_symbols * 2 > n_words", "n_words >= 100"),
}

#: Beliefs before any vote: share of good documents, how a rule votes on each class, and their weight in documents.
PRIOR_GOOD = 0.9
PRIOR_VOTES = {"good": {GOOD: 0.60, BAD: 0.02, ABSTAIN: 0.38}, "bad": {GOOD: 0.25, BAD: 0.40, ABSTAIN: 0.35}}
PRIOR_WEIGHT = 0.2
ROUNDS = 25
THRESHOLD = 0.5


def base_values(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """Columns ``keep``, then ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the whole text."""
    text = text_of()
    split = docs.select(*keep, text.alias("__text"), words_of(text).alias("__words"))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    return split.select(
        *split.columns[: len(keep)],
        F.size("__words").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("__text", f"[{SPACE}]+", "")).cast("bigint").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        let(F.col("__words"), lambda w: repeated_words(w)).cast("bigint").alias("n_repeat_words"),
    )


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more, in n log n.

    The windows are sorted by hash; neighbours that are equal repeat. Hashes have 64 bits.
    """
    n = F.size(words) - F.lit(window - 1)
    starts = F.sequence(F.lit(0), n - 1)
    keyed = F.transform(
        starts, lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(window)]).alias("h"), i.alias("at"))
    )
    return F.when(n < 2, F.lit(0)).otherwise(
        let(
            F.sort_array(keyed),
            lambda s: F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            F.filter(
                                F.transform(
                                    s,
                                    lambda e, j: F.when(
                                        (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]), e["at"]
                                    ),
                                ),
                                lambda at: at.isNotNull(),
                            ),
                            lambda at: F.sequence(at, at + F.lit(window - 1)),
                        )
                    )
                )
            ),
        )
    )


def votes(base: DataFrame) -> DataFrame:
    """``base`` with one vote column per rule; documents that failed the base rules are not asked."""
    named = [F.expr(f"CASE WHEN {bad} THEN {BAD} WHEN {good} THEN {GOOD} ELSE {ABSTAIN} END").alias(f"vote_{rule}") for rule, (bad, good) in RULES.items()]
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED_PER_CENT} * n_words")
    return base.select("*", failed.alias("base_failed"), *named)


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[dict[str, dict[int, float]]]]:
    """Share of good documents, and per rule the chance of each vote by class, from counted vote patterns.

    There are at most 3 to the power of the number of rules patterns, whatever the number of documents. The
    beliefs above count as ``PRIOR_WEIGHT`` of the documents, which keeps the two classes what their names say.
    """
    total = sum(n for _, n in patterns)
    good, chances = PRIOR_GOOD, [PRIOR_VOTES for _ in RULES]
    if not total:
        return good, chances
    weight = PRIOR_WEIGHT * total
    for _ in range(rounds):
        shares = [(votes_, n, posterior(votes_, good, chances)) for votes_, n in patterns]
        mass = {"good": sum(n * p for _, n, p in shares), "bad": sum(n * (1 - p) for _, n, p in shares)}
        belief = {"good": weight * PRIOR_GOOD, "bad": weight * (1 - PRIOR_GOOD)}
        good = (mass["good"] + belief["good"]) / (total + weight)
        updated = []
        for r in range(len(RULES)):
            by_class = {}
            for kind in ("good", "bad"):
                seen = {v: 0.0 for v in (GOOD, BAD, ABSTAIN)}
                for votes_, n, p in shares:
                    seen[votes_[r]] += n * (p if kind == "good" else 1 - p)
                by_class[kind] = {v: (seen[v] + belief[kind] * PRIOR_VOTES[kind][v]) / (mass[kind] + belief[kind]) for v in seen}
            updated.append(by_class)
        chances = updated
    return good, chances


def log_odds(good: float, chances: list[dict[str, dict[int, float]]]) -> tuple[float, list[dict[int, float]]]:
    """Log odds of a good document before any vote, and what each vote of each rule adds."""
    return math.log(good / (1 - good)), [{v: math.log(c["good"][v] / c["bad"][v]) for v in (GOOD, BAD, ABSTAIN)} for c in chances]


def posterior(pattern: tuple[int, ...], good: float, chances: list[dict[str, dict[int, float]]]) -> float:
    start, steps = log_odds(good, chances)
    return 1 / (1 + math.exp(-(start + sum(s[v] for s, v in zip(steps, pattern, strict=True)))))


def quality_of(judged: DataFrame) -> Column:
    """Posterior probability of a good document as a column over the votes, estimated from all rows of ``judged``."""
    names = [f"vote_{rule}" for rule in RULES]
    counted = judged.where("NOT base_failed").groupBy(*names).count().collect()  # at most 3^rules rows
    good, chances = estimate(sorted((tuple(r[n] for n in names), r["count"]) for r in counted))
    start, steps = log_odds(good, chances)
    odds = F.lit(start)
    for name, step in zip(names, steps, strict=True):
        odds = odds + F.when(F.col(name) == GOOD, step[GOOD]).when(F.col(name) == BAD, step[BAD]).otherwise(step[ABSTAIN])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def judge_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, the base values, ``base_failed``, ``quality`` (posterior) and ``kept``.

    A null or empty text has no words and fails the base rules. Rows are judged one by one, repeated rows
    alike; a null ``doc_id`` stays null. Other columns of ``docs`` are neither read nor returned. An empty
    table gives none.
    """
    # Kept, as the texts would be split once for the counts and once for the result.
    base = kept_once(base_values(docs, [F.col("doc_id")]))
    judged = votes(base)
    scored = judged.select(*base.columns, "base_failed", quality_of(judged).alias("quality"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def accepted(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``judge_documents`` keeps."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    judged = votes(base_values(docs, [whole]))
    quality = quality_of(judged)
    return judged.where(~F.col("base_failed") & (quality >= threshold)).select("__row.*")
