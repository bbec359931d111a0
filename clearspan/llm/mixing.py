"""Mixing sources to target weights by a curriculum that varies over the training run.

Every source has a weight schedule over training time 0 to 1. Its integral up to a time is the source's
token demand so far. A document lies at some cumulated token of its source, and the demand, inverted at that
token, says when it is trained on. Sources in demand beyond their size are passed over several times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.llm.common import HASH_RANGE, buckets_for, kept_once, key_hash, prefix_sums, text_of, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Schedules in turn, as relative weights at equally spaced times: fading out, steady, fading in.
SCHEDULES = ((3.0, 1.0), (1.0, 1.0), (1.0, 3.0))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, source_rows, rank, target`` from per-source sizes.

    Sources in code point order, null last, take the weights in turn. All tokens are shared out by weight; no
    source gets more than ``max_repeats`` times its size, and what that leaves over goes to the others by weight.
    The sources that reach their limit are those with the least limit per weight, so one ordered pass finds them.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank"), F.lit(len(weights))))
    limited = ranked.withColumn("__w", weight).withColumn("__limit", F.col("source_size") * F.lit(float(max_repeats)))
    # Integer-valued doubles: sums of limits and weights are exact in any order.
    by_need = Window.orderBy(F.col("__limit") / F.col("__w"), F.col("rank"))
    earlier, everything = by_need.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = limited.select(
        "*",
        F.coalesce(F.sum("__limit").over(earlier), F.lit(0.0)).alias("__limits_before"),
        F.coalesce(F.sum("__w").over(earlier), F.lit(0.0)).alias("__w_before"),
        F.sum("source_size").over(everything).cast("double").alias("__all"),
        F.sum("__w").over(everything).alias("__w_all"),
    )
    # Share per weight if exactly the sources before this one stop at their limit.
    level = (F.col("__all") - F.col("__limits_before")) / (F.col("__w_all") - F.col("__w_before"))
    found = F.struct((F.col("__limit") / F.col("__w")).alias("need"), F.col("rank"), level.alias("level"))
    first_open = F.min(F.when(level * F.col("__w") <= F.col("__limit"), found)).over(everything)["level"]
    target = F.least(F.col("__limit"), F.coalesce(first_open, level) * F.col("__w"))
    return totals.select("source", "source_size", "source_rows", "rank", target.alias("target"))


def time_of(share: Column, schedule: tuple[float, ...]) -> Column:
    """The time when a share (0 to 1) of a piecewise-linear schedule's whole demand is reached."""
    steps = len(schedule) - 1
    areas = [(a + b) / 2 / steps for a, b in zip(schedule, schedule[1:], strict=False)]
    whole, before, found = sum(areas), 0.0, None
    for i, area in enumerate(areas):
        a, slope = schedule[i], (schedule[i + 1] - schedule[i]) * steps
        rest = share * F.lit(whole) - F.lit(before)
        # a x + slope x^2 / 2 = rest, in the form that also holds for a slope of 0.
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * rest, F.lit(0.0)))
        x = F.lit(2.0) * rest / F.greatest(F.lit(a) + root, F.lit(1e-300))
        here = F.lit(i / steps) + F.least(F.greatest(x, F.lit(0.0)), F.lit(1 / steps))
        inside = share * F.lit(whole) < F.lit(before + area)
        found = F.when(inside, here) if found is None else found.when(inside, here)
        before += area
    return found.otherwise(F.lit(1.0))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, schedules=SCHEDULES, keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, rank, passes`` and the columns ``keep``.

    ``size`` is the number of words (null text: 0). ``passes`` lists the document's occurrences in the mix as
    ``(words, position)``, position being the training time from 0 to 1; ``taken`` is the sum of their words.
    Every source is passed over in the order of a hash until its target is reached, so only its last
    occurrence can be cut short. Rows with equal ``doc_id`` and size lie side by side, in any order; a null
    ``source`` is a source; empty texts have an empty list, texts of any length are counted whole, and an empty table gives
    no rows. Other columns are neither read nor returned.
    """
    # Kept: words are counted once, and every later step works on three narrow columns.
    sized = kept_once(docs.select("doc_id", F.col("source"), word_count(text_of()).alias("size"), *keep))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    targets = source_targets(sizes, weights, max_repeats).withColumnRenamed("source", "__source")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    joined = joined.withColumn("__order", key_hash(F.col("doc_id")))
    share = F.col("__order") / F.lit(HASH_RANGE)
    joined = joined.withColumn("__bucket", F.floor(share * buckets_for(F.col("source_rows"))))
    order = [F.col("__order"), F.col("doc_id"), F.col("size")]
    placed = prefix_sums(joined, ["rank"], "__bucket", order, F.col("size"), "__before")

    end = F.round(F.col("target")).cast("bigint")
    schedule_no = F.pmod(F.col("rank"), F.lit(len(schedules)))

    def occurrence(p: Column) -> Column:
        first = F.col("__before") + p * F.col("source_size")
        words = F.least(F.greatest(end - first, F.lit(0)), F.col("size")).cast("bigint")
        share = (first + words / F.lit(2.0)) / F.nullif("target", F.lit(0.0))
        time = F.when(schedule_no == 0, time_of(share, schedules[0]))
        for i, schedule in enumerate(schedules[1:], 1):
            time = time.when(schedule_no == i, time_of(share, schedule))
        return F.struct(words.alias("words"), time.alias("position"))

    every = F.array(*[occurrence(F.lit(p)) for p in range(max_repeats)])
    listed = placed.withColumn("passes", F.filter(every, lambda o: o["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda total, o: total + o["words"])
    return listed.select(
        "doc_id", "source", "size", F.col("source_size").cast("bigint").alias("source_size"), "target", taken.alias("taken"), "rank", "passes",
        *sized.columns[3:],
    )


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per occurrence, sorted by training position over range partitions."""
    single = mixed.select("*", F.posexplode("passes").alias("pass", "__o")).select(
        *[c for c in mixed.columns if c != "passes"], "pass", F.col("__o.words").alias("words"), F.col("__o.position").alias("position")
    )
    return single.repartitionByRange("position", "doc_id", "pass").sortWithinPartitions("position", "doc_id", "pass")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix takes them, in training order.

    An occurrence counts if at least half of the document's words are taken, and is then whole. Rows of equal
    ``doc_id``, ``source`` and text take the places of their kind in any order.
    """
    digest = F.md5(F.encode(text_of(), "UTF-8"))
    keys = ["__id", "__source", "__digest"]
    alike = Window.partitionBy(*keys).orderBy("__id")
    mixed = mix(docs, keep=(digest.alias("__digest"),), **options)
    taken = F.filter("passes", lambda o: o["words"] * 2 >= F.col("size"))
    wanted = mixed.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), "__digest", taken.alias("__passes"))
    wanted = wanted.withColumn("__n", F.row_number().over(alike)).where(F.size("__passes") > 0)
    wanted = wanted.select(*[F.col(k).alias(f"{k}_") for k in [*keys, "__n"]], "__passes")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
        digest.alias("__digest"),
    ).withColumn("__n", F.row_number().over(alike))
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in [*keys, "__n"]]
    joined = rows.join(wanted, same).select("__row", "__id", F.explode("__passes").alias("__o"))
    ordered = joined.withColumn("__at", F.col("__o.position")).repartitionByRange("__at", "__id").sortWithinPartitions("__at", "__id")
    return ordered.select("__row.*")
