"""Fee rules as an inverted bitmap index: the first rule, or all rules, that a row meets.

Rules of equal keys are numbered in their order. For every condition the index has a bitmap of rules per listed value,
and one per segment between the bounds of the rules; a row looks up one bitmap per condition, ANDs them and reads the first
bit. Rows never meet rules one by one, and no value or bound of a rule is part of the plan.

The index has one row per key and is computed once, from the rules alone. Rows are reduced first to what the index can tell
apart: listed values and segments.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from math import isqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clearspan.operators.lookup import lookup_join
from clearspan.operators.rules import BOUND, amount_in, is_blank
from clearspan.session import scratch_path

#: Rules per word of a bitmap: words stay positive.
WORD = 63
#: Listed values per bucket of a condition, about.
BUCKET = 4

C = F.col


@dataclass(frozen=True)
class Amounts:
    """An amount condition whose bounds are in the rule's currency: bounds and currency of the rules, and of the
    facts the amount, its currency, the rates from it by currency and, for rules without currency, the plain amount."""

    bounds: str
    rule_currency: str
    amount: str
    currency: str
    rates_to: str
    own: str | None = None


@dataclass(frozen=True)
class Conditions:
    """What rules test: equal keys (fact column -> rule column), parsed token conditions and parsed bounds
    (rule column -> fact column), and amounts."""

    keys: dict[str, str]
    tokens: dict[str, str] = field(default_factory=dict)
    numbers: dict[str, str] = field(default_factory=dict)
    amounts: Amounts | None = None


@dataclass(frozen=True)
class RuleIndex:
    rows: DataFrame
    conditions: Conditions
    payload: T.StructType


_WORDS = "array<bigint>"
_SEGMENTS = "blocks array<array<struct<bound:{kind},strict:boolean>>>, at array<array<bigint>>"


def _index_schema(keys: list[T.StructField], payload: T.StructType, conditions: Conditions) -> T.StructType:
    parsed = T._parse_datatype_string
    token = parsed(f"base {_WORDS}, names array<array<string>>, bits array<array<array<bigint>>>, {_SEGMENTS.format(kind='double')}")
    number = parsed(_SEGMENTS.format(kind=BOUND))
    fields = [T.StructField(f"__ix_k{i}", f.dataType) for i, f in enumerate(keys)]
    fields += [T.StructField("__ix_every", parsed(_WORDS)), T.StructField("__ix_payload", T.ArrayType(payload))]
    fields += [T.StructField(f"__ix_t{i}", token) for i in range(len(conditions.tokens))]
    fields += [T.StructField(f"__ix_n{i}", number) for i in range(len(conditions.numbers))]
    if conditions.amounts:
        amount = T.StructType([T.StructField("currency", T.StringType()), *number.fields])
        fields.append(T.StructField("__ix_amounts", T.ArrayType(amount)))
    return T.StructType(fields)


def _bitmap(bits: np.ndarray) -> np.ndarray:
    """The last axis of booleans as words."""
    n = bits.shape[-1]
    words = -(-n // WORD)
    padded = np.zeros((*bits.shape[:-1], words * WORD), dtype=bool)
    padded[..., :n] = bits
    wide = np.concatenate([padded.reshape(*bits.shape[:-1], words, WORD), np.zeros((*bits.shape[:-1], words, 64 - WORD), dtype=bool)], axis=-1)
    return np.packbits(wide, axis=-1, bitorder="little").view("<i8")[..., 0]


def _segments(n: int, intervals: list[tuple], free: np.ndarray) -> dict:
    """Sorted bounds in blocks, and the rules that hold for a missing value (first) and in each segment.

    ``intervals`` are (rule, lo, lo in, hi, hi in), None for no bound; ``free`` are rules that hold everywhere.
    A bound (value, strict) is reached by larger values, and by equal ones unless it is strict.
    """
    points = sorted({(lo, not lo_in) for _, lo, lo_in, _, _ in intervals if lo is not None} | {(hi, hi_in) for _, _, _, hi, hi_in in intervals if hi is not None})
    first = np.zeros(len(intervals), dtype=np.int64)
    last = np.full(len(intervals), len(points) + 1, dtype=np.int64)
    rule = np.array([i[0] for i in intervals], dtype=np.int64)
    for k, (_, lo, lo_in, hi, hi_in) in enumerate(intervals):
        if lo is not None:
            first[k] = bisect_left(points, (lo, not lo_in)) + 1
        if hi is not None:
            last[k] = bisect_left(points, (hi, hi_in)) + 1
    columns = []
    for start in range(0, n, WORD):
        # Word by word, so that memory follows the bounds.
        width = min(WORD, n - start)
        inside = (rule >= start) & (rule < start + width) & (first < last)
        change = np.zeros((len(points) + 2, width), dtype=np.int32)
        np.add.at(change, (first[inside], rule[inside] - start), 1)
        np.add.at(change, (last[inside], rule[inside] - start), -1)
        holds = (np.cumsum(change, axis=0)[: len(points) + 1] > 0) | free[start : start + width]
        columns.append(_bitmap(np.concatenate([free[None, start : start + width], holds]))[:, 0])
    size = isqrt(len(points)) + 1
    blocks = [[{"bound": b, "strict": s} for b, s in points[k : k + size]] for k in range(0, len(points), size)]
    return {"blocks": blocks, "at": [*np.stack(columns, axis=1)]}


def _token_index(n: int, cells: list[dict | None]) -> dict:
    """Bitmaps of one token condition: ``base`` for values that no rule lists, which listed values flip."""
    base = np.array([c is None or c["negate"] for c in cells], dtype=bool)
    listing: dict[str, list[int]] = {}
    spans = []
    for rule, cell in enumerate(cells):
        if cell:
            for name in dict.fromkeys(cell["values"]):
                listing.setdefault(name, []).append(rule)
            spans += [(rule, s["lo"], True, s["hi"], True) for s in cell["spans"] if s["lo"] is not None and s["hi"] is not None]
    buckets = max(len(listing) // BUCKET, 1)
    names: list[list[str]] = [[] for _ in range(buckets)]
    bits: list[list[list[int]]] = [[] for _ in range(buckets)]
    for name, rules in listing.items():
        flags = np.zeros(n, dtype=bool)
        flags[rules] = True
        bucket = crc32(name.encode()) % buckets
        names[bucket].append(name)
        bits[bucket].append(_bitmap(flags).tolist())
    return {"base": _bitmap(base).tolist(), "names": names, "bits": bits, **_segments(n, spans, np.zeros(n, dtype=bool))}


def _number_index(n: int, cells: list[dict | None]) -> dict:
    intervals = [(rule, c["lo"], c["lo_in"], c["hi"], c["hi_in"]) for rule, c in enumerate(cells) if c is not None]
    # Text that gives no bound holds for every number and for a missing one.
    free = np.array([c is None or (c["lo"] is None and c["hi"] is None) for c in cells], dtype=bool)
    return _segments(n, [i for i in intervals if i[1] is not None or i[3] is not None], free)


def _amounts_index(n: int, cells: list[dict | None], currencies: list[str | None]) -> list[dict]:
    """Bounds by currency; the empty currency stands for rules that have none."""
    found = {}
    for currency in sorted({c or "" for c, cell in zip(currencies, cells) if cell is not None}):
        own = [cell if (c or "") == currency else None for c, cell in zip(currencies, cells)]
        found[currency] = _number_index(n, own)
    return [{"currency": c, **index} for c, index in found.items()]


def build_index(rules: DataFrame, conditions: Conditions, order: list, payload: list[Column]) -> RuleIndex:
    """The index of ``rules``, parsed, in ``order`` per key; ``payload`` is what a matched rule gives.

    A rule whose key is null never holds. The index is written to the shared folder once; a task holds the rules of one key.
    """
    keys = list(conditions.keys.values())
    amounts = conditions.amounts
    given = rules.select(F.struct(*payload).alias("p")).schema["p"].dataType
    parts = [C(c).alias(f"__ix_t{i}") for i, c in enumerate(conditions.tokens)] + [C(c).alias(f"__ix_n{i}") for i, c in enumerate(conditions.numbers)]
    if amounts:
        currency = F.when(~is_blank(C(amounts.rule_currency)), F.upper(F.trim(amounts.rule_currency)))
        bounds = C(amounts.bounds) if amounts.own else F.when(currency.isNotNull(), C(amounts.bounds))
        parts += [bounds.alias("bounds"), currency.alias("currency")]
    ranked = rules.where(reduce(lambda a, b: a & b, [C(k).isNotNull() for k in keys]))
    ranked = ranked.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    narrow = ranked.select(*[C(k).alias(f"__ix_k{i}") for i, k in enumerate(keys)], "__place", F.struct(*payload).alias("payload"), *parts)
    schema = _index_schema([rules.schema[k] for k in keys], given, conditions)
    from pyspark.sql.pandas.types import to_arrow_schema

    shape, tokens, numbers, n_keys = to_arrow_schema(schema), len(conditions.tokens), len(conditions.numbers), len(keys)

    def one(table: pa.Table) -> pa.Table:
        # One column at a time becomes Python objects; the payload stays as it is.
        table = table.take(np.argsort(table["__place"].to_numpy(), kind="stable"))
        n = len(table)

        def column(name: str, index: Callable) -> pa.Array:
            return pa.array([index(table[name].to_pylist())], shape.field(name).type)

        payload = table["payload"].combine_chunks()
        out = {f"__ix_k{i}": table[f"__ix_k{i}"].slice(0, 1) for i in range(n_keys)}
        out["__ix_every"] = pa.array([_bitmap(np.ones(n, dtype=bool)).tolist()], shape.field("__ix_every").type)
        out["__ix_payload"] = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), payload).cast(shape.field("__ix_payload").type)
        out |= {f"__ix_t{i}": column(f"__ix_t{i}", lambda cells: _token_index(n, cells)) for i in range(tokens)}
        out |= {f"__ix_n{i}": column(f"__ix_n{i}", lambda cells: _number_index(n, cells)) for i in range(numbers)}
        if amounts:
            found = _amounts_index(n, table["bounds"].to_pylist(), table["currency"].to_pylist())
            out["__ix_amounts"] = pa.array([found], shape.field("__ix_amounts").type)
        return pa.table([out[f.name] for f in shape], schema=shape)

    spark = rules.sparkSession
    path = scratch_path(spark, "rule-index")
    narrow.groupBy(*[f"__ix_k{i}" for i in range(n_keys)]).applyInArrow(one, schema).write.parquet(path)
    return RuleIndex(spark.read.schema(schema).parquet(path), conditions, given)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def segment(value: Column, blocks: Column) -> Column:
    """How many of the sorted bounds in ``blocks`` a value has reached, -1 for a missing value.

    Two steps over lists of about the square root of their number: the blocks that begin no later, then the
    bounds of the last such block.
    """

    def reached(t: Column) -> Column:
        return (value > t["bound"]) | ((value == t["bound"]) & ~t["strict"])

    def inside(begun: Column) -> Column:
        last = F.size(F.filter(F.get(blocks, begun - 1), reached))
        return F.when(begun == 0, F.lit(0)).otherwise((begun - 1) * F.size(F.get(blocks, F.lit(0))) + last)

    return F.when(value.isNull(), F.lit(-1)).otherwise(_let(F.size(F.filter(blocks, lambda b: reached(F.get(b, F.lit(0))))), inside))


def _bucket(value: Column, names: Column) -> Column:
    return F.pmod(F.crc32(value.cast("binary")), F.size(names)).cast("int")


def _profile(index: RuleIndex) -> Column:
    """What the index tells rows apart by: keys, listed values, segments."""
    cond = index.conditions
    parts = [C(f).alias(f"__ix_k{i}") for i, f in enumerate(cond.keys)]
    for i, value in enumerate(cond.tokens.values()):
        names, blocks = C(f"__ix_t{i}.names"), C(f"__ix_t{i}.blocks")
        listed = F.array_contains(F.get(names, _bucket(C(value), names)), C(value))
        parts.append(F.when(listed, C(value)).alias(f"__ix_t{i}"))
        number = F.when(F.size(blocks) > 0, C(value).try_cast("double"))
        parts.append(F.coalesce(segment(number, blocks), F.lit(-1)).alias(f"s{i}"))
    for i, value in enumerate(cond.numbers.values()):
        parts.append(F.coalesce(segment(C(value), C(f"__ix_n{i}.blocks")), F.lit(-1)).alias(f"__ix_n{i}"))
    if cond.amounts:
        a = cond.amounts

        def in_currency(entry: Column) -> Column:
            converted = amount_in(C(a.amount), C(a.currency), entry["currency"], C(a.rates_to))
            return F.when(entry["currency"] == "", C(a.own)).otherwise(converted) if a.own else converted

        parts.append(F.transform(C("__ix_amounts"), lambda e: _let(in_currency(e), lambda v: segment(v, e["blocks"]))).alias("amounts"))
    return F.struct(*parts)


def _listed(value: Column, token: str) -> Column:
    """The bitmap of the rules that list a value, null if none does."""
    names, bits = C(f"{token}.names"), C(f"{token}.bits")

    def within(bucket: Column) -> Column:
        return F.get(F.get(bits, bucket), F.array_position(F.get(names, bucket), value).cast("int") - 1)

    return _let(_bucket(value, names), within)


def _words(index: RuleIndex) -> Column:
    """The bitmap of the rules that a profile ``__profile`` meets, beside its row of the index."""
    cond, held = index.conditions, [C("__ix_every").alias("every")]
    for i in range(len(cond.tokens)):
        token, told = f"__ix_t{i}", f"__profile.__ix_t{i}"
        span = F.get(C(f"{token}.at"), C(f"__profile.s{i}") + 1)
        held += [C(f"{token}.base").alias(f"base{i}"), _listed(C(told), token).alias(f"listed{i}"), span.alias(f"span{i}")]
    for i in range(len(cond.numbers)):
        held.append(F.get(C(f"__ix_n{i}.at"), C(f"__profile.__ix_n{i}") + 1).alias(f"n{i}"))
    if cond.amounts:
        held.append(F.zip_with("__ix_amounts", "__profile.amounts", lambda entry, seg: F.get(entry["at"], seg + 1)).alias("amounts"))

    def word(h: Column, w: Column) -> Column:
        def at(name: str) -> Column:
            return F.coalesce(F.get(h[name], w), F.lit(0).cast("bigint"))

        out = at("every")
        for i in range(len(cond.tokens)):
            out = out.bitwiseAND(at(f"base{i}").bitwiseXOR(at(f"listed{i}").bitwiseOR(at(f"span{i}"))))
        for i in range(len(cond.numbers)):
            out = out.bitwiseAND(at(f"n{i}"))
        if cond.amounts:
            out = F.aggregate(h["amounts"], out, lambda acc, x: acc.bitwiseAND(F.get(x, w)))
        return out

    return _let(F.struct(*held), lambda h: F.transform(F.sequence(F.lit(0), F.size(h["every"]) - 1), lambda w: word(h, w)))


def _first(words: Column) -> Column:
    """Number of the first bit that is set, null if none is."""

    def place(found: Column) -> Column:
        def within(w: Column) -> Column:
            low = F.get(found, w)
            return w * WORD + F.bit_count(low.bitwiseAND(-low) - 1)

        first = F.array_position(F.transform(found, lambda x: x != 0), True).cast("int")
        return _let(first, lambda at: F.when(at > 0, within(at - 1)))

    return _let(words, place)


def _all(words: Column) -> Column:
    """Numbers of all bits that are set."""

    def of(x: Column, w: Column) -> Column:
        bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)) != 0)
        return F.when(x == 0, F.array().cast("array<int>")).otherwise(F.transform(bits, lambda b: w * WORD + b))

    return F.flatten(F.transform(words, of))


def _told(index: RuleIndex) -> DataFrame:
    """The listed values and bounds of the index, without bitmaps and payload: every row of the facts meets them."""
    cond = index.conditions
    parts = [C(f"__ix_k{i}") for i in range(len(cond.keys))]
    parts += [F.struct(C(f"__ix_t{i}.names"), C(f"__ix_t{i}.blocks")).alias(f"__ix_t{i}") for i in range(len(cond.tokens))]
    parts += [F.struct(C(f"__ix_n{i}.blocks")).alias(f"__ix_n{i}") for i in range(len(cond.numbers))]
    if cond.amounts:
        parts.append(F.transform("__ix_amounts", lambda e: F.struct(e["currency"].alias("currency"), e["blocks"].alias("blocks"))).alias("__ix_amounts"))
    return index.rows.select(*parts)


def _found(facts: DataFrame, index: RuleIndex, value: Callable[[Column], Column], of_met: Callable[[DataFrame], DataFrame] = lambda met: met) -> DataFrame:
    """``facts`` with ``__found``: ``value`` of the bitmap of rules that each row meets, computed once per profile.

    ``of_met`` may replace ``__found`` of the profiles before the facts look them up."""
    keys = list(index.conditions.keys)
    meets = reduce(lambda a, b: a & b, [C(f) == C(f"__ix_k{i}") for i, f in enumerate(keys)])
    shaped = facts.join(_told(index), meets, "left").withColumn("__profile", _profile(index))
    shaped = shaped.select(*[C(f"`{c}`") for c in facts.columns], "__profile")
    profiles = shaped.select("__profile").distinct()
    same = reduce(lambda a, b: a & b, [C(f"__profile.__ix_k{i}") == C(f"__ix_k{i}") for i in range(len(keys))])
    met = of_met(profiles.join(index.rows, same).select("__profile", value(_words(index)).alias("__found")))
    return lookup_join(shaped, met, ["__profile"], ["__found"]).drop("__profile")


def first_rule(facts: DataFrame, index: RuleIndex, take: dict[str, str]) -> DataFrame:
    """``facts`` with fields of the payload (field -> new column) of the first rule each row meets, or nulls."""
    keys = [f"__ix_k{i}" for i in range(len(index.conditions.keys))]
    # The payload of all rules of a key is wide: a profile meets the bitmaps alone, and the one rule that it found.
    payloads = index.rows.select(*[C(k).alias(f"__p{k}") for k in keys], F.posexplode("__ix_payload").alias("__place", "__payload"))

    def with_payload(met: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [C(f"__profile.{k}") == C(f"__p{k}") for k in keys], C("__found") == C("__place"))
        return met.join(payloads, same).select("__profile", C("__payload").alias("__found"))

    found = _found(facts, index, _first, with_payload)
    return found.select(*[C(f"`{c}`") for c in facts.columns], *[C("__found")[c].alias(name) for c, name in take.items()])


def all_rules(facts: DataFrame, index: RuleIndex, take: dict[str, str]) -> DataFrame:
    """``facts`` paired with every rule that a row meets, with fields of the rule's payload."""
    found = _found(facts, index, lambda words: F.transform(_all(words), lambda k: F.get(C("__ix_payload"), k)))
    pairs = found.withColumn("__rule", F.explode("__found"))
    return pairs.select(*[C(f"`{c}`") for c in facts.columns], *[C("__rule")[c].alias(name) for c, name in take.items()])


def days(c: Column) -> Column:
    """A date as a number that bounds compare."""
    return F.unix_date(c).cast(BOUND)


def validity(valid_from: Column, valid_until: Column) -> Column:
    """The days from the first to the last as bounds; an open end holds on. Rules without first day hold on no day."""
    yes = F.lit(True)
    lo = F.coalesce(days(valid_from), F.lit(10**9).cast(BOUND))
    return F.struct(lo.alias("lo"), yes.alias("lo_in"), days(valid_until).alias("hi"), yes.alias("hi_in"))


def yes_no_condition(c: Column) -> Column:
    """NO wants a zero amount, any other word a positive one; as a token condition on ``amount_class``."""
    wanted = F.when(F.upper(F.trim(c)) == "NO", F.lit("zero")).otherwise(F.lit("positive"))
    parsed = F.struct(F.lit(False).alias("negate"), F.array(wanted).alias("values"), F.array().cast("array<struct<lo:double,hi:double>>").alias("spans"))
    return F.when(~is_blank(c), parsed)


def amount_class(amount: Column) -> Column:
    """Zero (also for a missing amount), positive or negative."""
    number = F.coalesce(amount, F.lit(0))
    return F.when(number == 0, "zero").when(number > 0, "positive").otherwise("negative")
