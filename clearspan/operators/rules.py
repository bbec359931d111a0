"""Reading the text of fee rules into arrays and bounds, and testing values against one parsed condition.

Matching transactions with whole rule tables is the work of ``rule_index``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions.text import rule_text
from clearspan.operators.lookup import lookup_join

# Spellings of "no condition".
NO_CONDITION = ["", "none", "nan", "null"]
# Columns of text-record rules whose single blanks are a value of their own.
BLANK_MATTERS = [
    "nnss_indicator",
    "cardholder_id_method",
    "moto_ec_indicator",
    "moto_eci_indicator",
    "acceptance_terminal_indicator",
    "merchant_vat",
    "mail_telephone_or_electronic_commerce_indicator",
]
_NUMBER = r"(-?[0-9]+(?:\.[0-9]+)?)"
BOUND = "decimal(24,6)"


def is_blank(c: Column) -> Column:
    """Null, empty, none, nan and null text all mean no condition."""
    return c.isNull() | F.lower(F.trim(c.cast("string"))).isin(NO_CONDITION)


def token_condition(c: Column, space_word: bool = False) -> Column:
    """Comma list of values and ``lo-hi`` ranges with an optional ``NOT:``, as a struct.

    Null when there is no condition. With ``space_word`` the word SPACE stands for a blank.
    """
    raw = rule_text(c)
    negate = raw.contains("NOT:")
    listed = F.replace(raw, F.lit("NOT:"), F.lit(""))
    if space_word:
        listed = F.replace(listed, F.lit("SPACE"), F.lit(" "))
    tokens = F.split(listed, ",")

    def bound(t: Column, i: int) -> Column:
        return F.get(F.split(t, "-"), F.lit(i)).try_cast("double")

    is_range = lambda t: t.rlike("^[^-]+-")
    spans = F.transform(
        F.filter(tokens, is_range), lambda t: F.struct(bound(t, 0).alias("lo"), bound(t, 1).alias("hi"))
    )
    parsed = F.struct(
        negate.alias("negate"), tokens.alias("values"), spans.alias("spans")
    )
    return F.when(~is_blank(c), parsed)


def token_match(condition: Column, value: Column, number: Column | None = None, spans: int | None = None) -> Column:
    """Whether a value meets a parsed token condition; ranges compare numerically.

    ``number`` is the value as double, if the caller has it. With ``spans``, the most ranges
    a condition has, the ranges are compared one by one: unlike a lambda over the array this
    compiles, which counts in a join condition.
    """
    number = value.try_cast("double") if number is None else number
    hit = F.coalesce(F.array_contains(condition["values"], value), F.lit(False))
    if spans is None:
        hit = hit | F.exists(
            condition["spans"], lambda s: F.coalesce(number.between(s["lo"], s["hi"]), F.lit(False))
        )
    else:
        for i in range(spans):
            span = F.get(condition["spans"], F.lit(i))
            hit = hit | F.coalesce((number >= span["lo"]) & (number <= span["hi"]), F.lit(False))
    return condition.isNull() | (hit != condition["negate"])


def number_condition(c: Column, bare_equal: bool = True) -> Column:
    """Bounds of text such as ``>=10<20`` or ``between 1 and 5``, as a struct.

    A bare number means equality unless ``bare_equal`` is off.

    Null when there is no condition; text without any bound matches everything.
    """
    text = F.lower(F.regexp_replace(c.cast("string"), " ", ""))

    def found(pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast(BOUND)

    between_lo = found(f"between{_NUMBER}and{_NUMBER}", 1)
    between_hi = found(f"between{_NUMBER}and{_NUMBER}", 2)
    at_least, above = found(f">={_NUMBER}"), found(f">{_NUMBER}")
    at_most, below = found(f"<={_NUMBER}"), found(f"<{_NUMBER}")
    equal = found(f"^={_NUMBER}$")
    if bare_equal:
        equal = F.coalesce(equal, found(f"^{_NUMBER}$"))
    lo = F.greatest(between_lo, at_least, above, equal)
    hi = F.least(between_hi, at_most, below, equal)
    parsed = F.struct(
        lo.alias("lo"),
        F.coalesce(above.isNull() | (lo > above), F.lit(True)).alias("lo_in"),
        hi.alias("hi"),
        F.coalesce(below.isNull() | (hi < below), F.lit(True)).alias("hi_in"),
    )
    return F.when(~is_blank(c), parsed)


def number_match(condition: Column, value: Column) -> Column:
    """Whether a number lies inside parsed bounds; a missing number fails any bound."""
    above = condition["lo"].isNull() | (value > condition["lo"]) | (condition["lo_in"] & (value == condition["lo"]))
    below = condition["hi"].isNull() | (value < condition["hi"]) | (condition["hi_in"] & (value == condition["hi"]))
    return condition.isNull() | F.coalesce(above & below, F.lit(False))


def yes_no_match(condition: Column, amount: Column) -> Column:
    """NO wants a zero amount, any other word a positive one; missing amounts are zero."""
    number = F.coalesce(amount, F.lit(0))
    return is_blank(condition) | F.when(F.upper(F.trim(condition)) == "NO", number == 0).otherwise(number > 0)


def converted_amounts(rows: DataFrame, rates: DataFrame, currency: str, by: list[str] = ()) -> DataFrame:
    """Add ``rates_to``: target currency -> rate from the row's currency (its own is 1).

    ``rates`` has ``from_ccy``, ``to_ccy``, ``rate`` and the ``by`` columns; one row per pair.
    """
    keys = [*by, "from_ccy"]
    one_each = rates.groupBy(*keys, "to_ccy").agg(F.max("rate").alias("rate"))
    maps = one_each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("to_ccy", "rate"))).alias("rates_to"))
    return lookup_join(rows, maps, {**{k: k for k in by}, currency: "from_ccy"}, ["rates_to"])


def amount_in(amount: Column, own: Column, target: Column, rates_to: Column) -> Column:
    """Amount in the target currency; null when no rate is known."""
    return F.when(F.upper(own) == F.upper(target), amount.cast("decimal(24,6)")).otherwise(
        (amount.cast("decimal(18,4)") * F.try_element_at(rates_to, F.upper(target)).cast("decimal(18,10)")).cast("decimal(24,6)")
    )


def needed_rules(rules: DataFrame, facts: DataFrame, keys: dict[str, str], day: str, valid_from="valid_from", valid_until="valid_until") -> DataFrame:
    """Rules with at least one row of equal keys inside their validity."""
    seen = facts.select(*[F.col(f).alias(f"__f{i}") for i, f in enumerate(keys)], F.col(day).alias("__day")).distinct()
    spans = seen.groupBy(*[f"__f{i}" for i in range(len(keys))]).agg(F.sort_array(F.collect_set("__day")).alias("__days"))
    cond = F.lit(True)
    for i, rule_key in enumerate(keys.values()):
        cond = cond & (F.col(rule_key) == F.col(f"__f{i}"))
    valid = F.exists(
        "__days", lambda d: (d >= F.col(valid_from)) & (d <= F.coalesce(F.col(valid_until), d))
    )
    return rules.join(spans, cond & valid, "left_semi")
