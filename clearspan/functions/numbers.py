"""Column builders for amounts, implied decimals, fees and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal types that multiply without losing scale.
AMOUNT = "decimal(18,4)"
RATE = "decimal(18,10)"
FEE_RATE = "decimal(14,8)"


def _money(c: Column) -> Column:
    return c.cast(AMOUNT)


def _converted(c: Column, fx: Column) -> Column:
    return _money(c) * fx.cast(RATE)


def fee_rate_to(fee_ccy: Column, txn_ccy: Column, rate: Column, blank_is_same: bool = False) -> Column:
    """Rate from the fee's currency to the transaction's; 1 when both are the same."""
    same = fee_ccy == txn_ccy
    if blank_is_same:
        same = same | fee_ccy.isNull() | (fee_ccy == "")
    return F.when(same, F.lit(1).cast(RATE)).otherwise(rate.cast(RATE))


def fee_clamped(amount: Column, variable: Column, fixed: Column, low: Column, high: Column, fx: Column) -> Column:
    """amount * variable + fixed, kept between low and high.

    A missing rate makes the fixed part 0 and drops both bounds.
    """
    zero = F.lit(0).cast("decimal(34,14)")
    base = _money(amount) * F.coalesce(variable.cast(FEE_RATE), F.lit(0).cast(FEE_RATE))
    fee = (base + F.coalesce(_converted(fixed, fx), zero)).cast("decimal(34,14)")
    bounded = F.greatest(fee, _converted(low, fx).cast("decimal(34,14)"))
    return F.least(bounded, _converted(high, fx).cast("decimal(34,14)"))


def fee_clamped_strict(
    amount: Column, variable: Column, fixed: Column, low: Column, high: Column, fx: Column
) -> Column:
    """As ``fee_clamped``, but a needed and missing rate makes the fee null.

    Without a variable rate the fee is the fixed part only.
    """
    wide = "decimal(34,14)"
    fixed_part = F.when(fixed.isNull(), F.lit(0).cast(wide)).otherwise(_converted(fixed, fx).cast(wide))
    rate_needed = fixed.isNotNull() | low.isNotNull() | high.isNotNull()
    fee = (_money(amount) * variable.cast(FEE_RATE)).cast(wide) + fixed_part
    bounded = F.least(
        F.greatest(fee.cast(wide), _converted(low, fx).cast(wide)), _converted(high, fx).cast(wide)
    )
    return (
        F.when(variable.isNull(), fixed_part)
        .when(amount.isNull() | (rate_needed & fx.isNull()), F.lit(None).cast(wide))
        .otherwise(bounded)
    )


def settlement_currency(incoming: Column, reconciled: Column, use_local: Column, local: Column, settlement: Column):
    return F.when(incoming, reconciled).otherwise(F.when(use_local, local).otherwise(settlement))


def settlement_amount(
    incoming: Column, reconciled: Column, amount: Column, use_local: Column, local_rate: Column, settle_rate: Column
) -> Column:
    """Incoming rows keep the reconciled amount; outgoing rows convert to local or settlement currency."""
    to_local = F.round(_converted(amount, local_rate), 4).cast(AMOUNT)
    to_settlement = F.round(_converted(amount, settle_rate), 4).cast(AMOUNT)
    outgoing = F.when(use_local & local_rate.isNotNull(), to_local).otherwise(to_settlement)
    return F.when(incoming, reconciled.cast(AMOUNT)).otherwise(outgoing)


def implied_decimal(c: Column, scale: int) -> Column:
    """Text amount; without a decimal point the last ``scale`` digits are decimals. Bad text is null."""
    text = F.trim(c)
    number = text.try_cast("decimal(30,8)")
    shift = F.lit(f"{10.0 ** -scale:.{max(scale, 1)}f}").cast(f"decimal({scale + 2},{scale})")
    shifted = (number * shift).cast("decimal(34,10)") if scale else number.cast("decimal(34,10)")
    return F.when(text.contains("."), number.cast("decimal(34,10)")).otherwise(shifted)


def _ten_to_minus(digits: Column, most: int = 9) -> Column:
    """10 to the power of minus ``digits`` (0 to ``most``) as an exact decimal."""
    powers = F.array(*[F.lit(f"{10.0 ** -d:.{most}f}").cast(f"decimal({most + 1},{most})") for d in range(most + 1)])
    return F.get(powers, digits)


def scale_prefixed(c: Column, out_scale: int = 9) -> Column:
    """First digit tells how many of the following digits are decimals."""
    text = F.regexp_replace(F.regexp_replace(F.trim(c), r"\.0$", ""), " ", "")
    rest = F.substring(text, 2, 18).try_cast("decimal(18,0)")
    scaled = rest * _ten_to_minus(F.substring(text, 1, 1).try_cast("int"))
    plain = text.try_cast("decimal(28,10)")
    value = F.when(text.contains("."), plain).when(text.rlike("^[0-9]{2,}$"), scaled.cast("decimal(28,10)"))
    return F.round(value, out_scale).cast(f"decimal(28,{out_scale})")


def currency_scaled(c: Column, decimals: Column, default: int = 2, out_scale: int = 4) -> Column:
    """Whole-number amount with as many decimals as its currency has; rounded half up, sign kept."""
    text = F.trim(c)
    number = F.when(text.rlike("^-?[0-9]+$"), text.try_cast("decimal(20,0)"))
    value = number * _ten_to_minus(F.coalesce(decimals, F.lit(default)))
    return F.round(value, out_scale).cast(f"decimal(18,{out_scale})")


def signed_for_reversal(amount: Column, is_reversal: Column) -> Column:
    return F.when(is_reversal, -amount).otherwise(amount)


def largest(*amounts: Column) -> Column:
    """Largest amount, nulls counted as 0."""
    return F.greatest(*[F.coalesce(a, F.lit(0)) for a in amounts])


def plain_decimal(c: Column, precision: int = 28, scale: int = 6) -> Column:
    """Number text with thousands commas."""
    return F.regexp_replace(c.cast("string"), ",", "").try_cast(f"decimal({precision},{scale})")


def amount_text(c: Column) -> Column:
    """Two decimals, half up."""
    return F.coalesce(F.round(c.cast("decimal(30,10)"), 2).cast("decimal(28,2)").cast("string"), F.lit(""))


def ratio_text(c: Column) -> Column:
    """Six decimals, cut toward zero."""
    wide = c.cast("decimal(30,12)")
    cut = F.sign(wide).cast("decimal(1,0)") * F.floor(F.abs(wide) * F.lit(1_000_000).cast("decimal(7,0)"))
    return F.coalesce(
        (cut.cast("decimal(27,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(28,6)").cast("string"),
        F.lit(""),
    )


def amount_or_fallback(amount: Column, rate: Column, fallback: Column, extra: Column, fallback_rate: Column) -> Column:
    """Converted amount; a zero amount uses fallback + extra at the fallback's rate. Missing rates are 1."""
    one = F.lit(1).cast(RATE)
    zero = F.lit(0).cast(AMOUNT)
    other = (F.coalesce(_money(fallback), zero) + F.coalesce(_money(extra), zero)).cast(AMOUNT)
    return F.when(amount == 0, F.coalesce(fallback_rate.cast(RATE), one) * other).otherwise(
        F.coalesce(rate.cast(RATE), one) * _money(amount)
    )


def unit_cost(cost: Column, count: Column) -> Column:
    """Cost per transaction, 6 decimals; null without transactions."""
    return F.round(F.try_divide(cost.cast("decimal(24,6)"), count.cast("decimal(12,0)")), 6).cast("decimal(24,6)")


def ratio(part: Column, whole: Column, scale: int = 12) -> Column:
    """Share of the whole, 0 when the whole is 0."""
    quotient = F.try_divide(part.cast("decimal(24,6)"), whole.cast("decimal(24,6)"))
    return F.coalesce(quotient.cast(f"decimal(28,{scale})"), F.lit(0).cast(f"decimal(28,{scale})"))
