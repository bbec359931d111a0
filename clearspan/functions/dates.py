"""Column builders for the date and time spellings found in clearing files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_year(two_digits: Column) -> Column:
    """Two-digit year with the usual pivot: 69-99 are 19xx, 00-68 are 20xx."""
    century = F.when(two_digits >= "69", F.lit("19")).otherwise(F.lit("20"))
    return F.concat(century, two_digits)


def _year_day(year: Column, day: Column) -> Column:
    text = F.concat(year, day)
    return F.when(text.rlike("^[0-9]{7}$"), F.try_to_date(text, "yyyyDDD"))


def parse_yyddd(c: Column) -> Column:
    """Five-digit YYDDD; anything else is null."""
    return F.when(c.rlike("^[0-9]{5}$"), _year_day(full_year(F.substring(c, 1, 2)), F.substring(c, 3, 3)))


def parse_mmdd(c: Column, file_date: Column) -> Column:
    """MMDD in the file's year, or the year before when the month is later; 0000 is the file date."""
    text = F.trim(c)
    month = F.substring(text, 1, 2).try_cast("int")
    year = F.year(file_date) - F.when(month > F.month(file_date), 1).otherwise(0)
    stamp = F.concat(year.cast("string"), text)
    parsed = F.when(text.rlike("^[0-9]{4}$"), F.try_to_date(stamp, "yyyyMMdd"))
    return F.when(text == "0000", file_date).otherwise(parsed)


def parse_yddd(c: Column, file_date: Column, not_after_file: bool = False) -> Column:
    """YDDD with the decade of the file date; 0000 is the file date.

    With ``not_after_file`` a date later than the file moves one year back.
    """
    text = F.trim(c)
    year = full_year(F.concat(F.substring(F.year(file_date).cast("string"), 3, 1), F.substring(text, 1, 1)))
    parsed = F.when(text.rlike("^[0-9]{4}$"), _year_day(year, F.substring(text, 2, 3)))
    if not_after_file:
        parsed = F.when(parsed > file_date, F.add_months(parsed, -12)).otherwise(parsed)
    return F.when(text == "0000", file_date).otherwise(parsed)


def parse_yyyyddd(c: Column) -> Column:
    """YYYY and a day count that may run past the year's end."""
    text = F.trim(c)
    first = F.try_to_date(F.concat(F.substring(text, 1, 4), F.lit("0101")), "yyyyMMdd")
    days = F.substring(text, 5, 4).try_cast("int") - 1
    return F.when(text.rlike("^[0-9]{5,8}$"), F.date_add(first, days))


def parse_clearing_date(c: Column, spelling: str, file_date: Column) -> Column:
    """One of the named spellings MMDD, YDDD, YDDD_MAX, YYYYDDD, or a Spark date pattern."""
    if spelling == "MMDD":
        return parse_mmdd(c, file_date)
    if spelling == "YDDD":
        return parse_yddd(c, file_date)
    if spelling == "YDDD_MAX":
        return parse_yddd(c, file_date, not_after_file=True)
    if spelling == "YYYYDDD":
        return parse_yyyyddd(c)
    return F.try_to_date(F.trim(c), spelling)


def parse_any(c: Column, *patterns: str) -> Column:
    """First pattern that fits."""
    text = F.trim(c.cast("string"))
    tries = []
    for pattern in patterns:
        digits_only = not any(ch in pattern for ch in "-/:")
        fitting = F.length(text) == len(pattern)
        if digits_only:
            fitting = fitting & text.rlike("^[0-9]+$")
        tries.append(F.when(fitting, F.try_to_date(text, pattern)))
    return F.coalesce(*tries)


def parse_file_date(c: Column) -> Column:
    """yyMMdd, yyyyMMdd or ISO text, chosen by length."""
    text = c.cast("string")
    return (
        F.when(F.length(text) == 6, F.try_to_date(F.concat(F.lit("20"), text), "yyyyMMdd"))
        .when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd"))
        .otherwise(text.try_cast("date"))
    )


def date_from_nanos(c: Column) -> Column:
    """Date of a count of nanoseconds since the epoch (UTC session)."""
    return F.to_date(F.timestamp_seconds(F.floor(c / F.lit(1_000_000_000).cast("decimal(11,0)"))))


def parse_day_hour(c: Column) -> Column:
    """YYDDDHH as timestamp; unreadable text is null."""
    text = F.trim(c)
    day = parse_yyddd(F.substring(text, 1, 5))
    hour = F.substring(text, 6, 2)
    stamp = F.concat_ws(" ", day.cast("string"), F.concat(hour, F.lit(":00:00")))
    readable = text.rlike("^[0-9]{5}([01][0-9]|2[0-3])$") & day.isNotNull()
    return F.when(readable, stamp).try_cast("timestamp")


def timestamp_text(c: Column) -> Column:
    """Timestamp with milliseconds as text."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")


def _sundays_until(day: Column) -> Column:
    """Sundays from a fixed past Sunday up to and including ``day``."""
    return F.floor((F.unix_date(day) + 4) / 7)


def timeliness(purchase: Column, processing: Column) -> Column:
    """Days strictly between two dates that are not Sundays; 0 on the same day."""
    days = F.datediff(processing, purchase)
    sundays = _sundays_until(F.date_sub(processing, 1)) - _sundays_until(purchase)
    working = days - 1 - F.greatest(F.lit(0), sundays)
    return F.when(days == 0, F.lit(0)).otherwise(working).cast("bigint")


def plain_timeliness(local: Column, settlement: Column) -> Column:
    return F.datediff(settlement, local).cast("bigint")


def month_key(c: Column, separator: str = "") -> Column:
    return F.date_format(c, f"yyyy{separator}MM")


def month_bounds(c: Column) -> tuple[Column, Column]:
    return F.trunc(c, "month"), F.last_day(c)


def day_sequence(first: Column, last: Column) -> Column:
    """One row per day, both ends included."""
    return F.explode(F.sequence(first, last))


def closed_before(c: Column, unit: str = "day") -> Column:
    """Last instant before ``c``: one day or one second earlier."""
    return F.date_sub(c, 1) if unit == "day" else c - F.expr(f"INTERVAL 1 {unit.upper()}")
