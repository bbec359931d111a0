"""Scalar functions on hand-made edge values."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clearspan.functions import classify, dates, numbers, text
from clearspan.functions.message import BINARY_ELEMENTS, DIGIT_ELEMENTS, FIXED_LENGTH, LENGTH_DIGITS, decode_messages

C = F.col


def values(spark, build, *inputs, types="a string"):
    rows = spark.createDataFrame([i if isinstance(i, tuple) else (i,) for i in inputs], types)
    return [r[0] for r in rows.select(build.alias("x")).collect()]


def test_blank_and_missing_text(spark):
    got = values(spark, text.first_non_blank(C("a"), C("b")), (None, " x "), ("  ", None), ("k", "z"), types="a string, b string")
    assert got == ["x", None, "k"]
    assert values(spark, text.or_blank_word(C("a")), None, "", "v") == ["BLANK", "", "v"]
    assert values(spark, text.or_blank_word(C("a"), when_empty=True), None, " ", "v") == ["BLANK", "BLANK", "v"]


def test_masked_accounts(spark):
    assert values(spark, text.account9(C("a")), "4028****1234", "12", "x" * 9) == [402800001, 12, None]
    assert values(spark, text.code_validity(C("a")), "12345x", "000000", "0000", "", None, "123456") == [
        "INVALID", "INVALID", "INVALID", "VALID", "VALID", "VALID",
    ]


def test_overpunch_sign_is_an_option(spark):
    assert values(spark, text.overpunch_amount(C("a"), 2), "12C", "12L", None, "zz") == [Decimal("1.23"), Decimal("1.23"), 0, 0]
    assert values(spark, text.overpunch_amount(C("a"), 2, signed=True), "12C", "12L") == [Decimal("1.23"), Decimal("-1.23")]


def test_dates_by_spelling(spark):
    day = F.lit("2024-01-15").cast("date")
    assert values(spark, dates.parse_mmdd(C("a"), day), "0110", "1231", "0229", "0000", "13", None) == [
        dt.date(2024, 1, 10), dt.date(2023, 12, 31), None, dt.date(2024, 1, 15), None, None,
    ]
    assert values(spark, dates.parse_yddd(C("a"), day), "4366", "3366", "4001", "0000") == [dt.date(2024, 12, 31), None, dt.date(2024, 1, 1), dt.date(2024, 1, 15)]
    assert values(spark, dates.parse_yddd(C("a"), day, not_after_file=True), "4366", "4001") == [dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    assert values(spark, dates.parse_yyyyddd(C("a")), "2023366", "2024366", "bad") == [dt.date(2024, 1, 1), dt.date(2024, 12, 31), None]
    assert values(spark, dates.parse_yyddd(C("a")), "24060", "99001", "2406", "24367") == [dt.date(2024, 2, 29), dt.date(1999, 1, 1), None, None]
    assert values(spark, dates.parse_any(C("a"), "yyyyMMdd", "yyyy-MM-dd", "ddMMyyyy"), "20240131", "2024-01-31", "31012024", "x") == [dt.date(2024, 1, 31)] * 3 + [None]


@pytest.mark.parametrize("purchase, processing, expected", [
    ("2024-01-05", "2024-01-05", 0), ("2024-01-05", "2024-01-06", 0), ("2024-01-05", "2024-01-08", 1), ("2024-01-05", "2024-01-15", 7), ("2024-01-08", "2024-01-05", -4),
])
def test_timeliness_skips_sundays(spark, purchase, processing, expected):
    build = dates.timeliness(C("a").cast("date"), C("b").cast("date"))
    assert values(spark, build, (purchase, processing), types="a string, b string") == [expected]


def test_decimals(spark):
    assert values(spark, numbers.implied_decimal(C("a"), 2), "1234", "12.5", "x", "", None) == [Decimal("12.34"), Decimal("12.5"), None, None, None]
    assert values(spark, numbers.scale_prefixed(C("a")), "31234", "0", "1.5", "a1") == [Decimal("1.234"), None, Decimal("1.5"), None]
    build = numbers.currency_scaled(C("a"), C("b"))
    assert values(spark, build, ("1234", 0), ("-1234", 3), ("1234", None), ("1.2", 2), types="a string, b int") == [
        Decimal("1234"), Decimal("-1.234"), Decimal("12.34"), None,
    ]
    assert values(spark, numbers.ratio_text(C("a").cast("decimal(20,10)")), "0.1234569", "-0.1234569") == ["0.123456", "-0.123456"]
    assert values(spark, numbers.amount_text(C("a").cast("decimal(20,10)")), "1.005", None) == ["1.01", ""]


FEE_TYPES = "amount decimal(18,4), variable decimal(14,8), fixed decimal(18,4), low decimal(18,4), high decimal(18,4), fx decimal(18,10)"


def fee_rows():
    d = Decimal
    return [
        (d(100), d("0.01"), d(1), d(5), d(50), d(2)),
        (d(100), d("0.01"), d(1), d(5), d(50), None),
        (d(100), None, d(1), d(5), d(50), d(2)),
        (d(100), d("0.01"), None, None, None, None),
        (d(10000), d("0.01"), d(1), d(5), d(10), d(2)),
    ]


def test_fee_rules_differ_by_scheme(spark):
    rows = spark.createDataFrame(fee_rows(), FEE_TYPES)
    parts = [C(c) for c in ("amount", "variable", "fixed", "low", "high", "fx")]
    lenient = [r[0] for r in rows.select(numbers.fee_clamped(*parts)).collect()]
    strict = [r[0] for r in rows.select(numbers.fee_clamped_strict(*parts)).collect()]
    assert lenient == [10, 1, 10, 1, 20]
    assert strict == [10, None, 2, 1, 20]


def test_jurisdiction_needs_known_countries(spark):
    build = classify.jurisdiction(C("a") == C("b"), F.lit(True), C("c"), C("d"))
    got = values(spark, build, ("1", "1", "x", "x"), ("1", "2", "x", "x"), ("1", "2", "x", "y"), ("1", None, "x", None), types="a string, b string, c string, d string")
    assert got == ["on-us", "intraregional", "interregional", ""]


def test_reversal_meaning_turns_for_chargebacks(spark):
    build = classify.reversal_of_indicator(C("a"), C("b"))
    assert values(spark, build, ("1240", "R"), ("1240", ""), ("1442", "R"), ("1442", None), (None, "R"), types="a string, b string") == [True, False, False, True, False]


def test_code_family(spark):
    assert values(spark, text.expand_code_family(C("a")), "5,6", " 7 , 05", "12", "", None) == ["05,15,25,35,06,16,26,36", "07,17,27,37,05", "12", "", None]


def scan_tags(blob):
    """Slow reading of tag runs: try every position."""
    found, at = {}, 0
    while at + 7 <= len(blob):
        head = blob[at : at + 7]
        end = at + 7 + int(head[4:]) if all(c in "0123456789" for c in head) else None
        if end is None or end > len(blob):
            at += 1
            continue
        found[head[:4]] = blob[at + 7 : end]
        at = end
    return found


def random_tags(rng):
    parts = []
    for _ in range(rng.randrange(7)):
        value = "".join(rng.choice("ab01é") for _ in range(rng.randrange(7)))
        parts.append(rng.choice(["".join(rng.choice("01x ") for _ in range(rng.randrange(9))), f"{rng.randrange(6):04d}{len(value):03d}{value}", "0165099short"]))
    return "".join(parts)


def test_tag_scan_agrees_with_trying_every_position(spark):
    rng = random.Random(3)
    blobs = [random_tags(rng) for _ in range(1500)] + ["", "0" * 300, "1" * 60, "00010000002000"]
    assert values(spark, text.tagged_from_containers(C("a")), *blobs) == [scan_tags(b) for b in blobs]
    pairs = [(rng.choice([None, *blobs[:50]]), rng.choice([None, *blobs[50:100]])) for _ in range(300)]
    got = values(spark, text.tagged_from_containers(C("a"), C("b")), *pairs, types="a string, b string")
    assert got == [{**scan_tags(x or ""), **scan_tags(y or "")} for x, y in pairs]
    plan = spark.range(1).select(text.tagged_from_containers(F.lit("0001001a")).alias("x"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def slow_decode(payload, ebcdic):
    """A payload read byte by byte."""
    data, at = payload or b"", 0

    def take(count):
        nonlocal at
        piece, at = data[at : at + count], at + count
        return piece if len(piece) == count else None

    def digits(raw):
        return "".join(chr(b - 0xC0) if 0xF0 <= b <= 0xF9 else "?" for b in raw) if ebcdic else raw.decode("latin1").strip()

    mti, bitmap = take(4), take(8)
    if bitmap and bitmap[0] & 0x80:
        second = take(8)
        bitmap = bitmap + second if second else None
    if mti is None or bitmap is None:
        return None, False, {}
    elements, width, bits = {}, 8 * len(bitmap), int.from_bytes(bitmap, "big")
    for number in (n for n in range(2, width + 1) if bits >> (width - n) & 1):
        length = FIXED_LENGTH.get(number)
        if number in LENGTH_DIGITS:
            head = take(LENGTH_DIGITS[number])
            stated = digits(head) if head else ""
            length = int(stated) if re.fullmatch("[0-9]+", stated) else None
        raw = take(length) if length is not None else None
        if raw is None:
            break
        if number in BINARY_ELEMENTS:
            value = raw.hex()
        else:
            value = digits(raw) if number in DIGIT_ELEMENTS else raw.decode("cp500" if ebcdic else "ascii", errors="replace")
        elements[f"de_{number}"] = value
    return digits(mti), True, elements


def random_payload(rng, ebcdic):
    known = sorted({*FIXED_LENGTH, *LENGTH_DIGITS})
    wanted = sorted(rng.sample(known, rng.randrange(12)) + ([rng.randrange(2, 129)] if rng.random() < 0.2 else []))
    bits = sum(1 << (128 - n) for n in set(wanted))
    two = any(n > 64 for n in wanted)
    bitmap = (bits | (1 << 127 if two else 0)).to_bytes(16, "big")[: 16 if two else 8]
    code = "cp500" if ebcdic else "ascii"

    def value(length, number):
        if number in DIGIT_ELEMENTS and rng.random() < 0.8:
            return "".join(rng.choice("0123456789") for _ in range(length)).encode(code)
        return bytes(rng.randrange(256) for _ in range(length))

    body = b""
    for n in wanted:
        if n in LENGTH_DIGITS:
            length = rng.randrange(12)
            body += rng.choice([f"{length:0{LENGTH_DIGITS[n]}d}"] * 9 + [" " * LENGTH_DIGITS[n]]).encode(code)
            body += value(length, n)
        elif n in FIXED_LENGTH:
            body += value(FIXED_LENGTH[n], n)
    whole = "1644".encode(code) + bitmap + body
    return whole[: rng.choice([len(whole)] * 4 + [rng.randrange(len(whole) + 1)])]


def decoded(spark, payloads, ebcdic):
    df = spark.createDataFrame([(i, bytearray(p) if p is not None else None) for i, p in enumerate(payloads)], "id int, payload binary")
    rows = decode_messages(df, "payload", ebcdic, ["id"]).orderBy("id")
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    return [(r["mti"], r["parse_ok"], r["elements"]) for r in rows.collect()]


@pytest.mark.parametrize("ebcdic", [False, True])
def test_messages_agree_with_reading_byte_by_byte(spark, ebcdic):
    rng = random.Random(5)
    payloads = [None, b"", *(random_payload(rng, ebcdic) for _ in range(800))]
    assert decoded(spark, payloads, ebcdic) == [slow_decode(p, ebcdic) for p in payloads]


def message(ebcdic=False):
    encode = (lambda s: s.encode("cp500")) if ebcdic else (lambda s: s.encode("ascii"))
    bitmap = bytes.fromhex("b000010000010000") + bytes.fromhex("0000000400000000")  # 1, 3, 4, 24, 48, 94
    body = "123456" + "000000001234" + "697" + "005hello" + "0242"
    return encode("1644") + bitmap + encode(body)


@pytest.mark.parametrize("ebcdic", [False, True])
def test_message_with_two_bitmaps(spark, ebcdic):
    ((mti, ok, elements),) = decoded(spark, [message(ebcdic)], ebcdic)
    assert (mti, ok) == ("1644", True)
    assert elements["de_3"] == "123456" and elements["de_24"] == "697" and elements["de_48"] == "hello"
    assert elements["de_94"] == "42"


def test_message_cut_short_keeps_what_is_whole(spark):
    whole = message()
    head, (_, ok, elements), nothing = decoded(spark, [whole[:10], whole[:45], None], False)
    assert head == nothing == (None, False, {})
    assert ok and "de_48" not in elements and elements["de_24"] == "697"
