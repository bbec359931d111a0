"""Decoding one message payload: class, bitmap and data elements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Length of each fixed data element.
FIXED_LENGTH = {
    3: 6, 4: 12, 5: 12, 6: 12, 9: 8, 10: 8, 12: 12, 14: 4, 22: 12, 23: 3, 24: 3, 25: 4, 26: 4, 30: 24, 37: 12, 38: 6,
    40: 3, 41: 8, 42: 15, 49: 3, 50: 3, 51: 3, 71: 8, 73: 6,
}
# Number of length digits of each variable data element.
LENGTH_DIGITS = {
    2: 2, 31: 2, 32: 2, 33: 2, 43: 2, 48: 3, 54: 3, 55: 3, 62: 3, 63: 3, 72: 3, 93: 2, 94: 2, 95: 2, 100: 2, 105: 3,
    111: 3, 123: 3, 124: 3, 125: 3, 127: 3,
}
# Elements read as digits, and elements kept as hexadecimal.
DIGIT_ELEMENTS = {2, 3, 4, 5, 6, 9, 10, 12, 14, 23, 24, 25, 26, 30, 37, 38, 49, 50, 51, 71, 73, 93, 94, 95, 100}
BINARY_ELEMENTS = {55}

#: Bits of the shorter bitmap; its first bit says that a second one follows.
BITS = 64
# White space around digits.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"

_BYTES = bytes(range(256)).decode("latin1")
_OUT = "array<struct<key:string,value:string>>"


def _translated(latin: Column, to: str) -> Column:
    """Text with one character per byte, each replaced by that of ``to``; what stays is left out, as nothing may become 0."""
    changed = [(a, b) for a, b in zip(_BYTES, to, strict=True) if a != b]
    return F.translate(latin, "".join(a for a, _ in changed), "".join(b for _, b in changed)) if changed else latin


def _digits(latin: Column, ebcdic: bool) -> Column:
    if ebcdic:
        return _translated(latin, "".join(chr(b - 0xC0) if 0xF0 <= b <= 0xF9 else "?" for b in range(256)))
    return latin


def _text(latin: Column, ebcdic: bool) -> Column:
    if ebcdic:
        return _translated(latin, bytes(range(256)).decode("cp500"))
    unreadable = _translated(latin, bytes(range(256)).decode("ascii", errors="replace"))
    return F.when(F.octet_length(latin) > F.length(latin), unreadable).otherwise(latin)


def _trimmed(digits: Column, ebcdic: bool) -> Column:
    return digits if ebcdic else F.btrim(digits, F.lit(BLANKS))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _by_number(values: dict[int, int]) -> Column:
    return F.array(*[F.lit(values.get(n)).cast("int") for n in range(2 * BITS + 1)])


def _head_length(payload: Column) -> Column:
    """Bytes of class and bitmap; a second bitmap follows if the first bit is set."""
    second = (F.length(payload) > 4) & (F.hex(F.substring(payload, 5, 1)) >= "80")
    return F.when(second, F.lit(20)).otherwise(F.lit(12))


def message_class(payload: Column, ebcdic: bool) -> Column:
    """The class of a message whose head is complete, else null."""
    first = _digits(F.decode(F.substring(payload, 1, 4), "ISO-8859-1"), ebcdic)
    return F.when(F.length(payload) >= _head_length(payload), _trimmed(first, ebcdic))


def decoded_payload(payload: Column, ebcdic: bool) -> Column:
    """Struct of class, whether the head is complete, and element texts (key, value) up to the first that is cut short.

    The bits of the bitmap are split at its ones, and the runs of zeros between them are folded in order, with the number of
    the element and its place in the payload as state. Numbers and texts are cut from views of the payload that
    have one character per byte.
    """
    latin = F.decode(payload, "ISO-8859-1")
    bits = lambda start: F.lpad(F.conv(F.hex(F.substring(payload, start, 8)), 16, 2), BITS, "0")
    head = _head_length(payload)
    whole = payload.isNotNull() & (F.length(payload) >= head)
    runs = F.split(F.when(head == 20, F.concat(F.substring(bits(5), 2, BITS), bits(13))).otherwise(F.substring(bits(5), 2, BITS)), "1")
    views = F.struct(payload.alias("raw"), F.length(payload).alias("size"), _digits(latin, ebcdic).alias("digits"), _text(latin, ebcdic).alias("text"))
    fixed, stated = _by_number(FIXED_LENGTH), _by_number(LENGTH_DIGITS)

    def element(view: Column, state: Column, run: Column) -> Column:
        """The state after the next element; once an element is cut short the others are left."""
        n, at, out = state["n"] + F.length(run) + 1, state["at"], state["out"]

        # Where the value begins, and its length, which stands before it for elements with length digits.
        width = F.get(stated, n)
        told = _trimmed(F.substr(view["digits"], at + 1, width), ebcdic)
        length = F.when(width.isNull(), F.get(fixed, n)).when((at + width <= view["size"]) & told.rlike("^[0-9]+$"), told.try_cast("int"))
        place = F.struct((at + F.coalesce(width, F.lit(0))).alias("start"), length.alias("length"))

        def taken(p: Column) -> Column:
            start, length = p["start"], p["length"]
            digits = _trimmed(F.substr(view["digits"], start + 1, length), ebcdic)
            value = F.when(n.isin(*DIGIT_ELEMENTS), digits).when(n.isin(*BINARY_ELEMENTS), F.lower(F.hex(F.substr(view["raw"], start + 1, length))))
            item = F.struct(F.concat(F.lit("de_"), n.cast("string")).alias("key"), value.otherwise(F.substr(view["text"], start + 1, length)).alias("value"))
            after = F.struct(n.alias("n"), (start + length).alias("at"), F.lit(True).alias("going"), F.concat(out, F.array(item)).alias("out"))
            ended = F.struct(n.alias("n"), at.alias("at"), F.lit(False).alias("going"), out.alias("out"))
            return F.when(start + length <= view["size"], after).otherwise(ended)

        return F.when(state["going"], _let(place, taken)).otherwise(state)

    begun = F.struct(F.lit(1).alias("n"), head.alias("at"), F.lit(True).alias("going"), F.array().cast(_OUT).alias("out"))
    found = _let(views, lambda view: F.aggregate(F.slice(runs, 1, F.size(runs) - 1), begun, lambda state, run: element(view, state, run), lambda state: state["out"]))
    return F.struct(
        message_class(payload, ebcdic).alias("mti"),
        whole.alias("parse_ok"), F.map_from_entries(F.when(whole, found).otherwise(F.array().cast(_OUT))).alias("elements"),
    )


def decode_messages(df: DataFrame, payload: str, ebcdic: bool, keep: list[str]) -> DataFrame:
    """Decode a table of payload rows; class 1644 shows its function code."""
    rows = df.select(*keep, decoded_payload(F.col(payload), ebcdic).alias("__decoded"))
    code = F.when(F.col("__decoded.mti") == "1644", F.col("__decoded.elements")["de_24"])
    return rows.select(*keep, F.col("__decoded.mti").alias("mti"), code.alias("function_code"), F.col("__decoded.parse_ok").alias("parse_ok"), F.col("__decoded.elements").alias("elements"))
