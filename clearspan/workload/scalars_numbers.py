"""Amounts, decimals and fees (J1-J12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.functions import numbers, typed
from clearspan.operators.lookup import lookup_join
from clearspan.workload.registry import query, scalar

FEE_INPUTS = {
    "amount": "CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4))",
    "variable": "CASE WHEN file_no = 0 THEN NULL ELSE CAST(merchant_nation * CAST('0.0011' AS DECIMAL(6,4)) AS DECIMAL(14,8)) END",
    "fixed": "CASE WHEN file_no = 1 THEN NULL ELSE CAST(merchant_region * CAST('1.25' AS DECIMAL(4,2)) AS DECIMAL(18,4)) END",
    "low": "CASE WHEN file_no = 2 THEN NULL ELSE CAST(issuer_region * CAST('20.5' AS DECIMAL(4,1)) AS DECIMAL(18,4)) END",
    "high": "CASE WHEN file_no = 3 THEN NULL ELSE CAST(issuer_region * CAST('20.5' AS DECIMAL(4,1)) + 1500 AS DECIMAL(18,4)) END",
    "fee_ccy": "CASE WHEN direction = 'IN' THEN 'EUR' ELSE 'USD' END",
    "ccy": "ccy",
    "rate": "CASE WHEN ccy = 'JPY' THEN NULL ELSE CAST(1 + issuer_nation * CAST('0.0137' AS DECIMAL(6,4)) AS DECIMAL(18,10)) END",
}
_FX = "CAST(CASE WHEN fee_ccy = ccy THEN 1 ELSE rate END AS DECIMAL(18,10))"
_FIX, _LOW, _HIGH = (f"CAST({c} * {_FX} AS DECIMAL(34,14))" for c in ("fixed", "low", "high"))

scalar(
    "num_fee_clamped",
    FEE_INPUTS,
    lambda: [
        numbers.fee_clamped(
            *[F.col(c) for c in ("amount", "variable", "fixed", "low", "high")],
            numbers.fee_rate_to(F.col("fee_ccy"), F.col("ccy"), F.col("rate")),
        ).alias("fee")
    ],
    {
        "fee": f"CAST(least(greatest(CAST(amount * coalesce(variable, CAST(0 AS DECIMAL(14,8))) AS DECIMAL(34,14)) + coalesce({_FIX}, CAST(0 AS DECIMAL(34,14))), {_LOW}), {_HIGH}) AS DECIMAL(34,14))"
    },
)

scalar(
    "num_fee_clamped_strict",
    FEE_INPUTS,
    lambda: [
        numbers.fee_clamped_strict(
            *[F.col(c) for c in ("amount", "variable", "fixed", "low", "high")],
            numbers.fee_rate_to(F.col("fee_ccy"), F.col("ccy"), F.col("rate"), blank_is_same=True),
        ).alias("fee")
    ],
    {
        "fee": f"""CAST(CASE WHEN variable IS NULL THEN CASE WHEN fixed IS NULL THEN CAST(0 AS DECIMAL(34,14)) ELSE {_FIX} END
        WHEN (fixed IS NOT NULL OR low IS NOT NULL OR high IS NOT NULL) AND {_FX} IS NULL THEN NULL
        ELSE least(greatest(CAST(amount * variable AS DECIMAL(34,14)) + CASE WHEN fixed IS NULL THEN CAST(0 AS DECIMAL(34,14)) ELSE {_FIX} END, {_LOW}), {_HIGH}) END AS DECIMAL(34,14))"""
    },
)

scalar(
    "num_settlement_amount",
    {
        "incoming": "direction = 'IN'",
        "reconciled": "CAST(amount_cents * CAST('0.011' AS DECIMAL(5,3)) AS DECIMAL(18,4))",
        "amount": FEE_INPUTS["amount"],
        "domestic": "merchant_nation = issuer_nation OR merchant_region = issuer_region",
        "ccy": "ccy",
        "local_rate": "CASE WHEN file_no = 0 THEN NULL ELSE CAST(1 + file_no * CAST('0.1234567' AS DECIMAL(8,7)) AS DECIMAL(18,10)) END",
        "settle_rate": "CASE WHEN file_no = 1 THEN NULL ELSE CAST(2 + file_no * CAST('0.0234561' AS DECIMAL(8,7)) AS DECIMAL(18,10)) END",
    },
    lambda: [
        numbers.settlement_amount(
            F.col("incoming"), F.col("reconciled"), F.col("amount"), F.col("domestic") & (F.col("ccy") == "GBP"),
            F.col("local_rate"), F.col("settle_rate"),
        ).alias("settlement_amount"),
        numbers.settlement_currency(
            F.col("incoming"), F.lit("REC"), F.col("domestic") & (F.col("ccy") == "GBP"), F.lit("GBP"), F.lit("EUR")
        ).alias("settlement_ccy"),
    ],
    {
        "settlement_amount": "CASE WHEN incoming THEN reconciled WHEN domestic AND ccy = 'GBP' AND local_rate IS NOT NULL "
        "THEN CAST(round(CAST(amount AS DECIMAL(28,4)) * local_rate, 4) AS DECIMAL(18,4)) ELSE CAST(round(CAST(amount AS DECIMAL(28,4)) * settle_rate, 4) AS DECIMAL(18,4)) END",
        "settlement_ccy": "CASE WHEN incoming THEN 'REC' WHEN domestic AND ccy = 'GBP' THEN 'GBP' ELSE 'EUR' END",
    },
)

_CENTS = "CAST(amount_cents AS STRING)"
scalar(
    "num_implied_decimal",
    {"s": f"CASE file_no WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN CAST(merchant_nation AS STRING) || '.375' WHEN 3 THEN ' ' || {_CENTS} || ' ' WHEN 4 THEN NULL ELSE '-' || {_CENTS} END",
     "file_no": "file_no", "cents": "amount_cents", "n": "merchant_nation"},
    lambda: [
        numbers.implied_decimal(F.col("s"), 2).cast("decimal(20,4)").alias("two"),
        numbers.implied_decimal(F.col("s"), 0).cast("decimal(20,4)").alias("none"),
        numbers.implied_decimal(F.col("s"), 6).cast("decimal(20,6)").alias("six"),
    ],
    {
        "two": "CAST(CASE WHEN file_no = 2 THEN n + CAST('0.375' AS DECIMAL(4,3)) WHEN file_no = 3 THEN cents * CAST('0.01' AS DECIMAL(3,2)) "
        "WHEN file_no > 4 THEN -cents * CAST('0.01' AS DECIMAL(3,2)) END AS DECIMAL(20,4))",
        "none": "CAST(CASE WHEN file_no = 2 THEN n + CAST('0.375' AS DECIMAL(4,3)) WHEN file_no = 3 THEN cents WHEN file_no > 4 THEN -cents END AS DECIMAL(20,4))",
        "six": "CAST(CASE WHEN file_no = 2 THEN n + CAST('0.375' AS DECIMAL(4,3)) WHEN file_no = 3 THEN cents * CAST('0.000001' AS DECIMAL(7,6)) "
        "WHEN file_no > 4 THEN -cents * CAST('0.000001' AS DECIMAL(7,6)) END AS DECIMAL(20,6))",
    },
)

scalar(
    "num_scale_prefixed",
    {"s": f"CASE file_no WHEN 0 THEN 'x' WHEN 1 THEN '7' WHEN 2 THEN '1.5' ELSE CAST(file_no AS STRING) || {_CENTS} END",
     "file_no": "file_no", "cents": "amount_cents"},
    lambda: [numbers.scale_prefixed(F.col("s")).alias("rate")],
    {
        "rate": "CAST(CASE file_no WHEN 2 THEN CAST('1.5' AS DECIMAL(2,1)) WHEN 3 THEN CAST(cents AS DECIMAL(18,0)) * CAST('0.001' AS DECIMAL(4,3)) "
        "WHEN 4 THEN CAST(cents AS DECIMAL(18,0)) * CAST('0.0001' AS DECIMAL(5,4)) WHEN 5 THEN CAST(cents AS DECIMAL(18,0)) * CAST('0.00001' AS DECIMAL(6,5)) "
        "WHEN 6 THEN CAST(cents AS DECIMAL(18,0)) * CAST('0.000001' AS DECIMAL(7,6)) END AS DECIMAL(28,9))"
    },
)


@query(
    "num_currency_decimals",
    """SELECT record, CAST(CASE WHEN file_no = 0 THEN NULL ELSE (CASE WHEN direction = 'IN' THEN 1 ELSE -1 END) * CAST(amount_cents AS DECIMAL(18,0)) *
        CASE ccy WHEN 'JPY' THEN CAST('1' AS DECIMAL(5,4)) WHEN 'USD' THEN CAST('0.001' AS DECIMAL(5,4)) ELSE CAST('0.01' AS DECIMAL(5,4)) END END AS DECIMAL(18,4)) AS amount FROM txn""",
    ("txn",),
)
def _currency_decimals(spark, sf_dir):
    digits = F.create_map(*[F.lit(x) for x in ("EUR", 2, "JPY", 0, "USD", 3)])
    rows = fixtures.txn(spark, sf_dir).selectExpr(
        "record", "ccy",
        "CASE WHEN file_no = 0 THEN 'n/a' ELSE CASE WHEN direction = 'IN' THEN '' ELSE '-' END || amount_cents END AS s",
    )
    dims = rows.select("ccy").distinct().withColumn("decimals", F.try_element_at(digits, F.col("ccy")))
    joined = lookup_join(rows, dims, ["ccy"], ["decimals"])
    return joined.select("record", numbers.currency_scaled(F.col("s"), F.col("decimals")).alias("amount"))


CAST_CATALOG = [
    {"name": "count_text", "type": "int"},
    {"name": "amount_text", "type": "float", "decimals": 2},
    {"name": "day_text", "type": "date", "format": "YDDD"},
    {"name": "label", "type": "str"},
    {"name": "account_number", "type": "str", "digits_only": True},
]
MESSAGE_CATALOG = [
    {"name": "count_text", "type": "int64"},
    {"name": "stamp", "type": "timestamp"},
    {"name": "clock", "type": "time"},
    {"name": "rate_text", "type": "decimal", "decimals": -1},
    {"name": "amount_text", "type": "decimal", "decimals": 2},
    {"name": "amount_ccy", "type": "decimal", "decimals": -2},
]
CAST_INPUTS = """record, processing_date,
  CASE WHEN file_no = 0 THEN 'x1' ELSE ' ' || CAST(merchant_nation AS STRING) || ' ' END AS count_text,
  CASE WHEN file_no = 1 THEN '??' ELSE CAST(amount_cents AS STRING) END AS amount_text,
  CASE WHEN file_no = 2 THEN '0000' ELSE substr(CAST(year(purchase_date) AS STRING), 4, 1) || lpad(CAST(dayofyear(purchase_date) AS STRING), 3, '0') END AS day_text,
  CASE WHEN file_no = 3 THEN '   ' ELSE ' ' || priority END AS label,
  substr(CAST(acct9 AS STRING), 1, 6) || 'XX*' AS account_number,
  substr(replace(CAST(processing_date AS STRING), '-', ''), 3) || '10' || lpad(CAST(merchant_nation AS STRING), 2, '0') || '07' AS stamp,
  '9' || lpad(CAST(merchant_nation AS STRING), 4, '0') AS clock,
  '5' || CAST(amount_cents AS STRING) AS rate_text,
  CAST(amount_cents AS STRING) AS amount_ccy, CASE WHEN ccy = 'JPY' THEN 392 ELSE 978 END AS currency_code_transaction_de_49"""


@query(
    "num_cast_by_catalog",
    f"""SELECT record, CAST(CASE WHEN count_text = 'x1' THEN 0 ELSE CAST(trim(count_text) AS BIGINT) END AS BIGINT) AS count_text,
      CAST(CASE WHEN amount_text = '??' THEN 0 ELSE CAST(amount_text AS DECIMAL(18,0)) * CAST('0.01' AS DECIMAL(3,2)) END AS DECIMAL(28,8)) AS amount_text,
      CASE WHEN day_text = '0000' THEN processing_date ELSE (SELECT CASE WHEN year(g) = y THEN g END FROM (SELECT y, make_date(y, 1, 1) + CAST(CAST(substr(day_text, 2, 3) AS INTEGER) - 1 AS INTEGER) AS g FROM
        (SELECT CASE WHEN yy >= 69 THEN 1900 + yy ELSE 2000 + yy END AS y FROM (SELECT CAST(substr(CAST(year(processing_date) AS VARCHAR), 3, 1) || left(day_text, 1) AS INTEGER) AS yy)))) END AS day_text,
      CASE WHEN trim(label) = '' THEN ' ' ELSE trim(label) END AS label,
      substr(account_number, 1, 6) || '000' AS account_number
    FROM (SELECT {CAST_INPUTS} FROM txn) t""",
    ("txn",),
)
def _cast_text(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).selectExpr(*_split_exprs(CAST_INPUTS))
    return rows.select("record", *typed.text_record_columns(CAST_CATALOG, F.col("processing_date")))


@query(
    "num_cast_by_message_catalog",
    f"""SELECT record, CASE WHEN count_text <> 'x1' THEN CAST(trim(count_text) AS BIGINT) END AS count_text,
      CAST(processing_date + CAST(lpad(substr(stamp, 7, 2), 2, '0') || ':' || substr(stamp, 9, 2) || ':' || substr(stamp, 11, 2) AS TIME) AS VARCHAR) AS stamp_text,
      '09:' || substr(clock, 2, 2) || ':' || substr(clock, 4, 2) AS clock,
      CAST(CAST(substr(rate_text, 2) AS DECIMAL(18,0)) * CAST('0.00001' AS DECIMAL(6,5)) AS DECIMAL(18,9)) AS rate_text,
      CASE WHEN amount_text <> '??' THEN CAST(CAST(amount_text AS DECIMAL(18,0)) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,2)) END AS amount_text,
      CAST(CASE WHEN currency_code_transaction_de_49 = 392 THEN CAST(amount_ccy AS DECIMAL(18,0)) ELSE CAST(amount_ccy AS DECIMAL(18,0)) * CAST('0.01' AS DECIMAL(3,2)) END AS DECIMAL(18,4)) AS amount_ccy
    FROM (SELECT {CAST_INPUTS} FROM txn) t""",
    ("txn",),
)
def _cast_message(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).selectExpr(*_split_exprs(CAST_INPUTS))
    rows = rows.withColumn("decimals_of", F.create_map(F.lit("392"), F.lit(0), F.lit("978"), F.lit(2)))
    out = rows.select("record", *typed.message_columns(rows, MESSAGE_CATALOG))
    return out.withColumn("stamp_text", F.date_format("stamp", "yyyy-MM-dd HH:mm:ss")).drop("stamp")


def _split_exprs(text: str) -> list[str]:
    """Split a select list at commas outside parentheses and quotes."""
    parts, depth, quoted, current = [], 0, False, ""
    for ch in text:
        quoted ^= ch == "'"
        depth += (ch == "(") - (ch == ")") if not quoted else 0
        if ch == "," and not depth and not quoted:
            parts.append(current.strip())
            current = ""
        else:
            current += ch
    return [*parts, current.strip()]


scalar(
    "num_reversal_sign",
    {"amount": "amount_cents", "fee": "merchant_nation * 3", "is_reversal": "code IN ('25', '15')"},
    lambda: [
        numbers.signed_for_reversal(F.col("amount"), F.col("is_reversal")).alias("amount"),
        numbers.signed_for_reversal(F.col("fee"), F.col("is_reversal")).alias("fee"),
    ],
    {"amount": "amount * CASE WHEN is_reversal THEN -1 ELSE 1 END", "fee": "fee * CASE WHEN is_reversal THEN -1 ELSE 1 END"},
)

scalar(
    "num_row_max",
    {"a": "CASE WHEN file_no = 0 THEN NULL ELSE amount_cents END", "b": "CASE WHEN file_no < 2 THEN NULL ELSE record END", "c": "CASE WHEN file_no < 3 THEN NULL ELSE acct9 END"},
    lambda: [numbers.largest(F.col("a"), F.col("b"), F.col("c")).alias("largest")],
    {"largest": "CASE WHEN coalesce(a, 0) >= coalesce(b, 0) AND coalesce(a, 0) >= coalesce(c, 0) THEN coalesce(a, 0) "
     "WHEN coalesce(b, 0) >= coalesce(c, 0) THEN coalesce(b, 0) ELSE coalesce(c, 0) END"},
)

scalar(
    "num_round_text",
    {
        "v": "CASE WHEN file_no = 0 THEN NULL ELSE CAST(CASE WHEN file_no = 1 THEN -1 ELSE 1 END * amount_cents * CAST('0.0012345' AS DECIMAL(9,7)) AS DECIMAL(28,8)) END",
        "s": "CAST(merchant_nation AS STRING) || ',' || lpad(CAST(record % 1000 AS STRING), 3, '0') || '.5'",
        "n": "merchant_nation",
        "r": "record % 1000",
    },
    lambda: [
        numbers.amount_text(F.col("v")).alias("amount_text"),
        numbers.ratio_text(F.col("v")).alias("ratio_text"),
        numbers.plain_decimal(F.col("s")).alias("plain"),
    ],
    {
        "amount_text": "CASE WHEN v IS NULL THEN '' ELSE CAST(CAST(round(v, 2) AS DECIMAL(28,2)) AS VARCHAR) END",
        "ratio_text": "CASE WHEN v IS NULL THEN '' ELSE regexp_replace(CAST(v AS VARCHAR), '[0-9]{2}$', '') END",
        "plain": "CAST(n * 1000 + r + CAST('0.5' AS DECIMAL(2,1)) AS DECIMAL(28,6))",
    },
)

scalar(
    "num_zero_amount_fallback",
    {
        "amount": "CASE WHEN file_no < 3 THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(amount_cents AS DECIMAL(18,4)) END",
        "rate": "CASE WHEN ccy = 'JPY' THEN NULL ELSE CAST(1 + merchant_region * CAST('0.25' AS DECIMAL(3,2)) AS DECIMAL(18,10)) END",
        "crypto": "CASE WHEN file_no = 0 THEN NULL ELSE CAST(record AS DECIMAL(18,4)) END",
        "extra": "CASE WHEN file_no = 1 THEN NULL ELSE CAST(merchant_nation AS DECIMAL(18,4)) END",
        "crypto_rate": "CASE WHEN ccy = 'GBP' THEN NULL ELSE CAST('1.5' AS DECIMAL(18,10)) END",
    },
    lambda: [
        numbers.amount_or_fallback(*[F.col(c) for c in ("amount", "rate", "crypto", "extra", "crypto_rate")])
        .cast("decimal(30,10)").alias("reported")
    ],
    {
        "reported": "CAST(CASE WHEN amount = 0 THEN coalesce(crypto_rate, CAST(1 AS DECIMAL(18,10))) * CAST(coalesce(crypto, 0) + coalesce(extra, 0) AS DECIMAL(28,4)) "
        "ELSE coalesce(rate, CAST(1 AS DECIMAL(18,10))) * CAST(amount AS DECIMAL(28,4)) END AS DECIMAL(30,10))"
    },
)


@query(
    "num_unit_cost",
    """SELECT file_no, merchant_nation, CAST((200000000 * sum(amount_cents) + count(*)) // (2 * count(*)) AS DECIMAL(24,0)) AS cost_e8 FROM txn GROUP BY file_no, merchant_nation""",
    ("txn",),
)
def _unit_cost(spark, sf_dir):
    groups = fixtures.txn(spark, sf_dir).groupBy("file_no", "merchant_nation").agg(
        F.sum("amount_cents").alias("c"), F.count("*").alias("n")
    )
    cost = numbers.unit_cost(F.col("c").cast("decimal(24,0)") * 100, F.col("n"))
    return groups.select("file_no", "merchant_nation", (cost * 1_000_000).cast("decimal(24,0)").alias("cost_e8"))


@query(
    "map_code_lookup",
    """SELECT record, CASE WHEN direction = 'IN' THEN CASE merchant_region WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 8 END
       ELSE CASE merchant_region WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 END END AS scope,
       CASE code WHEN '05' THEN 1 WHEN '06' THEN 1 WHEN '07' THEN 8 ELSE 255 END AS type_id FROM txn""",
    ("txn",),
)
def _maps(spark, sf_dir):
    from clearspan.functions import classify

    rows = fixtures.txn(spark, sf_dir)
    maps = {"IN": {0: 1, 1: 2, 2: 4, 3: 8}, "OUT": {0: 1, 1: 2, 2: 3, 3: 4}}
    scope = classify.brand_map(F.col("direction"), F.col("merchant_region"), maps, "OUT")
    kind = F.coalesce(classify.by_map(F.col("code"), {"05": 1, "06": 1, "07": 8}), F.lit(255))
    return rows.select("record", scope.alias("scope"), kind.alias("type_id"))
