"""Text functions (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearspan.functions import text
from clearspan.workload.registry import query, scalar

PAN = "substr(CAST(acct9 AS STRING), 1, 6) || '******' || lpad(CAST(record % 10000 AS STRING), 4, '0')"
REFERENCE = (
    "CASE WHEN code = '' THEN '   ' WHEN merchant_nation = 3 THEN '7AB12' "
    "ELSE '2' || lpad(CAST(merchant_nation * 1000 + file_no AS STRING), 6, '0') || 'XYZ' END"
)

scalar(
    "str_mask_to_zero",
    {"pan": PAN, "mixed": "'A' || CAST(acct9 AS STRING) || '-x' || code"},
    lambda: [text.mask_to_zero(F.col("pan")).alias("pan_zero"), text.non_digits_to_zero(F.col("mixed")).alias("digits")],
    {"pan_zero": "replace(pan, '*', '0')", "digits": "regexp_replace(mixed, '[^0-9]', '0', 'g')"},
)

scalar(
    "str_prefix",
    {"pan": "substr(CAST(acct9 AS STRING), 1, 7) || '*****' || CAST(record AS STRING)", "ref": REFERENCE},
    lambda: [
        text.prefix(F.col("pan"), 6).alias("bin6"),
        text.prefix(F.col("pan"), 8).alias("bin8"),
        text.account9(F.col("pan")).alias("account9"),
        text.acquirer_bin(F.col("ref")).alias("acquirer_bin"),
    ],
    {
        "bin6": "substr(pan, 1, 6)",
        "bin8": "replace(substr(pan, 1, 8), '*', '0')",
        "account9": "CAST(substr(replace(pan, '*', '0'), 1, 9) AS BIGINT)",
        "acquirer_bin": "CASE WHEN trim(ref) <> '' THEN TRY_CAST(substr(ref, 2, 6) AS INTEGER) END",
    },
)

scalar(
    "str_first_non_blank",
    {
        "a": "CASE WHEN direction = 'IN' THEN '  ' ELSE NULL END",
        "b": "code",
        "c": "' ' || priority || ' '",
    },
    lambda: [text.first_non_blank(F.col("a"), F.col("b"), F.col("c")).alias("chosen")],
    {"chosen": "CASE WHEN trim(coalesce(a, '')) <> '' THEN trim(a) WHEN trim(b) <> '' THEN trim(b) ELSE trim(c) END"},
)

scalar(
    "str_pad",
    {"n": "merchant_nation", "big": "record"},
    lambda: [
        text.pad_code(F.col("n"), 3).alias("code3"),
        text.pad_code(F.col("n"), 6).alias("code6"),
        text.pad_code(F.col("big"), 3).alias("cut3"),
    ],
    {
        "code3": "right('000' || CAST(n AS VARCHAR), 3)",
        "code6": "right('000000' || CAST(n AS VARCHAR), 6)",
        "cut3": "CASE WHEN big >= 1000 THEN left(CAST(big AS VARCHAR), 3) ELSE right('000' || CAST(big AS VARCHAR), 3) END",
    },
)

scalar(
    "str_normalise",
    {"s": "CASE WHEN code = '' THEN '   ' WHEN code = '15' THEN NULL ELSE '  ' || lower(priority) || '  x ' END"},
    lambda: [
        text.clean(F.col("s")).alias("trimmed"),
        text.clean_upper(F.col("s")).alias("upper_text"),
        text.rule_text(F.col("s")).alias("rule_text"),
        text.blank_to_null(F.col("s")).alias("null_if_blank"),
        text.blank_to_space(F.col("s")).alias("space_if_blank"),
        text.or_blank_word(F.col("s"), when_empty=True).alias("blank_word"),
    ],
    {
        "trimmed": "trim(s)",
        "upper_text": "upper(trim(s))",
        "rule_text": "upper(replace(s, ' ', ''))",
        "null_if_blank": "CASE WHEN trim(s) <> '' THEN trim(s) END",
        "space_if_blank": "CASE WHEN trim(s) = '' THEN ' ' ELSE trim(s) END",
        "blank_word": "CASE WHEN coalesce(trim(s), '') = '' THEN 'BLANK' ELSE trim(s) END",
    },
)

scalar(
    "str_suffix_class",
    {
        "auth": "CASE file_no WHEN 0 THEN '12345x' WHEN 1 THEN '100000' WHEN 2 THEN '0000' WHEN 3 THEN '0000n' "
        "WHEN 4 THEN ' ' WHEN 5 THEN NULL ELSE CAST(acct9 AS STRING) END"
    },
    lambda: [text.code_validity(F.col("auth")).alias("validity")],
    {
        "validity": "CASE WHEN auth IS NULL THEN 'VALID' WHEN right(auth, 1) = 'x' "
        "OR right(auth, 5) IN (' ', '0000', '00000', '0000n', '0000p', '0000y') THEN 'INVALID' ELSE 'VALID' END"
    },
)

scalar(
    "str_delimited_address",
    {
        "addr": "CASE WHEN file_no = 0 THEN NULL WHEN file_no = 1 THEN priority ELSE 'Shop ' || CAST(record AS STRING) || chr(92) "
        "|| priority || chr(92) || CASE WHEN file_no = 2 THEN '' ELSE 'City' END || chr(92) || "
        "rpad(CAST(acct9 AS STRING), 10, ' ') || 'SUB' || CASE WHEN file_no = 3 THEN 'GR' ELSE 'GRC99' END END"
    },
    lambda: text.address_parts(F.col("addr"), "de_43"),
    {
        "de_43_1": "nullif(rtrim(split_part(addr, chr(92), 1)), '')",
        "de_43_2": "nullif(rtrim(split_part(addr, chr(92), 2)), '')",
        "de_43_3": "nullif(rtrim(split_part(addr, chr(92), 3)), '')",
        "de_43_4": "nullif(rtrim(substr(split_part(addr, chr(92), 4), 1, 10)), '')",
        "de_43_5": "nullif(rtrim(substr(split_part(addr, chr(92), 4), 11, 3)), '')",
        "de_43_6": "nullif(rtrim(substr(split_part(addr, chr(92), 4), 14, 3)), '')",
    },
)

FIXED_LINE = (
    "code || CASE WHEN code = '' THEN '  ' ELSE '' END || CAST(file_no AS STRING) || lpad(CAST(amount_cents AS STRING), 12, '0') "
    "|| ccy || CASE WHEN direction = 'IN' THEN 'AX' ELSE 'BY' END || priority"
)
FIXED_LAYOUT = [
    {"source": "line", "name": "tc", "position": 1, "length": 2},
    {"source": "line", "name": "amount_text", "position": 4, "length": 12},
    {"source": "line", "name": "ccy_text", "position": 16, "length": 3},
    {"source": "line", "name": "in_priority", "position": 21, "length": 6, "id": "AX", "id_position": 19, "id_length": 2},
    {"source": "line", "name": "out_priority", "position": 21, "length": 20, "id": "BY", "id_position": 19, "id_length": 2},
]
scalar(
    "str_fixed_width_slice",
    {"line": FIXED_LINE},
    lambda: [
        *text.fixed_fields(FIXED_LAYOUT),
        *text.consecutive_fields(F.substring("line", 4, 15), {"whole": 10, "cents": 2, "unit": 3}),
    ],
    {
        "tc": "substr(line, 1, 2)",
        "amount_text": "substr(line, 4, 12)",
        "ccy_text": "substr(line, 16, 3)",
        "in_priority": "CASE WHEN substr(line, 19, 2) = 'AX' THEN substr(line, 21, 6) ELSE '' END",
        "out_priority": "CASE WHEN substr(line, 19, 2) = 'BY' THEN substr(line, 21, 20) ELSE '' END",
        "whole": "substr(line, 4, 10)",
        "cents": "substr(line, 14, 2)",
        "unit": "substr(line, 16, 3)",
    },
)

# Two containers of tag(4) length(3) value items; the second repeats tag 0158 and may end in a cut item.
BOX_ONE = (
    "'0105' || lpad(CAST(length(event_type) AS STRING), 3, '0') || event_type || "
    "CASE WHEN user_id % 3 = 0 THEN 'zz?' ELSE '' END || '0158004' || lpad(CAST(user_id % 10000 AS STRING), 4, '0')"
)
BOX_TWO = "CASE WHEN user_id % 2 = 0 THEN '0158003abc0165001M' ELSE '0165099short' END"


@query(
    "str_tlv_extract",
    f"""SELECT event_id, event_type AS tag_105,
      CASE WHEN user_id % 2 = 0 THEN 'abc' ELSE lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0') END AS tag_158,
      CASE WHEN user_id % 2 = 0 THEN 'M' END AS tag_165 FROM events""",
)
def _tagged(spark, sf_dir):
    base = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", f"{BOX_ONE} AS one", f"{BOX_TWO} AS two")
    tags = base.select("event_id", text.tagged_from_containers(F.col("one"), F.col("two")).alias("tags"))
    return tags.select("event_id", *[F.col("tags")[f"0{t}"].alias(f"tag_{t}") for t in (105, 158, 165)])


scalar(
    "str_overpunch",
    {
        "s": "CASE file_no WHEN 0 THEN NULL WHEN 1 THEN 'bad' ELSE substr(CAST(amount_cents AS STRING), 1, length(CAST(amount_cents AS STRING)) - 1) "
        "|| CASE WHEN direction = 'IN' THEN substr('{ABCDEFGHI', CAST(amount_cents % 10 AS INT) + 1, 1) "
        "ELSE substr('}JKLMNOPQR', CAST(amount_cents % 10 AS INT) + 1, 1) END END",
        "cents": "amount_cents",
        "file_no": "file_no",
        "direction": "direction",
    },
    lambda: [
        text.overpunch_amount(F.col("s"), 2).alias("amount"),
        text.overpunch_amount(F.col("s"), 2, signed=True).alias("signed_amount"),
    ],
    {
        "amount": "CAST(CASE WHEN file_no < 2 THEN 0 ELSE CAST(cents AS DECIMAL(18,0)) * CAST('0.01' AS DECIMAL(3,2)) END AS DECIMAL(28,8))",
        "signed_amount": "CAST(CASE WHEN file_no < 2 THEN 0 ELSE (CASE WHEN direction = 'IN' THEN 1 ELSE -1 END) * "
        "CAST(cents AS DECIMAL(18,0)) * CAST('0.01' AS DECIMAL(3,2)) END AS DECIMAL(28,8))",
    },
)

scalar(
    "str_pattern_tests",
    {"ind": "CASE WHEN code = '' THEN ' ' ELSE CAST(merchant_nation AS STRING) END", "name": "priority || lpad(CAST(file_no AS STRING), 5, '0')"},
    lambda: [
        F.col("ind").rlike("^[1-9]$").alias("is_remote"),
        F.col("name").like("%00004").alias("is_main_file"),
        F.lower("name").rlike("urgent|high").alias("is_hasty"),
    ],
    {
        "is_remote": "ind IN ('1','2','3','4','5','6','7','8','9')",
        "is_main_file": "right(name, 5) = '00004'",
        "is_hasty": "contains(lower(name), 'urgent') OR contains(lower(name), 'high')",
    },
)

scalar(
    "str_regex_extract",
    {"pan": "CASE WHEN file_no = 0 THEN 'X1' ELSE CAST(acct9 AS STRING) || '000' END", "cond": "'>=' || CAST(merchant_nation AS STRING) || '<' || CAST(record AS STRING)"},
    lambda: [
        text.leading_digits(F.col("pan"), 9).alias("nine"),
        F.regexp_extract("cond", r">=(\d+)", 1).try_cast("int").alias("lower_bound"),
        F.regexp_extract("cond", r"<(\d+)", 1).try_cast("bigint").alias("upper_bound"),
    ],
    {
        "nine": "CASE WHEN substr(pan, 1, 1) = 'X' THEN '' ELSE substr(pan, 1, 9) END",
        "lower_bound": "CAST(split_part(substr(cond, 3), '<', 1) AS INTEGER)",
        "upper_bound": "CAST(split_part(cond, '<', 2) AS BIGINT)",
    },
)

scalar(
    "str_hash_id",
    {
        "client": "direction",
        "name": "priority || CASE WHEN file_no = 0 THEN '' ELSE '_' || CAST(20000000 + record AS STRING) END || '.txt'",
        "day": "CASE WHEN file_no = 0 THEN 'NODATE' ELSE substr(CAST(20000000 + record AS STRING), 1, 8) END",
        "content": "md5(CAST(record AS STRING))",
    },
    lambda: [
        text.file_id(F.col("client"), F.col("name")).alias("file_id"),
        text.file_id(F.col("client"), F.col("name"), F.col("content")).alias("version_id"),
    ],
    {
        "file_id": "upper(md5(client || '|' || name || '|' || day))",
        "version_id": "upper(md5(client || '|' || name || '|' || left(content, 16)))",
    },
)

scalar(
    "str_expand_code_family",
    {"codes": "CASE file_no WHEN 0 THEN '5' WHEN 1 THEN '6, 05 ,7' WHEN 2 THEN '' WHEN 3 THEN 'nan' WHEN 4 THEN '9,9' WHEN 5 THEN NULL ELSE code END"},
    lambda: [text.expand_code_family(F.col("codes")).alias("expanded")],
    {
        "expanded": "CASE codes WHEN '5' THEN '05,15,25,35' WHEN '6, 05 ,7' THEN '06,16,26,36,05,07,17,27,37' WHEN '9,9' THEN '09' ELSE codes END"
    },
)

scalar(
    "str_normalise_for_diff",
    {
        "cell": "CASE file_no WHEN 0 THEN ' None ' WHEN 1 THEN NULL WHEN 2 THEN priority WHEN 3 THEN ' ' || CAST(record AS STRING) || '.5 ' "
        "ELSE CAST(merchant_nation AS STRING) END",
        "day": "CASE WHEN file_no = 1 THEN 'NaT' ELSE CAST(purchase_date AS STRING) || ' 00:00:00' END",
    },
    lambda: [
        text.normalised_cell(F.col("cell")).alias("cell_text"),
        text.normalised_cell(F.col("day"), is_date=True).alias("day_text"),
    ],
    {
        "cell_text": "CASE WHEN cell IS NULL OR trim(lower(cell)) = 'none' THEN '' WHEN TRY_CAST(trim(cell) AS DECIMAL(32,6)) IS NOT NULL "
        "THEN CAST(CAST(trim(cell) AS DECIMAL(32,6)) AS VARCHAR) ELSE cell END",
        "day_text": "CASE WHEN day = 'NaT' THEN '' ELSE left(day, 10) END",
    },
)

scalar(
    "str_masked_processing_code",
    {
        "pc": "CASE file_no WHEN 0 THEN '**0000' WHEN 1 THEN '*00000' WHEN 2 THEN '0*0000' WHEN 3 THEN '200000' ELSE code || '0000' END",
        "activity": "CASE WHEN direction = 'IN' THEN 'CC' ELSE 'XX' END",
    },
    lambda: [
        text.processing_code(F.col("pc"), F.col("activity"), unmask=False).alias("plain_code"),
        text.processing_code(F.col("pc"), F.col("activity"), unmask=True).alias("rebuilt_code"),
    ],
    {
        "plain_code": "left(pc, 2)",
        "rebuilt_code": "CASE WHEN pc = '**0000' THEN '18' WHEN pc = '*00000' THEN '20' WHEN pc = '0*0000' AND activity = 'CC' THEN '01' "
        "WHEN pc = '0*0000' THEN '09' ELSE left(pc, 2) END",
    },
)
