"""Joins (C) and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.functions import classify, text
from clearspan.operators import filters, joins, patterns, ranges, rule_index, rules, versions
from clearspan.operators.lookup import lookup_join
from clearspan.session import scratch_path
from clearspan.sources import sinks
from clearspan.workload.registry import query

C = F.col

# A point's best range: newest effective date, then the higher end, then the id.
def best_first():
    return [C("effective_date").desc(), C("high_key").desc(), C("range_id")]


def fx_rates(spark, sf_dir):
    return fixtures.fx(spark, sf_dir).select(
        "rate_date", "from_ccy", "to_ccy", (C("rate_ppm").cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,10)").alias("rate")
    )


RATE_SQL = "CAST(rate_ppm * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(18,10))"


@query(
    "jurisdiction_summary",
    """SELECT jurisdiction, direction, count(*) AS txns, CAST(sum(amount_cents) AS BIGINT) AS amount_cents FROM (
      SELECT t.direction, t.amount_cents, CASE WHEN b.range_nation IS NULL THEN '' WHEN t.merchant_nation = b.range_nation THEN 'off-us'
        WHEN t.merchant_region = n.n_regionkey THEN 'intraregional' ELSE 'interregional' END AS jurisdiction
      FROM txn t LEFT JOIN best b ON t.record = b.record LEFT JOIN nation n ON b.range_nation = n.n_nationkey) GROUP BY ALL""",
    ("txn", "acct_range"),
    """best AS (SELECT record, range_nation FROM (SELECT t.record, r.range_nation, row_number() OVER (PARTITION BY t.record
        ORDER BY r.effective_date DESC, r.high_key DESC, r.range_id) AS n FROM txn t JOIN acct_range r
        ON t.acct9 BETWEEN r.low_key AND r.high_key AND r.effective_date <= t.purchase_date) WHERE n = 1)""",
)
def jurisdiction_summary(spark, sf_dir):
    rows = ranges.best_range(
        fixtures.txn(spark, sf_dir), fixtures.acct_range(spark, sf_dir), ["acct9", "purchase_date"], C("acct9"), "low_key", "high_key",
        best_first(), {"range_nation": "range_nation"}, since=("effective_date", "purchase_date"),
    )
    nation = fixtures.table(spark, sf_dir, "nation")
    rows = lookup_join(rows, nation, {"range_nation": "n_nationkey"}, {"n_regionkey": "range_region"})
    kind = classify.jurisdiction(C("merchant_nation") == C("range_nation"), F.lit(False), C("merchant_region"), C("range_region"))
    return rows.groupBy(kind.alias("jurisdiction"), "direction").agg(F.count("*").alias("txns"), F.sum("amount_cents").alias("amount_cents"))


@query(
    "join_broadcast_lookup",
    """SELECT t.record, m.n_name AS merchant_name, mr.r_name AS merchant_region_name, i.n_name AS issuer_name
       FROM txn t LEFT JOIN nation m ON t.merchant_nation = m.n_nationkey LEFT JOIN region mr ON m.n_regionkey = mr.r_regionkey
       LEFT JOIN nation i ON t.issuer_nation = i.n_nationkey AND t.direction = 'IN'""",
    ("txn",),
)
def _lookups(spark, sf_dir):
    nation, region = (fixtures.table(spark, sf_dir, t) for t in ("nation", "region"))
    rows = fixtures.txn(spark, sf_dir).withColumn("issuer_key", F.when(C("direction") == "IN", C("issuer_nation")))
    rows = lookup_join(rows, nation, {"merchant_nation": "n_nationkey"}, {"n_name": "merchant_name", "n_regionkey": "rk"})
    rows = lookup_join(rows, region, {"rk": "r_regionkey"}, {"r_name": "merchant_region_name"})
    rows = lookup_join(rows, nation, {"issuer_key": "n_nationkey"}, {"n_name": "issuer_name"})
    return rows.select("record", "merchant_name", "merchant_region_name", "issuer_name")


@query(
    "join_point_in_range_bucketed",
    """SELECT t.record, r.range_id, r.product FROM txn t JOIN acct_range r ON t.acct9 BETWEEN r.low_key AND r.high_key AND r.effective_date <= t.purchase_date""",
    ("txn", "acct_range"),
)
def _point_in_range(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).withColumn("pan", F.concat(F.substring(C("acct9").cast("string"), 1, 9), F.lit("*******")))
    points = rows.select("record", "purchase_date", text.account9(C("pan")).alias("account9"))
    pairs = ranges.range_pairs(
        points, fixtures.acct_range(spark, sf_dir), "account9", "low_key", "high_key", also=C("effective_date") <= C("purchase_date")
    )
    return pairs.select("record", "range_id", "product")


@query(
    "join_interval_overlap_bucketed",
    """SELECT record, range_id FROM (SELECT t.record, r.range_id, row_number() OVER (PARTITION BY t.record ORDER BY r.effective_date DESC, r.high_key DESC, r.range_id) AS n
       FROM txn t LEFT JOIN acct_range r ON r.low_key * 1000 <= t.acct9 * 1000 + 49999999 AND r.high_key * 1000 + 999 >= t.acct9 * 1000) WHERE n = 1""",
    ("txn", "acct_range"),
)
def _overlap(spark, sf_dir):
    # Twelve-digit ranges against the interval an account of nine digits can stand for.
    spread = fixtures.acct_range(spark, sf_dir).withColumns({"low12": C("low_key") * 1000, "high12": C("high_key") * 1000 + 999})
    out = ranges.best_range(
        fixtures.txn(spark, sf_dir), spread, ["acct9"], C("acct9") * 1000, "low12", "high12", best_first(), {"range_id": "range_id"},
        point_end=C("acct9") * 1000 + 49_999_999,
    )
    return out.select("record", "range_id")


RULE_MATCH = """r.nation = t.merchant_nation AND r.valid_from <= t.purchase_date AND coalesce(r.valid_until, t.purchase_date) >= t.purchase_date
  AND (r.amount_min_cents IS NULL OR t.amount_cents >= r.amount_min_cents)
  AND CASE r.code_cond WHEN '' THEN true WHEN '05,06' THEN t.code IN ('05','06') WHEN 'NOT:07' THEN t.code <> '07' ELSE coalesce(TRY_CAST(t.code AS INTEGER) BETWEEN 6 AND 20, false) END"""


def parsed_rules(spark, sf_dir):
    raw = fixtures.rules(spark, sf_dir)
    parsed = raw.withColumn("code_parsed", rules.token_condition(C("code_cond")))
    floor = F.concat(F.lit(">="), C("amount_min_cents").cast("string"))
    return parsed.withColumns({"amount_parsed": rules.number_condition(floor), "days": rule_index.validity(C("valid_from"), C("valid_until"))})


#: Conditions of the rule fixture on transactions with ``cents`` and ``day``.
CONDITIONS = rule_index.Conditions({"merchant_nation": "nation"}, {"code_parsed": "code"}, {"amount_parsed": "cents", "days": "day"})
RULE_CONDITIONS = ["nation", "valid_from", "valid_until", "days", "code_parsed", "amount_parsed"]


def rule_facts(spark, sf_dir):
    """Transactions with the amount and the day in the type of rule bounds."""
    return fixtures.txn(spark, sf_dir).withColumns({"cents": C("amount_cents").cast(rules.BOUND), "day": rule_index.days(C("purchase_date"))})


@query(
    "join_rules_effective_dated",
    f"SELECT t.merchant_nation, t.code, count(*) AS pairs, CAST(sum(r.rule_id) AS BIGINT) AS id_sum FROM txn t JOIN rules r ON {RULE_MATCH} GROUP BY ALL",
    ("txn", "rules"),
)
def _rule_join(spark, sf_dir):
    # Rules that agree on all conditions match the same rows, so they are joined as one.
    alike = parsed_rules(spark, sf_dir).groupBy(*RULE_CONDITIONS).agg(F.count("*").alias("n"), F.sum("rule_id").alias("ids"))
    index = rule_index.build_index(alike, CONDITIONS, ["valid_from"], [C("n"), C("ids")])
    pairs = rule_index.all_rules(rule_facts(spark, sf_dir), index, {"n": "n", "ids": "ids"})
    return pairs.groupBy("merchant_nation", "code").agg(F.sum("n").alias("pairs"), F.sum("ids").alias("id_sum"))


@query(
    "semi_join_rule_prefilter",
    """SELECT rule_id, nation FROM rules r WHERE EXISTS (SELECT 1 FROM txn t WHERE t.merchant_nation = r.nation
       AND t.purchase_date BETWEEN r.valid_from AND r.valid_from + 3)""",
    ("txn", "rules"),
)
def _prefilter(spark, sf_dir):
    short_lived = fixtures.rules(spark, sf_dir).withColumn("valid_until", F.date_add("valid_from", 3))
    needed = rules.needed_rules(short_lived, fixtures.txn(spark, sf_dir), {"merchant_nation": "nation"}, "purchase_date")
    return needed.select("rule_id", "nation")


@query(
    "join_fx_rate",
    f"""SELECT t.record, CASE WHEN t.ccy = 'EUR' THEN CAST(1 AS DECIMAL(18,10)) ELSE {RATE_SQL} END AS rate, coalesce({RATE_SQL}, CAST(1 AS DECIMAL(18,10))) AS rate_or_one
       FROM txn t LEFT JOIN fx f ON f.rate_date = t.purchase_date AND f.from_ccy = t.ccy AND f.to_ccy = 'EUR'""",
    ("txn", "fx"),
)
def _fx(spark, sf_dir):
    rates = fx_rates(spark, sf_dir).where("to_ccy = 'EUR'")
    rows = joins.join_rate(fixtures.txn(spark, sf_dir), rates, {"purchase_date": "rate_date", "ccy": "from_ccy"}, "rate", "found")
    one = F.lit(1).cast("decimal(18,10)")
    own = F.when(C("ccy") == "EUR", one).otherwise(C("found"))
    return rows.select("record", own.alias("rate"), F.coalesce("found", one).alias("rate_or_one"))


@query(
    "join_fx_per_target_currency",
    """SELECT t.record, CASE t.ccy WHEN 'EUR' THEN CAST(amount_cents AS DECIMAL(24,6)) ELSE CAST(amount_cents * CAST(e.rate_ppm AS DECIMAL(18,0)) * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(24,6)) END AS in_eur,
        CASE t.ccy WHEN 'USD' THEN CAST(amount_cents AS DECIMAL(24,6)) ELSE CAST(amount_cents * CAST(e.rate_ppm * 2 AS DECIMAL(18,0)) * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(24,6)) END AS in_usd
       FROM txn t LEFT JOIN fx e ON e.rate_date = t.purchase_date AND e.from_ccy = t.ccy""",
    ("txn", "fx"),
)
def _fx_targets(spark, sf_dir):
    to_eur = fx_rates(spark, sf_dir)
    to_usd = to_eur.withColumns({"to_ccy": F.lit("USD"), "rate": (C("rate") * 2).cast("decimal(18,10)")})
    rates = to_eur.unionByName(to_usd).withColumnRenamed("rate_date", "purchase_date")
    rows = rules.converted_amounts(fixtures.txn(spark, sf_dir), rates, "ccy", ["purchase_date"])
    return rows.select("record", *[
        rules.amount_in(C("amount_cents"), C("ccy"), F.lit(t), C("rates_to")).alias(f"in_{t.lower()}") for t in ("EUR", "USD")
    ])


@query(
    "join_fx_without_date_or_from",
    f"""SELECT t.record, {RATE_SQL} AS usd_rate FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = 'USD'""",
    ("txn", "fx"),
)
def _fx_fixed_from(spark, sf_dir):
    usd = fx_rates(spark, sf_dir).where("from_ccy = 'USD' AND to_ccy = 'EUR'")
    rows = joins.join_rate(fixtures.txn(spark, sf_dir), usd, {"processing_date": "rate_date"}, "rate", "usd_rate")
    return rows.select("record", "usd_rate")


@query(
    "join_any_of_keys",
    """SELECT record, n_nationkey AS country_id, n_regionkey AS region FROM (SELECT t.record, n.n_nationkey, n.n_regionkey, row_number() OVER (PARTITION BY t.record ORDER BY n.n_nationkey) AS k
       FROM (SELECT record, CASE file_no % 4 WHEN 0 THEN CAST(merchant_nation AS VARCHAR) WHEN 1 THEN lower('NATION_' || CAST(issuer_nation AS VARCHAR)) WHEN 2 THEN ' N' || CAST(merchant_nation AS VARCHAR) ELSE 'nowhere' END AS raw FROM txn) t
       LEFT JOIN nation n ON upper(trim(t.raw)) IN (CAST(n.n_nationkey AS VARCHAR), n.n_name, 'N' || CAST(n.n_nationkey AS VARCHAR))) WHERE k = 1""",
    ("txn",),
)
def _any_key(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).selectExpr(
        "record",
        "CASE file_no % 4 WHEN 0 THEN CAST(merchant_nation AS STRING) WHEN 1 THEN lower('NATION_' || CAST(issuer_nation AS STRING)) "
        "WHEN 2 THEN ' N' || CAST(merchant_nation AS STRING) ELSE 'nowhere' END AS raw",
    )
    nation = fixtures.table(spark, sf_dir, "nation").withColumn("short", F.concat(F.lit("N"), C("n_nationkey").cast("string")))
    out = joins.join_any_key(
        rows, nation, C("raw"), ["n_nationkey", "n_name", "short"], {"n_nationkey": "country_id", "n_regionkey": "region"}, [C("n_nationkey")]
    )
    return out.select("record", "country_id", "region")


def fee_template(spark, sf_dir):
    """A template row per part brand and size: three dimensions, each possibly the wildcard."""
    return fixtures.table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS t_id", "p_size % 2 AS t_bus",
        "CASE WHEN p_size % 5 = 0 THEN 255 ELSE CAST(p_partkey % 25 AS INT) END AS t_nation",
        "CASE WHEN p_size % 3 = 0 THEN 255 ELSE p_size % 5 END AS t_region",
        "CASE WHEN p_size % 7 = 0 THEN 255 ELSE CAST(p_partkey % 7 AS INT) END AS t_file",
        "CAST(p_size AS BIGINT) AS fix_fee",
    )


TEMPLATE_SQL = """tmpl AS (SELECT p_partkey AS t_id, p_size % 2 AS t_bus, CASE WHEN p_size % 5 = 0 THEN 255 ELSE CAST(p_partkey % 25 AS INT) END AS t_nation,
   CASE WHEN p_size % 3 = 0 THEN 255 ELSE p_size % 5 END AS t_region, CASE WHEN p_size % 7 = 0 THEN 255 ELSE CAST(p_partkey % 7 AS INT) END AS t_file, CAST(p_size AS BIGINT) AS fix_fee FROM part)"""


@query(
    "join_wildcard_template",
    """SELECT g.bus, g.merchant_nation, g.issuer_region, g.file_no, count(*) AS matches, CAST(sum(g.n * t.fix_fee) AS BIGINT) AS fee FROM
       (SELECT CASE direction WHEN 'IN' THEN 1 ELSE 0 END AS bus, merchant_nation, issuer_region, file_no, count(*) AS n FROM txn GROUP BY ALL) g
       JOIN tmpl t ON t.t_bus = g.bus AND t.t_nation IN (g.merchant_nation, 255) AND t.t_region IN (g.issuer_region, 255) AND t.t_file IN (g.file_no, 255) GROUP BY ALL""",
    ("txn",),
    TEMPLATE_SQL,
)
def _wildcard(spark, sf_dir):
    groups = fixtures.txn(spark, sf_dir).groupBy(
        F.when(C("direction") == "IN", 1).otherwise(0).alias("bus"), "merchant_nation", "issuer_region", "file_no"
    ).agg(F.count("*").alias("n"))
    matched = joins.join_wildcard(
        groups, fee_template(spark, sf_dir), {"merchant_nation": "t_nation", "issuer_region": "t_region", "file_no": "t_file"}, {"bus": "t_bus"}, ["t_id", "fix_fee"]
    )
    return matched.groupBy("bus", "merchant_nation", "issuer_region", "file_no").agg(
        F.count("*").alias("matches"), F.sum(C("n") * C("fix_fee")).alias("fee")
    )


def size_buckets(spark, sf_dir):
    """Amount buckets per nation, overlapping, from suppliers."""
    return fixtures.table(spark, sf_dir, "supplier").selectExpr(
        "s_nationkey AS b_nation", "s_suppkey % 40 * 1000000 AS b_min", "s_suppkey % 40 * 1000000 + 6000000 + s_suppkey * 1000 AS b_max", "CAST(s_suppkey AS INT) AS b_id"
    )


BUCKETS_SQL = "buckets AS (SELECT s_nationkey AS b_nation, s_suppkey % 40 * 1000000 AS b_min, s_suppkey % 40 * 1000000 + 6000000 + s_suppkey * 1000 AS b_max, CAST(s_suppkey AS INT) AS b_id FROM supplier)"


def _bucket_sql(high: str, default: int) -> str:
    return f"""SELECT record, coalesce(b_id, {default}) AS bucket FROM (SELECT t.record, b.b_id, row_number() OVER (PARTITION BY t.record ORDER BY b_max - b_min, b_id) AS k
      FROM txn t LEFT JOIN buckets b ON b.b_nation = t.merchant_nation AND t.amount_cents >= b.b_min AND t.amount_cents {high} b.b_max) WHERE k = 1"""


def _bucket_query(spark, sf_dir, half_open, default):
    out = joins.join_bucket(
        fixtures.txn(spark, sf_dir), size_buckets(spark, sf_dir), {"merchant_nation": "b_nation"}, C("amount_cents"), "b_min", "b_max", "b_id", "bucket",
        default, half_open=half_open,
    )
    return out.select("record", "bucket")


query("join_amount_bucket_half_open", _bucket_sql("<", 0), ("txn",), BUCKETS_SQL)(lambda spark, sf_dir: _bucket_query(spark, sf_dir, True, 0))
query("join_amount_bucket_tightest", _bucket_sql("<=", 255), ("txn",), BUCKETS_SQL)(lambda spark, sf_dir: _bucket_query(spark, sf_dir, False, 255))


@query(
    "join_null_safe_multi_key",
    """SELECT t.record, g.n AS group_rows, CAST(g.c AS BIGINT) AS group_cents FROM t JOIN
       (SELECT code2, region2, ccy, count(*) AS n, sum(amount_cents) AS c FROM t GROUP BY ALL) g
       ON t.code2 IS NOT DISTINCT FROM g.code2 AND t.region2 IS NOT DISTINCT FROM g.region2 AND t.ccy IS NOT DISTINCT FROM g.ccy""",
    ("txn",),
    "t AS (SELECT record, amount_cents, ccy, nullif(code, '') AS code2, CASE WHEN file_no = 0 THEN NULL ELSE merchant_region END AS region2 FROM txn)",
)
def _null_safe(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).selectExpr(
        "record", "amount_cents", "ccy", "nullif(code, '') AS code2", "CASE WHEN file_no = 0 THEN NULL ELSE merchant_region END AS region2"
    )
    dims = ["code2", "region2", "ccy"]
    groups = rows.groupBy(*dims).agg(F.count("*").alias("n"), F.sum("amount_cents").alias("c"))
    out = lookup_join(rows, groups, dims, {"n": "group_rows", "c": "group_cents"}, null_safe=True)
    return out.select("record", "group_rows", "group_cents")


@query(
    "join_stage_consolidate",
    """SELECT t.record, t.file_no, t.ccy, c.mode, f.fee FROM txn t LEFT JOIN (SELECT record, file_no, CASE direction WHEN 'IN' THEN 'issuing' ELSE 'acquiring' END AS mode FROM txn WHERE code <> '') c
       ON t.record = c.record AND t.file_no = c.file_no LEFT JOIN (SELECT record, file_no, amount_cents // 100 AS fee FROM txn WHERE direction = 'OUT') f ON t.record = f.record AND t.file_no = f.file_no""",
    ("txn",),
)
def _consolidate(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir)
    keys = ["record", "file_no"]
    calculated = rows.where("code <> ''").select(*keys, "ccy", classify.business_mode_of_direction(C("direction")).alias("mode"))
    fees = rows.where("direction = 'OUT'").select(*keys, F.call_function("div", C("amount_cents"), F.lit(100).cast("bigint")).alias("fee"))
    return joins.consolidate(rows.select(*keys, "ccy"), [("calculated", calculated), ("fees", fees)], keys)


@query(
    "join_txn_calc_inner",
    """SELECT t.record, t.file_no, t.amount_cents, c.doubled, a.noted FROM txn t JOIN (SELECT record, file_no, amount_cents * 2 AS doubled FROM txn WHERE merchant_region <> 2) c
       ON t.record = c.record AND t.file_no = c.file_no LEFT JOIN (SELECT record, file_no, ccy AS noted FROM txn WHERE direction = 'IN') a ON t.record = a.record AND t.file_no = a.file_no""",
    ("txn",),
)
def _calc_inner(spark, sf_dir):
    rows, keys = fixtures.txn(spark, sf_dir), ["record", "file_no"]
    calc = rows.where("merchant_region <> 2").selectExpr(*keys, "amount_cents * 2 AS doubled")
    noted = rows.where("direction = 'IN'").selectExpr(*keys, "ccy AS noted")
    return rows.select(*keys, "amount_cents").join(calc, keys).join(noted, keys, "left")


@query(
    "join_overlap_column_resolution",
    """SELECT t.record, t.ccy AS ccy_cln, t.amount_cents, c.ccy AS ccy FROM txn t LEFT JOIN (SELECT record, lower(ccy) AS ccy FROM txn WHERE code <> '') c ON t.record = c.record""",
    ("txn",),
)
def _overlap_columns(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir)
    calc = rows.where("code <> ''").select("record", F.lower("ccy").alias("ccy"))
    return joins.join_suffixing(rows.select("record", "ccy", "amount_cents"), calc, ["record"], "_cln")


@query(
    "flag_parent_node",
    """SELECT reporting_id, rollup_id, CAST(CASE WHEN rollup_id = reporting_id THEN 10 WHEN reporting_id IN (SELECT rollup_id FROM sre WHERE rollup_id <> reporting_id) THEN 1 ELSE 0 END AS BIGINT) AS level,
       CAST(0 AS BIGINT) AS unknown_level FROM sre""",
    ("sre",),
)
def _hierarchy(spark, sf_dir):
    rows = joins.flag_hierarchy(fixtures.sre(spark, sf_dir), "rollup_id", "reporting_id", "level")
    return joins.flag_hierarchy(rows, "absent", "reporting_id", "unknown_level")


@query(
    "flag_excluded_keys",
    """SELECT event_id, CAST(CASE WHEN EXISTS (SELECT 1 FROM messages m WHERE m.fc = '695' AND m.file_no = CAST(e.user_id % 8 AS INT) AND m.msg_no + 1 = e.event_id) THEN 1 ELSE 0 END AS BIGINT) AS exclude_flag FROM events e""",
    ("messages",),
)
def _exclude(spark, sf_dir):
    messages = fixtures.messages(spark, sf_dir)
    cited = messages.where("fc = '695'").selectExpr("file_no AS cited_file", "msg_no + 1 AS cited_no")
    out = joins.flag_listed(messages, cited, {"file_no": "cited_file", "msg_no": "cited_no"}, "exclude_flag")
    return out.select(C("msg_no").alias("event_id"), "exclude_flag")


@query(
    "enrich_currency_codes",
    """SELECT f.rate_date, f.from_ccy AS from_currency, f.to_ccy AS to_currency, CASE f.from_ccy WHEN 'USD' THEN '840' WHEN 'GBP' THEN '826' END AS from_currency_numeric_code, '978' AS to_currency_numeric_code FROM fx f""",
    ("fx",),
)
def _currency_codes(spark, sf_dir):
    rates = fixtures.fx(spark, sf_dir).selectExpr("rate_date", "from_ccy AS from_currency", "to_ccy AS to_currency")
    # The dictionary repeats one currency with padding, as the source file does.
    codes = spark.createDataFrame([("USD ", " 840"), ("USD", "840"), ("GBP", "826"), ("EUR", "978")], "currency_alphabetic_code string, currency_numeric_code string")
    return joins.codes_of_pair(rates, codes).select("rate_date", "from_currency", "to_currency", "from_currency_numeric_code", "to_currency_numeric_code")


@query(
    "join_attach_cost",
    """SELECT t.record, t.file_no, CAST(coalesce(c.cost, 0) AS DECIMAL(18,4)) AS cost FROM txn t LEFT JOIN (SELECT record, file_no, CAST(amount_cents * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS cost FROM txn WHERE code IN ('05','25')) c
       ON t.record = c.record AND t.file_no = c.file_no""",
    ("txn",),
)
def _costs(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir)
    costs = rows.where("code IN ('05','25')").selectExpr("record", "file_no", "CAST(amount_cents * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS unit")
    detail = rows.select("record", "file_no", F.lit(0).alias("cost"))
    return joins.attach_cost(detail, costs, ["record", "file_no"], "unit", "cost")


@query(
    "update_from_delta",
    """SELECT t.c_custkey, CASE WHEN d.cnt IS NULL THEN 0 ELSE d.cnt END AS orders_now, coalesce(d.seg, t.c_mktsegment) AS segment FROM customer t
       LEFT JOIN (SELECT o_custkey, count(*) AS cnt, CASE WHEN count(*) > 12 THEN 'BUSY' END AS seg FROM orders GROUP BY o_custkey) d ON t.c_custkey = d.o_custkey""",
)
def _delta(spark, sf_dir):
    base = fixtures.table(spark, sf_dir, "customer").select("c_custkey", F.lit(0).cast("bigint").alias("orders_now"), C("c_mktsegment").alias("segment"))
    delta = fixtures.table(spark, sf_dir, "orders").groupBy(C("o_custkey").alias("c_custkey")).agg(F.count("*").alias("cnt"))
    delta = delta.withColumn("seg", F.when(C("cnt") > 12, "BUSY"))
    return joins.overlay(base, delta, ["c_custkey"], {"orders_now": "cnt", "segment": "seg"})


PATTERNS = [
    (1, "ALL", 30, r"ring$", 1, "RING"),
    (2, "Brand#2", 10, r"^small", 1, "SMALL-2"),
    (3, "ALL", 20, r"(red|blue) .*", 1, "COLOUR"),
    (4, "ALL", 5, r".*", 0, "OFF"),
    (5, "Brand#17", 20, r"widget", 1, "WIDGET-17"),
]


@query(
    "classify_by_pattern",
    """SELECT p_partkey, CASE WHEN p_brand = 'Brand#2' AND p_name LIKE 'small%' THEN 'SMALL-2' WHEN regexp_matches(p_name, '(red|blue) ') THEN 'COLOUR'
       WHEN p_brand = 'Brand#17' AND contains(p_name, 'widget') THEN 'WIDGET-17' WHEN p_name LIKE '%ring' THEN 'RING' END AS file_type FROM part""",
)
def _patterns(spark, sf_dir):
    files = fixtures.table(spark, sf_dir, "part").select("p_partkey", C("p_brand").alias("client"), F.upper("p_name").alias("name"))
    table = spark.createDataFrame(PATTERNS, "pattern_id int, customer_code string, priority int, file_format string, is_active int, kind string")
    return patterns.classify_names(files, table, "client", "name", {"kind": "file_type"}).select("p_partkey", "file_type")


@query(
    "anti_join_seen_lines",
    """SELECT event_id, rtrim(event_type || CAST(user_id AS VARCHAR)) AS line FROM events WHERE event_type || CAST(user_id AS VARCHAR) NOT IN
       (SELECT event_type || CAST(user_id AS VARCHAR) FROM events WHERE event_type IN ('click', 'error') AND value < 50)""",
)
def _unseen(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events").withColumn("line", F.concat("event_type", C("user_id").cast("string")))
    master = events.where("event_type IN ('click', 'error') AND value < 50").select(F.concat("line", F.lit("   ")).alias("line"))
    return versions.unseen_lines(events.select("event_id", "line"), master, "line")


def range_deliveries(spark, sf_dir):
    """Master and delivery: range versions split by size, so late older versions occur."""
    rows = fixtures.acct_range(spark, sf_dir).selectExpr(
        "range_id", "low_key % 9000000 AS table_key", "effective_date", "CAST(range_id AS STRING) || product AS lines", "range_nation"
    )
    return rows.where("range_nation < 15"), rows.where("range_nation >= 12")


MASTER_SQL = """keyed AS (SELECT range_id, low_key % 9000000 AS table_key, effective_date FROM acct_range),
  nexts AS (SELECT k.range_id, min(n.effective_date) AS next_date FROM keyed k JOIN keyed n ON n.table_key = k.table_key AND n.effective_date > k.effective_date GROUP BY k.range_id)"""
MASTER_SELECT = "SELECT k.range_id, k.table_key, k.effective_date, CAST(n.next_date - INTERVAL 1 DAY AS DATE) AS valid_until FROM keyed k LEFT JOIN nexts n ON k.range_id = n.range_id"


def _deliver(spark, deliveries):
    """The master after several deliveries; each rewrites only the partitions that it has keys in."""
    path = scratch_path(spark, "range-master")
    for delivery in deliveries:
        versions.merge_into_store(spark, path, delivery, ["table_key"], "effective_date", "valid_until", "lines")
    return spark.read.parquet(path).select("range_id", "table_key", "effective_date", "valid_until")


@query("join_successor_version", MASTER_SELECT, ("acct_range",), MASTER_SQL)
def _successor(spark, sf_dir):
    return _deliver(spark, list(range_deliveries(spark, sf_dir)))


@query("late_version_reopen", MASTER_SELECT, ("acct_range",), MASTER_SQL)
def _late_versions(spark, sf_dir):
    """The same master from deliveries in the other order, the newest versions first."""
    first, second = range_deliveries(spark, sf_dir)
    rows = first.unionByName(second).distinct()
    late, early = rows.where("effective_date < DATE '1995-06-01'"), rows.where("effective_date >= DATE '1995-06-01'")
    return _deliver(spark, [early, late])


@query(
    "detect_duplicate_file",
    """SELECT doc_id, CASE WHEN k.known IS NULL THEN 'new' WHEN k.known = md5(d.text) THEN 'duplicate' ELSE 'new version' END AS status FROM documents d
       LEFT JOIN (SELECT source || lang AS id, max_by(md5(text), doc_id) AS known FROM documents WHERE n_chars > 1000 GROUP BY ALL) k ON d.source || d.lang = k.id""",
)
def _duplicates(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.concat("source", "lang").alias("file_id"), F.md5("text").alias("content_hash")
    )
    ledger = docs.where("n_chars > 1000").selectExpr("file_id", "content_hash", "doc_id AS registered_at")
    return joins.file_status(docs, ledger).select("doc_id", "status")


@query(
    "subtable_select_via_catalog",
    """SELECT p_partkey FROM part p WHERE EXISTS (SELECT 1 FROM nation n WHERE n.n_name = 'NATION_' || CAST(n.n_nationkey AS VARCHAR) AND n.n_regionkey = p.p_size % 5 AND n.n_nationkey % 25 = p.p_partkey % 25 AND n.n_regionkey = 2)""",
)
def _subtable(spark, sf_dir):
    details = fixtures.table(spark, sf_dir, "part").selectExpr("p_partkey", "CAST(p_partkey % 25 AS INT) AS file_id", "p_size % 5 AS record_table_id")
    catalog = fixtures.table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS file_id", "n_regionkey AS table_sub_id", "CASE WHEN n_regionkey = 2 THEN 'T40' ELSE 'T' || n_regionkey END AS table_ipm_id"
    )
    return joins.subtable_records(details, catalog, "T40").select("p_partkey")
