"""Aggregations (D), sorts (F) and set operations (G)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan import fixtures
from clearspan.functions import classify, dates, numbers
from clearspan.operators import aggregates, joins, sets
from clearspan.operators.lookup import lookup_join
from clearspan.session import scratch_path
from clearspan.sources import sinks
from clearspan.workload.joins import TEMPLATE_SQL, fee_template, fx_rates
from clearspan.workload.registry import query

C = F.col
RATE = "CAST(coalesce(f.rate_ppm, 1000000) * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(18,10))"
MONEY = "CAST(t.amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(28,4))"


def money_rows(spark, sf_dir):
    """Transactions with amount, fee and rate to EUR."""
    rates = fx_rates(spark, sf_dir).where("to_ccy = 'EUR'")
    rows = joins.join_rate(fixtures.txn(spark, sf_dir), rates, {"purchase_date": "rate_date", "ccy": "from_ccy"}, "rate", "rate")
    cents = F.lit("0.01").cast("decimal(3,2)")
    return rows.withColumns({
        "amount": (C("amount_cents") * cents).cast("decimal(18,4)"),
        "fee": F.when(C("file_no") != 0, (C("amount_cents") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(18,4)")),
    })


@query(
    "agg_quality_summary",
    f"""SELECT t.direction, t.merchant_region, t.ccy, date_trunc('month', t.purchase_date)::DATE AS purchase_month, count(*) AS trx_count, CAST(sum({MONEY} * {RATE}) AS DECIMAL(38,10)) AS trx_amt,
        CAST(sum(CASE WHEN t.file_no = 0 THEN CAST(0 AS DECIMAL(38,14)) ELSE CAST(t.amount_cents * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(28,4)) * {RATE} END) AS DECIMAL(38,10)) AS itx_amt
        FROM txn t LEFT JOIN fx f ON f.rate_date = t.purchase_date AND f.from_ccy = t.ccy GROUP BY ALL""",
    ("txn", "fx"),
)
def _quality(spark, sf_dir):
    rows = money_rows(spark, sf_dir).withColumn("purchase_month", F.trunc("purchase_date", "month"))
    return aggregates.quality_summary(rows, ["direction", "merchant_region", "ccy", "purchase_month"], "amount", "fee", "rate")


@query(
    "agg_settlement_summary",
    f"""SELECT t.merchant_nation, t.direction, CAST(sum(t.file_no) AS DECIMAL(18,2)) AS trx_count, CAST(round(sum({MONEY} * {RATE}), 2) AS DECIMAL(18,2)) AS trx_amt,
        CAST(round(sum(CASE WHEN t.code <> '' THEN CAST(t.merchant_nation - t.issuer_nation AS DECIMAL(28,4)) * {RATE} END), 2) AS DECIMAL(18,2)) AS itx_amt
        FROM txn t LEFT JOIN fx f ON f.rate_date = t.purchase_date AND f.from_ccy = t.ccy GROUP BY ALL""",
    ("txn", "fx"),
)
def _settlement(spark, sf_dir):
    rows = money_rows(spark, sf_dir).withColumns({"credits": C("merchant_nation"), "debits": F.when(C("code") != "", -C("issuer_nation"))})
    return aggregates.settlement_summary(rows, ["merchant_nation", "direction"], "file_no", "amount", "credits", "debits", "rate")


@query(
    "agg_settlement_sql",
    f"""SELECT t.processing_date, CASE t.direction WHEN 'IN' THEN 'Issuer' ELSE 'Acquirer' END AS business_mode,
        CASE WHEN t.file_no = 0 THEN 'on-us' WHEN t.merchant_region = 4 THEN 'off-us' WHEN t.merchant_region IN (2, 3) THEN 'intraregional' WHEN t.merchant_region = 1 THEN 'interregional' END AS jurisdiction,
        CASE t.ccy WHEN 'EUR' THEN 'Local' ELSE 'Foreign' END AS settlement_currency, count(*) AS trx_count, CAST(sum({MONEY} * {RATE}) AS DECIMAL(38,10)) AS trx_amt,
        CAST(sum(CASE WHEN t.file_no = 0 THEN CAST(0 AS DECIMAL(38,14)) ELSE CAST(t.amount_cents * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(28,4)) * {RATE} END) AS DECIMAL(38,10)) AS itx_amt
        FROM txn t LEFT JOIN fx f ON f.rate_date = t.purchase_date AND f.from_ccy = t.ccy GROUP BY ALL""",
    ("txn", "fx"),
)
def _settlement_dims(spark, sf_dir):
    rows = money_rows(spark, sf_dir)
    dims = {
        "business_mode": aggregates.mode_of_member(F.when(C("direction") == "IN", "I").otherwise("A")),
        "jurisdiction": aggregates.jurisdiction_of_activity(F.when(C("file_no") == 0, "C").otherwise("M"), F.concat(F.lit("0"), C("merchant_region").cast("string"))),
        "settlement_currency": classify.local_or_foreign(C("ccy"), F.lit("EUR")),
    }
    return aggregates.quality_summary(rows.withColumns(dims), ["processing_date", *dims], "amount", "fee", "rate")


@query(
    "agg_transactional_sql",
    f"""SELECT t.purchase_date, t.direction, t.merchant_region, count(*) AS trx_count, CAST(sum(CASE t.direction WHEN 'IN' THEN {MONEY} * {RATE} ELSE CAST(t.record AS DECIMAL(28,4)) * CAST(1 AS DECIMAL(18,10)) END) AS DECIMAL(38,10)) AS trx_amt,
        CAST(sum(CASE t.direction WHEN 'IN' THEN CAST(t.file_no AS DECIMAL(28,4)) * {RATE} ELSE CAST(t.merchant_nation AS DECIMAL(28,4)) * CAST(1 AS DECIMAL(18,10)) END) AS DECIMAL(38,10)) AS itx_amt
        FROM txn t LEFT JOIN fx f ON f.rate_date = t.purchase_date AND f.from_ccy = t.ccy GROUP BY ALL""",
    ("txn", "fx"),
)
def _directional(spark, sf_dir):
    rows = money_rows(spark, sf_dir).withColumn("no_rate", F.lit(None).cast("decimal(18,10)"))
    return aggregates.directional_totals(
        rows, ["purchase_date", "direction", "merchant_region"], C("direction") == "IN", ("amount", "file_no", "rate"), ("record", "merchant_nation", "no_rate")
    )


@query(
    "agg_fee_report",
    """SELECT direction, merchant_region, ccy, code, count(*) AS transaction_count, CAST(sum(amount_cents) AS BIGINT) AS transaction_amount, min(priority) AS priority,
       CAST(0 AS DECIMAL(24,6)) AS transaction_scheme_fee_cost, CAST(0 AS DECIMAL(24,6)) AS unitary_scheme_fee_cost, CAST(0 AS DECIMAL(24,6)) AS estimated_scheme_fee_cost, CAST(0 AS DECIMAL(24,6)) AS unitary_estimated_scheme_fee_cost FROM txn GROUP BY direction, merchant_region, ccy, code""",
    ("txn",),
)
def _fee_report(spark, sf_dir):
    return aggregates.fee_report(fixtures.txn(spark, sf_dir), ["direction", "merchant_region", "ccy", "code"], "amount_cents", "priority")


@query("agg_distinct_terminals", "SELECT l_suppkey AS merchant, count(DISTINCT l_partkey) AS count_terminal FROM lineitem GROUP BY l_suppkey")
def _terminals(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "lineitem").select(C("l_suppkey").alias("merchant"), "l_partkey")
    return aggregates.distinct_terminals(rows, "merchant", "l_partkey")


@query(
    "agg_monthly_merchant",
    """SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS month, l_suppkey, p.p_size AS program, count(*) AS txn_cnt, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS txn_cents
       FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey GROUP BY ALL""",
)
def _monthly(spark, sf_dir):
    lines = fixtures.table(spark, sf_dir, "lineitem").select(
        dates.month_key(C("l_shipdate")).cast("int").alias("month"), "l_suppkey", "l_partkey", F.lit(1).cast("bigint").alias("txn_cnt"),
        F.round(C("l_extendedprice") * 100).cast("bigint").alias("txn_cents"),
    )
    by_product = aggregates.sums(lines, ["month", "l_suppkey", "l_partkey"], ["txn_cnt", "txn_cents"])
    programs = fixtures.table(spark, sf_dir, "part").select("p_partkey", "p_size")
    with_program = lookup_join(by_product, programs, {"l_partkey": "p_partkey"}, {"p_size": "program"})
    return aggregates.sums(with_program, ["month", "l_suppkey", "program"], ["txn_cnt", "txn_cents"])


def merchant_base(spark, sf_dir):
    return fixtures.txn(spark, sf_dir).groupBy(
        F.when(C("direction") == "IN", 1).otherwise(0).alias("bus"), "merchant_nation", "issuer_region", "file_no"
    ).agg(
        F.count("*").alias("TXN_CNT"),
        F.sum((C("amount_cents") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")).cast("decimal(18,2)").alias("TXN_AMT"),
    )


# Fixed and variable fees per family from the template's fee and its part.
def _fees(of):
    out = {}
    for i, f in enumerate(aggregates.FEE_FAMILIES):
        out[f"FIX_{f}_FEE"] = of(f"CASE WHEN fix_fee % 6 = {i} THEN NULL ELSE CAST(fix_fee * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(12,6)) END")
        out[f"VAR_{f}_FEE"] = of(f"CAST((fix_fee + {i}) * CAST('0.00001' AS DECIMAL(6,5)) AS DECIMAL(12,6))")
    return out


_FEE_SQL = ", ".join(f"{e} AS {c}" for c, e in _fees(str).items())
_COMPONENT_SQL = ", ".join(
    f"CAST(sum(coalesce(FIX_{f}_FEE, CAST(0 AS DECIMAL(12,6))) * CAST(TXN_CNT AS DECIMAL(18,0)) + VAR_{f}_FEE * CAST(TXN_AMT AS DECIMAL(24,2))) AS DECIMAL(28,8)) AS {f}_AMT"
    for f in aggregates.FEE_FAMILIES
)
BASE_SQL = """base AS (SELECT CASE direction WHEN 'IN' THEN 1 ELSE 0 END AS bus, merchant_nation, issuer_region, file_no, count(*) AS TXN_CNT,
  CAST(sum(CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS TXN_AMT FROM txn GROUP BY ALL)"""
COMPONENTS_SQL = f"""{TEMPLATE_SQL}, {BASE_SQL}, fees AS (SELECT *, {_FEE_SQL} FROM tmpl), comp AS (SELECT g.merchant_nation, {_COMPONENT_SQL} FROM base g JOIN fees t
  ON t.t_bus = g.bus AND t.t_nation IN (g.merchant_nation, 255) AND t.t_region IN (g.issuer_region, 255) AND t.t_file IN (g.file_no, 255) GROUP BY g.merchant_nation)"""


def fee_base(spark, sf_dir):
    """Components per merchant nation: groups times every fitting template row."""
    template = fee_template(spark, sf_dir).withColumns(_fees(F.expr))
    matched = joins.join_wildcard(
        merchant_base(spark, sf_dir), template, {"merchant_nation": "t_nation", "issuer_region": "t_region", "file_no": "t_file"}, {"bus": "t_bus"}, list(_fees(str))
    )
    return aggregates.fee_components(matched, ["merchant_nation"], "TXN_CNT", "TXN_AMT")


_SUM = " + ".join(f"{f}_AMT" for f in aggregates.FEE_FAMILIES)


@query(
    "agg_fee_components",
    f"SELECT *, CAST({_SUM} AS DECIMAL(28,8)) AS TOT_PLUS_1_AMT, CAST({_SUM} + merchant_nation AS DECIMAL(28,8)) AS TOT_AMT FROM comp",
    ("txn",),
    COMPONENTS_SQL,
)
def _components(spark, sf_dir):
    return aggregates.fee_totals(fee_base(spark, sf_dir), "merchant_nation")


_R2 = {f: f"CAST(round({f}_AMT, 2) AS DECIMAL(24,2))" for f in aggregates.FEE_FAMILIES}
_AMT2 = "CAST(TXN_AMT AS DECIMAL(24,2))"


def _share(part: str) -> str:
    """Quotient to 4 decimals cut toward zero, in whole numbers."""
    return f"CASE WHEN TXN_AMT = 0 THEN 0 ELSE CAST(CAST(({part}) * 100 AS HUGEINT) * 10000 // CAST({_AMT2} * 100 AS HUGEINT) AS BIGINT) END"


@query(
    "agg_ratio_columns",
    f"""SELECT c.merchant_nation, {', '.join(f"{_share(_R2[f])} AS {f}_FEE" for f in aggregates.FEE_FAMILIES)},
        {_share(' + '.join(_R2.values()))} AS TOT_PLUS_1_FEE FROM comp c JOIN (SELECT merchant_nation, CASE WHEN merchant_nation = 7 THEN 0 ELSE sum(TXN_AMT) END AS TXN_AMT FROM base GROUP BY merchant_nation) b ON b.merchant_nation = c.merchant_nation""",
    ("txn",),
    COMPONENTS_SQL,
)
def _ratios(spark, sf_dir):
    totals = merchant_base(spark, sf_dir).groupBy("merchant_nation").agg(F.sum("TXN_AMT").cast("decimal(24,2)").alias("TXN_AMT"))
    totals = totals.withColumn("TXN_AMT", F.when(C("merchant_nation") == 7, F.lit(0)).otherwise(C("TXN_AMT")).cast("decimal(24,2)"))
    rows = fee_base(spark, sf_dir).join(totals, "merchant_nation").withColumn("TXN_IRF", F.lit(0))
    shares = aggregates.fee_ratios(rows)
    names = [f"{f}_FEE" for f in aggregates.FEE_FAMILIES] + ["TOT_PLUS_1_FEE"]
    return shares.select("merchant_nation", *[F.floor(C(n) * 10000).cast("bigint").alias(n) for n in names])


@query(
    "agg_report_trailer",
    """SELECT count(*) AS detail_rows, CAST(sum(CAST(round(a, 2) AS DECIMAL(24,2))) AS DECIMAL(34,2)) AS amount, CAST(sum(n) AS BIGINT) AS n FROM
       (SELECT merchant_nation, ccy, CAST(sum(amount_cents) * CAST('0.001' AS DECIMAL(4,3)) AS DECIMAL(28,8)) AS a, count(*) AS n FROM txn GROUP BY ALL)""",
    ("txn",),
)
def _trailer(spark, sf_dir):
    detail = fixtures.txn(spark, sf_dir).groupBy("merchant_nation", "ccy").agg(
        (F.sum("amount_cents") * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(28,8)").alias("amount"), F.count("*").alias("n")
    )
    return aggregates.report_totals(detail, ["amount"], ["n"])


@query(
    "agg_table_diff",
    """SELECT count(*) FILTER (c.id IS NULL) AS added, count(*) FILTER (n.id IS NULL) AS removed, count(*) FILTER (c.id IS NOT NULL AND n.id IS NOT NULL) AS common,
       count(*) FILTER (n.price <> c.price OR n.size <> c.size) AS changed, count(*) FILTER (n.price <> c.price) AS changed_price, count(*) FILTER (n.size <> c.size) AS changed_size, CAST(0 AS BIGINT) AS changed_day FROM
       (SELECT p_partkey AS id, p_retailprice + CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS price, CASE WHEN p_size > 45 THEN 0 ELSE p_size END AS size FROM part WHERE p_brand <> 'Brand#2') n
       FULL JOIN (SELECT p_partkey AS id, p_retailprice AS price, p_size AS size FROM part WHERE p_brand <> 'Brand#17') c ON n.id = c.id""",
)
def _diff(spark, sf_dir):
    part = fixtures.table(spark, sf_dir, "part")
    new = part.where("p_brand <> 'Brand#2'").selectExpr(
        "p_partkey AS id", "CAST(p_retailprice + CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS STRING) AS price", "CASE WHEN p_size > 45 THEN 0 ELSE p_size END AS size", "'2024-01-01 00:00:00' AS day"
    )
    current = part.where("p_brand <> 'Brand#17'").selectExpr(
        "CAST(p_partkey AS STRING) || '.0' AS id", "' ' || CAST(CAST(p_retailprice AS DECIMAL(12,4)) AS STRING) AS price", "CAST(p_size AS STRING) AS size", "'2024-01-01' AS day"
    )
    return aggregates.table_diff(new, current, ["id"], dates=["day"])


@query(
    "check_control_totals",
    """SELECT 'detail' AS total, (SELECT count(*) FROM txn) AS actual, (SELECT count(*) FROM orders) AS expected, true AS agrees
       UNION ALL SELECT 'groups', (SELECT count(*) FROM (SELECT DISTINCT merchant_nation, ccy FROM txn)), CAST(100 AS BIGINT), true""",
    ("txn",),
)
def _control(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir)
    groups = rows.select("merchant_nation", "ccy").distinct()
    path = scratch_path(spark, "summary")
    sinks.write_run_summary(spark, path, detail=fixtures.table(spark, sf_dir, "orders").count(), groups=100)
    summary = sinks.read_run_summary(spark, path, "detail bigint, groups bigint")
    return aggregates.control_totals(summary, {"detail": rows, "groups": groups})


@query(
    "check_missing_dates",
    """SELECT day FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS DATE) AS day) WHERE day NOT IN (SELECT rate_date FROM fx)""",
    ("fx",),
)
def _missing(spark, sf_dir):
    first, last = (F.lit(d).cast("date") for d in ("1995-01-01", "1998-12-31"))
    return aggregates.missing_dates(fixtures.fx(spark, sf_dir), "rate_date", first, last)


@query(
    "agg_latest_header",
    """SELECT file_no, version, header_date FROM (SELECT file_no, version, header_date, row_number() OVER (PARTITION BY file_no ORDER BY coalesce(TRY_CAST(version AS INTEGER), -1) DESC, version DESC, header_date DESC) AS n FROM
       (SELECT file_no, CASE WHEN merchant_region = 0 THEN priority ELSE CAST(merchant_nation AS VARCHAR) END AS version, purchase_date AS header_date FROM txn)) WHERE n = 1""",
    ("txn",),
)
def _latest_header(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).selectExpr(
        "file_no", "CASE WHEN merchant_region = 0 THEN priority ELSE CAST(merchant_nation AS STRING) END AS version", "purchase_date AS header_date"
    )
    return aggregates.latest_header(rows, ["file_no"], "version", ["header_date"])


@query(
    "distinct_dedupe",
    """SELECT issuer_nation, merchant_nation, record, ccy FROM (SELECT *, row_number() OVER (PARTITION BY issuer_nation, merchant_nation ORDER BY purchase_date DESC, record) AS n FROM txn) WHERE n = 1""",
    ("txn",),
)
def _dedupe(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir)
    kept = aggregates.distinct_by(rows, ["issuer_nation", "merchant_nation"], [C("purchase_date").desc(), C("record")])
    return kept.select("issuer_nation", "merchant_nation", "record", "ccy")


@query(
    "count_by_source",
    """SELECT 'lines' AS output_type, file_no, count(*) AS records FROM lines GROUP BY file_no UNION ALL SELECT 'headers', file_no, count(*) FROM messages WHERE fc = '697' GROUP BY file_no""",
    ("lines", "messages"),
)
def _by_source(spark, sf_dir):
    outputs = {"lines": fixtures.lines(spark, sf_dir), "headers": fixtures.messages(spark, sf_dir).where("fc = '697'")}
    return aggregates.count_by_source(outputs, "file_no")


@query(
    "sort_report_rows",
    """SELECT row_number() OVER (ORDER BY ccy, merchant_nation, code) AS position, ccy, merchant_nation, code, n FROM (SELECT ccy, merchant_nation, code, count(*) AS n FROM txn GROUP BY ALL)""",
    ("txn",),
)
def _sorted(spark, sf_dir):
    report = fixtures.txn(spark, sf_dir).groupBy("ccy", "merchant_nation", "code").agg(F.count("*").alias("n"))
    return sinks.numbered(report, ["ccy", "merchant_nation", "code"], "position")


@query(
    "sort_rules_priority",
    "SELECT rule_id, nation, row_number() OVER (PARTITION BY nation ORDER BY var_bp DESC, rule_id) AS position FROM rules",
    ("rules",),
)
def _rule_priority(spark, sf_dir):
    ordered = sinks.numbered(fixtures.rules(spark, sf_dir).select("rule_id", "nation", "var_bp"), ["nation", C("var_bp").desc(), "rule_id"], "overall")
    first = ordered.groupBy("nation").agg(F.min("overall").alias("first"))
    placed = lookup_join(ordered, first, ["nation"], ["first"])
    return placed.select("rule_id", "nation", (C("overall") - C("first") + 1).alias("position"))


@query("limit_one_lookup", "SELECT t.record, n.n_regionkey AS home_region FROM txn t, (SELECT min(n_regionkey) AS n_regionkey FROM nation WHERE n_name = 'NATION_7') n", ("txn",))
def _one_lookup(spark, sf_dir):
    nation = fixtures.table(spark, sf_dir, "nation").where("n_name = 'NATION_7'").groupBy("n_name").agg(F.min("n_regionkey").alias("r"))
    rows = fixtures.txn(spark, sf_dir).withColumn("home", F.lit("NATION_7"))
    return lookup_join(rows, nation, {"home": "n_name"}, {"r": "home_region"}).select("record", "home_region")


@query(
    "topk_by_key",
    "SELECT merchant_nation, record, amount_cents FROM (SELECT *, row_number() OVER (PARTITION BY merchant_nation ORDER BY amount_cents DESC, record) AS n FROM txn) WHERE n <= 3",
    ("txn",),
)
def _topk(spark, sf_dir):
    order = Window.partitionBy("merchant_nation").orderBy(C("amount_cents").desc(), "record")
    ranked = fixtures.txn(spark, sf_dir).withColumn("n", F.row_number().over(order)).where("n <= 3")
    return ranked.select("merchant_nation", "record", "amount_cents")


def _halves(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir)
    return rows.where("direction = 'IN'"), rows.where("direction = 'OUT'")


query("union_positional", "SELECT record, direction, ccy FROM txn", ("txn",))(
    lambda spark, sf_dir: sets.union_positional([h.select("record", "direction", "ccy") for h in _halves(spark, sf_dir)])
)


@query("union_by_name", "SELECT record, direction, ccy FROM txn", ("txn",))
def _by_name(spark, sf_dir):
    a, b = _halves(spark, sf_dir)
    return sets.union_by_name([a.select("record", "direction", "ccy"), b.select("ccy", "record", "direction")])


@query("union_allow_missing", "SELECT record, CASE direction WHEN 'IN' THEN ccy END AS ccy, CASE direction WHEN 'OUT' THEN code END AS code FROM txn", ("txn",))
def _missing_columns(spark, sf_dir):
    a, b = _halves(spark, sf_dir)
    return sets.union_allow_missing([a.select("record", "ccy"), b.select("code", "record")])


@query(
    "duplicate_on_us",
    """SELECT record, direction AS mode, 'original' AS origin FROM txn UNION ALL SELECT record, 'IN', 'copy' FROM txn WHERE direction = 'OUT' AND merchant_nation = issuer_nation""",
    ("txn",),
)
def _on_us(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).select("record", C("direction").alias("mode"), F.lit("original").alias("origin"), (C("merchant_nation") == C("issuer_nation")).alias("own"))
    return sets.duplicate_on_us(rows, C("own") & (C("mode") == "OUT"), "mode", "IN", {"origin": "copy"}).drop("own")


@query(
    "set_difference_keys",
    """SELECT coalesce(n.k, c.k) AS custkey, CASE WHEN n.k IS NULL THEN 'current' WHEN c.k IS NULL THEN 'new' ELSE 'both' END AS side FROM
       (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 150000) n FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice <= 150000) c ON n.k = c.k""",
)
def _differences(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    return sets.key_differences(orders.where("o_totalprice > 150000"), orders.where("o_totalprice <= 150000"), ["custkey"])


@query("concat_chunks", "SELECT rate_date, from_ccy, rate_ppm FROM fx", ("fx",))
def _chunks(spark, sf_dir):
    folder = scratch_path(spark, "rate-chunks")
    rates = fixtures.fx(spark, sf_dir)
    for ccy in ("USD", "GBP", "JPY"):
        rates.where(C("from_ccy") == ccy).write.parquet(f"{folder}/{ccy}")
    return sets.concat_chunks(spark, folder).select("rate_date", "from_ccy", "rate_ppm")
