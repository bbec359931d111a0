"""Windows (E): versions, best matches, first rules, records and blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.functions.dates import timestamp_text
from clearspan.operators import ranges, records, rule_index, versions
from clearspan.sources.sinks import numbered
from clearspan.workload.joins import CONDITIONS, RULE_MATCH, best_first, parsed_rules, rule_facts
from clearspan.workload.registry import query

C = F.col
AS_OF = "DATE '1994-09-01'"


@query(
    "window_latest_version",
    f"""SELECT range_id, band, effective_date FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY effective_date DESC, high_key DESC, range_id) AS n
        FROM (SELECT *, low_key // 200000 AS band FROM acct_range) WHERE effective_date <= {AS_OF}) WHERE n = 1""",
    ("acct_range",),
)
def _latest(spark, sf_dir):
    banded = fixtures.acct_range(spark, sf_dir).withColumn("band", F.call_function("div", C("low_key"), F.lit(200_000).cast("bigint")))
    kept = ranges.latest_versions(banded, "band", "high_key", "effective_date", F.expr(AS_OF), [C("range_id")])
    return kept.select("range_id", "band", "effective_date")


@query(
    "window_best_match",
    """SELECT t.record, b.range_id, b.product FROM txn t LEFT JOIN (SELECT record, range_id, product FROM (SELECT t.record, r.range_id, r.product, row_number() OVER (PARTITION BY t.record
       ORDER BY r.effective_date DESC, r.high_key DESC, r.range_id) AS n FROM txn t JOIN acct_range r ON t.acct9 BETWEEN r.low_key AND r.high_key AND r.effective_date <= t.purchase_date) WHERE n = 1) b ON t.record = b.record""",
    ("txn", "acct_range"),
)
def _best(spark, sf_dir):
    rows = ranges.best_range(
        fixtures.txn(spark, sf_dir), fixtures.acct_range(spark, sf_dir), ["acct9", "purchase_date"], C("acct9"), "low_key", "high_key",
        best_first(), {"range_id": "range_id", "product": "product"}, since=("effective_date", "purchase_date"),
    )
    return rows.select("record", "range_id", "product")


def matched_rules(spark, sf_dir):
    names = ["rule_id", "var_bp", "fix_cents", "min_cents", "cap_cents"]
    index = rule_index.build_index(parsed_rules(spark, sf_dir), CONDITIONS, ["rule_id"], [C(c) for c in names])
    return rule_index.first_rule(rule_facts(spark, sf_dir), index, {c: c for c in names})


FIRST_RULE_SQL = f"""firsts AS (SELECT t.record, min(r.rule_id) AS rule_id FROM txn t JOIN rules r ON {RULE_MATCH} GROUP BY t.record)"""


@query(
    "window_first_rule",
    """SELECT t.record, coalesce(f.rule_id, 0) AS rule_id, r.var_bp, r.fix_cents FROM txn t LEFT JOIN firsts f ON t.record = f.record LEFT JOIN rules r ON f.rule_id = r.rule_id""",
    ("txn", "rules"),
    FIRST_RULE_SQL,
)
def _first_rule(spark, sf_dir):
    rows = matched_rules(spark, sf_dir)
    return rows.select("record", F.coalesce("rule_id", F.lit(0)).alias("rule_id"), "var_bp", "fix_cents")


@query("window_rule_ordinal", "SELECT rule_id, nation, row_number() OVER (ORDER BY nation, rule_id) AS ordinal FROM rules", ("rules",))
def _ordinal(spark, sf_dir):
    return numbered(fixtures.rules(spark, sf_dir).select("rule_id", "nation"), ["nation", "rule_id"], "ordinal")


@query(
    "window_tightest_bucket",
    """SELECT acct9, range_id, width FROM (SELECT a.acct9, r.range_id, r.high_key - r.low_key AS width, row_number() OVER (PARTITION BY a.acct9 ORDER BY r.high_key - r.low_key, r.range_id) AS n
       FROM (SELECT DISTINCT acct9 FROM txn) a JOIN acct_range r ON a.acct9 BETWEEN r.low_key AND r.high_key) WHERE n = 1""",
    ("txn", "acct_range"),
)
def _tightest(spark, sf_dir):
    accounts = fixtures.txn(spark, sf_dir).select("acct9").distinct()
    sized = fixtures.acct_range(spark, sf_dir).withColumn("width", C("high_key") - C("low_key"))
    out = ranges.best_range(accounts, sized, ["acct9"], C("acct9"), "low_key", "high_key", [C("width"), C("range_id")], {"range_id": "range_id", "width": "width"})
    return out.where("range_id IS NOT NULL").select("acct9", "range_id", "width")


@query(
    "window_scd2_close",
    """SELECT range_id, k, CASE WHEN nxt IS NULL THEN NULL ELSE strftime(nxt - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S.000') END AS valid_to FROM
       (SELECT a.range_id, a.low_key % 4500000 AS k, (SELECT min(b.effective_date) FROM acct_range b WHERE b.low_key % 4500000 = a.low_key % 4500000 AND b.effective_date > a.effective_date) AS nxt FROM acct_range a)""",
    ("acct_range",),
)
def _close(spark, sf_dir):
    rows = fixtures.acct_range(spark, sf_dir).selectExpr("range_id", "low_key % 4500000 AS k", "CAST(effective_date AS TIMESTAMP) AS started")
    return versions.close_versions(rows, ["k"], "started", "ended").select("range_id", "k", timestamp_text(C("ended")).alias("valid_to"))


@query(
    "window_drop_dups_keep_first",
    """SELECT product, range_id, effective_date FROM (SELECT *, row_number() OVER (PARTITION BY product ORDER BY effective_date DESC, range_nation, range_id) AS n FROM acct_range) WHERE n = 1""",
    ("acct_range",),
)
def _keep_first(spark, sf_dir):
    kept = versions.keep_last_version(fixtures.acct_range(spark, sf_dir), ["product"], [C("effective_date").desc(), C("range_nation"), C("range_id")])
    return kept.select("product", "range_id", "effective_date")


RECORDS_SQL = """marked AS (SELECT *, CASE WHEN seq <= lag(seq) OVER (PARTITION BY file_no ORDER BY line_no) OR lag(seq) OVER (PARTITION BY file_no ORDER BY line_no) IS NULL THEN 1 ELSE 0 END AS opens FROM lines),
  placed AS (SELECT *, sum(opens) OVER (PARTITION BY file_no ORDER BY line_no) AS record FROM marked)"""


@query(
    "window_assemble_records",
    """SELECT file_no, min(line_no) AS record_start, """
    + ", ".join(f"coalesce(max(line) FILTER (seq = {k}), '') AS \"{k}\"" for k in range(5))
    + " FROM placed GROUP BY file_no, record",
    ("lines",),
    RECORDS_SQL,
)
def _assemble(spark, sf_dir):
    return records.assemble_records(fixtures.lines(spark, sf_dir), ["file_no"], "line_no", "seq", [str(k) for k in range(5)])


@query(
    "window_block_context",
    """SELECT m.file_no, m.msg_no, m.fc, h.block_start, h.block_end, e.msg_date AS trailer_date FROM messages m
       JOIN (SELECT h.file_no, h.msg_no AS block_start, (SELECT min(x.msg_no) FROM messages x WHERE x.file_no = h.file_no AND x.fc = '695' AND x.msg_no > h.msg_no) AS block_end,
             (SELECT min(x.msg_no) FROM messages x WHERE x.file_no = h.file_no AND x.fc = '697' AND x.msg_no > h.msg_no) AS next_start FROM messages h WHERE h.fc = '697') h
       ON m.file_no = h.file_no AND m.msg_no BETWEEN h.block_start AND h.block_end JOIN messages e ON e.msg_no = h.block_end
       WHERE h.block_end IS NOT NULL AND (h.next_start IS NULL OR h.block_end < h.next_start)""",
    ("messages",),
)
def _blocks(spark, sf_dir):
    rows = records.with_block(fixtures.messages(spark, sf_dir), ["file_no"], "msg_no", "fc", {"msg_date": "trailer_date"})
    return rows.select("file_no", "msg_no", "fc", "block_start", "block_end", "trailer_date")
