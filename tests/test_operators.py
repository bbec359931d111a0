"""Operators against brute force and hand-made edge cases."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from clearspan.functions import text
from clearspan.operators import aggregates, chunked, columns, filters, joins, ranges, records, rule_index, rules, sets, versions
from clearspan.operators.lookup import lookup_join
from clearspan.operators.ranges import best_range, range_pairs
from clearspan.session import scratch_path
from clearspan.sources import readers, sinks
from clearspan.streaming import incremental

C = F.col


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_lookup_is_the_same_broadcast_and_shuffled(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}", {"a": i}) for i in range(300)] + [(900, None, None)], "id int, key string, m map<string,int>")
    dim = spark.createDataFrame([("hot", 1), ("k3", 2), (None, 9)], "k string, v int")
    found = {}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (limit, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for null_safe in (False, True):
            wide = lookup_join(facts, dim, {"key": "k"}, ["v"], null_safe=null_safe)
            assert dict((r["id"], r["v"]) for r in wide.collect())[900] == (9 if null_safe else None)
            found.setdefault(null_safe, []).append(rows(wide))
        for how in ("left_semi", "left_anti"):
            found.setdefault(how, []).append(rows(lookup_join(facts, dim, {"key": "k"}, {}, how=how)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert all(a == b for a, b in found.values())


def test_no_job_runs_before_a_lookup_is_read(spark):
    tracker = spark.sparkContext.statusTracker()
    facts = spark.range(100).withColumn("k", C("id") % 7)
    sides = facts.groupBy("k").agg(F.count("*").alias("n"))
    spark.sparkContext.setJobGroup("lookups", "none yet")
    lookup_join(facts, sides, ["k"], ["n"])
    assert not tracker.getJobIdsForGroup("lookups")


@pytest.mark.parametrize("spans", [[], [(100, 199)], [(100, 199), (150, 249)], [(0, 10**9)], [(0, 10**9), (5, 5)]])
def test_ranges_of_one_width_or_none(spark, spans):
    ranges = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(spans)], "id int, lo long, hi long")
    points = spark.createDataFrame([(p,) for p in (0, 5, 100, 150, 199, 200, 249, 250)], "p long")
    pairs = range_pairs(points, ranges, "p", "lo", "hi")
    want = sorted((p, i) for p in (0, 5, 100, 150, 199, 200, 249, 250) for i, (lo, hi) in enumerate(spans) if lo <= p <= hi)
    assert sorted((r["p"], r["id"]) for r in pairs.collect()) == want


def test_one_wide_range_with_most_accounts_in_it(spark):
    facts = spark.range(5000).select(F.when(C("id") % 10 > 0, C("id") + 4_000_000).otherwise(C("id")).alias("acct"))
    ranges = spark.createDataFrame([(1, 4_000_000, 4_999_999), (2, 4_000_500, 4_000_599)], "id int, lo long, hi long")
    best = best_range(facts, ranges, ["acct"], C("acct"), "lo", "hi", [C("hi") - C("lo"), C("id")], {"id": "found"})
    want = {a: (2 if 4_000_500 <= a <= 4_000_599 else 1 if a >= 4_000_000 else None) for a in (r["acct"] for r in facts.collect())}
    assert {r["acct"]: r["found"] for r in best.collect()} == want


def test_more_conditions_than_any_limit(spark):
    table = spark.createDataFrame([("c", f"code IN ('{i}')") for i in range(1200)], "client string, condition string")
    assert len(filters.client_conditions(table, client="c")) == 1200


def test_conditions_of_an_unknown_form_are_reported(spark):
    table = spark.createDataFrame([("c", "a IN ('1')"), ("c", "a > 3"), ("d", "app_hash_file in files"), ("d", None)], "client string, condition string")
    df = spark.createDataFrame([("1",), ("2",)], "a string")
    with pytest.warns(UserWarning, match="a > 3"):
        assert filters.by_condition_table(df, table, client="c").count() == 1
    with pytest.raises(filters.InputError, match="a > 3"):
        filters.by_condition_table(df, table, strict=True, client="c")
    assert filters.by_condition_table(df, table, strict=True, client="d").count() == 2


def test_problems_have_five_examples(spark):
    df = spark.createDataFrame([(f"x{i % 9}", None if i % 2 else "a") for i in range(90)], "n string, a string")
    found = {r["column"]: r for r in filters.column_problems(df, ["a"], ["n"]).collect()}
    assert found["a"]["rows"] == 45 and found["n"]["rows"] == 90
    assert found["n"]["examples"] == [f"x{i}" for i in range(5)] and found["a"]["examples"] == [""]


def test_segments_of_a_thousand_bounds(spark):
    from decimal import Decimal

    bounds = sorted({(Decimal(i * 7 % 1009), bool(i % 2)) for i in range(1000)})
    values = [Decimal(v) / 2 for v in range(-3, 2050, 17)]
    blocks = [bounds[k : k + 33] for k in range(0, len(bounds), 33)]
    df = spark.createDataFrame([(v, blocks) for v in [*values, None]], f"v decimal(24,6), blocks array<array<struct<bound:{rules.BOUND},strict:boolean>>>")
    got = {r["v"]: r["s"] for r in df.select("v", rule_index.segment(C("v"), C("blocks")).alias("s")).collect()}
    assert got.pop(None) == -1
    assert {k: got[k] for k in got} == {v.quantize(Decimal("0.000001")): sum(v > b or (v == b and not strict) for b, strict in bounds) for v in values}


def test_ranges_in_many_spans_of_a_rule(spark):
    text = ",".join(f"{10 * i:04d}-{10 * i + 3:04d}" for i in range(40))
    table = spark.createDataFrame([(1, text)], "id int, cond string").withColumn("parsed", rules.token_condition(C("cond")))
    values = spark.createDataFrame([(f"{v:04d}",) for v in range(0, 420, 3)], "v string")
    hits = values.crossJoin(table).where(rules.token_match(C("parsed"), C("v"), spans=40)).collect()
    assert sorted(int(r["v"]) for r in hits) == [v for v in range(0, 400, 3) if v % 10 <= 3]


def test_wildcards_in_more_combinations_than_any_limit(spark):
    dims = {f"f{i}": f"t{i}" for i in range(7)}
    facts = spark.createDataFrame([tuple([n, *((n >> i) & 1 for i in range(7))]) for n in range(12)], "id int, " + ", ".join(f"{f} int" for f in dims))
    template = spark.createDataFrame([tuple([m, *(joins.WILDCARD if (m >> i) & 1 else (m * 3 >> i) & 1 for i in range(7))]) for m in range(128)], "fee int, " + ", ".join(f"{t} int" for t in dims.values()))
    found = sorted((r["id"], r["fee"]) for r in joins.join_wildcard(facts, template, dims, {}, ["fee"]).collect())
    cells = template.collect()
    want = sorted((n, t["fee"]) for n in range(12) for t in cells if all(t[f"t{i}"] in (joins.WILDCARD, (n >> i) & 1) for i in range(7)))
    assert found == want and len({tuple(t[f"t{i}"] == joins.WILDCARD for i in range(7)) for t in cells}) == 128


def test_ledger_survives_a_lost_checkpoint(spark, tmp_path):
    source, ledger = str(tmp_path / "in"), str(tmp_path / "ledger")
    schema = "file_id string, content_hash string, arrived_at timestamp"

    def arrive(n, file_id, content):
        df = spark.createDataFrame([(file_id, content)], "file_id string, content_hash string").withColumn("arrived_at", F.lit(f"2024-01-0{n} 00:00:00").cast("timestamp"))
        df.write.mode("append").parquet(source)

    arrive(1, "a", "1")
    arrive(2, "b", "1")
    fields = spark.createDataFrame([], schema).schema
    incremental.run_ledger(incremental.new_files(spark, source, fields), ledger, str(tmp_path / "first"))
    arrive(3, "c", "1")
    incremental.run_ledger(incremental.new_files(spark, source, fields), ledger, str(tmp_path / "second"))
    rows_ = spark.read.parquet(ledger).collect()
    assert sorted((r["file_id"], r["status"]) for r in rows_) == [("a", "duplicate"), ("a", "new"), ("b", "duplicate"), ("b", "new"), ("c", "new")]


def test_library_reaches_workers_from_any_folder(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    code = (
        f"import sys; sys.path.insert(0, {str(root)!r})\n"
        "import __spark_entry__ as e\nfrom pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "for n in ('udf_row_decode', 'str_tlv_extract', 'udf_first_match_rules'): print(n, len(e.queries()[n](s, '/root/testdata/sf0.001').take(1)))\n"
    )
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_ranges_against_brute_force(spark):
    rng = random.Random(7)
    spans = []
    for i in range(200):
        low = rng.randint(400_000_000, 400_400_000)
        spans.append((i, low, low + rng.choice([0, 9, 99, 5000, 120_000, 9_000_000])))
    points = [rng.randint(399_999_990, 400_500_000) for _ in range(150)] + [spans[0][1], spans[1][2]]
    r = spark.createDataFrame(spans, "rid int, low long, high long")
    p = spark.createDataFrame([(x, x + 700) for x in points], "point long, stop long")
    got = rows(ranges.range_pairs(p, r, "point", "low", "high").select("point", "rid"))
    assert got == sorted([(x, i) for x in points for i, lo, hi in spans if lo <= x <= hi], key=repr)
    overlap = rows(ranges.range_pairs(p, r, "point", "low", "high", point_end="stop", levels=tuple(range(3, 10))).select("point", "rid"))
    assert overlap == sorted([(x, i) for x in points for i, lo, hi in spans if lo <= x + 700 and hi >= x], key=repr)


def test_newest_then_widest_range_wins_and_old_versions_are_replaced(spark):
    table = spark.createDataFrame(
        [(100, 300, "2024-01-01", "old"), (100, 120, "2024-03-01", "narrow"), (100, 150, "2024-03-01", "wide"), (90, 400, "2024-02-01", "outer")], "low long, high long, d string, name string"
    ).withColumn("d", F.to_date("d"))
    facts = spark.createDataFrame([(1, 110, "2024-02-15"), (2, 110, "2024-03-05"), (3, 200, "2024-03-05"), (4, 110, "2023-01-01"), (5, 500, "2024-03-05")], "id int, n long, day string")
    facts = facts.withColumn("day", F.to_date("day"))
    active = ranges.version_intervals(table, "low", "d", [C("high").desc()])
    out = ranges.best_range(facts, active, ["n", "day"], C("n"), "low", "high", [C("d").desc(), C("high").desc()], {"name": "name"}, also=ranges.valid_version("d", "day"))
    assert dict((r["id"], r["name"]) for r in out.collect()) == {1: "outer", 2: "wide", 3: "outer", 4: None, 5: None}


def random_rules(rng, n):
    out = []
    for i in range(n):
        tokens = rng.choice(["", "nan", "05,06", "NOT:07", "05-07", "NOT:5-6,25", "15, 20-30", "XX", None])
        amount = rng.choice([None, "", ">=10", "<=50", ">10<40", "between 20 and 30", "=25", "25", "none"])
        start = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 40))
        until = rng.choice([None, start + dt.timedelta(days=rng.randint(0, 30))])
        out.append((i + 1, rng.choice("AB"), tokens, amount, start, until))
    return out


def slow_match(rule, key, code, amount, day):
    """First-match reading of one rule, straight from its text."""
    _, rule_key, tokens, limits, start, until = rule
    if rule_key != key or day < start or (until and day > until):
        return False
    if tokens not in (None, "", "nan"):
        negate, hit = tokens.startswith("NOT:"), False
        for t in tokens.removeprefix("NOT:").replace(" ", "").split(","):
            if "-" in t:
                lo, hi = map(int, t.split("-"))
                hit |= code.isdigit() and lo <= int(code) <= hi
            else:
                hit |= code == t
        if hit == negate:
            return False
    if limits in (None, "", "none"):
        return True
    if amount is None:
        return False
    text_ = limits.replace(" ", "")
    between = re.match(r"between(\d+)and(\d+)", text_)
    if between:
        return int(between[1]) <= amount <= int(between[2])
    tests = re.findall(r"(>=|<=|>|<|=)(\d+)", text_) or [("=", text_)]
    compare = {">=": amount.__ge__, "<=": amount.__le__, ">": amount.__gt__, "<": amount.__lt__, "=": amount.__eq__}
    return all(compare[op](int(n)) for op, n in tests)


def test_first_rule_against_a_loop_over_rule_text(spark):
    rng = random.Random(11)
    table = random_rules(rng, 120)
    facts = [
        (i, rng.choice("AB"), rng.choice(["05", "06", "07", "15", "25", "XX", "BLANK"]), rng.choice([None, 9, 10, 11, 25, 30, 40, 50, 51]), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 60)))
        for i in range(400)
    ]
    raw = spark.createDataFrame(table, RULES)
    df = rule_rows(spark, facts)
    index = text_index(raw)
    first = rule_index.first_rule(df, index, {"rule_id": "winner"})
    expected = {f[0]: [r[0] for r in table if slow_match(r, f[1], f[2], f[3], f[4])] for f in facts}
    assert {r["id"]: r["winner"] for r in first.collect()} == {i: next(iter(ids), None) for i, ids in expected.items()}
    every = rule_index.all_rules(df, index, {"rule_id": "rule"})
    assert sorted((r["id"], r["rule"]) for r in every.collect()) == sorted((i, r) for i, ids in expected.items() for r in ids)


RULES = "rule_id int, rule_key string, code string, amount string, valid_from date, valid_until date"


def text_index(raw):
    parsed = raw.withColumns({
        "p_code": rules.token_condition(C("code")), "p_amount": rules.number_condition(C("amount")), "p_days": rule_index.validity(C("valid_from"), C("valid_until")),
    })
    conditions = rule_index.Conditions({"key": "rule_key"}, {"p_code": "code"}, {"p_amount": "v_amount", "p_days": "v_day"})
    return rule_index.build_index(parsed, conditions, ["rule_id"], [C("rule_id")])


def rule_rows(spark, facts):
    df = spark.createDataFrame(facts, "id int, key string, code string, amount int, day date")
    return df.withColumns({"v_amount": C("amount").cast(rules.BOUND), "v_day": rule_index.days(C("day"))})


def test_ten_thousand_rules_of_one_key(spark):
    """As many codes, bounds and days as rules; the plan does not grow with them."""
    rng = random.Random(12)
    day = dt.date(2024, 1, 1)
    table = [
        (i, "A" if i % 3 else "B", rng.choice([f"c{i},c{i + 1}", f"NOT:c{i % 50}", f"{i}-{i + 30}", None]), rng.choice([f">={i}", f"<{i}", f"between {i} and {i + 100}", None]),
         day + dt.timedelta(days=i % 500), rng.choice([None, day + dt.timedelta(days=i % 500 + 20)]))
        for i in range(10_000)
    ]
    facts = [(k, rng.choice("AB"), rng.choice([f"c{rng.randrange(10_000)}", str(rng.randrange(10_000)), None]), rng.choice([None, rng.randrange(10_000)]), day + dt.timedelta(days=rng.randrange(-5, 530))) for k in range(150)]
    index = text_index(spark.createDataFrame(table, RULES))
    found = rule_index.first_rule(rule_rows(spark, facts), index, {"rule_id": "winner"})
    small = rule_index.first_rule(rule_rows(spark, facts), text_index(spark.createDataFrame(table[:5], RULES)), {"rule_id": "winner"})
    sizes = [len(df._jdf.queryExecution().optimizedPlan().toString()) for df in (found, small)]
    assert abs(sizes[0] - sizes[1]) < 0.1 * sizes[1]
    expected = {f[0]: next((r[0] for r in table if slow_match(r, f[1], f[2] or "", f[3], f[4])), None) for f in facts}
    assert {r["id"]: r["winner"] for r in found.collect()} == expected


def test_amount_conditions_by_currency_and_yes_no(spark):
    table = [(1, "A", ">100", "EUR", "NO"), (2, "A", "<=50", "usd ", None), (3, "A", "5", None, "YES"), (4, "B", None, "EUR", None), (5, "A", ">=0", "JPY", None), (None, None, None, None, None)]
    parsed = spark.createDataFrame(table, "rule_id int, rule_key string, limits string, currency string, cash string").withColumns({
        "p": rules.number_condition(C("limits")), "yn": rule_index.yes_no_condition(C("cash")),
    })
    facts = [(1, "A", 200, "EUR", 0, {"USD": 2.0}), (2, "A", 20, "USD", None, {"EUR": 0.5}), (3, "A", 5, "GBP", 9, {}), (4, "B", None, None, None, None), (5, "C", 1, "EUR", 0, {}), (6, "A", 5, "EUR", -1, None)]
    df = spark.createDataFrame(facts, "id int, key string, amount int, ccy string, cash int, rates_to map<string,double>").withColumns({
        "own": C("amount").cast(rules.BOUND), "cash_class": rule_index.amount_class(C("cash")),
    })
    got = {}
    for own in ("own", None):
        amounts = rule_index.Amounts("p", "currency", "amount", "ccy", "rates_to", own)
        index = rule_index.build_index(parsed, rule_index.Conditions({"key": "rule_key"}, {"yn": "cash_class"}, {}, amounts), ["rule_id"], [C("rule_id")])
        for r in rule_index.all_rules(df, index, {"rule_id": "rule"}).collect():
            got.setdefault((own, r["id"]), []).append(r["rule"])
    # Rule 3 has no currency: it tests the plain amount, or nothing where there is none.
    assert got == {("own", 1): [1], ("own", 2): [2], ("own", 3): [3], ("own", 4): [4], (None, 1): [1], (None, 2): [2], (None, 3): [3], (None, 4): [4]}


def test_needed_rules(spark):
    raw = spark.createDataFrame(random_rules(random.Random(3), 40), RULES)
    facts = spark.createDataFrame([("A", dt.date(2024, 1, 20)), ("A", dt.date(2024, 1, 20))], "key string, day date")
    got = {r["rule_id"] for r in rules.needed_rules(raw, facts, {"key": "rule_key"}, "day").collect()}
    day = dt.date(2024, 1, 20)
    assert got == {r["rule_id"] for r in raw.collect() if r["rule_key"] == "A" and r["valid_from"] <= day <= (r["valid_until"] or day)}


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_records_do_not_depend_on_chunks(spark, size):
    rng = random.Random(size)
    lines = [(f, i, rng.choice("01235DE"), f"l{i}") for f in ("a", "b") for i in sorted(rng.sample(range(200), 60))]
    expected = set()
    for f in ("a", "b"):
        start, before = None, None
        for _, i, key, _ in (x for x in lines if x[0] == f):
            ordinal = int(key) if key.isdigit() else ord(key) - 55
            if before is None or ordinal <= before:
                start = i
            before = ordinal
            expected.add((f, i, start))
    df = spark.createDataFrame(lines, "file string, no long, key string, line string")
    got = records.record_starts(df, ["file"], "no", records.sequence_ordinal(C("key")), size)
    assert {(r["file"], r["no"], r["record_start"]) for r in got.collect()} == expected
    whole = records.assemble_records(df, ["file"], "no", "key", list("01235DE"), size=size)
    assert whole.count() == len({(f, s) for f, _, s in expected})


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_blocks_do_not_depend_on_chunks(spark, size):
    rng = random.Random(size)
    messages = [(f, i, rng.choice(["697", "695", "200", "200"])) for f in (1, 2) for i in range(80)]
    expected = set()
    for f in (1, 2):
        start, held = None, []
        for _, i, code in (m for m in messages if m[0] == f):
            if code == "697":
                start, held = i, [i]
            elif start is not None:
                held.append(i)
                if code == "695":
                    expected |= {(f, n, start, i) for n in held}
                    start, held = None, []
    df = spark.createDataFrame(messages, "file int, no long, code string")
    got = records.with_block(df, ["file"], "no", "code", {"no": "end_no"}, size)
    assert {(r["file"], r["no"], r["block_start"], r["end_no"]) for r in got.collect()} == expected


def test_line_families(spark):
    sms = "3300" + "x" * 12 + "SMSRAWDATA" + "y" * 8 + "V22200" + " " * 10
    lines = spark.createDataFrame([("05x1",), ("0508",), (sms,), ("46x0",), ("01xE",), ("04x8",), ("99x0",)], "line string")
    family, key = records.line_family(C("line"), F.lit(False))
    got = [tuple(r) for r in lines.select(family, key).collect()]
    assert got == [("draft", "1"), (None, None), ("message", "22200"), (None, None), ("returned", "E"), (None, None), (None, None)]
    assert [r[0] for r in lines.select(records.line_family(C("line"), F.lit(True))[0]).collect()][3] == "settlement"


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_range_master_does_not_depend_on_delivery_order(spark, order):
    deliveries = [
        [("k", "2024-01-01", "l1"), ("k", "2024-05-01", "l3")],
        [("k", "2024-03-01", "l2"), ("j", "2024-01-01", "m1")],
        [("k", "2024-03-01", "l2   "), ("k", "2025-01-01", "l4")],
    ]
    schema = "key string, effective string, lines string"
    master = spark.createDataFrame([], schema).withColumns({"effective": F.to_date("effective"), "until": F.lit(None).cast("date")})
    for i in order:
        delivery = spark.createDataFrame(deliveries[i], schema).withColumn("effective", F.to_date("effective"))
        master = versions.merge_versions(master, delivery, ["key"], "effective", "until", "lines").checkpoint()
    got = {(r["key"], str(r["effective"]), str(r["until"])) for r in master.collect()}
    assert got == {("k", "2024-01-01", "2024-02-29"), ("k", "2024-03-01", "2024-04-30"), ("k", "2024-05-01", "2024-12-31"), ("k", "2025-01-01", "None"), ("j", "2024-01-01", "None")}
    assert master.count() == 5


def test_wildcards_match_any_value(spark):
    template = spark.createDataFrame([(1, 1, 255, 5), (2, 1, 3, 255), (3, 2, 255, 255), (4, 1, 255, 255)], "t int, tb int, ta int, tc int")
    facts = spark.createDataFrame([(1, 1, 3, 5), (2, 1, 4, 5), (3, 2, 9, 9), (4, 1, None, 5)], "id int, b int, a int, c int")
    args = (facts, template, {"a": "ta", "c": "tc"}, {"b": "tb"}, ["t"])
    masked = rows(joins.join_wildcard(*args).select("id", "t"))
    assert masked == [(1, 1), (1, 2), (1, 4), (2, 1), (2, 4), (3, 3), (4, 1), (4, 4)]
    assert masked == [(1, 1), (1, 2), (1, 4), (2, 1), (2, 4), (3, 3), (4, 1), (4, 4)]


def test_buckets_half_open_and_closed(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 5), (4, None)], "id int, amount int").withColumn("k", F.lit(1))
    buckets = spark.createDataFrame([(1, 10, 20, 1), (1, 0, 100, 2)], "bk int, lo int, hi int, bid int").where("bid = 1")
    args = (facts, buckets, {"k": "bk"}, C("amount"), "lo", "hi", "bid", "bucket", 0)
    assert [r[-1] for r in rows(joins.join_bucket(*args, half_open=True).select("id", "bucket"))] == [1, 0, 0, 0]
    assert [r[-1] for r in rows(joins.join_bucket(*args, half_open=False).select("id", "bucket"))] == [1, 1, 0, 0]


def test_rates_are_joined_by_date_so_rows_do_not_multiply(spark):
    facts = spark.createDataFrame([(1, "d1", "USD"), (2, "d2", "USD"), (3, "d3", "USD")], "id int, day string, ccy string")
    rates = spark.createDataFrame([("d1", "USD", 2), ("d2", "USD", 3), ("d2", "USD", 3)], "rate_date string, from_ccy string, rate int")
    got = joins.join_rate(facts, rates, {"day": "rate_date", "ccy": "from_ccy"}, "rate", "r", F.lit(1))
    assert [tuple(r) for r in got.orderBy("id").select("id", "r").collect()] == [(1, 2), (2, 3), (3, 1)]


def test_stage_keys_must_be_unique_and_complete(spark):
    base = spark.createDataFrame([("f", "0", 1), ("f", "1", 1)], "file_id string, file_idn string, ref_id int")
    calc = base.withColumn("v", C("file_idn"))
    keys = ["file_id", "file_idn", "ref_id"]
    assert joins.consolidate(base, [("calc", calc)], keys).count() == 2
    with pytest.raises(filters.InputError, match="repeat"):
        joins.consolidate(base, [("calc", calc.union(calc))], keys)


def test_input_checks_name_column_and_examples(spark):
    df = spark.createDataFrame([("1", "x", None), (None, "2", "on"), ("3", "y", None)], "a string, n string, active string")
    with pytest.raises(filters.InputError, match="a: 1 rows null"):
        filters.require(df, ["a"])
    with pytest.raises(filters.InputError, match=r"n: 2 rows not a number.*x"):
        filters.require(df, [], ["n"])
    filters.require(df, [], ["n"], C("active") == "on")
    with pytest.raises(filters.InputError, match="absent"):
        filters.require(df, ["gone"])
    with pytest.raises(filters.InputError):
        filters.in_list(df, df.where("false"), ["a"], fail_if_empty=True)
    assert filters.in_list(df, df.where("false"), ["a"]).count() == 0


def test_control_totals_refuse(spark):
    with pytest.raises(filters.InputError):
        aggregates.check_totals(1, 2, "groups")
    with pytest.raises(filters.InputError):
        aggregates.check_row_ratio(4, 10)
    aggregates.check_row_ratio(5, 10)
    aggregates.check_row_ratio(1, 0)


def test_numbering_is_dense_over_many_partitions(spark):
    df = spark.range(1000).select((C("id") * 7919 % 1000).alias("v"))
    got = sinks.numbered(df, ["v"], "n").collect()
    assert sorted((r["v"], r["n"]) for r in got) == [(i, i + 1) for i in range(1000)]


def test_on_us_copy_only_when_enabled(spark):
    df = spark.createDataFrame([(1, "on-us", "A"), (2, "on-us", "I"), (3, "off-us", "A")], "id int, j string, mode string")
    own = (C("j") == "on-us") & (C("mode") == "A")
    assert rows(sets.duplicate_on_us(df, own, "mode", "I").select("id", "mode")) == [(1, "A"), (1, "I"), (2, "I"), (3, "A")]
    assert sets.duplicate_on_us(df, own, "mode", "I", enabled=False).count() == 3


def test_unknown_condition_does_not_filter(spark):
    assert filters.condition_column(["a = 1", None, "zz in ('1')"], ["a"]) is None
    df = spark.createDataFrame([("1",), ("2",)], "a string")
    assert df.where(filters.condition_column(["t.A_x in ('9')", "t.a IN ('2')"], ["a"])).count() == 1


def test_align_and_optional(spark):
    df = spark.createDataFrame([("7", 1)], "a string, b int")
    assert columns.align(df, "b string, a int, c date").collect()[0].asDict() == {"b": "1", "a": 7, "c": None}
    assert [r[0] for r in df.select(columns.optional(df, "zz", "d")).collect()] == ["d"]


def test_next_after_links_across_chunks(spark):
    df = spark.createDataFrame([("k", i) for i in (1, 5, 9, 25, 26)], "k string, o long")
    got = chunked.next_after(df, ["k"], "o", "n", F.call_function("div", C("o"), F.lit(10).cast("bigint")))
    assert rows(got.select("o", "n")) == [(1, 5), (25, 26), (26, None), (5, 9), (9, 25)]


def test_ledger_survives_a_second_run(spark):
    source, ledger, bookmark = (scratch_path(spark, n) for n in ("arrivals", "ledger", "bookmark"))
    schema = "file_id string, content_hash string, arrived_at timestamp"
    at = lambda n: dt.datetime(2024, 1, 1, 0, n)
    for batch in ([("f", "h1", at(0)), ("f", "h1", at(1)), ("g", "x", at(2))], [("f", "h1", at(3)), ("f", "h2", at(4))], []):
        if batch:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.new_files(spark, source, spark.createDataFrame([], schema).schema)
        incremental.run_ledger(stream, ledger, bookmark)
    got = {(r["file_id"], r["content_hash"], r["status"], r["arrivals"]) for r in spark.read.parquet(ledger).collect()}
    assert got == {("f", "h1", "new", 2), ("g", "x", "new", 1), ("f", "h1", "duplicate", 1), ("f", "h2", "new version", 1)}


def test_published_version_keeps_history(spark):
    root = scratch_path(spark, "table")
    for stamp in ("1", "2"):
        sinks.publish_version(spark.createDataFrame([(stamp,)], "v string"), root, stamp)
    assert spark.read.parquet(sinks.current_version(spark, root)).collect()[0]["v"] == "2"
    assert [r["v"] for r in spark.read.parquet(f"{root}/history").collect()] == ["1"]


def test_missing_dataset(spark):
    assert readers.scan_optional(spark, scratch_path(spark, "none"), "a int").count() == 0
    with pytest.raises(FileNotFoundError, match="vendor"):
        readers.scan_first_existing(spark, "/nowhere", "vendor")


def test_containers_later_wins(spark):
    df = spark.createDataFrame([("0001002ab0002001x", "0001001z")], "a string, b string")
    assert df.select(text.tagged_from_containers(C("a"), C("b"))).collect()[0][0] == {"0001": "z", "0002": "x"}
