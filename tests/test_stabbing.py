"""Best ranges of points, against loops over all ranges."""

import random

import pytest
from pyspark.sql import functions as F

from clearspan.operators import joins, ranges, rule_index, rules, stabbing

C = F.col

def order():
    return [C("day").desc(), C("high").desc(), C("rid")]


def spans_of(rng, n):
    out = []
    for i in range(n):
        low = rng.randint(0, 400)
        out.append((i, low, low + rng.choice([0, 3, 40, 300]), rng.randint(0, 9)))
    return out + [(n, None, 5, 1), (n + 1, 5, None, 1), (n + 2, 5, 900, None), (n + 3, 50, 40, 1)]


def first(spans, holds):
    found = [s for s in spans if None not in s and s[1] <= s[2] and holds(s)]
    return min(found, key=lambda s: (-s[3], -s[2], s[0]))[0] if found else None


@pytest.mark.parametrize("chunk", [1, 7, stabbing.CHUNK])
def test_newest_range_since_a_day_against_a_loop(spark, monkeypatch, chunk):
    monkeypatch.setattr(stabbing, "CHUNK", chunk)
    rng = random.Random(3)
    spans = spans_of(rng, 150)
    facts = [(rng.randint(-5, 720), rng.randint(-1, 10)) for _ in range(200)] + [(None, 3), (9, None), (20, 5), (20, 5)]
    table = spark.createDataFrame(spans, "rid int, low long, high long, day int").repartition(3)
    rows = spark.createDataFrame(facts, "x long, on int").repartition(3)
    out = ranges.best_range(rows, table, ["x", "on"], C("x"), "low", "high", order(), {"rid": "found"}, since=("day", "on"))
    expected = [(x, d, first(spans, lambda s: None not in (x, d) and s[1] <= x <= s[2] and s[3] <= d)) for x, d in facts]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)


def test_intervals_against_a_loop(spark):
    rng = random.Random(4)
    spans = [s for s in spans_of(rng, 80) if s[3] is not None]
    points = [rng.randint(-50, 800) for _ in range(150)] + [None]
    table = spark.createDataFrame(spans, "rid int, low long, high long, day int")
    out = ranges.best_range(spark.createDataFrame([(p,) for p in points], "x long"), table, ["x"], C("x"), "low", "high", order(), {"rid": "found"}, point_end=C("x") + C("x") % 7 + 9)
    expected = [(p, first(spans, lambda s: p is not None and s[1] <= p + abs(p) % 7 * (1 if p > 0 else -1) + 9 and s[2] >= p)) for p in points]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)


def test_all_points_in_all_ranges(spark):
    """As pairs they would be 1.6 thousand million."""
    n = 40_000
    table = spark.range(n).selectExpr("id AS rid", "id AS low", f"id + {n} AS high", "id AS day")
    facts = spark.range(n).selectExpr(f"{n - 1} - id % 7 AS x", "id AS on")
    out = ranges.best_range(facts, table, ["x", "on"], C("x"), "low", "high", order(), {"rid": "found"}, since=("day", "on"))
    assert out.count() == n and out.where("found = least(x, on)").count() == n


@pytest.mark.parametrize("half_open", [True, False])
def test_narrowest_bucket_of_a_key_against_a_loop(spark, half_open):
    rng = random.Random(6)
    buckets = [(rng.choice("AB"), lo := rng.randint(0, 200), lo + rng.choice([0, 1, 30, 90]), i) for i in range(120)] + [(None, 0, 999, 500), ("A", None, 9, 501), ("A", 3, None, 502)]
    facts = [(i, rng.choice(["A", "B", "C", None]), rng.choice([None, *range(-2, 300)])) for i in range(400)]
    table, rows = spark.createDataFrame(buckets, "bk string, lo long, hi long, bid int"), spark.createDataFrame(facts, "id int, k string, amount long")
    out = joins.join_bucket(rows, table, {"k": "bk"}, C("amount"), "lo", "hi", "bid", "bucket", -7, half_open=half_open)

    def narrowest(k, a):
        held = [(hi - lo, i) for b, lo, hi, i in buckets if None not in (k, a, b, lo, hi) and b == k and lo <= a and (a < hi if half_open else a <= hi)]
        return min(held)[1] if held else -7

    assert {r["id"]: r["bucket"] for r in out.collect()} == {i: narrowest(k, a) for i, k, a in facts}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_rule_loop_with_odd_rows_against_the_index(spark, tmp_path):
    """Missing sizes, amounts and dates, repeated rows; rules that agree reach the loop once."""
    import __spark_entry__ as entry

    rng = random.Random(8)
    spark.createDataFrame([(i, f"n{i}", i % 5) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(i, i % 25) for i in range(20)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    parts = [(i, rng.choice([None, *range(1, 51)]), "B") for i in range(3000)]
    spark.createDataFrame(parts + parts[:50], "p_partkey long, p_size int, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    orders = [(i, i % 20, rng.choice([None, rng.random() * 90000, 2000.0]), rng.choice([None, f"199{rng.randint(4, 9)}-0{rng.randint(1, 9)}-11"]), "1") for i in range(600)]
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate string, o_orderpriority string"
    spark.createDataFrame(orders + orders[:30], schema).withColumn("o_orderdate", C("o_orderdate").cast("timestamp")).write.parquet(f"{tmp_path}/orders.parquet")
    loop, index = (entry.queries()[n](spark, str(tmp_path)) for n in ("udf_first_match_rules", "window_first_rule"))
    missing = {i for i, _, price, day, _ in orders if price is None or day is None}
    found = sorted(tuple(r) for r in loop.collect() if r[0] not in missing)
    assert len({r for _, r in found}) > 30
    assert found == sorted((r["record"], r["rule_id"] or -1) for r in index.collect() if r["record"] not in missing)
    assert "min(rule_id" in loop._jdf.queryExecution().optimizedPlan().toString()


def test_facts_do_not_meet_bitmaps_or_payloads(spark):
    """Rows of the facts meet listed values and bounds; the payload of a key's rules is looked up for the one that was found."""
    n = 3000
    table = spark.range(n).selectExpr("id AS rule_id", "'A' AS rule_key", f"'>=' || (id * 7 % {n}) AS limits", "repeat('x', 500) AS note")
    index = rule_index.build_index(table.withColumn("p", rules.number_condition(C("limits"))), rule_index.Conditions({"key": "rule_key"}, {}, {"p": "v"}), ["rule_id"], [C("rule_id"), C("note")])
    facts = spark.range(50).selectExpr("id", "'A' AS key", "CAST(id * 61 - 1 AS DECIMAL(24,6)) AS v")
    assert "'at'" not in str(rule_index._told(index).schema) and "'bits'" not in str(rule_index._told(index).schema)
    out = rule_index.first_rule(facts, index, {"rule_id": "found", "note": "note"})
    rows = {r["id"]: (r["found"], r["note"]) for r in out.collect()}
    first = lambda v: next((k for k in range(n) if k * 7 % n <= v), None)
    assert rows == {i: (f := first(i * 61 - 1), None if f is None else "x" * 500) for i in range(50)}
