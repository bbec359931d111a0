"""File patterns against plain regular expressions, and many of them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clearspan.operators import patterns

C = F.col
TABLE = "pattern_id int, customer_code string, priority int, file_format string, is_active int, kind string"


@pytest.mark.parametrize(
    ("pattern", "literal"),
    [
        ("abc", "ABC"), ("^visa_in_.*\\.txt$", "VISA_IN_"), ("a?bcd", "BCD"), ("abcd?", "ABC"), ("ab+cd", "AB"), ("abc|d", ""), ("(abc|d)efg", "EFG"),
        ("ab{0,2}cde", "CDE"), ("\\d+report\\.csv", "REPORT.CSV"), ("x[abc]+yyy", "YYY"), ("[]a]bcd", "BCD"), ("\\x41bcd", ""), ("\\Qa.b\\E", ""),
        ("(?x)a b c", ""), ("(?:abc)?def", "DEF"), ("é clear", " CLEAR"), ("a(b[)]c)def", "DEF"), ("", ""), ("abc)", ""), ("ab*", "A"), ("a\\(b\\)", "A(B)"),
    ],
)
def test_required_literals(pattern, literal):
    assert patterns.required_literal(pattern) == literal


def expected(files, table, everyone="ALL"):
    out = {}
    for key, client, name in files:
        found = None
        for pid, whom, priority, pattern, active, kind in sorted(table, key=lambda r: (r[2], r[0])):
            if active == 1 and client is not None and name is not None and whom in (client, everyone) and pattern is not None and re.search(pattern, name, re.IGNORECASE | re.ASCII):
                found = kind
                break
        out[key] = found
    return out


def classified(spark, files, table):
    names = spark.createDataFrame(files, "id int, client string, name string")
    found = patterns.classify_names(names, spark.createDataFrame(table, TABLE), "client", "name", {"kind": "file_type"})
    assert found.columns == ["id", "client", "name", "file_type"]
    return found, {r["id"]: r["file_type"] for r in found.collect()}


def test_patterns_are_found_as_by_a_loop(spark):
    rng = random.Random(1)
    parts = ["visa", "mc_", "in", "out", "\\d{2}", "[a-c]", ".*", "x?", "(clr|rep)", "\\.txt", "$", "^", "file+", "a|b"]
    table = [(i, rng.choice(["ALL", "c1", "c2", "c3", None]), rng.randrange(5), "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))), rng.choice([1, 1, 1, 0]), f"k{i}") for i in range(80)]
    table = [t for t in table if not re.search(r"\^\^|\?\?|\*\?|\$\$|\+\+", t[3])]
    table.append((900, "c1", 0, None, 1, "null"))
    words = ["VISA", "mc_", "In", "OUT", "12", "b", "clr", "REP", ".txt", "x", "File"]
    files = [(i, rng.choice(["c1", "c2", "c9", "ALL", None]), rng.choice([None, "", "".join(rng.choice(words) for _ in range(rng.randrange(0, 6)))])) for i in range(300)]
    assert classified(spark, files, table)[1] == expected(files, table)


def test_no_patterns_and_no_files(spark):
    assert classified(spark, [(1, "c", "n")], [])[1] == {1: None}
    assert classified(spark, [], [(1, "ALL", 1, "x", 1, "k")])[1] == {}


def test_a_hundred_thousand_patterns_of_ten_thousand_clients(spark):
    table = [(i, f"c{i % 10_000}" if i % 100 else "ALL", i // 10_000, f"(in|out)_{i}_.*\\.dat$" if i % 7 else f"^x{i}", 1, f"k{i}") for i in range(100_000)]
    files = [(i, f"c{i * 37 % 10_050}", f"IN_{i * 37 % 100_000}_z.DAT" if i % 3 else f"X{i * 100}") for i in range(200)]
    found, got = classified(spark, files, table)
    by_id = {t[0]: t for t in table}
    want = {}
    for key, client, name in files:
        digits = re.search(r"\d+", name)[0]
        hits = [t for t in (by_id.get(int(digits[:k])) for k in range(1, len(digits) + 1)) if t and t[1] in (client, "ALL") and re.search(t[3], name, re.IGNORECASE)]
        want[key] = min(hits, key=lambda t: (t[2], t[0]))[5] if hits else None
    assert got == want and sum(v is not None for v in got.values()) > 3
    few, _ = classified(spark, files[:3], table[:3])
    sizes = [len(df._jdf.queryExecution().optimizedPlan().toString()) for df in (found, few)]
    assert abs(sizes[0] - sizes[1]) < 500
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
