"""Commits, versions, bookmarks, control totals and delta merges of stored tables."""

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.operators import versions
from clearspan.sources import commits, readers, sinks
from clearspan.streaming import incremental

C = F.col


def one(spark, value):
    return spark.createDataFrame([(value,)], "v string")


def shown(spark, root):
    return [r["v"] for r in spark.read.parquet(sinks.current_version(spark, root)).collect()]


def test_of_two_commits_of_one_number_one_fails(spark, tmp_path):
    log = str(tmp_path / "log")
    assert commits.latest(spark, log) == (0, None)
    assert commits.commit(spark, log, 0, {"a": 1}) == 1
    with pytest.raises(commits.ConflictError):
        commits.commit(spark, log, 0, {"a": 2})
    assert commits.commit(spark, log, 1, {"a": 3}) == 2
    assert commits.latest(spark, log) == (2, {"a": 3})
    assert commits.entries(spark, log, after=1) == [(2, {"a": 3})]
    assert not [n for n in os.listdir(log) if n.startswith(".") and not n.endswith(".crc")]


def test_of_two_publishers_at_once_one_fails(spark, tmp_path):
    root = str(tmp_path / "table")
    sinks.publish_version(one(spark, "a"), root, "1")
    seen, _ = commits.latest(spark, f"{root}/_commits")
    sinks.publish_version(one(spark, "b"), root, "2", after=seen)
    with pytest.raises(commits.ConflictError):
        sinks.publish_version(one(spark, "c"), root, "3", after=seen)
    assert shown(spark, root) == ["b"] and len(list((tmp_path / "table" / "versions").iterdir())) == 2
    with pytest.raises(commits.ConflictError):
        sinks.publish_version(one(spark, "d"), root, "2")


def test_a_crash_between_commit_and_history_is_made_up(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    sinks.publish_version(one(spark, "a"), root, "1")
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "keep_history", lambda *_: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            sinks.publish_version(one(spark, "b"), root, "2")
        broken.setattr(commits, "commit", lambda *_: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            sinks.publish_version(one(spark, "lost"), root, "x")
    assert shown(spark, root) == ["b"]
    sinks.publish_version(one(spark, "c"), root, "3")
    history = spark.read.parquet(f"{root}/history")
    assert sorted((r["v"], str(r["snapshot_ts"])) for r in history.collect()) == [("a", "2"), ("b", "3")]


def test_bookmark_takes_new_and_rewritten_files_once(spark, tmp_path):
    folder, bookmark = str(tmp_path / "in"), str(tmp_path / "mark")
    schema = "v int"

    def put(name, value):
        spark.createDataFrame([(value,)], schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")

    taken = []

    def work(rows, run):
        taken.append((run, sorted(r["v"] for r in rows.collect())))

    fields = spark.createDataFrame([], schema).schema
    put("a", 1)
    put("b", 2)
    assert incremental.run_new_and_changed(spark, folder, fields, bookmark, work) == 2
    assert incremental.run_new_and_changed(spark, folder, fields, bookmark, work) == 0
    put("a", 10)
    put("c", 3)

    def failing(rows, run):
        raise ValueError("no luck")

    with pytest.raises(ValueError):
        incremental.run_new_and_changed(spark, folder, fields, bookmark, failing)
    assert incremental.run_new_and_changed(spark, folder, fields, bookmark, work) == 2
    # The same name and length, but another time.
    (file,) = Path(folder, "b").glob("*.parquet")
    os.utime(file, (1, 1))
    assert incremental.run_new_and_changed(spark, folder, fields, bookmark, work) == 1
    assert taken == [(1, [1, 2]), (2, [3, 10]), (3, [2])]


def test_totals_are_counted_while_a_table_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_counted(spark.range(7), path, total=F.sum("id"), rows=F.count("*")) == {"total": 21, "rows": 7}
    assert sinks.write_counted(spark.range(0), path) == {"rows": 0}

    def refuse(totals):
        raise ValueError(totals)

    sinks.write_counted(spark.range(3), path, check=lambda totals: None)
    with pytest.raises(ValueError, match="9"):
        sinks.write_counted(spark.range(9), path, check=refuse)
    assert spark.read.parquet(path).count() == 3 and len([p for p in tmp_path.iterdir() if p.name.startswith("t")]) == 1


def test_files_follow_the_volume(spark, tmp_path):
    rows = spark.range(300_000).select("id", F.md5(C("id").cast("string")).alias("text"))
    count = {}
    for name, part, size in (("small", rows.limit(100), 4 << 20), ("large", rows, 4 << 20), ("one", rows, 1 << 30)):
        sinks.write_by_volume(part, str(tmp_path / name), size)
        count[name] = len(list((tmp_path / name).glob("*.parquet")))
    assert count["small"] == 1 and 3 <= count["large"] <= 8 and count["one"] == 1
    assert spark.read.parquet(str(tmp_path / "large")).count() == 300_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") in ("64MB", "67108864b")


def test_late_version_rewrites_one_partition(spark, tmp_path):
    path = str(tmp_path / "master")
    schema = "key string, effective date, lines string"
    day = lambda m: dt.date(2024, m, 1)
    first = spark.createDataFrame([(f"k{i}", day(m), f"{i}-{m}") for i in range(200) for m in (1, 6)], schema)
    versions.merge_into_store(spark, path, first, ["key"], "effective", "until", "lines", parts=16)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    late = spark.createDataFrame([("k7", day(3), "7-3"), ("k7", day(1), "7-1  ")], schema)
    versions.merge_into_store(spark, path, late, ["key"], "effective", "until", "lines", parts=16)
    after = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    assert {p.parent for p in set(before) ^ set(after)} == {next(p for p in after if p not in before).parent}
    rows = spark.read.parquet(path)
    assert rows.count() == 401
    got = [(r["effective"], r["until"]) for r in rows.where("key = 'k7'").orderBy("effective").collect()]
    assert got == [(day(1), dt.date(2024, 2, 29)), (day(3), dt.date(2024, 5, 31)), (day(6), None)]
    versions.merge_into_store(spark, path, late.limit(0), ["key"], "effective", "until", "lines", parts=16)
    whole = versions.merge_versions(first.withColumn("until", F.lit(None).cast("date")), first.unionByName(late), ["key"], "effective", "until", "lines")
    assert rows.count() == whole.count()


def test_lines_keep_every_byte(spark, tmp_path):
    lines = [b"0501aaa\x01bbb", b"0502\"q\",\xe9\xff", b"   ", b"", b"0503\\x\x00y", b"0504 end "]
    (tmp_path / "f.txt").write_bytes(b"\n".join(lines) + b"\n")
    got = {(r["line_no"], r["line"]) for r in readers.scan_text_lines(spark, str(tmp_path)).collect()}
    assert {line for _, line in got} == {b.decode("latin1") for b in lines if b.strip()}
    assert [line for _, line in sorted(got)] == [b.decode("latin1") for b in lines if b.strip()]


def test_a_table_that_is_written_again_has_its_new_columns(spark, tmp_path):
    for k, column in enumerate(("a", "b")):
        spark.range(2).withColumnRenamed("id", column).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
        os.utime(tmp_path / "t.parquet", (1000 + k, 1000 + k))
        assert fixtures.table(spark, str(tmp_path), "t").columns == [column]
