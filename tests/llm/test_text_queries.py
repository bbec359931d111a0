"""The registered text queries against SQL on the smallest tables, and the pipeline stage by stage."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from clearspan.llm import classifier, mixing, queries, rules

SMALL = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not SMALL.exists(), reason="test tables are absent")


def test_all_operators_are_registered():
    named = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in named) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in named and 4 <= len(corpus_pipeline.STAGES) <= 5


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    db = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    df = queries.QUERIES[name](spark, str(SMALL))
    found = db.execute(queries.ORACLES[name])
    columns = sorted(d[0] for d in found.description)
    assert columns == sorted(df.columns)
    want = found.df()[columns].astype(str).values.tolist()
    assert sorted(df.select(*columns).toPandas().astype(str).values.tolist()) == sorted(want)


@needs_tables
@pytest.mark.parametrize("name", ["op3_quality_rules", "op5_mixing", "op7_url_filters", "op10_fingerprints"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, str(SMALL))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


@needs_tables
def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(str(SMALL / "documents.parquet"))
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(SMALL))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(path := str(tmp_path / str(k)))
        rows = spark.read.parquet(path)
        if k < 3:
            assert 0 < rows.count() < before, name
            before = rows.count()
            ids = {r.doc_id for r in rows.select("doc_id").collect()}
        docs = rows
    last = docs.collect()
    assert {r.doc_id for r in last} <= ids
    assert all(r.n_tokens == len(r.ids) for r in last)
    texts = {r.doc_id: r.text for r in spark.read.parquet(str(SMALL / "documents.parquet")).collect()}
    assert all(r.text == texts[r.doc_id] for r in last)
    assert sorted(r.doc_id for r in entry.queries()["pipeline"](spark, str(SMALL)).collect()) == sorted(r.doc_id for r in last)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@needs_tables
def test_pipeline_stages_against_plain_versions(spark):
    """Every stage's rows from what went into it: scores one by one, posteriors by SQL's rows, all pairs, counts of the mix, the library's ids."""
    folder = str(SMALL)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}

    model = classifier.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = {i for i, t in texts.items() if model.score(classifier.features([(t or "").encode()]))[0] >= classifier.THRESHOLD}
    first = spark.createDataFrame(stages["quality classifier"](spark, docs, folder).collect(), docs.schema)
    assert {r.doc_id for r in first.collect()} == want

    second = spark.createDataFrame(stages["quality rules"](spark, first, folder).collect(), docs.schema)
    want = {r.doc_id for r in rules.judge_documents(first).where("kept").collect()}
    assert {r.doc_id for r in second.collect()} == want

    third = spark.createDataFrame(stages["near duplicates"](spark, second, folder).collect(), docs.schema)
    sets, group = {i: shingle_set(texts[i]) for i in sorted(want)}, {i: i for i in want}
    root = lambda x: x if group[x] == x else root(group[x])
    for k, a in enumerate(sets):
        for b in list(sets)[:k]:
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    assert {r.doc_id for r in third.collect()} == {root(i) for i in want}

    fourth = spark.createDataFrame(stages["source mixing"](spark, third, folder).collect(), docs.schema)
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(third).collect()}
    assert Counter(r.doc_id for r in fourth.collect()) == Counter({i: n // size + (2 * (n % size) >= size) for i, (n, size) in taken.items() if size and n})

    tokenizer = Tokenizer.from_file(queries.vocabulary_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    for r in stages["bpe encoding"](spark, fourth, folder).collect():
        assert (list(r.ids), r.text) == (tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, texts[r.doc_id])


EDGE = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, kept boolean, ids string, `__row` string"


def test_pipeline_stages_on_edge_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, clashing names, labels that are null or missing."""
    good = " ".join(f"word{i % 97} and" for i in range(300))
    rows = [
        (1, good, "en", "a", 5), (1, good, "en", "a", 5), (2, good + " more", None, None, None), (None, good + " of it", "en", "a", 1), (None, None, None, None, None),
        (3, "", "en", "a", 0), (4, " \n\t", "en", "b", 3), (5, "x", "en", None, 1), (6, "junk### " * 90, "en", "b", 9), (7, " ".join(f"w{i}" for i in range(30_000)), "en", "c", 9),
        (8, None, "en", "c", 0), (9, "only one line\n" * 200, "en", "c", 1),
    ]
    docs = spark.createDataFrame([(*r, 0.5, 1, None, "x", "y") for r in rows], EDGE)
    folder = str(tmp_path / "tables")
    spark.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None), (99, 0)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    given = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, given, folder).write.parquet(path := str(tmp_path / str(k)))
        given = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert given.columns == docs.columns, name
    left = {r.doc_id for r in given.collect()}
    assert left <= {1, 7} and 6 not in left
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0, name


def test_each_filtering_stage_keeps_clean_documents(spark, tmp_path):
    folder = str(tmp_path / "tables")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k} the" for k in range(60)), "en", "s", 1) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, docs, folder).count() == 30, name
