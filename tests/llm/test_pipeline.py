"""The pipeline's stages, each on its own input, and the SQL of the registered queries."""

import os

import pytest

import corpus_pipeline
from airgrid.llm import decontaminate, jaccard_join, secrets, text, toxicity
from airgrid.llm.catalog import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")


@needs_tables
def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    out = stages["toxicity"](spark, docs, SMALL)
    assert out.columns == docs.columns
    model = toxicity.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    bad = toxicity.score_toxicity(docs, model).where("toxicity >= 0.7")
    assert out.count() == docs.count() - bad.count()
    out = stages["n-gram Jaccard join"](spark, docs, SMALL)
    groups = jaccard_join.similar_groups(docs)
    assert out.columns == docs.columns and out.count() == groups.select("component_id").distinct().count()
    out = stages["benchmark decontamination"](spark, docs, SMALL)
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert out.columns == docs.columns
    assert out.count() == decontaminate.decontaminate(docs, bench).where("n_hit = 0").count()
    out = stages["secret scans"](spark, docs, SMALL)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert secrets.find_secrets(out).where("size(base) > 0").count() == 0


CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, toxicity double, _of int, _mark int, row string, mark string, root int"


def clashing(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), -7.0, 1, 2, "r", "m", 3) for i, t in rows], CLASHING
    )


@needs_tables
def test_stages_keep_columns_of_clashing_names(spark):
    rows = [(1, "ordinary words in a row"), (None, "other words"), (3, None), (4, ""), (4, "")]
    docs = clashing(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert len(got) == 5 and all((r.toxicity, r._of, r._mark, r.row, r.mark, r.root) == (-7.0, 1, 2, "r", "m", 3) for r in got)


def test_one_row_of_each_group_stays(spark):
    whole = " ".join(f"w{i}" for i in range(60))
    near = whole.replace("w59", "x59")
    rows = [(None, whole), (None, whole), (5, whole), (5, whole), (6, whole), (5, near), (None, None), (7, ""), (None, "alone one"),
            (None, "alone one"), (9, "nine lives"), (9, "nine lives"), (9, "of another text")]
    out = jaccard_join.one_of_each(clashing(spark, rows)).collect()
    kept = sorted(((r.doc_id, r.text) for r in out), key=repr)
    first = [k for k in kept if k in ((5, whole), (5, near))]
    assert len(first) == 1
    rest = [k for k in kept if k not in first]
    assert rest == sorted([(None, None), (7, ""), (None, "alone one"), (9, "nine lives"), (9, "of another text")], key=repr)


def test_one_row_of_each_group_by_shuffle(spark):
    """Beyond the bound the keys are joined by a shuffle, NULL ids included."""
    docs = clashing(spark, [(i if i % 3 else None, f"text {i % 7}") for i in range(40)])
    keys = spark.createDataFrame([(None, "text 3"), (4, "text 4"), (5, "text 4")], "doc_id bigint, t string")
    keys = keys.selectExpr("doc_id", "xxhash64(t) AS mark")
    for how, n in (("left_semi", None), ("left_anti", None)):
        one, two = (text.rows_by_key(docs, keys, how, most) for most in (text.MOST_KEYS, 0))
        assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    gone = {(r.doc_id, r.text) for r in text.rows_by_key(docs, keys, "left_semi").collect()}
    assert gone == {(None, "text 3"), (4, "text 4")}


@needs_tables
def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert "copy" in rows.columns and rows.count() > 0


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_its_sql(spark, name):
    got = QUERIES[name](spark, SMALL)
    if name not in SQL:
        assert got.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
        return
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = db.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in got.select(names).collect())
