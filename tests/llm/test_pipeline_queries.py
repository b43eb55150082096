import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from pulsewatch.llm import decontam, queries, toxicity
from pulsewatch.llm.common import saved, table
from tests.llm.cases import documents
from tests.llm.test_near_duplicates import brute_force
from tests.llm.test_packing_html_secrets import _found

SMALL, ORACLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_every_query_is_registered():
    names = set(E.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(queries.SQL[name])
    columns = [d[0] for d in cur.description]
    df = E.queries()[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted(cur.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_covers_its_table(spark, name):
    df = E.queries()[name](spark, SMALL)
    ids = {r[0] for r in df.select(df.columns[0]).collect()}
    source, key = next((t, k) for t, k in (("pages", "page_id"), ("embeddings", "vec_id"), ("documents", "doc_id"))
                       if k in df.columns)
    every = {r[0] for r in table(spark, SMALL, source).select(key).collect()}
    assert ids == every or name.startswith("op8") and ids <= every


def test_stages_equal_brute_force(spark):
    docs = table(spark, ORACLE, "documents")
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontaminate", "secrets", "pack"]

    def run(name, df):
        return saved(stages[name](spark, df, ORACLE), f"test-{name}")

    one = run("toxicity", docs)
    model = toxicity.fit(docs, table(spark, ORACLE, "labels"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    kept = {i for i, s in scores.items() if s < 0.3}
    assert {r["doc_id"]: r.asDict() for r in one.collect()} == {i: rows[i] for i in kept}

    two = run("near_duplicates", one)
    kept = {i for i, _, _, first in brute_force([(i, rows[i]["text"]) for i in kept], 5) if first}
    assert {r["doc_id"]: r.asDict() for r in two.collect()} == {i: rows[i] for i in kept}

    three = run("decontaminate", two)
    items = [r["text"] for r in table(spark, ORACLE, "benchmark").collect()]
    after = {r["doc_id"] for r in three.collect()}
    assert not [i for i in after if any(t in (rows[i]["text"] or "") for t in items)]
    found = {r["doc_id"] for r in decontam.matches(two, table(spark, ORACLE, "benchmark")).collect()}
    assert after == kept - found

    four = run("secrets", three)
    masked = {r["doc_id"]: r.asDict() for r in four.collect()}
    assert set(masked) == after
    for i, r in masked.items():
        before = rows[i]
        if not _found(before["text"]):
            assert r == before
        else:
            assert "[secret]" in r["text"] and not _found(r["text"]) and r["n_chars"] == len(r["text"])

    five = run("pack", four)
    assert {r["doc_id"] for r in five.select("doc_id").distinct().collect()} == after


def test_stages_take_awkward_rows(spark):
    for docs in (documents(spark), documents(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = saved(stage(spark, docs, SMALL), f"test-{name}")
            if name != "pack":
                assert out.columns == docs.columns
                docs = out
        assert out.count() >= docs.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 100
