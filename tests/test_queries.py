"""Every query against its SQL; those without SQL run and are held against plain Python."""

import pytest

import __spark_entry__ as entry
from rostrum.functions.excerpts import excerpt_of, snippet_of
from rostrum.queries import QUERIES, SQL
from tests.oracle import DATA, connect, same


@pytest.fixture(scope="module")
def db():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, db, name):
    same(spark, db, QUERIES[name], SQL[name])


def test_registry(spark):
    assert set(SQL) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_excerpts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["p30_snippet"](spark, DATA).collect():
        assert r.snippet == snippet_of(texts[r.doc_id], "the")
    for r in QUERIES["p31_excerpt"](spark, DATA).collect():
        assert r.excerpt == excerpt_of(texts[r.doc_id], ["that"])


def test_excerpt_rules():
    body = "a" * 500 + " term " + "b" * 2000 + " term " + "c" * 500
    assert excerpt_of(body, ["none"]) == body
    cut = excerpt_of(body, ["term"], window=10, ends=5)
    assert cut.count(" […] ") == 3 and cut.startswith("aaaaa […] ")
    assert excerpt_of("terms", ["term"]) == "terms"
    assert snippet_of("x" * 700, "term").endswith("...") and snippet_of("one term here", "term") == "one term here"
