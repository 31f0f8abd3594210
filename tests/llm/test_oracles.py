"""Queries with a SQL twin: on a given table, and on awkward rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from monthlake.llm import url_filter
from monthlake.llm.queries import QUERIES, SQL

from .conftest import SMALL

ON_DOCS = [n for n in SQL if n not in ("op10_url_filter", "op13_vector_codes")]


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=repr)


def agree(spark, name, path):
    con = duckdb.connect()
    table = {"op10_url_filter": "pages", "op13_vector_codes": "embeddings"}.get(name, "documents")
    con.execute(f"create view {table} as select * from '{path}/{table}.parquet{'' if path == SMALL else '/*.parquet'}'")
    got = QUERIES[name](spark, path)
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(got.columns)
    want = rows(columns, cur.fetchall())
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == want
    return want


@pytest.mark.parametrize("name", sorted(SQL))
def test_given_table(batches, name):
    assert agree(batches, name, SMALL)


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_awkward_rows(batches, awkward, folder, name):
    # Rows that share an id are told apart by nothing in SQL that joins on the id.
    once = awkward.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    assert agree(batches, name, folder(documents=once))


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_empty_table(batches, empty, folder, name):
    assert QUERIES[name](batches, folder(documents=empty)).count() == 0


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_every_row_comes_back(batches, awkward, folder, name):
    extra = awkward.withColumn("size", F.lit("x")).withColumn("score", F.lit("y")).withColumn("_row", F.lit(1))
    assert QUERIES[name](batches, folder(documents=extra)).count() == awkward.count()


def test_urls(batches, folder):
    urls = [None, "", "no scheme", "http://", "https://example.org", "https://EXAMPLE.org/es/1?x=/de/", "http://a.b.com/de/x#f",
            "ftp://com/fr/", "http://xcom/de/1", "http://m.casino-win.example.net/", "http://x.net/alphabet", "http://free.net/bets",
            "http://x.net/free-free", "http://example.org/en/12", "http://n.net/" + "a" * 50_000 + "-porn"]
    pages = batches.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    found = agree(batches, "op10_url_filter", folder(pages=pages))
    assert len(found) == len(urls)
    by_id = {r.page_id: r for r in QUERIES["op10_url_filter"](batches, folder(pages=pages)).collect()}
    assert (by_id[5].host, by_id[5].path, by_id[5].rule, by_id[5].verdict) == ("example.org", "/es/1", "example.org/es/", "block")
    assert by_id[4].rule is None and by_id[8].rule is None and by_id[6].verdict == "block"
    assert by_id[9].verdict == "block" and by_id[10].verdict == "allow"
    assert by_id[11].verdict == "block" and by_id[12].verdict == "allow" and by_id[14].verdict == "block"


def test_pages_cases(batches, folder):
    """Repeated rows, nulls, columns that clash, and no rows."""
    rows_ = [(1, "http://x.net/casino"), (1, "http://x.net/casino"), (None, "http://a.org/x"), (2, None)]
    pages = batches.createDataFrame(rows_, "page_id long, url string")
    clash = pages.withColumns({c: F.lit("mine") for c in ("host", "path", "rule", "verdict", "_hits", "_rule", "html")})
    found = QUERIES["op10_url_filter"](batches, folder(pages=clash)).collect()
    assert sorted((r.host, r.verdict) for r in found) == [("", "allow"), ("a.org", "allow"), ("x.net", "block"), ("x.net", "block")]
    judged = url_filter.judge(clash)
    assert judged.columns.count("host") == 1 and {r.html for r in judged.collect()} == {"mine"}
    assert QUERIES["op10_url_filter"](batches, folder(pages=pages.filter("false"))).count() == 0


def test_vectors_with_bad_rows(batches, folder):
    r = np.random.default_rng(8)
    good = [(i, [float(np.float32(v)) for v in r.normal(0, 0.4, 16)], None if i % 5 == 0 else i % 3) for i in range(150)]
    bad = [(900, None, 1), (901, [float("nan")] * 16, 1), (902, [None] * 16, 2)]
    copies = [(1000 + i, good[4][1], 1) for i in range(20)]
    frame = batches.createDataFrame(good + bad + copies, "vec_id long, embedding array<float>, label int")
    assert len(agree(batches, "op13_vector_codes", folder(embeddings=frame))) == 170
