import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry
from monthlake.catalogue import load
from oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
# Every query of the library that has a SQL twin; those for training text are compared in their own tests.
NAMES = sorted(load().SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cur.fetchall())
    assert got or name in EMPTY


# Checks that find nothing on good data.
EMPTY = {n for n in NAMES if n[0] in "aj"}


def test_registry():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert set(load().QUERIES) - set(sql) == {
        "a02_manifest", "a03_schema_survey", "a03y_rows_by_file", "k02_quantiles",
        "k09q_speed_quantiles",
    }


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "pickup_date" and df.count() > 1000
