"""Registered queries: against DuckDB on the smallest tables, and their plans."""

import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tallyline import catalog
from tools.check import TABLES, as_rows

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = as_rows(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no product of two tables, however it is spelled
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    result = duck.execute(ORACLES[name])
    assert got == as_rows([d[0] for d in result.description], result.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["state", "county_name", "color2_c", "release"] and df.count() == 25


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = QUERIES["typed_filter_select"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(l_shipdate" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"}


def test_entry_stands_without_the_training_data_subpackage():
    code = (
        "import sys; sys.modules['tallyline.llm'] = sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; from tallyline import catalog\n"
        "assert set(e.queries()) == set(catalog.QUERIES) and e.oracle_sql() == catalog.ORACLES"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)
