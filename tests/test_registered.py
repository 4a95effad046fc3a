"""Registered queries against their oracle SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entries
from contract.oracle import ORACLE
from contract.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda row: [(x is None, type(x).__name__, x if x is not None else 0) for x in row])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = tables.execute(ORACLE[name])
    described = {c[0]: TYPES[str(c[1])] for c in result.description}
    order = [c[0] for c in result.description]
    assert described == dict(df.dtypes)
    want = [tuple(row[order.index(c)] for c in columns) for row in result.fetchall()]
    got = [tuple(row) for row in df.select(*columns).collect()]
    assert in_order(got) == in_order(want)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_plans_read_only_the_dimensions_asked_for(spark):
    for name in ("a14_date_bounds", "a9_rollup_time", "q16_heatmap"):
        text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
        assert not any(column in text for column in ("nama_lengkap", "c_name", "nama_merchant", "p_name", "segmen_nasabah")), name
    text = QUERIES["a9_rollup_time"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in text[text.index("Expand"):]


def test_generator_grows_with_the_orders(spark):
    rows = QUERIES["s16_dirty_batch"](spark, SF_DIR)
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
    assert orders < rows.count() < orders * 1.05
    assert rows.select("trx_id").distinct().count() == orders


def test_entry(spark):
    assert entries.entry(spark).count() > 0
