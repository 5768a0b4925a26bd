"""A sample of the registered queries against their SQL, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables absent")

SAMPLE = [
    "dwell_features", "block_day_utilization", "gate_hourly_peak", "departure_curve",
    "revenue_impact", "row_checks", "clean_visits", "cluster_dispersion", "holt_winters",
]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in ("lineitem", "orders", "events"):
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    try:
        return repr(float(value))
    except (TypeError, ValueError):
        return str(value)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, db, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = db.execute(f"select {quoted} from ({entry.oracle_sql()[name]})").fetchall()
    assert got == sorted(tuple(map(plain, r)) for r in want)


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
