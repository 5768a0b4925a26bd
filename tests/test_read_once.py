"""Queries on visits read the tables once and go on from what they have written."""

import pytest

from quayside.operators import quality
from quayside.plans import catalog
from quayside.sources import joinable


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Order lines, some of them twice or without a quantity, and their orders."""
    path = str(tmp_path_factory.mktemp("tables"))
    lines = spark.range(600).selectExpr(
        "id div 4 as l_orderkey", "id * 7 % 90 + 1 as l_partkey", "id * 5 % 30 as l_suppkey",
        "cast(id % 4 + 1 as int) as l_linenumber", "if(id % 50 = 0, null, double(id % 40 + 1)) as l_quantity",
        "double(id * 13 % 997) as l_extendedprice", "element_at(array('N', 'A', 'R'), cast(id % 3 + 1 as int)) as l_returnflag",
        "timestamp_ntz '1998-01-01' + make_dt_interval(cast(id % 300 as int)) as l_shipdate")
    lines.union(lines.where("l_orderkey < 5")).write.parquet(f"{path}/lineitem.parquet")
    spark.range(150).selectExpr("id as o_orderkey", "if(id % 2 = 0, '2-HIGH', '5-LOW') as o_orderpriority").write.parquet(
        f"{path}/orders.parquet")
    return path


def only_stages(df):
    files = df.inputFiles()
    return bool(files) and all("/stage-" in f for f in files)


@pytest.mark.parametrize("query", ["segment_revenue", "silhouette_squared", "executive_kpis", "quality_status"])
def test_the_result_reads_what_was_written(spark, tables, query):
    found = getattr(catalog, query)(spark, tables)
    assert only_stages(found) and found.count() > 0


def test_checks_of_visits_with_a_column_without_a_type(make_visits):
    visits = make_visits([{"container_id": "C1"}, {"container_id": "C1"}, {"container_id": "C2"}])
    plain = quality.quality_checks(visits, "2025-06-01")
    odd = quality.quality_checks(visits.selectExpr("*", "null as remark", "array(1) as parts"), "2025-06-01")
    assert only_stages(odd)
    rows = lambda df: sorted(map(tuple, df.where("column != 'remark'").collect()))
    assert rows(odd) == rows(plain)
    assert {r.metric: r.value for r in odd.where("column = 'remark'").collect()} == {"rows": 3.0, "pct": 100.0}


def test_revenue_counts_each_pair_of_a_repeated_visit(spark, tables):
    f = catalog.feats(spark, tables)
    labels = catalog.labelled(spark, tables).select("visit_id", "cluster")
    plain = f.select("visit_id", "storage_cost_usd").join(labels, "visit_id").groupBy("cluster").count()
    assert sorted((r[0], r[1]) for r in plain.collect()) == sorted(
        (r.cluster, r.visits) for r in catalog.segment_revenue(spark, tables).collect())


def test_buckets_follow_the_rows(spark, tables, monkeypatch):
    assert [joinable.buckets_for(n, 8) for n in (0, 8_000_000, 8_000_001)] == [8, 8, 9]
    monkeypatch.setattr(joinable, "ROWS_PER_BUCKET", 50)
    made, write = [], joinable.write_joinable
    monkeypatch.setattr(joinable, "write_joinable", lambda *a, **k: (made.append(a[3]), write(*a, **k)))
    assert catalog.window_segments_stored(spark, tables).count() > 0
    assert made == [13, 13]  # 620 visits; the same for visits and labels
