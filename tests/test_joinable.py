"""Stored tables join without an exchange and read the months of a window only."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from quayside.sources import joinable
from tests.conftest import ts


@pytest.fixture(scope="module")
def stored(spark, make_visits, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    visits = make_visits([{"gate_in_time": None if i % 37 == 0 else ts("2025-01-01 05:00:00") + timedelta(days=i)}
                          for i in range(200)])
    labels = visits.where("visit_id < 'v0150'").select("visit_id", (F.xxhash64("visit_id") % 4).alias("cluster"))
    joinable.write_joinable(visits, "t_visits", f"{path}/visits", 4)
    joinable.write_joinable(labels, "t_labels", f"{path}/labels", 4, by_month=False)
    yield visits, labels, path
    for table in ("t_visits", "t_labels"):
        spark.sql(f"drop table {table}")


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_labels_join_without_an_exchange(spark, stored):
    visits, labels, path = stored
    joined = joinable.with_labels(joinable.read_window(spark, "t_visits"), spark.table("t_labels"))
    plan = plan_of(joined)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    key = lambda df: sorted(str(tuple(r)) for r in df.select(sorted(df.columns)).collect())
    assert key(joined) == key(visits.join(labels, "visit_id", "left"))
    assert joined.where("cluster is null").count() == 50
    assert len(list((path / "visits").glob("month=202502/*.parquet"))) <= 4  # one file for each bucket


def test_a_window_reads_its_months(spark, stored):
    part = joinable.read_window(spark, "t_visits", "2025-02-10", "2025-03-05")
    joined = joinable.with_labels(part, spark.table("t_labels"))
    plan = plan_of(joined)
    assert "Exchange" not in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    days = sorted(r.gate_in_time.date().isoformat() for r in part.collect())
    assert days[0] >= "2025-02-10" and days[-1] <= "2025-03-05" and len(days) == len(stored[0].where(
        "date(gate_in_time) between '2025-02-10' and '2025-03-05'").collect())


def test_clashing_column(stored, tmp_path):
    with pytest.raises(ValueError):
        joinable.write_joinable(stored[0].withColumn("month", F.lit(1)), "t_bad", str(tmp_path / "x"))
