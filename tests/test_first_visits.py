"""Visits cleaned on a stream, in several batches with a restart, equal those cleaned at once."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from quayside.operators import quality
from quayside.plans import catalog
from quayside.streaming import first_visits
from tests.conftest import ts

AS_OF = "2025-03-01"


def test_shuffled_files_with_a_restart(spark, make_visits, tmp_path):
    rng, rows = random.Random(8), []
    for i in range(240):
        entry = ts("2025-01-01 00:00:00") + timedelta(hours=8 * i)
        seen = {"container_id": rng.choice([f"C{i % 5}", None]), "gate_in_time": rng.choice([entry] * 9 + [None]),
                "gate_out_time": rng.choice([None, entry + timedelta(hours=9), entry - timedelta(hours=9)])}
        for copy in range(rng.choice([1, 1, 2, 3])):  # copies come up to five days apart
            rows.append((entry + timedelta(hours=rng.randrange(120)), {**seen, "weight_tons": float(copy)}))
    rows = [row for _, row in sorted(rows, key=lambda r: r[0])]
    ids = rng.sample(range(10_000), len(rows))  # the first in source order need not arrive first
    rows = [{**row, "visit_id": f"v{n:05d}"} for row, n in zip(rows, ids)]
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    step = len(rows) // 6 + 1
    for part in range(0, len(rows), step):
        make_visits(rows[part:part + step]).coalesce(1).write.mode("append").parquet(source)
        if part // step in (2, 5):  # the query ends and is started again on the same checkpoint
            stream = spark.readStream.schema(make_visits([]).schema).option("maxFilesPerTrigger", 1).parquet(source)
            first_visits.write_first_visits(stream, out, state, "6 days").awaitTermination()
    whole, written = spark.read.parquet(source), spark.read.parquet(out)
    assert 100 < written.count() < quality.keep_first(whole).count()
    key = lambda df: sorted(str(tuple(r)) for r in df.select(sorted(df.columns)).collect())
    assert key(first_visits.with_held_visits(written, whole)) == key(quality.keep_first(whole))
    assert key(first_visits.clean_visits(written, whole, AS_OF)) == key(quality.clean_visits(whole, AS_OF))


def test_a_late_visit_is_found_again(spark, make_visits, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    for day in ("2025-02-01", "2025-02-20", "2025-01-01"):
        make_visits([{"visit_id": day, "gate_in_time": ts(f"{day} 00:00:00")}]).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(make_visits([]).schema).parquet(source)
        first_visits.write_first_visits(stream, out, state, "1 day").awaitTermination()
    whole, written = spark.read.parquet(source), spark.read.parquet(out)
    assert [r.visit_id for r in written.collect()] == ["2025-02-01"]
    assert first_visits.with_held_visits(written, whole).agg(F.count(F.lit(1))).first()[0] == 3


@pytest.fixture
def streams(monkeypatch):
    """Small files and batches; the streams that have run are kept."""
    ran, write = [], first_visits.write_first_visits
    monkeypatch.setattr(first_visits, "ROWS_PER_FILE", 60, raising=False)
    monkeypatch.setattr(first_visits, "FILES_PER_BATCH", 2, raising=False)
    monkeypatch.setattr(first_visits, "write_first_visits", lambda *a: (ran.append(write(*a)), ran[-1])[1])
    return ran


def test_the_state_holds_a_batch_and_not_all_visits(spark, tmp_path, streams):
    lines = spark.range(900).selectExpr(  # a day's entries lie far apart in the table
        "id div 2 as l_orderkey", "id * 7 % 90 + 1 as l_partkey", "id * 5 % 30 as l_suppkey",
        "cast(id % 2 + 1 as int) as l_linenumber", "double(id % 40 + 1) as l_quantity", "double(id % 97) as l_extendedprice",
        "'N' as l_returnflag", "timestamp_ntz '2000-01-01' + make_dt_interval(cast(id * 389 % 900 as int)) as l_shipdate")
    lines.union(lines.where("l_orderkey < 5")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(450).selectExpr("id as o_orderkey", "'2-HIGH' as o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    rows = lambda df: sorted(str(tuple(r)) for r in df.collect())
    found = catalog.clean_visits_stream(spark, str(tmp_path))
    assert rows(found) == rows(catalog.clean_visits(spark, str(tmp_path))) and found.count() > 400
    states = [p.stateOperators[0] for p in streams[0].recentProgress]
    assert len(states) > 5 and first_visits.came_in_time(streams[0])
    assert max(s.numRowsTotal for s in states) < 250  # 120 rows of a batch, and those of seven days before it


def test_files_follow_the_entry_and_copies_share_one(spark, make_visits, tmp_path, streams):
    entry = ts("2025-01-01 00:00:00")
    visits = make_visits([{"container_id": f"C{i % 10}", "gate_in_time": None if i % 9 == 0 else entry + timedelta(days=i * 37 % 200)}
                          for i in range(400)])
    path = str(tmp_path / "in")
    first_visits.write_in_order(visits, path)
    files = (spark.read.parquet(path).select("*", "_metadata.file_path", "_metadata.file_modification_time")
             .groupBy("file_modification_time", "file_path").agg(F.min("gate_in_time"), F.max("gate_in_time"), F.count("*"))
             .orderBy("file_modification_time").collect())
    assert len(files) >= 5 and sum(f[4] for f in files) == 400
    assert len({f[0] for f in files}) == len(files)
    known = [(f[2], f[3]) for f in files if f[2]]
    assert all(a[1] <= b[0] for a, b in zip(known, known[1:]))
    shared = spark.read.parquet(path).groupBy("container_id", "gate_in_time").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert shared.where("n > 1").isEmpty()


def test_late_rows_and_earlier_runs_are_not_taken_as_in_time(spark, make_visits, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    add = lambda *days: make_visits([
        {"visit_id": d, "container_id": d, "gate_in_time": ts(f"{d} 00:00:00")} for d in days]).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(make_visits([]).schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = first_visits.write_first_visits(stream, out, state, "1 day")
        query.awaitTermination()
        return first_visits.came_in_time(query)

    for days in (("2025-02-01",), ("2025-02-20",)):
        add(*days)
    assert run()
    whole, written = spark.read.parquet(source), spark.read.parquet(out)
    held = lambda **k: sorted(r.visit_id for r in first_visits.with_held_visits(written, whole, **k).collect())
    assert held(in_time=True) == held() == ["2025-02-01", "2025-02-20"]
    add("2025-01-01")
    assert not run()  # late, and the first batches were those of an earlier run
    whole, written = spark.read.parquet(source), spark.read.parquet(out)
    assert len(held()) == 3
    source, out, state = (str(tmp_path / f"{name}-late") for name in ("in", "out", "state"))
    for days in (("2025-02-20",), ("2025-03-20",), ("2025-01-01",)):
        add(*days)
    assert not run()
