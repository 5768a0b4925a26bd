from tests.conftest import ts

from quayside.plans import catalog
from quayside.streaming import gate_counts


def test_finished_hours_are_emitted_and_late_rows_dropped(spark, tmp_path):
    batches = [
        ["2025-01-01 00:10:00", "2025-01-01 00:50:00", "2025-01-01 01:20:00"],
        ["2025-01-01 05:00:00"],
        ["2025-01-01 00:30:00", "2025-01-01 05:30:00", "2025-01-01 09:00:00"],  # first one is too late
    ]
    source, schema = tmp_path / "in", None
    for i, times in enumerate(batches):
        df = spark.createDataFrame([(ts(t),) for t in times], "ts timestamp_ntz").coalesce(1)
        df.write.mode("append").parquet(str(source))
        schema = df.schema
        stream = gate_counts.read_events(spark, str(source), schema)
        query = gate_counts.write_counts(
            gate_counts.hourly_counts(stream), str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
    got = {r.hour: r.gate_throughput_hr for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: 2, 1: 1, 5: 2}


def test_batch_counts_equal_a_plain_count(spark):
    events = spark.createDataFrame([(ts("2025-01-01 00:10:00"),), (ts("2025-01-01 00:11:00"),)], "ts timestamp_ntz")
    assert [tuple(r)[1:] for r in gate_counts.hourly_counts(events).collect()] == [(0, 2)]


def test_registered_query_counts_files_in_any_order(spark, tmp_path):
    hours = [(d, h) for d in range(1, 6) for h in range(24)]
    parts = [hours[72:], hours[:30], hours[50:72], hours[30:50]]
    for part in parts:
        rows = [(ts(f"2025-01-{d:02} {h:02}:{m:02}:00"), "in") for d, h in part for m in (5, 40)]
        spark.createDataFrame(rows, "ts timestamp_ntz, event_type string").coalesce(1) \
            .write.mode("append").parquet(str(tmp_path / "events.parquet"))
    got = catalog.events_hourly_stream(spark, str(tmp_path)).collect()
    assert sorted((r.date.day, r.hour, r.gate_throughput_hr) for r in got) == [(d, h, 2) for d, h in hours]
