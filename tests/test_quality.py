import json

import pytest

from quayside.operators import quality
from quayside.plans.validation import validate
from quayside.sources import sinks
from quayside.sources.configs import read_tariff, read_yard, scan_yard
from quayside.sources.visits import load_visits
from tests.conftest import ts

HEADER = "container_id,size_ft,container_type,weight_tons,gate_in_time,gate_out_time,movement_type,yard_block"


@pytest.fixture()
def csv(spark, tmp_path):
    def write(lines, header=HEADER):
        path = tmp_path / "visits.csv"
        path.write_text("\n".join([header, *lines]) + "\n")
        return load_visits(spark, str(path))
    return write


def checks(df):
    return {(r.check, r.column, r.metric): (r.level, r.value) for r in df.collect()}


def test_unreadable_values_become_null_and_are_told_apart(csv):
    v = csv(["C1,20.0,dry,x,2025-01-01 08:00:00,2025-01-03 08:00:00,import,A01",
             "C2,40,nan,5.5,not a date,,import,A01",
             "C3,30,box,-2,2025-02-01T00:00:00,soon,moved,"])
    rows = v.orderBy("container_id").collect()
    assert [r.size_ft for r in rows] == [20, 40, 30]
    assert [r.weight_tons for r in rows] == [None, 5.5, -2.0]
    got = checks(quality.row_checks(v, "2025-12-31"))
    assert got["unreadable", "gate_in_time", "rows"] == ("error", 1.0)
    assert got["unreadable", "gate_out_time", "rows"] == ("warning", 1.0)
    assert got["nulls", "gate_out_time", "rows"] == ("ok", 1.0)  # counted on the raw text
    assert got["domain", "size_ft", "rows"] == ("warning", 1.0)
    assert got["domain", "container_type", "rows"] == ("warning", 1.0)
    assert got["nulls", "container_type", "pct"] == ("error", 33.33)
    assert got["non_positive", "weight_tons", "rows"] == ("warning", 1.0)


def test_first_copy_in_the_file_is_kept(csv):
    v = csv(["C1,20,dry,1,2025-01-01 00:00:00,,import,A01",
             "C1,20,dry,2,2025-01-01 00:00:00,,import,A01",
             "C1,20,dry,1,2025-01-01 00:00:00,,import,A01",
             "C2,20,dry,9,2025-01-01 00:00:00,,import,A01"])
    counts = quality.duplicate_counts(v).first()
    assert (counts.exact_duplicates, counts.key_duplicates) == (1, 2)
    assert sorted((r.container_id, r.weight_tons) for r in quality.clean_visits(v).collect()) == [
        ("C1", 1.0), ("C2", 9.0)]


def test_duplicates_are_judged_before_date_rules(make_visits):
    v = make_visits([
        {"gate_out_time": ts("2024-12-01 00:00:00")},  # reversed, first of its key
        {"gate_out_time": ts("2025-01-05 00:00:00")}, {"container_id": "C2"}])
    assert [r.container_id for r in quality.clean_visits(v, "2025-12-31").collect()] == ["C2"]


def test_keep_first_limits_rows_before_the_shuffle(make_visits):
    plan = quality.keep_first(make_visits([{}]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_future_and_equal_times(make_visits):
    same = ts("2025-01-02 00:00:00")
    v = make_visits([{"container_id": "A", "gate_in_time": same, "gate_out_time": same},
                     {"container_id": "B", "gate_out_time": ts("2025-03-01 00:00:00")}])
    assert [r.container_id for r in quality.clean_visits(v, "2025-02-01").collect()] == ["A"]


def test_missing_column_fails_without_a_job(spark, csv):
    v = csv(["C1,20"], header="container_id,size_ft")
    done = validate(spark, v)
    assert done.clean is None and done.status == "FAIL"
    assert {e["column"] for e in done.report()["errors"]} >= {"yard_block", "gate_in_time"}


def test_small_clean_input_fails_on_minimum_rules_and_is_not_written(spark, make_visits, tmp_path):
    done = validate(spark, make_visits([{}]), "2025-12-31")
    report = done.report()
    assert report["status"] == "FAIL"
    assert {(e["column"], e["metric"]) for e in report["errors"]} == {
        ("container_id", "unique_containers"), ("gate_in_time", "span_days")}
    assert not sinks.write_clean_visits(done, str(tmp_path / "clean"))


def test_report_and_sinks_of_a_good_input(spark, make_visits, tmp_path):
    rows = [{"container_id": f"C{i}", "gate_in_time": ts(f"2025-{1 + i // 28 % 4:02d}-{1 + i % 28:02d} 00:00:00"),
             "yard_block": "AB"[i % 2]} for i in range(120)]
    done = validate(spark, make_visits(rows), "2025-12-31", yard_given=True)
    report = done.report()
    assert report["status"] == "WARN"  # everything still in the yard
    assert report["total_rows"] == report["valid_rows"] == 120
    assert report["date_range"]["span_days"] > 30 and report["yard_config_provided"]
    assert report["profiling"]["size_ft"]["mean"] == 40.0
    assert report["profiling"]["yard_block"]["top_values"] == {"A": 60, "B": 60}
    assert sinks.write_clean_visits(done, str(tmp_path / "clean"))
    assert spark.read.parquet(str(tmp_path / "clean")).count() == 120
    sinks.write_quality_report(done, str(tmp_path / "report"))
    text = spark.read.text(str(tmp_path / "report")).first().value
    assert json.loads(text)["unique_containers"] == 120


def test_invalid_values_in_order_of_appearance(make_visits):
    rows = [{"movement_type": m} for m in ("zz", "import", "aa", "zz", "mm", "bb", "cc", "dd")]
    got = quality.invalid_values(make_visits(rows)).orderBy("rank").collect()
    assert [(r.value, r.rows) for r in got] == [("zz", 2), ("aa", 1), ("mm", 1), ("bb", 1), ("cc", 1)]


def test_config_files(spark, tmp_path):
    (tmp_path / "yard.json").write_text(json.dumps({"terminal_name": "T", "blocks": [
        {"block_id": "R01", "teu_capacity": 720, "has_reefer_plugs": True, "reefer_plug_count": 200},
        {"block_id": "A01", "teu_capacity": 100, "has_reefer_plugs": False, "reefer_plug_count": 7}]}, indent=1))
    (tmp_path / "tariff.json").write_text(json.dumps({
        "free_days": {"import": 3}, "storage_tiers": [{"from_day": 1, "to_day": None, "rate_per_teu_per_day": 9}]}))
    yard = read_yard(spark, str(tmp_path / "yard.json"))
    assert yard.total_capacity == 820
    plugs = {r.yard_block: r.reefer_plug_count for r in scan_yard(spark, str(tmp_path / "yard.json")).collect()}
    assert plugs == {"R01": 200, "A01": None}
    tariff = read_tariff(spark, str(tmp_path / "tariff.json"))
    assert tariff.storage_tiers[0].width == 9999 and tariff.avg_throughput_revenue_per_teu == 85.0
