from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quayside.operators import features, gate, occupancy
from quayside.params import SAMPLE_YARD, AnalysisParams, Block, YardConfig
from quayside.sources.configs import block_dimension
from tests.conftest import ts


@pytest.fixture(scope="module")
def feats(make_visits):
    rows, start = [], ts("2025-01-01 10:00:00")
    for i in range(120):
        entry = start + timedelta(hours=7 * i)
        leave = None if i % 9 == 0 else entry + timedelta(hours=(i * 37) % 400)
        if i % 31 == 5:
            leave = entry - timedelta(days=2)  # reversed: occupies nothing
        rows.append({
            "gate_in_time": entry, "gate_out_time": leave,
            "yard_block": ["A01", "R01", "X9"][i % 3], "size_ft": [20, 40][i % 2],
            "container_type": ["dry", "reefer", None, "tank"][i % 4],
            "yard_tier": None if i % 5 == 0 else i % 5})
    return features.visit_features(make_visits(rows), AnalysisParams())


def by_hand(feats):
    rows = feats.collect()
    lo = min(r.gate_in_time for r in rows).date()
    hi = max(r.gate_in_time for r in rows).date()
    out = {}
    for n in range((hi - lo).days + 1):
        day = lo + timedelta(days=n)
        for block in {r.yard_block for r in rows}:
            inside = [r for r in rows if r.yard_block == block and r.gate_in_time.date() <= day
                      and (r.gate_out_time is None or r.gate_out_time.date() >= day)]
            tiers = [r.yard_tier for r in inside if r.yard_tier is not None]
            teu = sum(r.teu_equivalent for r in inside)
            out[day, block] = (
                len(inside), teu, sum(r.container_type == "reefer" for r in inside),
                sum(tiers) / len(tiers) if tiers else None,
                sum(r.teu_equivalent * r.is_overstay for r in inside) / teu if teu else 0.0)
    return out


@pytest.mark.parametrize("method", ["changes", "expansion"])
def test_block_days_equal_a_direct_count(spark, feats, method):
    got = occupancy.block_day_features(
        feats, block_dimension(spark, SAMPLE_YARD), method=method, rounded=False).collect()
    want = by_hand(feats)
    assert len(got) == len(want)
    for r in got:
        n, teu, reefers, tier, over = want[r.date, r.yard_block]
        assert (r.container_count, r.teu_occupied) == (n, teu)
        assert r.avg_stack_height == (pytest.approx(tier) if tier is not None else None)
        assert r.overstay_teu_ratio == pytest.approx(over)
        if r.yard_block == "R01":
            assert r.block_utilization_pct == pytest.approx(teu / 720 * 100)
            assert r.reefer_plug_util_pct == pytest.approx(reefers / 180 * 100)
        elif r.yard_block == "X9":
            assert r.teu_capacity is None and r.block_utilization_pct is None


def test_type_mix_adds_up_and_leaves_out_unknown_types(spark, feats):
    by_type = occupancy.occupancy_by_type(feats)
    known = occupancy.block_occupancy(by_type).select("yard_block", "date", "container_count")
    mix = occupancy.type_mix(by_type)
    shares = mix.groupBy("yard_block", "date").agg(
        F.sum("type_pct").alias("pct"), F.sum("container_count").alias("n"))
    for r in shares.join(known, ["yard_block", "date"]).collect():
        assert r.pct == pytest.approx(r.n / r.container_count * 100)


def test_without_tiers_and_with_capacity_from_data(spark, feats):
    b = occupancy.block_day_features(
        feats.drop("yard_tier"), block_dimension(spark, None), capacity_from_data=True)
    assert b.where("avg_stack_height is not null").isEmpty()
    peaks = b.groupBy("yard_block").agg(F.max("block_utilization_pct").alias("m")).collect()
    assert {r.m for r in peaks} == {100.0}


def test_one_scan_of_the_visits_is_expanded_to_changes_only(spark, feats):
    plan = occupancy.occupancy_by_type(feats)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_congestion_runs_and_peaks(spark):
    days = [date(2025, 1, d) for d in (1, 2, 3, 5, 6, 8, 9, 10)]
    util = [85.0, 90.0, 81.0, 95.0, 99.0, 80.0, 82.0, 99.0]
    b = spark.createDataFrame([("A", d, u) for d, u in zip(days, util)],
                              "yard_block string, date date, block_utilization_pct double")
    runs = occupancy.congestion_runs(b).collect()
    assert [(r.start_date, r.end_date, r.days, r.peak_util) for r in runs] == [
        (date(2025, 1, 1), date(2025, 1, 3), 3, 90.0)]
    peak = occupancy.peak_events(b).first()
    assert (peak.peak_date, peak.peak_util) == (date(2025, 1, 6), 99.0)


def test_gate_hours_and_peak_flag(make_visits):
    rows = [{"gate_in_time": ts(f"2025-01-01 {h:02d}:10:00")} for h in (1, 1, 1, 2, 2, 3, 4, 5)]
    rows.append({"gate_in_time": ts("2025-01-01 06:00:00"), "gate_out_time": ts("2025-01-01 01:59:00")})
    hourly = {r.hour: (r.gate_throughput_hr, r.peak_hour_flag)
              for r in gate.gate_hourly(make_visits(rows)).collect()}
    assert hourly == {1: (4, 1), 2: (2, 1), 3: (1, 0), 4: (1, 0), 5: (1, 0), 6: (1, 0)}


def test_surges_by_terminal_and_by_block(spark, make_visits):
    yard = YardConfig((Block("A01", 10), Block("B01", 90)))
    f = features.visit_features(make_visits(
        [{"vessel_name": "BIG"}] * 8 + [{"vessel_name": "SMALL", "yard_block": "A01"}] + [{"vessel_name": None}] * 9))
    assert [(r.vessel_name, r.teu_equivalent) for r in gate.vessel_surges(f, yard.total_capacity).collect()] == [("BIG", 16)]
    assert {r.vessel_name for r in gate.block_vessel_surges(f, block_dimension(spark, yard)).collect()} == {"BIG", "SMALL"}
    assert gate.vessel_surges(f.drop("vessel_name"), 1).isEmpty()
