from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from quayside.functions import bands
from quayside.operators import dwell, features, impact
from quayside.params import SAMPLE_TARIFF, AnalysisParams, TariffConfig, Tier
from tests.conftest import ts

START = ts("2025-01-01 00:00:00")


def stay(hours, **more):
    return {"gate_in_time": START, "gate_out_time": START + timedelta(hours=hours), **more}


def expected_cost(hours, movement, kind, teu):
    """Plain arithmetic: walk the days beyond the free ones through the tiers."""
    days = hours / 24
    left = max(0.0, days - {"import": 3, "export": 5, "transhipment": 7}.get(movement, 3))
    total = 0.0
    for width, rate in ((4, 15), (6, 30), (11, 55), (9978, 85)):
        used = min(left, width)
        total += used * rate * teu
        left -= used
    return total + {"reefer": 25, "hazardous": 18}.get(kind, 0) * days * teu


def test_dwell_bands_at_their_edges(make_visits):
    hours = [0, 23.99, 24, 24.01, 72, 72.01, 168, 168.01]
    rows = features.visit_features(make_visits([stay(h) for h in hours])).orderBy("visit_id").collect()
    assert [r.dwell_category for r in rows] == [
        "short", "short", "unknown", "normal", "normal", "long", "long", "overstay"]
    assert [r.is_overstay for r in rows] == [0] * 7 + [1]


def test_open_visit_has_no_dwell_cost_or_overstay(make_visits):
    row = features.visit_features(make_visits([{}]), tariff=SAMPLE_TARIFF).first()
    assert row.dwell_hours is None and row.storage_cost_usd is None
    assert row.is_overstay == 0 and row.dwell_category == "unknown"


def test_cost_at_tier_edges_and_for_unknown_movements(make_visits):
    cases = [(h, m, k, s) for h in (1, 72, 73, 168, 169, 312, 576, 577, 2400)
             for m in ("import", "export", "transhipment", "other", None)
             for k, s in (("dry", 20), ("reefer", 40), ("hazardous", 45))]
    visits = make_visits([stay(h, movement_type=m, container_type=k, size_ft=s) for h, m, k, s in cases])
    rows = features.visit_features(visits, tariff=SAMPLE_TARIFF).orderBy("visit_id").collect()
    for (h, m, k, s), row in zip(cases, rows):
        want = expected_cost(h, m, k, 1 if s == 20 else 2)
        assert row.storage_cost_usd == pytest.approx(want, abs=0.00501), (h, m, k, s)


def test_gap_between_tiers_is_ignored_and_cost_rounds_half_even(make_visits):
    tariff = TariffConfig(free_days={}, storage_tiers=(Tier(20, None, 100.0), Tier(1, 2, 0.6)))
    visits = make_visits([stay(24 * 6, size_ft=20), stay(24 * 3 + 5, size_ft=20)])
    rows = features.visit_features(visits, tariff=tariff).orderBy("visit_id").collect()
    assert rows[0].storage_cost_usd == 2 * 0.6 + 100.0
    assert rows[1].storage_cost_usd == 0.12  # 0.125 goes to the even cent


def test_no_tariff_and_no_optional_columns(make_visits):
    slim = features.minimal_columns(make_visits([stay(30)]))
    row = features.visit_features(slim).first()
    assert row.storage_cost_usd is None and row.flow_path == "unknown"
    assert row.is_high_cube is False and row.iso_container_group == "dry"


def test_iso_codes(make_visits):
    codes = ["45R1", "22G1", "L5T1", "42P1", "22B1", "22X1", "22", None]
    rows = features.visit_features(
        make_visits([{"iso_type_code": c} for c in codes])).orderBy("visit_id").collect()
    assert [r.is_high_cube for r in rows] == [True, False, True, False, False, False, False, False]
    assert [r.iso_container_group for r in rows] == [
        "reefer", "dry", "tank", "special", "dry", "dry", "dry", "dry"]


def test_teu_sizes(make_visits):
    visits = make_visits([{"size_ft": s} for s in (20, 40, 45, 53, None)])
    teu = lambda p: [r.teu_equivalent for r in features.visit_features(visits, p).orderBy("visit_id").collect()]
    assert teu(AnalysisParams()) == [1, 2, 2, 2, 2]
    assert teu(AnalysisParams(teu_for_45ft=2.25)) == [1.0, 2.0, 2.25, 2.0, 2.0]


def test_window_filters_reach_the_scan(spark, make_visits, tmp_path):
    make_visits([stay(5), stay(5, yard_block="B01")]).write.parquet(str(tmp_path / "v"))
    params = AnalysisParams(analysis_date_start="2025-01-01", target_blocks=("A01",))
    chosen = features.analysis_window(spark.read.parquet(str(tmp_path / "v")), params)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(yard_block,A01)" in plan or "In(yard_block" in plan
    assert chosen.count() == 1


def test_revenue_does_not_depend_on_the_threshold(make_visits):
    visits = make_visits([stay(h) for h in (24, 130, 150, 200, 300)])
    rows = impact.threshold_sensitivity(
        features.visit_features(visits, tariff=SAMPLE_TARIFF), (5, 10)).orderBy("threshold_days").collect()
    assert [r.overstay_count for r in rows] == [4, 1]
    assert rows[0].total_revenue == rows[1].total_revenue
    assert rows[1].count_delta == -3


def test_priority_list_falls_back_to_long_dwell(make_visits):
    visits = make_visits([stay(h) for h in (10, 100, 160)])
    rows = impact.priority_list(features.visit_features(visits, tariff=SAMPLE_TARIFF)).collect()
    assert {r.visit_id for r in rows} == {"v0000", "v0001", "v0002"}
    visits = make_visits([stay(h) for h in (10, 200, 300)])
    rows = impact.priority_list(features.visit_features(visits, tariff=SAMPLE_TARIFF)).collect()
    assert [r.visit_id for r in rows] == ["v0002", "v0001"]


def test_histogram_of_a_constant_has_all_bins(make_visits):
    rows = dwell.histogram(
        features.visit_features(make_visits([stay(48)] * 3)), "dwell_days", 4).orderBy("bin").collect()
    assert [r.visits for r in rows] == [0, 0, 3, 0]
    assert rows[0].bin_start == 1.5 and rows[-1].bin_end == 2.5


def test_rankings_need_two_groups(make_visits):
    few = features.visit_features(make_visits([stay(48)] * 51))
    assert [r.position for r in dwell.flow_path_ranking(few).collect()] == [None]
    both = features.visit_features(make_visits(
        [stay(48)] * 51 + [stay(96, gate_out_mode="rail")] * 51 + [stay(900, gate_out_mode="barge")] * 50))
    assert {r.flow_path: r.position for r in dwell.flow_path_ranking(both).collect()} == {
        "vessel→rail": "slowest", "vessel→truck": "fastest"}


def test_bands(spark):
    row = spark.range(1).select(
        bands.archetype(F.lit(1.0)).alias("a"), bands.archetype(F.lit(31.0)).alias("b"),
        bands.silhouette_quality(F.lit(0.5)).alias("c"), bands.mape_quality(F.lit(10.0)).alias("d"),
        bands.utilization_band(F.lit(85.0)).alias("e")).first()
    assert tuple(row) == ("Fast Movers", "Chronic Blockers", "Weak but usable", "Good", "Congested")
