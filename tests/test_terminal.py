from datetime import timedelta

import pytest

from quayside.operators import features
from quayside.params import SAMPLE_TARIFF, SAMPLE_YARD, AnalysisParams, Block, TariffConfig, YardConfig
from quayside.plans import terminal
from quayside.sources import configs
from tests.conftest import ts

START = ts("2025-01-01 06:00:00")


@pytest.fixture(scope="module")
def stays(make_visits):
    return make_visits([{
        "container_id": f"C{i % 200}", "gate_in_time": START + timedelta(hours=4 * i),
        "gate_out_time": START + timedelta(hours=4 * i + 10 + (i * 29) % 260),
        "yard_block": ["R01", "R02"][i % 2], "container_type": "reefer",
        "movement_type": ["import", "export"][i % 2]} for i in range(300)])


def test_required_columns_without_any_configuration(spark, stays, tmp_path):
    tables = terminal.feature_tables(spark, features.minimal_columns(stays))
    assert tables.surges is None
    reports = terminal.reports(tables)
    assert "shipping_line_ranking" not in reports and "revenue_impact" not in reports
    kpis = reports["executive_kpis"].first()
    assert kpis.total_containers == 300 and kpis.total_revenue == 0.0
    assert kpis.peak_utilization_pct is None
    assert not reports["priority_list"].isEmpty()
    terminal.write_features(tables, str(tmp_path))
    days = spark.read.parquet(str(tmp_path / "block_daily_features"))
    assert days.count() == tables.block_day.count() == 2 * 51  # the last entry is on day 51
    assert not (tmp_path / "vessel_surges").exists()


def test_reefer_terminal_with_plugs_and_forecast(spark, stays):
    yard = YardConfig((Block("R01", 720, 200, True), Block("R02", 500, 150, True)))
    params = AnalysisParams.from_json('{"forecast_horizon_days": 7, "container_types_focus": ["reefer"]}')
    tables = terminal.feature_tables(spark, stays, params, yard, SAMPLE_TARIFF)
    row = tables.block_day.where("yard_block = 'R02' and container_count > 0").first()
    assert row.block_utilization_pct == pytest.approx(row.teu_occupied / 500 * 100, abs=0.05)
    assert row.reefer_plug_util_pct == pytest.approx(row.container_count / 150 * 100, abs=0.05)
    assert row.type_mix == {"reefer": 100.0}
    first, second, best = terminal.forecasts(tables, params, optimise=False)
    assert best.first().model in {"HoltWinters_Additive", "SeasonalMovingAverage"}
    assert len(first.first().forecast) == 11 + 7  # 51 days: 40 to train, 11 to test


def test_configurations_round_trip(spark, tmp_path):
    for i, yard in enumerate([SAMPLE_YARD, YardConfig(), YardConfig((Block("Ä 1"),), "Hafen \"Süd\"")]):
        configs.write_yard(spark, yard, f"{tmp_path}/yard{i}")
        configs.write_yard(spark, yard, f"{tmp_path}/yard{i}")
        assert configs.read_yard(spark, f"{tmp_path}/yard{i}") == yard
    for i, tariff in enumerate([SAMPLE_TARIFF, TariffConfig()]):
        configs.write_tariff(spark, tariff, f"{tmp_path}/tariff{i}")
        assert configs.read_tariff(spark, f"{tmp_path}/tariff{i}") == tariff
