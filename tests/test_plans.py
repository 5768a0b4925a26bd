"""Plans that scan once, quantiles of crowded values, fallbacks and the segmentation of a terminal."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.functions.exact import quantiles
from quayside.operators import forecast, occupancy
from quayside.params import SAMPLE_TARIFF, SAMPLE_YARD, AnalysisParams
from quayside.plans import catalog, terminal
from quayside.sources.configs import read_tariff, read_yard
from quayside.sources.order_visits import visits

DATA = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_yard_occupancy_reads_the_visits_once(spark):
    changes = occupancy.visit_changes(catalog.feats(spark, DATA))
    assert len(re.findall(r"Scan parquet.*l_orderkey", plan_of(changes))) == 1
    by_type = occupancy.occupancy_by_type(catalog.feats(spark, DATA))
    assert "l_orderkey" not in plan_of(by_type)  # all else comes from the stored changes


def test_no_task_holds_the_days_of_all_groups(spark):
    """Only the one-row ends of the calendar come together in a single partition."""
    plan = plan_of(occupancy.occupancy_by_type(catalog.feats(spark, DATA)))
    single = re.findall(r"Exchange SinglePartition.*\n.*", plan)
    assert single and all("partial_min(date" in s or "partial_max(date" in s for s in single)
    windows = re.findall(r"Window \[.*", plan)
    assert windows and all("yard_block" in w for w in windows)


def test_visits_are_not_shuffled_by_number(spark):
    assert "REPARTITION_BY_NUM" not in plan_of(visits(spark, DATA))


def test_quantiles_of_crowded_values(spark):
    values = np.random.default_rng(4).uniform(0, 6e-4, 100_000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    got = {r.prob: r.quantile for r in quantiles(df, "v", [0.0, 0.1, 0.5, 0.99, 1.0]).collect()}
    assert [got[p] for p in sorted(got)] == pytest.approx(list(np.quantile(values, sorted(got))), abs=1e-15)


def test_short_series_fall_back(spark):
    days = [("long", i, 100.0 + i % 7) for i in range(60)] + [("short", i, 50.0) for i in range(12)] + [
        ("zero", i, float(i % 3)) for i in range(60)]
    daily = spark.createDataFrame(days, "series_id string, i int, value double").select(
        "series_id", F.expr("date_add(date'2025-01-01', i)").alias("date"), "value")
    series = forecast.split_series(daily)
    models = {r.series_id: r.model for r in forecast.optimised_holt_winters(series, multiplicative=True).collect()}
    assert models == {"long": "HoltWinters_Optimised_Multiplicative", "short": "SeasonalMovingAverage",
                      "zero": "SeasonalMovingAverage"}


def test_backtest_equals_refits(spark):
    rng = np.random.default_rng(1)
    days = [("a", i, float(100 + 10 * (i % 7) + rng.normal())) for i in range(70)]
    daily = spark.createDataFrame(days, "series_id string, i int, value double").select(
        "series_id", F.expr("date_add(date'2025-01-01', i)").alias("date"), "value")
    got = {r.origin: r.mae for r in forecast.rolling_backtest(daily).collect()}
    assert sorted(got) == list(range(28, 57, 7))
    for origin in got:
        known = daily.where(F.col("date") < F.date_add(F.lit("2025-01-01").cast("date"), origin + 14))
        series = forecast.split_series(known, (origin + 0.5) / (origin + 14))
        row = forecast.accuracy(forecast.holt_winters(series, 0), places=None).first()
        assert got[origin] == pytest.approx(row.mae)


def test_segmentation_honours_its_parameters(spark, tmp_path):
    feats = catalog.feats(spark, DATA).cache()
    fixed = terminal.segmentation(feats, AnalysisParams(num_segments=3), SAMPLE_TARIFF, n_init=1)
    assert fixed.chosen.first().k == 3 and fixed.profiles.count() == 3
    costs = [r.opportunity_cost for r in fixed.recommendations.collect()]
    assert costs == sorted(costs, reverse=True)
    terminal.write_segmentation(fixed, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/labels").count() == feats.where("dwell_hours is not null").count()
    assert spark.read.parquet(f"{tmp_path}/models/chosen").first().silhouette_metric == "euclidean"
    assert 0 <= fixed.chosen.first().silhouette_bound < 0.2
    free = terminal.segmentation(feats, AnalysisParams(random_seed=7), ks=(2, 3), n_init=1)
    assert free.chosen.first().k in (2, 3)
    feats.unpersist()


def test_warning_level_decides_the_breach(spark):
    tables = terminal.feature_tables(spark, visits(spark, DATA), yard=SAMPLE_YARD, tariff=SAMPLE_TARIFF)
    models, _, _ = terminal.forecasts(tables, AnalysisParams(), optimise=False)
    low = terminal.outlook(models, SAMPLE_YARD, AnalysisParams(utilization_warning_pct=0.001)).first()
    high = terminal.outlook(models, SAMPLE_YARD, AnalysisParams(utilization_warning_pct=99)).first()
    assert low.is_urgent == 1 and high.is_urgent == 0


def test_several_configuration_documents(spark, tmp_path):
    for name, block in (("a", "A1"), ("b", "B1")):
        (tmp_path / f"{name}.json").write_text('{"terminal_name": "T", "blocks": [{"block_id": "%s", "teu_capacity": 5}]}' % block)
    assert {b.block_id for b in read_yard(spark, str(tmp_path)).blocks} == {"A1", "B1"}
    with pytest.raises(ValueError):
        read_tariff(spark, str(tmp_path))
