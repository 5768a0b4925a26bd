from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quayside.operators import forecast

# Daily TEU of a published two-block run from 2025-01-01 on, the
# accuracy of the fixed-weight model on its last 37 days, and its forecast.
DAILY = [
    28, 63, 88, 79, 73, 126, 133, 143, 145, 159, 153, 117, 146, 155, 164, 171, 185, 169,
    128, 175, 185, 193, 189, 183, 156, 147, 192, 193, 215, 198, 194, 155, 124, 175, 176,
    191, 201, 200, 167, 174, 196, 184, 190, 189, 189, 151, 137, 215, 220, 223, 213, 208,
    177, 153, 199, 190, 198, 191, 181, 158, 144, 201, 206, 220, 227, 224, 195, 169, 215,
    222, 221, 224, 220, 200, 169, 209, 211, 201, 199, 214, 186, 165, 200, 208, 200, 215,
    219, 186, 163, 194, 183, 197, 205, 193, 164, 154, 192, 190, 198, 187, 184, 166, 153,
    193, 188, 201, 211, 192, 174, 156, 217, 205, 213, 198, 198, 179, 168, 207, 228, 223,
    222, 216, 186, 165, 200, 209, 205, 222, 218, 197, 171, 203, 200, 210, 232, 244, 221,
    189, 226, 223, 226, 221, 219, 191, 181, 238, 228, 247, 247, 248, 205, 187, 212, 200,
    198, 188, 177, 168, 161, 207, 223, 223, 228, 230, 195, 171, 203, 191, 198, 211, 192,
    166, 165, 190, 205, 209, 229, 209, 196, 183, 198,
]
FUTURE = [250.7, 238.2, 242.6, 243.3, 220.4, 203.9, 249.1, 254.0, 241.5, 245.8, 246.6, 223.7, 207.2, 252.4]


def daily(spark, values, series="terminal", start=date(2025, 1, 1)):
    return spark.createDataFrame(
        [(series, start + timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)],
        "series_id string, date date, value double")


def test_published_run_is_reproduced(spark):
    series = forecast.split_series(daily(spark, DAILY))
    row = series.select(F.size("train").alias("a"), F.size("test").alias("b")).first()
    assert (row.a, row.b) == (144, 37)
    model = forecast.holt_winters(series)
    score = forecast.accuracy(model).first()
    assert (score.mape, score.rmse, score.mae) == (13.33, 30.23, 25.88)
    future = forecast.future_values(model).orderBy("date").collect()
    assert [round(r.predicted, 1) for r in future] == FUTURE
    assert future[0].date == date(2025, 7, 1)
    assert future[0].band_15pct_low == pytest.approx(future[0].predicted * 0.85)


def test_short_series_are_smoothed_flat(spark):
    curve = forecast.forecast_curve(forecast.holt_winters(forecast.split_series(
        daily(spark, [10, 20, 30, 40, 50]))))
    level = 10.0
    for v in (20, 30, 40):
        level = 0.3 * v + 0.7 * level
    assert {round(r.predicted, 9) for r in curve.where("zone <> 'train'").collect()} == {round(level, 9)}
    assert {r.model for r in curve.collect()} == {"SimpleExponentialSmoothing"}


def test_gaps_take_the_value_before_them(spark):
    days = daily(spark, [5, None, None, 7]).where("value is not null")
    assert [r.value for r in forecast.fill_gaps(days).orderBy("date").collect()] == [5.0, 5.0, 5.0, 7.0]


def test_moving_average_by_hand(spark):
    y = [float((i * 13) % 17 + i / 3) for i in range(40)]
    model = forecast.seasonal_moving_average(forecast.split_series(daily(spark, y)), 5)
    n = 32
    means = [sum(y[j:n:7]) / len(y[j:n:7]) for j in range(7)]
    centre = sum(means) / 7
    trend = [sum(y[max(0, i - 13):i + 1]) / len(y[max(0, i - 13):i + 1]) for i in range(n)]
    slope = (trend[-1] - trend[n - 14]) / 14
    want = [max(0.0, trend[-1] + h * slope + means[(n + h) % 7] - centre) for h in range(13)]
    assert model.first().forecast == pytest.approx(want)


def test_zero_actuals_do_not_count_in_mape(spark):
    df = spark.createDataFrame(
        [("s", "m", [0.0, 10.0], [5.0, 8.0])],
        "series_id string, model string, test array<double>, forecast array<double>")
    row = forecast.accuracy(df).first()
    assert (row.mape, row.mae, row.rmse) == (20.0, 3.5, 3.81)


def test_choice_prefers_the_first_model_on_a_tie(spark):
    df = spark.createDataFrame(
        [("s", "one", [10.0], [9.0])], "series_id string, model string, test array<double>, forecast array<double>")
    other = df.withColumn("model", F.lit("another"))
    assert forecast.select_model(df, other).first().model == "one"


def test_search_is_no_worse_in_sample_than_its_grid_points(spark):
    series = forecast.split_series(daily(spark, DAILY))
    grid = [(0.2, 0.1, 0.1), (0.5, 0.0, 0.1)]
    both = [forecast.optimised_holt_winters(series, grid=[g]).first().params["sse"] for g in grid]
    assert forecast.optimised_holt_winters(series, grid=grid).first().params["sse"] == min(both)


def test_refinement_never_loses_to_its_grid(spark):
    series = forecast.split_series(daily(spark, DAILY).unionByName(daily(spark, DAILY[40:120], "part")))
    for multiplicative in (False, True):
        rows = forecast.optimised_holt_winters(series, multiplicative=multiplicative, rounds=6).collect()
        plain = {r.series_id: r.params for r in forecast.optimised_holt_winters(
            series, multiplicative=multiplicative).collect()}
        assert {r.series_id for r in rows} == {"terminal", "part"}
        for r in rows:
            assert r.params["grid_sse"] == plain[r.series_id]["sse"]
            assert r.params["sse"] < r.params["grid_sse"]
            again = forecast.optimised_holt_winters(
                series.where(F.col("series_id") == r.series_id), multiplicative=multiplicative,
                grid=[(r.params["alpha"], r.params["beta"], r.params["gamma"])]).first()
            assert again.params["sse"] == r.params["sse"]
            assert all(0 <= r.params[k] <= 1 for k in ("alpha", "beta", "gamma"))


def test_breach_date(spark):
    model = forecast.holt_winters(forecast.split_series(daily(spark, DAILY)))
    row = forecast.breach(model, capacity=300, warning_pct=84).first()
    assert row.breach_date == date(2025, 7, 8) and row.days_until_breach == 8
    assert forecast.breach(model, capacity=1220).first().breach_date is None


def test_backtest_origins(spark):
    rows = forecast.rolling_backtest(daily(spark, DAILY), every=50).collect()
    assert sorted(r.origin for r in rows) == [28, 78, 128]


def test_one_day_and_thirty_days_are_not_lost(spark):
    days = daily(spark, [7.0], "day").unionByName(daily(spark, DAILY[:30], "month"))
    series = forecast.split_series(days)
    for models in (forecast.holt_winters(series), forecast.seasonal_moving_average(series),
                   forecast.optimised_holt_winters(series, grid=[(0.2, 0.1, 0.1)])):
        assert {r.series_id for r in models.collect()} == {"day", "month"}
    flat = forecast.forecast_curve(forecast.holt_winters(series)).where("series_id = 'day'").collect()
    assert len(flat) == 15 and {r.predicted for r in flat} == {7.0}
    chosen = forecast.select_model(forecast.holt_winters(series), forecast.seasonal_moving_average(series))
    assert {r.series_id for r in chosen.collect()} == {"day", "month"}
    got = forecast.rolling_backtest(days).collect()
    assert sorted((r.series_id, r.origin, r.mae) for r in got) == [("day", None, None), ("month", None, None)]
