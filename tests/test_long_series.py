from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import forecast, long_series

DAYS = "series_id string, date date, value double"


def made_days(spark, series, start, n):
    """A trend with a weekly season, from the day's number alone."""
    i = F.col("id")
    return spark.range(n).select(
        F.lit(series).alias("series_id"), F.date_add(F.lit(start), i.cast("int")).alias("date"),
        (200 + i / 500 + 30 * F.sin(i * 0.9) + F.pmod(i * 37, F.lit(11)) + 15 * F.pmod(i, F.lit(7))).alias("value"))


def keyed(rows, *keys):
    return {tuple(r[k] for k in keys): r for r in rows}


def same(got, want, keys, places):
    got, want = keyed(got.collect(), *keys), keyed(want.collect(), *keys)
    assert set(got) == set(want)
    for key, row in want.items():
        for name, value in row.asDict().items():
            if isinstance(value, float):
                assert got[key][name] == pytest.approx(value, rel=places, abs=places), (key, name)
            else:
                assert got[key][name] == value, (key, name)


@pytest.fixture(scope="module")
def several(spark):
    """Lengths around a span, starts on every slot, with holes of days and of whole spans."""
    parts = [made_days(spark, f"s{n}", date(1969, 12, 29) + timedelta(days=j), n)
             for j, n in enumerate((1, 5, 17, 18, 41, 42, 43, 896, 897, 2700))]
    days = parts[0]
    for part in parts[1:]:
        days = days.unionByName(part)
    holes = made_days(spark, "holes", date(2001, 5, 3), 4000).where(
        "datediff(date, date'2001-05-03') not between 500 and 2600 and day(date) <> 14").withColumn(
        "value", F.when(F.month("date") != 3, F.col("value")))
    return days.unionByName(holes).cache()


def test_curves_equal_the_fold_over_arrays(spark, several):
    want = forecast.forecast_curve(forecast.holt_winters(forecast.split_series(forecast.fill_gaps(several))))
    same(long_series.holt_winters_curve(several), want, ["series_id", "date"], 1e-9)


def test_backtests_equal_the_fold_over_arrays(spark, several):
    want = forecast.rolling_backtest(forecast.fill_gaps(several))
    same(long_series.rolling_backtest(several), want, ["series_id", "origin"], 1e-9)


def test_blocks_of_spans_compose(spark, several, monkeypatch):
    monkeypatch.setattr(long_series, "BLOCK", 2)
    days = several.where("series_id in ('s2700', 'holes')")
    want = forecast.forecast_curve(forecast.holt_winters(forecast.split_series(forecast.fill_gaps(days))))
    same(long_series.holt_winters_curve(days), want, ["series_id", "date"], 1e-9)


def test_accuracy_of_a_curve(spark, several):
    days = several.where("series_id in ('s2700', 's43')")
    want = forecast.accuracy(forecast.holt_winters(forecast.split_series(days)), places=None)
    same(long_series.curve_accuracy(long_series.holt_winters_curve(days)), want, ["series_id"], 1e-9)


def test_empty_input_and_rows_without_keys(spark):
    days = spark.createDataFrame([(None, date(2025, 1, 1), 1.0), ("s", None, 2.0)], DAYS)
    assert long_series.holt_winters_curve(days).count() == 0
    assert long_series.rolling_backtest(days).count() == 0


def test_leading_nulls_stay_null(spark):
    days = made_days(spark, "s", date(2025, 1, 1), 30).withColumn(
        "value", F.when(F.col("date") > date(2025, 1, 3), F.col("value")))
    values = long_series.spans(days).orderBy("span").select(F.explode_outer("values")).collect()
    assert [r[0] is None for r in values] == [True] * 3 + [False] * 27


def test_a_million_days_in_one_series(spark):
    """Against a fold in numpy; no row holds more than a span, no plan sorts the values of a series."""
    n, start = 1_000_000, date(1000, 1, 1)
    days = made_days(spark, "long", start, n)
    future = long_series.holt_winters_curve(days).where("zone = 'future'").orderBy("date").collect()
    y = np.array([r.value for r in days.orderBy("date").select("value").collect()])
    cut = int(n * 0.8)
    level, season = y[:7].mean(), y[:7] - y[:7].mean()
    trend = (y[7:14].mean() - level) / 7
    for t in range(1, cut):
        slot, before = t % 7, level
        level = 0.2 * (y[t] - season[slot]) + 0.8 * (level + trend)
        trend = 0.1 * (level - before) + 0.9 * trend
        season[slot] = 0.1 * (y[t] - level) + 0.9 * season[slot]
    steps = np.arange(n - cut + 1, n - cut + 15)
    want = level + steps * trend + season[(cut + steps - 1) % 7]
    assert [r.predicted for r in future] == pytest.approx(list(want), rel=1e-9)
    assert future[0].date == start + timedelta(days=n)
    assert long_series.spans(days).agg(F.max(F.size("values"))).first()[0] == long_series.SPAN
