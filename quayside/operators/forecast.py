"""Daily load forecasts, one series per row.

A series is folded into an array of its daily values (bounded by the calendar),
and every model is an expression over that array. Recursions such as exponential
smoothing are sequential within a series, so the work spreads over series: a
terminal, each block, each terminal of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.functions import bands

SEASON = 7
TRAIN_SHARE = 0.8
BAND = 0.15
UNRELIABLE_MAPE = 30

# --- fixed values: smoothing weights of the published models ------------------
ALPHA, BETA, GAMMA = 0.2, 0.1, 0.1
SIMPLE_ALPHA = 0.3
TREND_WINDOW = 14
# ------------------------------------------------------------------------------

SERIES = ["series_id", "start_date", "train", "test"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an intermediate value inside an expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(values))


def daily_series(block_day: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Occupied TEU per day (series_id, date, value) without holes.

    Days missing between the first and the last take the value before them.
    """
    series = F.concat_ws("/", *[F.col(k) for k in keys]) if keys else F.lit("terminal")
    totals = block_day.groupBy(series.alias("series_id"), "date").agg(
        F.sum("teu_occupied").cast("double").alias("value"))
    return fill_gaps(totals)


def fill_gaps(totals: DataFrame) -> DataFrame:
    spine = totals.groupBy("series_id").agg(
        F.explode(F.sequence(F.min("date"), F.max("date"))).alias("date"))
    so_far = (Window.partitionBy("series_id").orderBy("date")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        spine.join(totals, ["series_id", "date"], "left")
        .select("series_id", "date",
                F.last("value", ignorenulls=True).over(so_far).alias("value"))
    )


def split_series(daily: DataFrame, train_share: float = TRAIN_SHARE) -> DataFrame:
    """One row per series: the first share of the days to train, one day at least, the rest to test."""
    return (
        daily.groupBy("series_id")
        .agg(F.array_sort(F.collect_list(F.struct("date", "value"))).alias("days"))
        .withColumn("split", F.greatest(F.floor(F.size("days") * train_share), F.lit(1)).cast("int"))
        .select(
            "series_id", F.col("days")[0]["date"].alias("start_date"),
            F.slice("days", F.lit(1), F.col("split"))["value"].alias("train"),
            F.slice("days", F.col("split") + 1, F.size("days") - F.col("split"))["value"]
            .alias("test"))
    )


# --- models: expressions over an array of training values ---------------------

def _season_start(y: Column, multiplicative: bool) -> Column:
    first, second = F.slice(y, 1, SEASON), F.slice(y, SEASON + 1, SEASON)
    level = _mean(first)
    seasonal = F.transform(first, lambda v: v / level if multiplicative else v - level)
    return F.struct(
        level.alias("level"), ((_mean(second) - level) / SEASON).alias("trend"),
        seasonal.alias("seasonal"),
        F.array().cast("array<array<double>>").alias("fitted"), F.lit(0.0).alias("sse"))


CHUNK = 64


def _appended(chunks: Column, value: Column, t: Column) -> Column:
    """Adds a value to a list of chunks, so that a day copies one chunk and the list of them."""
    last = F.element_at(chunks, -1)
    return F.when(F.pmod(t, F.lit(CHUNK)) == 0, F.concat(chunks, F.array(F.array(value)))).otherwise(
        F.concat(F.slice(chunks, F.lit(1), F.size(chunks) - 1), F.array(F.concat(last, F.array(value)))))


def _step(
    alpha: Column | float, beta: Column | float, gamma: Column | float,
    multiplicative: bool, keep_fitted: bool,
) -> Callable[[Column, Column], Column]:
    """One day of smoothing: the state after a point (value, t).

    The first value yields a fitted value but no update.
    """
    combine = (lambda base, s: base * s) if multiplicative else (lambda base, s: base + s)
    remove = (lambda v, s: v / s) if multiplicative else (lambda v, s: v - s)

    def step(state: Column, point: Column) -> Column:
        value, t = point["value"], point["t"]
        slot = F.pmod(t, F.lit(SEASON))
        season = F.element_at(state["seasonal"], slot + 1)
        expected = combine(state["level"] + state["trend"], season)
        error = value - expected
        level = (remove(value, season) * alpha
                 + (state["level"] + state["trend"]) * (1 - alpha))

        def with_level(new_level: Column) -> Column:
            trend = (new_level - state["level"]) * beta + state["trend"] * (1 - beta)
            new_season = remove(value, new_level) * gamma + season * (1 - gamma)
            fitted = combine(new_level + trend, new_season)
            return F.struct(
                new_level.alias("level"), trend.alias("trend"),
                F.transform(state["seasonal"], lambda s, i: F.when(i == slot, new_season)
                            .otherwise(s)).alias("seasonal"),
                (_appended(state["fitted"], fitted, t) if keep_fitted
                 else state["fitted"]).alias("fitted"),
                (state["sse"] + error * error).alias("sse"))

        first = F.struct(
            state["level"].alias("level"), state["trend"].alias("trend"),
            state["seasonal"].alias("seasonal"),
            (F.array(F.array(expected)) if keep_fitted else state["fitted"]).alias("fitted"),
            (state["sse"] + error * error).alias("sse"))
        return F.when(t == 0, first).otherwise(_let(level, with_level))

    return step


def _smooth(
    y: Column, alpha: Column | float, beta: Column | float, gamma: Column | float,
    multiplicative: bool = False, keep_fitted: bool = True,
) -> Column:
    """Level, trend, season, fitted values (in chunks) and one-step squared error after ``y``."""
    points = F.transform(y, lambda v, i: F.struct(v.alias("value"), i.alias("t")))
    return F.aggregate(points, _season_start(y, multiplicative),
                       _step(alpha, beta, gamma, multiplicative, keep_fitted))


def _project(state: Column, n: Column, steps: Column, multiplicative: bool = False) -> Column:
    """Forecast 1..steps days after the ``n`` training days."""
    def at(h: Column) -> Column:
        season = F.element_at(state["seasonal"], F.pmod(n + h - 1, F.lit(SEASON)) + 1)
        base = state["level"] + h * state["trend"]
        return base * season if multiplicative else base + season

    return F.transform(F.sequence(F.lit(1), steps), at)


def _with_model(series: DataFrame, model: Column, fitted: Column, forecast: Column,
                params: Column) -> DataFrame:
    return series.select(
        *[c for c in series.columns if c not in ("state", "best", "grid")],
        model.alias("model"), params.alias("params"),
        fitted.alias("fitted"), forecast.alias("forecast"))


def _steps(horizon: int) -> Column:
    return F.size("test") + horizon


def holt_winters(series: DataFrame, horizon: int = 14) -> DataFrame:
    """Additive exponential smoothing with fixed weights and a weekly season.

    Series shorter than two seasons fall back to simple smoothing with a flat
    forecast.
    """
    y, n = F.col("train"), F.size("train")
    short = n < 2 * SEASON
    smoothed = F.aggregate(
        F.slice(y, F.lit(2), F.greatest(n - 1, F.lit(0))), F.array(y[0]),
        lambda acc, v: F.concat(acc, F.array(
            v * SIMPLE_ALPHA + F.element_at(acc, -1) * (1 - SIMPLE_ALPHA))))
    flat = F.array_repeat(F.element_at("simple", -1), _steps(horizon))
    fixed = F.create_map(*[F.lit(x) for x in (
        "alpha", ALPHA, "beta", BETA, "gamma", GAMMA, "seasonal_period", float(SEASON))])
    states = (
        series.withColumn("state", F.when(~short, _smooth(y, ALPHA, BETA, GAMMA)))
        .withColumn("simple", F.when(short, smoothed))
    )
    return _with_model(
        states, F.when(short, "SimpleExponentialSmoothing").otherwise("HoltWinters_Additive"),
        F.coalesce("simple", F.flatten(F.col("state.fitted"))),
        F.when(short, flat).otherwise(_project(F.col("state"), n, _steps(horizon))),
        F.when(short, F.create_map(F.lit("alpha"), F.lit(SIMPLE_ALPHA))).otherwise(fixed),
    ).drop("simple")


def seasonal_moving_average(series: DataFrame, horizon: int = 14) -> DataFrame:
    """Rolling-mean trend plus the mean deviation of each weekday; never negative."""
    y, n = F.col("train"), F.size("train")
    season = F.transform(
        F.sequence(F.lit(0), F.lit(SEASON - 1)),
        lambda j: F.coalesce(
            _mean(F.filter(y, lambda v, i: F.pmod(i, F.lit(SEASON)) == j)), F.lit(0.0)))
    width = F.greatest(F.least(F.lit(TREND_WINDOW), F.floor(n / 2).cast("int")), F.lit(1))
    trend = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: _mean(F.slice(y, F.greatest(i - width, F.lit(0)) + 1, F.least(i, width))))
    states = (
        series.withColumn("season", season).withColumn("trend", trend)
        .withColumn("centre", _mean(F.col("season")))
        .withColumn("slope", (
            F.element_at("trend", -1)
            - F.element_at("trend", F.greatest(n - TREND_WINDOW, F.lit(0)) + 1)) / TREND_WINDOW)
    )
    offset = lambda i: (
        F.element_at("season", F.pmod(i, F.lit(SEASON)) + 1) - F.col("centre"))
    return _with_model(
        states, F.lit("SeasonalMovingAverage"),
        F.transform("trend", lambda v, i: v + offset(i)),
        F.transform(F.sequence(F.lit(0), _steps(horizon) - 1), lambda h: F.greatest(
            F.lit(0.0), F.element_at("trend", -1) + h * F.col("slope") + offset(n + h))),
        F.create_map(F.lit("window"), F.lit(float(SEASON)), F.lit("trend_slope"), F.col("slope")),
    ).drop("season", "trend", "centre", "slope")


DEFAULT_GRID = [(a, b, g) for a in (0.1, 0.2, 0.4, 0.6, 0.8, 1.0)
                for b in (0.0, 0.05, 0.1, 0.2) for g in (0.0, 0.05, 0.1, 0.2)]


def _grid_fit(series: DataFrame, grid: Sequence[tuple], multiplicative: bool) -> DataFrame:
    """Per series, the grid point with the smallest one-step squared error."""
    y = F.col("train")
    points = F.explode(F.array(*[
        F.struct(F.lit(float(a)).alias("alpha"), F.lit(float(b)).alias("beta"),
                 F.lit(float(g)).alias("gamma")) for a, b, g in grid]))
    # One row per (series, grid point): spread the points, keep only the error.
    scored = (
        series.select("series_id", "train", points.alias("p"))
        .repartition("series_id", "p")
        .select("series_id", "p", _smooth(
            y, F.col("p.alpha"), F.col("p.beta"), F.col("p.gamma"),
            multiplicative, keep_fitted=False)["sse"].alias("sse"))
    )
    best = scored.groupBy("series_id").agg(
        F.min(F.struct("sse", "p")).alias("best"))
    return series.join(best, "series_id")


FIRST_STEP = 0.1


def _refine(best: DataFrame, rounds: int, multiplicative: bool) -> DataFrame:
    """Moves the best grid point on: each round tries a step up and down in every weight.

    The best of the six replaces the point where its error is lower; else the step is
    halved. The error therefore never rises above the grid's.
    """
    def tries(at: Column) -> Column:
        step = F.lit(FIRST_STEP) * F.pow(F.lit(0.5), at["halved"])
        moves = F.array(*[
            F.struct(*[F.least(F.greatest(at[k] + step * sign if k == moved else at[k], F.lit(0.0)),
                               F.lit(1.0)).alias(k) for k in ("alpha", "beta", "gamma")])
            for moved in ("alpha", "beta", "gamma") for sign in (1, -1)])
        return F.array_min(F.transform(moves, lambda p: F.struct(
            _smooth(F.col("train"), p["alpha"], p["beta"], p["gamma"], multiplicative, False)["sse"].alias("sse"),
            p.alias("p"))))

    def on(at: Column, _: Column) -> Column:
        def choose(found: Column) -> Column:
            lower = found["sse"] < at["sse"]
            return F.struct(
                F.when(lower, found["sse"]).otherwise(at["sse"]).alias("sse"),
                *[F.when(lower, found["p"][k]).otherwise(at[k]).alias(k) for k in ("alpha", "beta", "gamma")],
                (at["halved"] + F.when(lower, 0).otherwise(1)).alias("halved"))
        return _let(tries(at), choose)

    p = F.col("best.p")
    start = F.struct(F.col("best.sse").alias("sse"), p["alpha"].alias("alpha"), p["beta"].alias("beta"),
                     p["gamma"].alias("gamma"), F.lit(0).alias("halved"))
    found = best.repartition("series_id").withColumn(
        "found", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, on))
    return found.withColumn("grid_sse", F.col("best.sse")).withColumn("best", F.struct(
        F.col("found.sse").alias("sse"), F.struct("found.alpha", "found.beta", "found.gamma").alias("p"))).drop("found")


def optimised_holt_winters(
    series: DataFrame, horizon: int = 14, grid: Sequence[tuple] = tuple(DEFAULT_GRID),
    multiplicative: bool = False, fallback: bool = True, rounds: int = 0,
) -> DataFrame:
    """Exponential smoothing with weights searched on a grid, per series.

    ``rounds`` of refinement around the best grid point may follow; ``params`` then also
    holds the error of the grid (``grid_sse``), which the refined one never exceeds.
    A series that cannot be fitted (shorter than two seasons, or not positive where
    the season multiplies) falls back to the seasonal moving average.
    """
    fits = F.size("train") >= 2 * SEASON
    if multiplicative:
        fits = fits & (F.array_min("train") > 0)
    best = _grid_fit(series.where(fits), grid, multiplicative)
    extra = []
    if rounds:
        best = _refine(best, rounds, multiplicative)
        extra = [F.lit("grid_sse"), F.col("grid_sse")]
    p, n = F.col("best.p"), F.size("train")
    states = best.withColumn("state", _smooth(
        F.col("train"), p["alpha"], p["beta"], p["gamma"], multiplicative))
    name = "Multiplicative" if multiplicative else "Additive"
    fitted = _with_model(
        states, F.lit(f"HoltWinters_Optimised_{name}"), F.flatten(F.col("state.fitted")),
        _project(F.col("state"), n, _steps(horizon), multiplicative),
        F.create_map(F.lit("alpha"), p["alpha"], F.lit("beta"), p["beta"],
                     F.lit("gamma"), p["gamma"], F.lit("sse"), F.col("best.sse"), *extra)).drop("grid_sse")
    if not fallback:
        return fitted
    return fitted.unionByName(seasonal_moving_average(
        series.where(~F.coalesce(fits, F.lit(False))), horizon))


def season_form_by_aic(series: DataFrame, horizon: int = 14,
                       grid: Sequence[tuple] = tuple(DEFAULT_GRID)) -> DataFrame:
    """Additive or multiplicative season, whichever has the lower AIC.

    A series too short for either keeps its moving average, without an AIC.
    """
    both = optimised_holt_winters(series, horizon, grid).unionByName(
        optimised_holt_winters(series, horizon, grid, multiplicative=True, fallback=False))
    n = F.size("train")
    free = 3 + 2 + SEASON
    scored = both.withColumn("aic", n * F.log(F.col("params")["sse"] / n) + 2 * free)
    order = Window.partitionBy("series_id").orderBy("aic", "model")
    return (scored.withColumn("_n", F.row_number().over(order))
            .where(F.col("_n") == 1).drop("_n"))


# --- accuracy, choice and curves ----------------------------------------------

def _errors(actual: Column, predicted: Column) -> dict[str, Column]:
    n = F.least(F.size(actual), F.size(predicted))
    pairs = F.arrays_zip(F.slice(actual, F.lit(1), n).alias("a"),
                         F.slice(predicted, F.lit(1), n).alias("f"))
    relative = F.transform(F.filter(pairs, lambda p: p["a"] != 0),
                           lambda p: F.abs((p["a"] - p["f"]) / p["a"]))
    gaps = F.transform(pairs, lambda p: p["a"] - p["f"])
    return {
        "mape": _mean(relative) * 100,
        "rmse": F.sqrt(_mean(F.transform(gaps, lambda e: e * e))),
        "mae": _mean(F.transform(gaps, F.abs)),
    }


def accuracy(models: DataFrame, places: int | None = 2, in_sample: bool = False) -> DataFrame:
    """MAPE (zero actuals skipped), RMSE and MAE on the test days per model."""
    actual, predicted = ("train", "fitted") if in_sample else ("test", "forecast")
    errors = _errors(F.col(actual), F.col(predicted))
    return models.select("series_id", "model", *[
        (F.round(e, places) if places is not None else e).alias(name)
        for name, e in errors.items()])


def select_model(first: DataFrame, second: DataFrame) -> DataFrame:
    """The model with the lower MAPE per series; the first one on a tie."""
    ranked = (
        accuracy(first).withColumn("preference", F.lit(1))
        .unionByName(accuracy(second).withColumn("preference", F.lit(2)))
    )
    best = ranked.groupBy("series_id").agg(F.min(F.struct(
        F.coalesce("mape", F.lit(float("inf"))).alias("key"), "preference",
        "model", "mape", "rmse", "mae")).alias("m"))
    return best.select(
        "series_id", "m.model", "m.mape", "m.rmse", "m.mae",
        bands.mape_quality(F.col("m.mape")).alias("quality"),
        F.coalesce(F.col("m.mape") > UNRELIABLE_MAPE, F.lit(True)).cast("int")
        .alias("is_unreliable"))


def forecast_curve(models: DataFrame) -> DataFrame:
    """Train, test and future days in long form, with the band of +-15 %."""
    n, m = F.size("train"), F.size("test")
    zones = F.concat(
        F.transform("train", lambda v, i: F.struct(
            i.alias("offset"), F.lit("train").alias("zone"), v.alias("actual"),
            F.element_at("fitted", i + 1).alias("predicted"))),
        F.transform("forecast", lambda f, h: F.struct(
            (n + h).alias("offset"),
            F.when(h < m, "test").otherwise("future").alias("zone"),
            F.try_element_at("test", h + 1).alias("actual"), f.alias("predicted"))))
    future = F.col("zone") == "future"
    return models.select("series_id", "model", "start_date", F.inline(zones)).select(
        "series_id", "model", F.date_add("start_date", F.col("offset").cast("int")).alias("date"),
        "zone", "actual", "predicted",
        F.when(future, F.col("predicted") * (1 - BAND)).alias("band_15pct_low"),
        F.when(future, F.col("predicted") * (1 + BAND)).alias("band_15pct_high"))


def future_values(models: DataFrame) -> DataFrame:
    return forecast_curve(models).where(F.col("zone") == "future")


def breach(models: DataFrame, capacity: float, warning_pct: float = 80) -> DataFrame:
    """First forecast day above the warning level and the days left until then."""
    util = F.col("predicted") / float(capacity) * 100
    over = util > warning_pct
    return (
        future_values(models).groupBy("series_id", "model").agg(
            F.min("date").alias("_first"), F.count(F.lit(1)).alias("horizon_days"),
            F.max(util).alias("peak_forecast_util"),
            F.min(F.when(over, F.col("date"))).alias("breach_date"))
        .withColumn("days_until_breach", F.datediff("breach_date", F.date_sub("_first", 1)))
        .withColumn("is_urgent", F.col("breach_date").isNotNull().cast("int"))
        .drop("_first")
    )


def rolling_backtest(
    daily: DataFrame, horizon: int = 14, first: int = 28, every: int = 7,
) -> DataFrame:
    """Accuracy of the fixed-weight model from a series of forecast origins.

    Smoothing only looks back, so one fold over a series yields the state at every
    origin; the days between two origins are one chunk of the fold. A series too short for
    any origin comes as one row without origin and errors.
    """
    every_series = split_series(daily, 1.0)
    enough = F.size("train") >= first + horizon
    whole = every_series.where(enough)
    y, n = F.col("train"), F.size("train")
    origins = F.sequence(F.lit(first), n - horizon, F.lit(every))
    start = F.struct(_season_start(y, False).alias("state"), F.array().cast(
        "array<struct<level:double,trend:double,seasonal:array<double>>>").alias("kept"))

    def leg(acc: Column, origin: Column) -> Column:
        past = F.when(origin == first, F.lit(0)).otherwise(origin - every)
        points = F.transform(F.slice(y, past + 1, origin - past),
                             lambda v, i: F.struct(v.alias("value"), (past + i).cast("int").alias("t")))
        after = F.aggregate(points, acc["state"], _step(ALPHA, BETA, GAMMA, False, False))
        return _let(after, lambda s: F.struct(s.alias("state"), F.concat(acc["kept"], F.array(F.struct(
            s["level"].alias("level"), s["trend"].alias("trend"), s["seasonal"].alias("seasonal")))).alias("kept")))

    states = F.aggregate(origins, start, leg)["kept"]
    rows = whole.select("series_id", "train", F.inline(F.arrays_zip(
        origins.alias("origin"), states.alias("state"))))
    cut = rows.select(
        "series_id", "origin", F.slice("train", F.col("origin") + 1, F.lit(horizon)).alias("test"),
        _project(F.col("state"), F.col("origin"), F.lit(horizon)).alias("forecast"))
    errors = _errors(F.col("test"), F.col("forecast"))
    scored = cut.select("series_id", "origin", *[e.alias(k) for k, e in errors.items()])
    return scored.unionByName(every_series.where(~enough).select("series_id"), allowMissingColumns=True)
