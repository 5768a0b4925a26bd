"""Smoothing of series of any length: no array, task or window holds the values of a whole series.

Additive smoothing is an affine map of its state (level, trend, seven seasonal
offsets). A span of days takes a state ``s`` to ``M s + c``: ``M`` depends on the
weights alone, and ``c`` is what the span makes of a state of zeros. So all spans are
folded at once, the states entering them follow by composing maps (the spans of a
block, then the blocks of a series), and a second fold starts from these states.

A series of ``n`` days has ``n / 896`` narrow rows of states and an array of
``n / 917,504`` blocks; its values stay in rows of 896. Days are numbered from a fixed
origin, so that spans and seasonal slots need no look at the start of a series.

Input is (series_id, date, value) with one row per series and day at most. Rows
without series or date are left out; a missing day or value takes the one before it,
and is null before the first. Empty input gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.operators import forecast
from quayside.operators.forecast import ALPHA, BAND, BETA, CHUNK, GAMMA, SEASON, TRAIN_SHARE
from quayside.session import cut_lineage

SPAN = 2 * SEASON * CHUNK  # whole seasons, and whole chunks of fitted values
BLOCK = 1024
ORIGIN = 4096 * SPAN  # makes the numbers of all days from year 1 on positive
KEY = ["series_id", "span"]
STATE = 2 + SEASON


def _span_of(day: Column) -> Column:
    return F.floor(day / SPAN).cast("int")


def _date(day: Column) -> Column:
    return F.date_from_unix_date((day - ORIGIN).cast("int"))


def spans(daily: DataFrame, ahead: int = 2 * SEASON) -> DataFrame:
    """The days of each series in rows of one span, without holes.

    (series_id, span, day, values, ahead, start, stop): the number of the first day, the
    values from it on, the first ``ahead`` values of the next span, the first and last day
    of the series.
    """
    if not 2 * SEASON <= ahead <= SPAN:
        raise ValueError(f"ahead must lie between {2 * SEASON} and {SPAN}")
    day = F.unix_date("date") + ORIGIN
    pieces = cut_lineage(
        daily.where(F.col("series_id").isNotNull() & F.col("date").isNotNull())
        .select("series_id", day.alias("day"), F.col("value").cast("double").alias("value"))
        .groupBy("series_id", _span_of(F.col("day")).alias("span"))
        .agg(F.min("day").alias("low"), F.max("day").alias("high"), F.array_sort(F.filter(
            F.collect_list(F.struct("day", "value")), lambda p: p["value"].isNotNull())).alias("points")))
    along, whole = Window.partitionBy("series_id").orderBy("span"), Window.partitionBy("series_id")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    known = pieces.select(*KEY, "low", "high", F.try_element_at("points", F.lit(-1))["value"].alias("known"))
    facts = known.select(
        "series_id", F.col("span").alias("at"), F.min("low").over(whole).alias("start"),
        F.max("high").over(whole).alias("stop"), F.last("known", ignorenulls=True).over(before).alias("carry"),
        F.last("known", ignorenulls=True).over(along).alias("later"),
        (F.coalesce(F.lead("span").over(along), F.col("span") + 1) - 1).alias("until"))
    places = facts.select("*", F.explode(F.sequence("at", "until")).alias("span")).select(
        *KEY, "start", "stop", F.when(F.col("span") == F.col("at"), F.col("carry")).otherwise(
            F.col("later")).alias("carry"))
    points = F.coalesce("points", F.array().cast("array<struct<day:int,value:double>>"))
    end = F.least(F.col("span") * SPAN + SPAN, F.col("stop") + 1)
    filled = F.flatten(F.transform("points", lambda p, i: F.array_repeat(
        p["value"], (F.coalesce(F.try_element_at("points", i + 2)["day"], F.col("end")) - p["day"]).cast("int"))))
    dense = cut_lineage(
        places.join(pieces.select(*KEY, "points"), KEY, "left")
        .withColumn("points", points).withColumn("end", end)
        .withColumn("day", F.greatest(F.col("span") * SPAN, F.col("start")))
        .select(*KEY, "day", "start", "stop", F.concat(
            F.array_repeat("carry", (F.coalesce(F.try_element_at("points", F.lit(1))["day"], F.col("end"))
                                     - F.col("day")).cast("int")), filled).alias("values")))
    heads = dense.select("series_id", (F.col("span") - 1).alias("span"), F.slice("values", 1, ahead).alias("ahead"))
    return dense.join(heads, KEY, "left").withColumn(
        "ahead", F.coalesce("ahead", F.array().cast("array<double>")))


# --- states as vectors --------------------------------------------------------------

def span_map(alpha: float, beta: float, gamma: float, days: int = SPAN) -> np.ndarray:
    """The matrix by which ``days`` days from slot 0 on act on a state."""
    whole = np.eye(STATE)
    for slot in range(days):
        slot %= SEASON
        level, trend, season = np.eye(STATE)[0], np.eye(STATE)[1], np.eye(STATE)[2 + slot]
        step = np.eye(STATE)
        step[0] = (1 - alpha) * (level + trend) - alpha * season
        step[1] = beta * (step[0] - level) + (1 - beta) * trend
        step[2 + slot] = (1 - gamma) * season - gamma * step[0]
        whole = step @ whole
    return whole


def _after(matrix: np.ndarray, state: Column, own: Column) -> Column:
    """``matrix state + own``."""
    rows = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in matrix])
    moved = F.transform(rows, lambda row: F.aggregate(
        F.zip_with(row, state, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y))
    return F.zip_with(moved, own, lambda a, b: a + b)


def _nothing() -> Column:
    return F.array_repeat(F.lit(0.0), STATE)


def _vector(state: Column) -> Column:
    return F.concat(F.array(state["level"], state["trend"]), state["seasonal"])


def _state(vector: Column) -> Column:
    return F.struct(
        F.element_at(vector, 1).alias("level"), F.element_at(vector, 2).alias("trend"),
        F.slice(vector, 3, SEASON).alias("seasonal"),
        F.array().cast("array<array<double>>").alias("fitted"), F.lit(0.0).alias("sse"))


def _is_first() -> Column:
    return F.col("span") == _span_of(F.col("start"))


def _opening() -> Column:
    """The state after the first day of a series, which is fitted but updates nothing."""
    first = F.concat("values", "ahead")
    fresh = forecast._season_start(F.slice(first, 1, 2 * SEASON), False)

    def opened(state: Column) -> Column:
        expected = state["level"] + state["trend"] + F.element_at(state["seasonal"], 1)
        error = F.element_at(first, 1) - expected
        turned = F.transform(F.sequence(F.lit(0), F.lit(SEASON - 1)), lambda slot: F.element_at(
            state["seasonal"], F.pmod(slot - F.col("start"), F.lit(SEASON)) + 1))
        return F.struct(
            state["level"].alias("level"), state["trend"].alias("trend"), turned.alias("seasonal"),
            F.array(F.array(expected)).alias("fitted"), (error * error).alias("sse"))

    return forecast._let(fresh, opened)


def _points(count: Column) -> Column:
    """The first ``count`` values of a span, without the first day of the series."""
    points = F.transform("values", lambda v, i: F.struct(
        v.alias("value"), (F.col("day") + i).cast("int").alias("t")))
    skipped = _is_first().cast("int")
    return F.slice(points, skipped + 1, F.greatest(count - skipped, F.lit(0)))


def entering_states(
    pieces: DataFrame, alpha: float = ALPHA, beta: float = BETA, gamma: float = GAMMA,
) -> DataFrame:
    """(series_id, span, state): what every span starts from; of no use for the first span of a series."""
    start = F.when(_is_first(), _opening()).otherwise(_state(_nothing()))
    folded = F.aggregate(_points(F.size("values")), start, forecast._step(alpha, beta, gamma, False, False))
    block = F.floor((F.col("span") - _span_of(F.col("start"))) / BLOCK).cast("int")
    parts = cut_lineage(
        pieces.select(*KEY, block.alias("block"), _vector(folded).alias("own"))
        .groupBy("series_id", "block")
        .agg(F.array_sort(F.collect_list(F.struct("span", "own"))).alias("parts")))

    over_span = span_map(alpha, beta, gamma)
    over_block = np.linalg.matrix_power(over_span, BLOCK)
    none = F.array().cast("array<array<double>>")

    def states_before(items: str, first: Column, matrix: np.ndarray) -> Column:
        """The state before each item of a list of maps."""
        begin = F.struct(first.alias("state"), none.alias("kept"))
        return F.aggregate(items, begin, lambda acc, item: F.struct(
            _after(matrix, acc["state"], item["own"]).alias("state"),
            F.concat(acc["kept"], F.array(acc["state"])).alias("kept")))["kept"]

    ends = parts.select("series_id", "block", F.aggregate(
        "parts", _nothing(), lambda s, p: _after(over_span, s, p["own"])).alias("own"))
    begins = (
        ends.groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct("block", "own"))).alias("blocks"))
        .select("series_id", F.inline(F.arrays_zip(
            F.col("blocks.block").alias("block"), states_before("blocks", _nothing(), over_block).alias("begin")))))
    return parts.join(begins, ["series_id", "block"]).select("series_id", F.inline(F.arrays_zip(
        F.col("parts.span").alias("span"), states_before("parts", F.col("begin"), over_span).alias("state"))))


def _with_states(pieces: DataFrame, alpha: float, beta: float, gamma: float) -> DataFrame:
    states = cut_lineage(entering_states(pieces, alpha, beta, gamma))
    begin = F.when(_is_first(), _opening()).otherwise(_state(F.col("state")))
    return pieces.join(states, KEY).withColumn("begin", begin)


# --- results ------------------------------------------------------------------------

def holt_winters_curve(
    daily: DataFrame, horizon: int = 14, train_share: float = TRAIN_SHARE,
    alpha: float = ALPHA, beta: float = BETA, gamma: float = GAMMA,
) -> DataFrame:
    """What ``forecast.forecast_curve`` makes of ``forecast.holt_winters``, for series of any length.

    Series with less than two seasons to train are smoothed as there.
    """
    pieces = spans(daily)
    days = F.col("stop") - F.col("start") + 1
    n = F.greatest(F.floor(days * train_share), F.lit(1)).cast("int")
    pieces = pieces.withColumn("cut", F.col("start") + n)
    short = F.col("cut") - F.col("start") < 2 * SEASON
    long = pieces.where(~short)
    seen = F.least(F.size("values"), F.greatest(F.col("cut") - F.col("day"), F.lit(0)))
    trained = _with_states(long.where(F.col("day") < F.col("cut")), alpha, beta, gamma)

    def fold(keep: bool) -> Column:
        return F.aggregate(_points(seen), F.col("begin"), forecast._step(alpha, beta, gamma, False, keep))

    fitted = trained.select("series_id", "day", F.posexplode(F.arrays_zip(
        F.slice("values", F.lit(1), seen).alias("actual"), F.flatten(fold(True)["fitted"]).alias("predicted"))))
    train = fitted.select(
        "series_id", (F.col("day") + F.col("pos")).alias("day"), F.lit("train").alias("zone"),
        "col.actual", "col.predicted")

    last = trained.where(F.col("span") == _span_of(F.col("cut") - 1))
    finals = cut_lineage(last.select("series_id", "start", "stop", "cut", _vector(fold(False)).alias("final")))

    def ahead(day: Column) -> Column:
        state = _state(F.col("final"))
        season = F.element_at(state["seasonal"], F.pmod(day, F.lit(SEASON)) + 1)
        return state["level"] + (day - F.col("cut") + 1) * state["trend"] + season

    tested = finals.where(F.col("cut") <= F.col("stop")).select("series_id", "final", F.explode(
        F.sequence(_span_of(F.col("cut")), _span_of(F.col("stop")))).alias("span"))
    test = (
        long.where(F.col("day") + F.size("values") > F.col("cut")).join(tested, KEY)
        .select("series_id", "cut", "final", "day", F.posexplode("values").alias("pos", "actual"))
        .withColumn("day", F.col("day") + F.col("pos")).where(F.col("day") >= F.col("cut"))
        .select("series_id", "day", F.lit("test").alias("zone"), "actual", ahead(F.col("day")).alias("predicted")))
    future = finals.select("*", F.explode(F.sequence(
        F.col("stop") + 1, F.col("stop") + horizon)).alias("day")).select(
        "series_id", "day", F.lit("future").alias("zone"), F.lit(None).cast("double").alias("actual"),
        ahead(F.col("day")).alias("predicted"))

    coming = F.col("zone") == "future"
    curve = train.unionByName(test).unionByName(future).select(
        "series_id", F.lit("HoltWinters_Additive").alias("model"), _date(F.col("day")).alias("date"),
        "zone", "actual", "predicted",
        F.when(coming, F.col("predicted") * (1 - BAND)).alias("band_15pct_low"),
        F.when(coming, F.col("predicted") * (1 + BAND)).alias("band_15pct_high"))
    few = pieces.where(short).select("series_id", "day", F.posexplode("values").alias("pos", "value")).select(
        "series_id", _date(F.col("day") + F.col("pos")).alias("date"), "value")
    return curve.unionByName(forecast.forecast_curve(
        forecast.holt_winters(forecast.split_series(few, train_share), horizon)))


def curve_accuracy(curve: DataFrame, zone: str = "test") -> DataFrame:
    """MAPE (zero actuals skipped), RMSE and MAE of a curve's days of one zone, summed map-side."""
    gap = F.col("actual") - F.col("predicted")
    relative = F.when(F.col("actual") != 0, F.abs(gap / F.col("actual")))
    return curve.where(F.col("zone") == zone).groupBy("series_id", "model").agg(
        (F.avg(relative) * 100).alias("mape"), F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"))


def rolling_backtest(daily: DataFrame, horizon: int = 14, first: int = 28, every: int = 7) -> DataFrame:
    """What ``forecast.rolling_backtest`` returns, for series of any length.

    ``horizon`` is at most a span, ``first`` at least two seasons. A series too short for
    any origin comes as one row without origin and errors.
    """
    if first < 2 * SEASON:
        raise ValueError(f"first must be at least {2 * SEASON}")
    pieces = spans(daily, max(horizon, 2 * SEASON))
    enough = F.col("stop") - F.col("start") + 1 >= first + horizon
    step = forecast._step(ALPHA, BETA, GAMMA, False, False)

    def advance(acc: Column, point: Column) -> Column:
        """One day on; the state stays in ``kept`` where a forecast starts behind the day."""
        origin = point["t"] + 1 - F.col("start")
        wanted = ((origin >= first) & (F.pmod(origin - first, F.lit(every)) == 0)
                  & (point["t"] + horizon <= F.col("stop")))
        return forecast._let(step(acc["state"], point), lambda s: F.struct(s.alias("state"), F.when(
            wanted, F.concat(acc["kept"], F.array(F.struct(
                origin.alias("origin"), s["level"].alias("level"), s["trend"].alias("trend"),
                s["seasonal"].alias("seasonal"))))).otherwise(acc["kept"]).alias("kept")))

    begin = F.struct(F.col("begin").alias("state"), F.array().cast(
        "array<struct<origin:int,level:double,trend:double,seasonal:array<double>>>").alias("kept"))
    rows = _with_states(pieces.where(enough), ALPHA, BETA, GAMMA).select(
        "series_id", "start", "day", "values", "ahead",
        F.explode(F.aggregate(_points(F.size("values")), begin, advance)["kept"]).alias("state"))
    behind = F.col("start") + F.col("state.origin")
    cut = rows.select(
        "series_id", F.col("state.origin").alias("origin"),
        F.slice(F.concat("values", "ahead"), behind - F.col("day") + 1, F.lit(horizon)).alias("test"),
        forecast._project(F.col("state"), behind, F.lit(horizon)).alias("forecast"))
    errors = forecast._errors(F.col("test"), F.col("forecast"))
    scored = cut.select("series_id", "origin", *[e.alias(k) for k, e in errors.items()])
    return scored.unionByName(pieces.where(~enough & _is_first()).select("series_id"), allowMissingColumns=True)
