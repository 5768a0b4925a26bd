"""Dwell-time reports: KPIs, breakdowns, histograms, rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.functions import bands
from quayside.functions.exact import mean_days, quantiles, quantiles_wide, sum_money
from quayside.functions.visit import dwell_micros

LONG_STAY_DAYS = 30
CURVE_MARKS = (0.50, 0.75, 0.90, 0.95)
CURVE_MAX_DAYS = 60.0


def closed(features: DataFrame) -> DataFrame:
    """Visits whose dwell is known."""
    return features.where(F.col("dwell_hours").isNotNull())


def dwell_below(features: DataFrame, days: float) -> DataFrame:
    return features.where(F.col("dwell_days") < days)


def executive_kpis(features: DataFrame, block_day: DataFrame) -> DataFrame:
    """Headline numbers of the terminal (one row)."""
    median = quantiles(features, "dwell_days", [0.5]).select("quantile").scalar()
    peak = block_day.agg(F.max("block_utilization_pct")).scalar()
    return features.agg(
        F.count(F.lit(1)).alias("total_containers"),
        mean_days(dwell_micros()).alias("avg_dwell_days"),
        F.try_divide(F.sum(F.when(F.col("dwell_days").isNotNull(), F.col("is_overstay"))),
                     F.count("dwell_days")).alias("_rate"),
        F.coalesce(sum_money(F.col("storage_cost_usd")), F.lit(0.0)).alias("total_revenue"),
        F.count_if(F.col("dwell_days") > LONG_STAY_DAYS).alias("long_stay_count"),
    ).select(
        "total_containers", "avg_dwell_days", median.alias("median_dwell_days"),
        (F.col("_rate") * 100).alias("overstay_pct"), "total_revenue",
        "long_stay_count", peak.alias("peak_utilization_pct"))


def _with_quantiles(stats: DataFrame, rows: DataFrame, key: str, named: dict[str, float]) -> DataFrame:
    return stats.join(quantiles_wide(rows, "dwell_days", named, [key]), key)


def dwell_by(features: DataFrame, key: str) -> DataFrame:
    """Mean, median, count and overstay rate of dwell per value of ``key``."""
    rows = closed(features).where(F.col(key).isNotNull())
    stats = rows.groupBy(key).agg(
        mean_days(dwell_micros()).alias("mean_dwell"),
        F.count(F.lit(1)).alias("visits"),
        (F.sum("is_overstay") / F.count(F.lit(1))).alias("overstay_rate"))
    return _with_quantiles(stats, rows, key, {"median_dwell": 0.5})


def dwell_by_movement(features: DataFrame, below_days: float = 45) -> DataFrame:
    """Count, mean, median and 95th percentile per movement type."""
    rows = dwell_below(features, below_days).where(F.col("movement_type").isNotNull())
    stats = rows.groupBy("movement_type").agg(
        mean_days(dwell_micros()).alias("mean_dwell"),
        F.count(F.lit(1)).alias("visits"))
    return _with_quantiles(stats, rows, "movement_type", {"median_dwell": 0.5, "p95_dwell": 0.95})


def quartiles_by(features: DataFrame, key: str) -> DataFrame:
    """Box-plot quartiles of dwell per value of ``key``."""
    rows = closed(features).where(F.col(key).isNotNull())
    return quantiles_wide(rows, "dwell_days", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, [key])


def histogram(rows: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram between the smallest and largest value.

    Every bin is returned, empty ones too; the last bin includes its upper
    edge. Equal values are counted before anything is joined.
    """
    keys = list(keys)
    counts = (rows.where(F.col(value).isNotNull())
              .groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    flat = F.col("lo") == F.col("hi")
    edges = (
        counts.groupBy(*keys).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        .where(F.col("lo").isNotNull())
        .select(*keys, F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    )
    if not keys:
        counts, edges = (d.withColumn("_k", F.lit(0)) for d in (counts, edges))
    on = keys or ["_k"]
    step = (F.col("hi") - F.col("lo")) / bins
    filled = (
        counts.join(edges, on)
        .withColumn("bin", F.least(
            F.floor((F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
            F.lit(bins - 1)).cast("int"))
        .groupBy(*on, "bin").agg(F.sum("_n").alias("visits"))
    )
    return (
        edges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .join(filled, [*on, "bin"], "left")
        .select(*keys, "bin",
                (F.col("lo") + step * F.col("bin")).alias("bin_start"),
                (F.col("lo") + step * (F.col("bin") + 1)).alias("bin_end"),
                F.coalesce("visits", F.lit(0)).alias("visits"))
    )


def dwell_histogram(features: DataFrame) -> DataFrame:
    return histogram(dwell_below(features, 60), "dwell_days", 50)


def dwell_histogram_by_movement(features: DataFrame, movements: Sequence[str]) -> DataFrame:
    rows = dwell_below(features, 45).where(F.col("movement_type").isin(*movements))
    return histogram(rows, "dwell_days", 40, ["movement_type"])


def category_breakdown(features: DataFrame) -> DataFrame:
    """Count and share of each dwell category among closed visits."""
    total = closed(features).agg(F.count(F.lit(1))).scalar()
    return (closed(features).groupBy("dwell_category")
            .agg(F.count(F.lit(1)).alias("visits"))
            .withColumn("pct", F.col("visits") / total * 100))


def departure_curve(features: DataFrame) -> DataFrame:
    """Share of containers gone after each minute of dwell, and whether a chart shows it.

    Visits are counted per minute first. The running total is taken within each
    day and shifted by the total of the days before, so that no task sees more
    than the minutes of one day or one row per day.
    """
    minutes = (
        closed(features)
        .groupBy(F.floor(dwell_micros() / 60e6).alias("minute"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("day", F.floor(F.col("minute") / 1440))
    )
    one = Window.partitionBy(F.lit(0))
    days = (
        minutes.groupBy("day").agg(F.sum("n").alias("in_day"))
        .withColumn("before", F.sum("in_day").over(one.orderBy("day")) - F.col("in_day"))
        .withColumn("total", F.sum("in_day").over(one))
        .select("day", "before", "total")
    )
    limit = F.least(F.lit(CURVE_MAX_DAYS),
                    quantiles(features, "dwell_days", [0.99]).select("quantile").scalar())
    within = Window.partitionBy("day").orderBy("minute")
    return (
        minutes.withColumn("so_far", F.sum("n").over(within)).join(days, "day")
        .select((F.col("minute") / 1440.0).alias("dwell_days"),
                (F.col("before") + F.col("so_far")).alias("departed"),
                ((F.col("before") + F.col("so_far")) / F.col("total") * 100)
                .alias("departed_pct"))
        .withColumn("in_view", (F.col("dwell_days") <= limit).cast("int"))
    )


def departure_marks(features: DataFrame) -> DataFrame:
    """Dwell days by which 50, 75, 90 and 95 % of the containers have left."""
    return quantiles(features, "dwell_days", CURVE_MARKS).select(
        (F.col("prob") * 100).cast("int").alias("pct"),
        F.col("quantile").alias("dwell_days"))


def ranking(features: DataFrame, key: str, more_than: int) -> DataFrame:
    """Mean dwell per value of ``key`` with enough visits; ends are marked.

    With fewer than two values left there is nothing to compare and no mark.
    """
    means = (
        closed(features).where(F.col(key).isNotNull()).groupBy(key)
        .agg(mean_days(dwell_micros()).alias("mean_dwell"),
             F.count(F.lit(1)).alias("visits"))
        .where(F.col("visits") > more_than)
    )
    ends = means.agg(
        F.max(F.struct("mean_dwell", key))[key].alias("slowest"),
        F.min(F.struct("mean_dwell", key))[key].alias("fastest"))
    return means.withColumn("position", F.when(
        ends.select("slowest").scalar() != ends.select("fastest").scalar(),
        F.when(F.col(key) == ends.select("slowest").scalar(), "slowest")
         .when(F.col(key) == ends.select("fastest").scalar(), "fastest")))


def flow_path_ranking(features: DataFrame) -> DataFrame:
    return ranking(features, "flow_path", 50)


def shipping_line_ranking(features: DataFrame) -> DataFrame:
    return ranking(features, "shipping_line", 100)


def slowest_lines(features: DataFrame, k: int = 3) -> DataFrame:
    """The shipping lines with the longest mean dwell."""
    return (shipping_line_ranking(features).drop("position")
            .orderBy(F.desc("mean_dwell"), "shipping_line").limit(k))


def correlations(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    row = closed(features).agg(*[
        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}")
        for a, b in pairs])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                 F.col(f"{a}|{b}").alias("correlation"))
        for a, b in pairs])))


def port_comparison(features: DataFrame) -> DataFrame:
    """Mean import dwell of the terminal against published port figures."""
    mean = (closed(features).where(F.col("movement_type") == "import")
            .agg(mean_days(dwell_micros()).alias("terminal_mean")))
    ports = [F.struct(F.lit(port).alias("port"), F.lit(days).alias("port_mean"))
             for port, days, _ in bands.PORT_BENCHMARKS]
    return mean.select("terminal_mean", F.inline(F.array(*ports))).select(
        "port", "port_mean", "terminal_mean",
        (F.col("terminal_mean") - F.col("port_mean")).alias("difference_days"))


def path_comparison(features: DataFrame) -> DataFrame:
    """Mean dwell of each flow path against the terminal's mean."""
    overall = closed(features).agg(mean_days(dwell_micros())).scalar()
    return (
        closed(features).groupBy("flow_path")
        .agg(mean_days(dwell_micros()).alias("mean_dwell"))
        .withColumn("terminal_mean", overall)
        .withColumn("ratio", F.try_divide("mean_dwell", "terminal_mean"))
        .withColumn("comparison", F.when(F.col("ratio") > 1, "above")
                    .when(F.col("ratio") < 1, "below").otherwise("equal to"))
    )
