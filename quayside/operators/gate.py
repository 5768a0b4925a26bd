"""Gate traffic and vessel surges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SURGE_SHARE = 0.15
PEAK_QUANTILE = 0.80


def gate_events(visits: DataFrame) -> DataFrame:
    """One row per gate passage (ts, direction), from one pass over the visits."""
    passage = F.inline(F.array(
        F.struct(F.col("gate_in_time").alias("ts"), F.lit("in").alias("direction")),
        F.struct(F.col("gate_out_time").alias("ts"), F.lit("out").alias("direction")),
    ))
    return visits.select(passage).where(F.col("ts").isNotNull())


def hourly_counts(visits: DataFrame) -> DataFrame:
    """Gate passages per date and hour."""
    return (
        gate_events(visits)
        .groupBy(F.to_date("ts").alias("date"), F.hour("ts").alias("hour"))
        .agg(F.count(F.lit(1)).alias("gate_throughput_hr"))
    )


def gate_hourly(visits: DataFrame) -> DataFrame:
    """Hourly counts with a flag on the busiest fifth of the hours.

    The threshold is taken over the hours (their number is bounded by the
    calendar), not over the visits.
    """
    hourly = hourly_counts(visits)
    threshold = hourly.agg(F.percentile("gate_throughput_hr", F.lit(PEAK_QUANTILE))).scalar()
    return hourly.withColumn(
        "peak_hour_flag", (F.col("gate_throughput_hr") >= threshold).cast("int"))


def hourly_by_direction(visits: DataFrame) -> DataFrame:
    """Gate passages by hour of day, in and out apart."""
    return gate_events(visits).groupBy(F.hour("ts").alias("hour"), "direction").agg(
        F.count(F.lit(1)).alias("gate_moves"))


def mean_by_hour(hourly: DataFrame) -> DataFrame:
    """Mean passages per hour of day over the days on which the hour occurs."""
    return hourly.groupBy("hour").agg(F.avg("gate_throughput_hr").alias("mean_moves"))


def vessel_surges(features: DataFrame, total_capacity: float, share: float = SURGE_SHARE) -> DataFrame:
    """Days on which one vessel brings at least a share of the yard's capacity."""
    return _vessel_load(features).where(
        F.col("teu_equivalent") >= total_capacity * share
    ).withColumn("vessel_surge_flag", F.lit(1))


def _vessel_load(features: DataFrame, *more: str) -> DataFrame:
    if "vessel_name" not in features.columns:
        features = features.withColumn("vessel_name", F.lit(None).cast("string"))
    return (
        features.where(F.col("gate_in_time").isNotNull() & F.col("vessel_name").isNotNull())
        .groupBy(F.to_date("gate_in_time").alias("date"), "vessel_name", *more)
        .agg(F.sum("teu_equivalent").alias("teu_equivalent"))
    )


def block_vessel_surges(features: DataFrame, blocks: DataFrame, share: float = SURGE_SHARE) -> DataFrame:
    """The stricter reading: one vessel takes more than a share of one block."""
    load = _vessel_load(features, "yard_block").join(
        blocks.select("yard_block", "teu_capacity"), "yard_block")
    return load.where(
        F.col("teu_equivalent") > F.col("teu_capacity") * share
    ).withColumn("vessel_surge_flag", F.lit(1))
