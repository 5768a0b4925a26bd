"""Visit features: one lazy projection over the visits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import visit as V
from quayside.params import AnalysisParams, TariffConfig

FEATURE_COLUMNS = [
    "is_high_cube", "iso_container_group", "dwell_hours", "dwell_days",
    "teu_equivalent", "dwell_category", "is_overstay", "storage_cost_usd",
    "flow_path",
]


def analysis_window(visits: DataFrame, params: AnalysisParams) -> DataFrame:
    """Date window, container types and blocks to analyse (pushed to the scan)."""
    out = visits
    if params.analysis_date_start:
        start = F.lit(params.analysis_date_start).cast("timestamp_ntz")
        out = out.where(F.col("gate_in_time") >= start)
    if params.analysis_date_end:
        after = F.date_add(F.lit(params.analysis_date_end).cast("date"), 1)
        out = out.where(F.col("gate_in_time") < after.cast("timestamp_ntz"))
    if params.container_types_focus:
        out = out.where(F.col("container_type").isin(*params.container_types_focus))
    if params.target_blocks:
        out = out.where(F.col("yard_block").isin(*params.target_blocks))
    return out


def minimal_columns(visits: DataFrame) -> DataFrame:
    """Only the required columns: the smallest input every operator accepts."""
    from quayside.schema import REQUIRED_COLUMNS

    key = ["visit_id"] if "visit_id" in visits.columns else []
    return visits.select(*key, *REQUIRED_COLUMNS)


def visit_features(
    visits: DataFrame,
    params: AnalysisParams = AnalysisParams(),
    tariff: TariffConfig | None = None,
) -> DataFrame:
    """All per-visit features. Absent optional inputs give null or neutral values."""
    present = set(visits.columns)
    threshold = params.overstay_threshold_days
    container_type = F.col("container_type") if "container_type" in present else F.lit("unknown")
    if "iso_type_code" in present:
        code = F.col("iso_type_code")
        high_cube, group = V.is_high_cube(code), V.iso_group(code, container_type)
    else:
        high_cube, group = F.lit(False), container_type
    if {"gate_in_mode", "gate_out_mode"} <= present:
        path = V.flow_path(F.col("gate_in_mode"), F.col("gate_out_mode"))
    else:
        path = F.lit("unknown")
    hours, days = F.col("dwell_hours"), F.col("dwell_days")
    return (
        visits.withColumns({
            "is_high_cube": high_cube,
            "iso_container_group": group,
            "dwell_hours": V.dwell_hours(),
            "teu_equivalent": V.teu(F.col("size_ft"), params.teu_for_45ft),
            "flow_path": path,
        })
        .withColumn("dwell_days", hours / 24.0)
        .withColumns({
            "dwell_category": V.dwell_category(hours, days, threshold),
            "is_overstay": V.is_overstay(days, threshold),
            "storage_cost_usd": V.storage_cost(
                days, F.col("movement_type"), container_type,
                F.col("teu_equivalent"), tariff),
        })
        .select(*visits.columns, *FEATURE_COLUMNS)
    )


def feature_sanity(features: DataFrame) -> DataFrame:
    """Infinite values over all numeric columns; absent values in key features."""
    numeric = [f.name for f in features.schema if f.dataType.typeName() == "double"]
    infinite = [F.count_if(F.abs(F.col(c)) == float("inf")) for c in numeric]
    total = infinite[0]
    for column in infinite[1:]:
        total = total + column
    hours = F.col("dwell_hours")
    return features.agg(
        total.alias("infinite_values"),
        F.count_if(hours.isNull() | F.isnan(hours)).alias("missing_dwell_hours"),
        F.count_if(F.col("teu_equivalent").isNull()).alias("missing_teu_equivalent"),
    )


def open_visit_age(visits: DataFrame, as_of: str | None = None) -> DataFrame:
    """Age of the containers still in the yard at ``as_of`` (default: now)."""
    moment = (F.lit(as_of).cast("timestamp_ntz") if as_of else F.localtimestamp())
    return (visits.where(F.col("gate_out_time").isNull())
            .withColumn("age_days", V.age_days(moment)))


def one_hot(features: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Indicator columns for the given categories.

    Kept apart from segmentation, where categories would outweigh dwell.
    """
    return features.withColumns({
        f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0))
        for v in values
    })
