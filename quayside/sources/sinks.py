"""Writing results. Tables go to parquet; JSON and CSV are for the edge."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.occupancy import type_mix_json
from quayside.plans.validation import Validation
from quayside.sources.visits import POSITION, RAW


def write_clean_visits(validation: Validation, path: str) -> bool:
    """Validated visits, unless the data failed; tells whether anything was written."""
    if validation.clean is None or validation.status == "FAIL":
        return False
    helpers = [c for c in (POSITION, *RAW.values()) if c in validation.clean.columns]
    validation.clean.drop(*helpers).write.mode("overwrite").parquet(path)
    return True


def write_quality_report(validation: Validation, path: str) -> None:
    """The report as one JSON document, written through Spark to any file system."""
    text = json.dumps(validation.report(), default=str, ensure_ascii=False)
    spark = validation.visits.sparkSession
    spark.range(1).select(F.lit(text).alias("value")).write.mode("overwrite").text(path)


def write_quality_table(validation: Validation, path: str) -> None:
    validation.checks.write.mode("overwrite").json(path)


def write_by_date(df: DataFrame, path: str) -> None:
    """Partitioned by month, as a day holds few rows; one shuffle, so that a month is few files."""
    (df.withColumn("month", F.date_format("date", "yyyy-MM")).repartition("month")
     .write.mode("overwrite").partitionBy("month").parquet(path))


def write_if_any(df: DataFrame, path: str) -> bool:
    """Write only a result that has rows."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_csv(df: DataFrame, path: str) -> None:
    """Flat text with a header; map columns become JSON text."""
    flat = type_mix_json(df) if "type_mix" in df.columns else df
    flat.write.mode("overwrite").option("header", True).csv(path)


def write_labels(labelled: DataFrame, path: str) -> None:
    """Segment labels keyed by visit, so that repeat visits keep their own label."""
    labelled.select("visit_id", "container_id", "cluster").write.mode("overwrite").parquet(path)


def write_forecast(curve: DataFrame, accuracy: DataFrame, path: str) -> None:
    curve.write.mode("overwrite").json(f"{path}/curve")
    accuracy.write.mode("overwrite").json(f"{path}/accuracy")


def write_models(metrics: DataFrame, chosen: DataFrame, path: str) -> None:
    """Metrics of all models, and the chosen one with its warning."""
    metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    chosen.write.mode("overwrite").parquet(f"{path}/chosen")


def write_profiles(profiles: DataFrame, recommendations: DataFrame, path: str) -> None:
    profiles.write.mode("overwrite").parquet(f"{path}/profiles")
    recommendations.write.mode("overwrite").parquet(f"{path}/recommendations")
