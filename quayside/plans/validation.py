"""From raw visit files to validated visits and a quality report."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from quayside.operators import quality as Q
from quayside.schema import missing_required, present_optional
from quayside.session import cut_lineage
from quayside.sources.visits import load_visits


@dataclass
class Validation:
    """Lazy checks and clean rows; ``report`` and ``status`` run jobs."""

    checks: DataFrame
    clean: DataFrame | None
    visits: DataFrame
    configs: dict

    @property
    def status(self) -> str:
        return Q.status(self.checks).first()["status"]

    def report(self) -> dict:
        """The quality report as a plain dict, built from the (bounded) check table."""
        rows = self.checks.collect()
        found = lambda level: [
            {"check": r["check"], "column": r["column"], "metric": r["metric"], "value": r["value"]}
            for r in rows if r["level"] == level]
        errors, warnings = found("error"), found("warning")
        out = {
            "status": "FAIL" if errors else "WARN" if warnings else "PASS",
            "errors": errors, "warnings": warnings,
            "optional_columns_present": present_optional(self.visits.columns),
            **self.configs,
        }
        if self.clean is None:
            return out
        value = {(r["check"], r["column"], r["metric"]): r["value"] for r in rows}
        total = int(value["total_rows", "*", "rows"])
        out["column_quality"] = {
            column: {"nulls": int(v), "null_pct": value["nulls", column, "pct"]}
            for (check, column, metric), v in value.items()
            if check == "nulls" and metric == "rows"}
        cover = Q.coverage(self.clean).first()
        out.update(
            total_rows=total, valid_rows=cover["valid_rows"],
            excluded_rows=total - cover["valid_rows"],
            unique_containers=cover["unique_containers"])
        if cover["start_date"] is not None:
            out["date_range"] = {
                "start": str(cover["start_date"]), "end": str(cover["end_date"]),
                "span_days": cover["span_days"]}
        profiling = {
            r["column"]: {k: v for k, v in r.asDict().items() if k != "column" and v is not None}
            for r in Q.numeric_profile(self.clean).collect()}
        for r in Q.categorical_profile(self.clean).collect():
            profiling[r["column"]] = {"count": r["count"], "unique": r["unique"], "top_values": {}}
        for r in Q.top_values(self.clean).orderBy("column", "rank").collect():
            profiling[r["column"]]["top_values"][r["value"]] = r["rows"]
        out["profiling"] = profiling
        return out


def validate(
    spark: SparkSession,
    visits: DataFrame,
    as_of: str | None = None,
    yard_given: bool = False,
    tariff_given: bool = False,
    from_files: bool = False,
) -> Validation:
    """Check ``visits``; without all required columns no job is run at all.

    Visits ``from_files``, as ``load_visits`` gives them, are read there again and not written once more.
    """
    configs = {"yard_config_provided": yard_given, "tariff_config_provided": tariff_given}
    if missing_required(visits.columns):
        return Validation(Q.schema_checks(spark, visits.columns), None, visits, configs)
    repeated = cut_lineage(Q.repeated_keys(visits)) if from_files else None
    clean = Q.clean_visits(visits, as_of, repeated)
    checks = cut_lineage(Q.quality_checks(visits, as_of, repeated))  # a few dozen rows, used repeatedly
    return Validation(checks, clean, visits, configs)


def validate_files(
    spark: SparkSession, path: str, fmt: str = "csv", as_of: str | None = None,
    yard_given: bool = False, tariff_given: bool = False,
) -> Validation:
    """Load and check visit files; files that cannot be read give a FAIL report, not an error."""
    try:
        return validate(spark, load_visits(spark, path, fmt), as_of, yard_given, tariff_given, from_files=True)
    except (PySparkException, Py4JJavaError) as error:
        checks = spark.createDataFrame([("unreadable_file", "error", "*", "files", 1.0)], Q.CHECK_SCHEMA)
        configs = {"yard_config_provided": yard_given, "tariff_config_provided": tariff_given,
                   "reason": str(error).splitlines()[0][:300]}
        return Validation(checks, None, spark.createDataFrame([], "visit_id string"), configs)
