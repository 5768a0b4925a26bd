"""Headline queries at one scale; prints one JSON line.

Environment: BENCH_SF_DIR (tables, default /root/testdata/sf0.1) and BENCH_CPUS
(cores of the local session, default 8). Every query runs to completion into a
sink that discards the rows. ``scenario`` is the whole analysis in one go:
validation with its report, features, block-days, gate hours, surges, reports and
both forecasts. ``segmentation`` is one k with all ten restarts of both algorithms,
selection, labels and profiles; BENCH_FULL_SWEEP=1 takes every k from 2 to 10.
"""

from __future__ import annotations

import json
import os
import time

from quayside.operators import forecast, segments
from quayside.params import SAMPLE_TARIFF, SAMPLE_YARD, AnalysisParams
from quayside.plans import catalog, terminal
from quayside.plans.validation import validate
from quayside.session import clear_scratch, cut_lineage, local_session
from quayside.sources.order_visits import visits

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "dwell_features", "tiered_cost", "block_day_utilization", "gate_hourly_peak",
    "revenue_impact", "dwell_by_type", "departure_curve", "priority_list",
    "clean_visits", "row_checks", "numeric_profile", "nearest_centroid",
    "segment_profiles", "holt_winters", "forecast_choice",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def scenario(spark) -> None:
    params = AnalysisParams()
    checked = validate(spark, cut_lineage(visits(spark, SF_DIR)))
    checked.report()
    tables = terminal.feature_tables(spark, checked.clean, params, SAMPLE_YARD, SAMPLE_TARIFF)
    for df in (tables.gate_hourly, tables.surges):
        drain(df)
    for df in terminal.reports(tables, SAMPLE_TARIFF).values():
        drain(df)
    first, second, best = terminal.forecasts(tables, params)
    drain(best)
    drain(forecast.forecast_curve(first))


def segmentation(spark) -> None:
    params = AnalysisParams(num_segments=None if os.environ.get("BENCH_FULL_SWEEP") else 4)
    found = terminal.segmentation(catalog.feats(spark, SF_DIR), params, SAMPLE_TARIFF)
    for df in (found.profiles, found.revenue, found.recommendations):
        drain(df)


def kmeans_fit(spark) -> None:
    points = cut_lineage(segments.weighted_points(
        segments.scaled_features(catalog.feats(spark, SF_DIR))))
    segments.fit_kmeans(points, 8, n_init=1, seed=42)


def main() -> None:
    spark = local_session(CPUS, "quayside-bench")
    drain(catalog.dwell_features(spark, SF_DIR))  # warm-up: JIT and file cache
    times: dict[str, float] = {}

    def timed(name, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        timed(name, lambda: drain(catalog.QUERIES[name](spark, SF_DIR)))
    timed("kmeans_fit", lambda: kmeans_fit(spark))
    timed("scenario", lambda: scenario(spark))
    timed("segmentation", lambda: segmentation(spark))
    rows = visits(spark, SF_DIR).count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "visits": rows, "cpus": CPUS, "driver_memory": spark.conf.get("spark.driver.memory"),
    }))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
