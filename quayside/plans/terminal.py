"""The whole analysis of a terminal, from visits to reports, as lazy tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quayside.operators import dwell, features, forecast, gate, impact, occupancy, segments
from quayside.params import AnalysisParams, TariffConfig, YardConfig
from quayside.session import cut_lineage
from quayside.sources import sinks
from quayside.sources.configs import block_dimension


@dataclass
class TerminalTables:
    features: DataFrame
    block_day: DataFrame
    gate_hourly: DataFrame
    surges: DataFrame | None


def feature_tables(
    spark: SparkSession,
    visits: DataFrame,
    params: AnalysisParams = AnalysisParams(),
    yard: YardConfig | None = None,
    tariff: TariffConfig | None = None,
    materialise: bool = True,
) -> TerminalTables:
    """Feature tables of validated visits.

    Many reports read the visit features and the block-days, so both are written
    once, as columnar files in the shared folder, instead of being recomputed.
    """
    chosen = features.analysis_window(visits, params)
    feats = features.visit_features(chosen, params, tariff)
    if materialise:
        feats = cut_lineage(feats)
    block_day = occupancy.block_day_features(
        feats, block_dimension(spark, yard), capacity_from_data=False)
    if materialise:
        block_day = cut_lineage(block_day)
    capacity = yard.total_capacity if yard else 0
    surges = gate.vessel_surges(feats, capacity) if capacity else None
    return TerminalTables(feats, block_day, gate.gate_hourly(feats), surges)


def write_features(tables: TerminalTables, path: str) -> None:
    tables.features.write.mode("overwrite").parquet(f"{path}/dwell_features")
    sinks.write_by_date(tables.block_day, f"{path}/block_daily_features")
    tables.gate_hourly.write.mode("overwrite").parquet(f"{path}/gate_hourly")
    if tables.surges is not None:
        sinks.write_if_any(tables.surges, f"{path}/vessel_surges")


def forecasts(tables: TerminalTables, params: AnalysisParams, optimise: bool = True):
    """Both models over the terminal's daily load, and the better one."""
    series = forecast.split_series(forecast.daily_series(tables.block_day))
    horizon = params.forecast_horizon_days
    first = forecast.holt_winters(series, horizon)
    second = (forecast.optimised_holt_winters if optimise
              else forecast.seasonal_moving_average)(series, horizon)
    return first, second, forecast.select_model(first, second)


def outlook(models: DataFrame, yard: YardConfig, params: AnalysisParams = AnalysisParams()) -> DataFrame:
    """When the forecast load passes the warning level of the parameters."""
    return forecast.breach(models, yard.total_capacity, params.utilization_warning_pct)


@dataclass
class Segmentation:
    metrics: DataFrame
    chosen: DataFrame
    labelled: DataFrame
    profiles: DataFrame
    revenue: DataFrame
    recommendations: DataFrame


def segmentation(
    feats: DataFrame, params: AnalysisParams = AnalysisParams(), tariff: TariffConfig | None = None,
    ks=range(2, 11), n_init: int = 10,
) -> Segmentation:
    """From visit features to labels, profiles, names, revenue and advice.

    ``num_segments`` fixes the number of segments; without it the metrics choose.
    Advice is ordered by opportunity cost where a tariff is given, else by dwell.
    """
    if params.num_segments is not None:
        ks = [params.num_segments]
    sweep = segments.sweep(feats, ks, n_init=n_init, seed=params.random_seed)
    chosen = cut_lineage(segments.select_best(sweep.metrics, max_k=max(ks)) if params.num_segments is not None
                         else segments.select_best(sweep.metrics))
    best = chosen.first()  # one row
    labelled = cut_lineage(sweep.label(best["algorithm"], best["k"]))
    profiles = segments.segment_labels(segments.segment_profiles(labelled))
    cost = impact.overstay_opportunity(labelled, tariff, ["cluster"]) if tariff is not None else None
    return Segmentation(sweep.metrics, chosen, labelled, profiles, segments.revenue_by_segment(labelled),
                        segments.recommendations(profiles, cost))


def write_segmentation(found: Segmentation, path: str) -> None:
    sinks.write_models(found.metrics, found.chosen, f"{path}/models")
    sinks.write_labels(found.labelled, f"{path}/labels")
    sinks.write_profiles(found.profiles, found.recommendations, f"{path}/segments")


def reports(tables: TerminalTables, tariff: TariffConfig | None = None) -> dict[str, DataFrame]:
    """The report tables by name; those that need a tariff only with one."""
    f, b = tables.features, tables.block_day
    out = {
        "executive_kpis": dwell.executive_kpis(f, b),
        "category_breakdown": dwell.category_breakdown(f),
        "dwell_histogram": dwell.dwell_histogram(f),
        "dwell_by_type": dwell.dwell_by(f, "container_type"),
        "dwell_by_movement": dwell.dwell_by_movement(f),
        "departure_curve": dwell.departure_curve(f),
        "departure_marks": dwell.departure_marks(f),
        "block_summary": occupancy.block_summary(b),
        "weekly_utilization": occupancy.weekly_utilization(b),
        "gate_by_hour": gate.mean_by_hour(tables.gate_hourly),
        "priority_list": impact.priority_list(f),
        "congestion_flags": occupancy.congestion_flags(occupancy.block_summary(b)),
        "peak_events": occupancy.peak_events(b),
        "plug_trend": occupancy.plug_trend(b),
        "gate_by_direction": gate.hourly_by_direction(f),
        "port_comparison": dwell.port_comparison(f),
        "path_comparison": dwell.path_comparison(f),
    }
    if "flow_path" in f.columns:
        out["flow_path_ranking"] = dwell.flow_path_ranking(f)
    if "shipping_line" in f.columns:
        out["shipping_line_ranking"] = dwell.shipping_line_ranking(f)
    if tariff is not None:
        out["revenue_impact"] = impact.revenue_impact(f, tariff)
        out["what_if"] = impact.what_if(f, tariff)
    return out
