"""Revenue, opportunity cost and clearance priorities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import bands
from quayside.functions import visit as V
from quayside.functions.exact import mean_days, sum_days, sum_money
from quayside.params import AnalysisParams, TariffConfig

# --- fixed values: throughput cases ---
WHAT_IF = ((0.7, "-30%"), (1.0, "current"), (1.3, "+30%"), (1.5, "+50%"))
# ---------------------------------------
PRIORITY_COLUMNS = [
    "container_id", "dwell_days", "yard_block", "movement_type", "container_type",
    "size_ft", "shipping_line", "vessel_name", "storage_cost_usd",
]


def revenue_impact(features: DataFrame, tariff: TariffConfig) -> DataFrame:
    """Storage revenue against the cost of the capacity overstays block (one row).

    ``demurrage_daily`` spreads the overstay revenue over the mean overstay
    dwell (at least one day), as the published report does.
    """
    over = F.col("is_overstay") == 1
    rate = float(tariff.avg_throughput_revenue_per_teu)
    money = F.col("storage_cost_usd")
    sums = features.agg(
        sum_money(money).alias("total_revenue"),
        F.coalesce(sum_money(F.when(over, money)), F.lit(0.0)).alias("overstay_revenue"),
        F.count_if(over).alias("overstay_count"),
        F.coalesce(F.sum(F.when(over, F.col("teu_equivalent"))), F.lit(0)).alias("overstay_teu"),
        mean_days(F.when(over, V.dwell_micros())).alias("mean_overstay_days"),
    )
    return (
        sums.withColumns({
            "overstay_revenue_pct": F.when(
                F.col("total_revenue") > 0,
                F.try_divide("overstay_revenue", "total_revenue") * 100).otherwise(0.0),
            "opportunity_cost_daily": F.col("overstay_teu") * rate,
            "demurrage_daily": F.col("overstay_revenue") / F.greatest(
                F.col("mean_overstay_days"), F.lit(1.0)),
        })
        .withColumn("opportunity_exceeds", (
            F.col("opportunity_cost_daily") > F.col("demurrage_daily")).cast("int"))
    )


def what_if(features: DataFrame, tariff: TariffConfig) -> DataFrame:
    """Daily opportunity cost if the throughput revenue per TEU were different."""
    rate = float(tariff.avg_throughput_revenue_per_teu)
    cases = F.inline(F.array(*[
        F.struct(F.lit(m).alias("multiplier"), F.lit(name).alias("scenario"))
        for m, name in WHAT_IF]))
    return (
        revenue_impact(features, tariff)
        .select("overstay_teu", "demurrage_daily", cases)
        .withColumn("throughput_rate", F.lit(rate) * F.col("multiplier"))
        .withColumn("opportunity_cost_daily", F.col("overstay_teu") * F.col("throughput_rate"))
        .withColumn("vs_demurrage", F.when(
            F.col("opportunity_cost_daily") > F.col("demurrage_daily"), "Exceeds")
            .otherwise("Below"))
        .select("scenario", "multiplier", "throughput_rate",
                "opportunity_cost_daily", "vs_demurrage")
    )


def threshold_sensitivity(
    features: DataFrame, thresholds: Sequence[float] = (5, 10),
) -> DataFrame:
    """Overstay rate and count per threshold from one pass over the visits.

    Revenue does not depend on the threshold; the deltas are against the first.
    """
    days = F.col("dwell_days")
    counted = features.agg(
        F.count(days).alias("closed"),
        F.coalesce(sum_money(F.col("storage_cost_usd")), F.lit(0.0)).alias("revenue"),
        *[F.count_if(days > t).alias(f"over_{i}") for i, t in enumerate(thresholds)])
    return counted.select("closed", "revenue", "over_0", F.inline(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold_days"),
                 F.col(f"over_{i}").alias("overstay_count"))
        for i, t in enumerate(thresholds)]))).select(
        "threshold_days", "overstay_count",
        (F.try_divide("overstay_count", "closed") * 100).alias("overstay_rate"),
        F.col("revenue").alias("total_revenue"),
        (F.col("overstay_count") - F.col("over_0")).alias("count_delta"),
        (F.try_divide(F.col("overstay_count") - F.col("over_0"), "closed") * 100)
        .alias("rate_delta"),
    )


def saved_day_value(
    features: DataFrame, tariff: TariffConfig, params: AnalysisParams = AnalysisParams(),
) -> DataFrame:
    """Storage revenue given up if every container left one day earlier."""
    shorter = F.greatest(F.col("dwell_days") - 1.0, F.lit(0.0))
    reduced = V.storage_cost(shorter, F.col("movement_type"), F.col("container_type"),
                             F.col("teu_equivalent"), tariff)
    rate = float(tariff.avg_throughput_revenue_per_teu)
    return features.where(F.col("dwell_days").isNotNull()).agg(
        sum_money(F.col("storage_cost_usd")).alias("revenue_now"),
        sum_money(reduced).alias("revenue_one_day_less"),
        (F.sum(F.when(F.col("is_overstay") == 1, F.col("teu_equivalent")).otherwise(0)) * rate)
        .alias("throughput_value_of_day"),
    ).withColumn("revenue_given_up", F.col("revenue_now") - F.col("revenue_one_day_less"))


def overstay_opportunity(features: DataFrame, tariff: TariffConfig, keys: Sequence[str]) -> DataFrame:
    """Opportunity cost of overstays per group: sum of TEU x days beyond free x rate."""
    free_micros = V.free_days(F.col("movement_type"), tariff).cast("bigint") * 86_400_000_000
    beyond = F.when(F.col("is_overstay") == 1,
                    F.col("teu_equivalent") * (V.dwell_micros() - free_micros))
    rate = float(tariff.avg_throughput_revenue_per_teu)
    return features.groupBy(*keys).agg(
        (F.coalesce(sum_days(beyond.cast("bigint")), F.lit(0.0)) * rate).alias("opportunity_cost"),
        F.coalesce(sum_money(F.col("storage_cost_usd")), F.lit(0.0)).alias("storage_revenue"),
    ).withColumn("net_impact", F.col("opportunity_cost") - F.col("storage_revenue"))


def priority_columns(features: DataFrame) -> list[str]:
    """The list's columns that the input has."""
    return [c for c in PRIORITY_COLUMNS if c in features.columns]


def priority_list(features: DataFrame, top: int = 30, fallback: int = 50) -> DataFrame:
    """Containers to clear first: overstays by cost (by dwell without a tariff).

    When nothing overstays, the longest-dwelling containers stand in. Which of
    the two applies is decided inside the plan.
    """
    cost = F.coalesce("storage_cost_usd", F.lit(float("-inf")))
    order = [F.desc(cost), F.desc_nulls_last("dwell_days"), F.asc("visit_id")]
    columns = ["visit_id", *priority_columns(features)]
    over = features.where(F.col("is_overstay") == 1)
    none_over = over.limit(1).agg(F.count(F.lit(1))).scalar() == 0
    longest = (features.where(F.col("dwell_days").isNotNull() & none_over)
               .orderBy(F.desc("dwell_days"), F.asc("visit_id")).limit(fallback))
    return (
        over.orderBy(*order).limit(top).select(*columns)
        .unionByName(longest.orderBy(*order).limit(top).select(*columns))
    )


def gate_exits(features: DataFrame) -> DataFrame:
    """Containers taken out of each block per day."""
    return features.where(F.col("gate_out_time").isNotNull()).groupBy(
        "yard_block", F.to_date("gate_out_time").alias("date")
    ).agg(F.count(F.lit(1)).alias("retrievals"))


def reshuffle_cost(block_day: DataFrame, exits: DataFrame) -> DataFrame:
    """Expected cost range of rehandling moves per block and day."""
    height = F.col("avg_stack_height")
    joined = block_day.where(height.isNotNull()).join(exits, ["yard_block", "date"])
    moves = [F.col("retrievals") * bands.reshuffle_probability(height, end) for end in (0, 1)]
    return joined.select(
        "yard_block", "date", "avg_stack_height", "retrievals",
        moves[0].alias("reshuffles_low"), moves[1].alias("reshuffles_high"),
        (moves[0] * bands.RESHUFFLE_COST_USD[0]).alias("cost_low_usd"),
        (moves[1] * bands.RESHUFFLE_COST_USD[1]).alias("cost_high_usd"))
