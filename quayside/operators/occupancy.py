"""Block x day occupancy of the yard.

A visit occupies its block on every day from gate-in to gate-out, both included
(an open visit up to the last day of the calendar). Expanding visits into days
multiplies the data by the dwell time, so the default way is to keep only the
changes: +1 on the day of entry, -1 on the day after exit. Changes are combined
map-side into (block, type, day) totals, whose number does not depend on the
number of visits, and a running sum over the days turns them into occupancy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.session import cut_lineage

MEASURES = ["containers", "teu", "overstay_teu", "tier_sum", "tier_count"]


def _stays(features: DataFrame, without_block: bool = False) -> DataFrame:
    """Day range and weights of each visit.

    A visit that leaves before it enters occupies nothing, yet its block stays
    in the grid: it keeps its entry day with zero weights.
    """
    first, last = F.to_date("gate_in_time"), F.to_date("gate_out_time")
    counts = F.when(last < first, 0).otherwise(1).cast("bigint")
    fractional = dict(features.dtypes)["teu_equivalent"] == "double"
    teu = F.col("teu_equivalent").cast("double" if fractional else "bigint")
    tier = (F.col("yard_tier").cast("bigint") if "yard_tier" in features.columns
            else F.lit(None).cast("bigint"))
    kind = F.col("container_type") if "container_type" in features.columns else F.lit("unknown")
    placed = F.lit(True) if without_block else F.col("yard_block").isNotNull()
    return features.where(F.col("gate_in_time").isNotNull() & placed).select(
        "yard_block", kind.alias("container_type"),
        first.alias("first_day"),
        F.when(last.isNotNull(), F.greatest(first, last)).alias("last_day"),
        counts.alias("containers"),
        (counts * teu).alias("teu"),
        (counts * teu * F.col("is_overstay")).alias("overstay_teu"),
        (counts * F.coalesce(tier, F.lit(0))).alias("tier_sum"),
        (counts * tier.isNotNull().cast("bigint")).alias("tier_count"),
    )


def calendar_bounds(features: DataFrame) -> DataFrame:
    """First and last gate-in day: one row (lo, hi)."""
    return features.agg(F.to_date(F.min("gate_in_time")).alias("lo"),
                        F.to_date(F.max("gate_in_time")).alias("hi"))


def _calendar(bounds: DataFrame) -> F.Column:
    return F.sequence(bounds.select("lo").scalar(), bounds.select("hi").scalar())


def calendar_days(features: DataFrame) -> DataFrame:
    """Every day between the first and the last gate-in."""
    return calendar_bounds(features).select(F.explode(F.sequence("lo", "hi")).alias("date"))


def _dense(sparse: DataFrame, bounds: DataFrame) -> DataFrame:
    """Per (block, type) group, the given days plus a zero row for every day.

    A group's sparse days travel as one array (bounded by the calendar), so the
    partitioning by group made here also serves whatever follows.
    """
    types = dict(sparse.dtypes)
    zero = [F.lit(0).cast(types[m]).alias(m) for m in MEASURES]
    calendar = F.transform("calendar", lambda day: F.struct(day.alias("date"), *zero))
    return (
        sparse.groupBy("yard_block", "container_type")
        .agg(F.collect_list(F.struct("date", *MEASURES)).alias("days"))
        .withColumn("calendar", _calendar(bounds))
        .select("yard_block", "container_type",
                F.inline(F.concat("days", calendar)))
        .groupBy("yard_block", "container_type", "date")
        .agg(*[F.sum(m).alias(m) for m in MEASURES])
    )


def visit_changes(features: DataFrame) -> DataFrame:
    """Net changes per (block, type, day), and the number of entries on that day.

    Weights are added on the day of entry and taken off on the day after exit; what
    leaves after the calendar ends is kept. Fractional TEU are sums of doubles.
    """
    change = F.explode(F.array(
        F.struct(F.col("first_day").alias("date"), F.lit(1).alias("sign")),
        F.struct(F.date_add("last_day", 1).alias("date"), F.lit(-1).alias("sign")),
    ))
    return (
        _stays(features, without_block=True).select("*", change.alias("c"))
        .where(F.col("c.date").isNotNull())
        .groupBy("yard_block", "container_type", F.col("c.date").alias("date"))
        .agg(*[F.sum(F.col(m) * F.col("c.sign")).alias(m) for m in MEASURES],
             F.count_if(F.col("c.sign") == 1).alias("entries"))
    )


def _by_changes(features: DataFrame) -> DataFrame:
    """Dense (block, type, day) occupancy from entry and exit changes, in one scan.

    The changes are written, so the visits are read when this is called, and only then. The
    calendar is a narrow aggregate of them: its ends are the first and the last day with an
    entry. Visits without a block count for it, and for nothing else.
    """
    changes = cut_lineage(visit_changes(features))
    bounds = changes.where(F.col("entries") > 0).agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    groups = (
        changes.where(F.col("yard_block").isNotNull()).groupBy("yard_block", "container_type")
        .agg(F.collect_list(F.struct("date", *MEASURES)).alias("days"))
        .withColumns({"lo": bounds.select("lo").scalar(), "hi": bounds.select("hi").scalar()}))
    types = dict(changes.dtypes)
    zero = [F.lit(0).cast(types[m]).alias(m) for m in MEASURES]
    calendar = F.transform(F.sequence("lo", "hi"), lambda day: F.struct(day.alias("date"), *zero))
    running = Window.partitionBy("yard_block", "container_type").orderBy("date")
    # Exits after the last day fall outside the calendar. Nothing lies before
    # it, because the calendar starts with the first entry.
    return (
        groups.select("yard_block", "container_type", "hi", F.inline(F.concat("days", calendar)))
        .groupBy("yard_block", "container_type", "date")
        .agg(*[F.sum(m).alias(m) for m in MEASURES], F.max("hi").alias("hi"))
        .select("yard_block", "container_type", "date", "hi",
                *[F.sum(m).over(running).alias(m) for m in MEASURES])
        .where(F.col("date") <= F.col("hi")).drop("hi")
    )


def _by_expansion(features: DataFrame) -> DataFrame:
    """The same totals by expanding each visit into its days (short stays only)."""
    bounds = calendar_bounds(features)
    hi = bounds.select("hi").scalar()
    end = F.least(F.coalesce("last_day", hi), hi)
    expanded = (
        _stays(features).select(
            "yard_block", "container_type", *MEASURES,
            F.explode(F.sequence("first_day", end)).alias("date"))
        .groupBy("yard_block", "container_type", "date")
        .agg(*[F.sum(m).alias(m) for m in MEASURES])
    )
    return _dense(expanded, bounds)


def occupancy_by_type(features: DataFrame, method: str = "changes") -> DataFrame:
    """Dense occupancy per (block, container type, day).

    ``changes`` writes the changes when it is called; ``expansion`` is lazy.
    """
    return {"changes": _by_changes, "expansion": _by_expansion}[method](features)


def block_occupancy(by_type: DataFrame, *more: F.Column) -> DataFrame:
    """Totals per (block, day), with further aggregates if given."""
    return by_type.groupBy("yard_block", "date").agg(
        F.sum("containers").alias("container_count"),
        F.sum("teu").alias("teu_occupied"),
        F.sum("overstay_teu").alias("overstay_teu"),
        F.sum("tier_sum").alias("tier_sum"),
        F.sum("tier_count").alias("tier_count"),
        F.sum(F.when(F.col("container_type") == "reefer", F.col("containers"))
              .otherwise(0)).alias("reefer_count"),
        *more,
    )


def type_mix(by_type: DataFrame) -> DataFrame:
    """Share of each container type per block and day, in percent (long form)."""
    whole = Window.partitionBy("yard_block", "date")
    return (
        by_type.withColumn("_all", F.sum("containers").over(whole))
        .where((F.col("containers") > 0) & F.col("container_type").isNotNull())
        .select("date", "yard_block", "container_type",
                F.col("containers").alias("container_count"),
                (F.col("containers") / F.col("_all") * 100).alias("type_pct"))
    )


def _rounded(column: F.Column, places: int, rounded: bool) -> F.Column:
    return F.bround(column, places) if rounded else column


def block_day_features(
    features: DataFrame,
    blocks: DataFrame,
    method: str = "changes",
    capacity_from_data: bool = False,
    rounded: bool = True,
) -> DataFrame:
    """Utilisation metrics for every block on every day.

    ``blocks`` is the block dimension (see ``sources.configs``). With
    ``capacity_from_data`` the highest occupancy seen stands in for a block
    that has no configured capacity; otherwise its utilisation is null.
    """
    by_type = occupancy_by_type(features, method)
    present = (F.col("containers") > 0) & F.col("container_type").isNotNull()
    daily = block_occupancy(by_type, F.array_sort(F.collect_list(
        F.when(present, F.struct("container_type", "containers")))).alias("mix")
    ).join(
        blocks.select("yard_block", "teu_capacity", "reefer_plug_count"),
        "yard_block", "left")
    capacity = F.col("teu_capacity")
    if capacity_from_data:
        seen = F.max("teu_occupied").over(Window.partitionBy("yard_block"))
        daily = daily.withColumn("teu_capacity", F.coalesce(capacity, seen).cast("int"))
    teu = F.col("teu_occupied")
    usable = F.when(capacity > 0, capacity)
    plugs = F.when(F.col("reefer_plug_count") > 0, F.col("reefer_plug_count"))
    share = lambda e: F.struct(
        e["container_type"],
        _rounded(e["containers"] / F.col("container_count") * 100, 1, rounded))
    return daily.select(
        "date", "yard_block", "container_count", "teu_occupied", "teu_capacity",
        _rounded(teu / usable * 100, 1, rounded).alias("block_utilization_pct"),
        _rounded(F.col("reefer_count") / plugs * 100, 1, rounded)
        .alias("reefer_plug_util_pct"),
        _rounded(F.try_divide("tier_sum", "tier_count"), 2, rounded)
        .alias("avg_stack_height"),
        F.when(teu > 0, _rounded(F.try_divide(F.col("overstay_teu"), teu), 3, rounded))
        .otherwise(0.0).alias("overstay_teu_ratio"),
        F.map_from_entries(F.transform("mix", share)).alias("type_mix"),
    )


def type_mix_json(block_day: DataFrame) -> DataFrame:
    """The map column as JSON text, for flat files."""
    return block_day.withColumn("type_mix", F.to_json("type_mix"))


# --- summaries over block-day rows -------------------------------------------

def block_summary(block_day: DataFrame) -> DataFrame:
    """Mean and peak utilisation and mean load per block."""
    return block_day.groupBy("yard_block").agg(
        F.avg("block_utilization_pct").alias("mean_util"),
        F.max("block_utilization_pct").alias("max_util"),
        F.avg("teu_occupied").alias("mean_teu"),
    )


def congestion_flags(
    summary: DataFrame, congested_above: float = 75, underused_below: float = 30,
) -> DataFrame:
    """Blocks that peaked too high or are hardly used."""
    return summary.withColumns({
        "is_congested": F.coalesce(F.col("max_util") > congested_above, F.lit(False)).cast("int"),
        "is_underused": F.coalesce(F.col("mean_util") < underused_below, F.lit(False)).cast("int"),
    }).where((F.col("is_congested") == 1) | (F.col("is_underused") == 1))


def weekly_utilization(block_day: DataFrame) -> DataFrame:
    """Mean utilisation per block and week (weeks start on Monday), long form."""
    return (
        block_day.groupBy("yard_block",
                          F.to_date(F.date_trunc("week", "date")).alias("week"))
        .agg(F.avg("block_utilization_pct").alias("mean_util"))
    )


def weekly_matrix(block_day: DataFrame) -> DataFrame:
    """The whole block x week matrix, row by row: every block has every week of the calendar."""
    weekly = weekly_utilization(block_day)
    mean = weekly.groupBy("yard_block").agg(F.avg("mean_util").alias("overall_util"))
    ends = weekly.agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
    weeks = F.sequence(ends.select("lo").scalar(), ends.select("hi").scalar(), F.expr("interval 7 days"))
    return (mean.withColumn("week", F.explode(weeks))
            .join(weekly, ["yard_block", "week"], "left")
            .select("yard_block", "week", "mean_util", "overall_util"))


def congestion_runs(
    block_day: DataFrame, above_pct: float = 80, longer_than_hours: float = 48,
) -> DataFrame:
    """Unbroken runs of days above a utilisation level that last too long."""
    by_date = Window.partitionBy("yard_block").orderBy("date")
    return (
        block_day.where(F.col("block_utilization_pct") > above_pct)
        .withColumn("_run", F.date_sub("date", F.row_number().over(by_date)))
        .groupBy("yard_block", "_run")
        .agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"),
             F.count(F.lit(1)).alias("days"),
             F.max("block_utilization_pct").alias("peak_util"))
        .where(F.col("days") * 24 > longer_than_hours)
        .drop("_run")
    )


def reshuffle_hotspots(
    block_day: DataFrame, min_height: float = 3.5, min_util: float = 70,
) -> DataFrame:
    """Block-days that are stacked high and full at the same time."""
    return block_day.where(
        (F.col("avg_stack_height") > min_height)
        & (F.col("block_utilization_pct") > min_util))


def peak_events(block_day: DataFrame) -> DataFrame:
    """Highest utilisation of each block and the first day it was reached."""
    util = F.col("block_utilization_pct")
    return (
        block_day.where(util.isNotNull()).groupBy("yard_block")
        .agg(F.max(F.struct(util.alias("u"), (-F.unix_date("date")).alias("d"))).alias("m"))
        .select("yard_block", F.date_from_unix_date((-F.col("m.d")).cast("int")).alias("peak_date"),
                F.col("m.u").alias("peak_util"))
    )


def plug_trend(block_day: DataFrame) -> DataFrame:
    """Reefer plug use over time, for blocks that have plugs."""
    return block_day.where(F.col("reefer_plug_util_pct").isNotNull()).select(
        "date", "yard_block", "reefer_plug_util_pct")


def geometric_capacity(blocks: DataFrame, teu_per_slot: float = 1) -> DataFrame:
    """Bays x rows x tiers x TEU per slot, next to the configured capacity."""
    return blocks.select(
        "yard_block", "teu_capacity",
        (F.col("yard_bays") * F.col("yard_rows") * F.col("max_tier") * teu_per_slot)
        .alias("geometric_teu"))
