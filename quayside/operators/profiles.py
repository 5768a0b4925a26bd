"""Profiles of visits as states that are stored by day and merged without a rescan.

A state holds counters, ends and central moments, which merge exactly (moments up to the
rounding of doubles), and sketches with a stated error: ranks (KLL), distinct values (HLL)
and frequent values. Its size does not depend on the number of rows. Any grouping of merged
states gives the state of their rows, so days can be merged to months and those to years.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import schema as S
from quayside.operators import quality as Q

RANK_K = 800          # size of a rank sketch
DISTINCT_LG_K = 12    # 4,096 registers
TRACKED = 1000        # values a sketch of frequent values tracks
# Rank error of a KLL sketch of size k, 99 % of the time (fixed values of the published sketch).
RANK_ERROR = 2.296 / RANK_K ** 0.9723
COUNT_ERROR = 3.5 / 2 ** (TRACKED * 4 // 3).bit_length()  # the map of a sketch has a power of two of places
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_LG_K / 2)  # relative standard error
INFINITE = float("inf")


def _number(column: str) -> Column:
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))


def numeric_states(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One state per group and numeric column, from one pass. Null and NaN are missing."""
    columns = [c for c in (columns or S.NUMERIC_PROFILE_COLUMNS) if c in df.columns]
    parts = {}
    for c in columns:
        x = _number(c)
        finite = F.when(F.abs(x) < INFINITE, x)
        n, m2 = F.count(finite), F.coalesce(F.var_pop(finite), F.lit(0.0)) * F.count(finite)
        skew = F.coalesce(F.nanvl(F.skewness(finite), F.lit(0.0)), F.lit(0.0))
        parts[c] = {
            "rows": F.count(F.lit(1)), "count": F.count(x), "finite": n,
            "lowest": F.count_if(x == -INFINITE), "highest": F.count_if(x == INFINITE),
            "min": F.min(x), "max": F.max(x), "mean": F.coalesce(F.avg(finite), F.lit(0.0)),
            "m2": m2, "m3": F.coalesce(skew * F.pow(F.try_divide(m2, n), F.lit(1.5)) * n, F.lit(0.0)),
            "ranks": F.kll_sketch_agg_double(x, F.lit(RANK_K)),
        }
    return _long(df.groupBy(*keys), keys, parts)


def text_states(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One state per group and text column, from one pass."""
    columns = [c for c in (columns or S.CATEGORICAL_PROFILE_COLUMNS) if c in df.columns]
    text = lambda c: F.col(f"`{c}`").cast("string")
    return _long(df.groupBy(*keys), keys, {c: {
        "rows": F.count(F.lit(1)), "count": F.count(text(c)),
        "distinct": F.hll_sketch_agg(text(c), F.lit(DISTINCT_LG_K)),
        "frequent": F.call_function("approx_top_k_accumulate", text(c), F.lit(TRACKED)),
    } for c in columns})


def _long(grouped, keys: Sequence[str], parts: dict[str, dict[str, Column]]) -> DataFrame:
    wide = grouped.agg(*[col.alias(f"{c}__{name}") for c, state in parts.items() for name, col in state.items()])
    return wide.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{name}`").alias(name) for name in state])
        for c, state in parts.items()])))


def merge_numeric(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The states of the groups ``keys``, in the shape they came in.

    Moments are merged around the mean of the group, which a narrow aggregate finds first.
    """
    by = [*keys, "column"]
    centre = states.groupBy(*by).agg(
        F.coalesce(F.try_divide(F.sum(F.col("mean") * F.col("finite")), F.sum("finite")), F.lit(0.0)).alias("_mean"))
    same = F.lit(True)
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    shifted = states.join(centre.select("_mean", *[F.col(name).alias(f"_{name}") for name in by]), same)
    off, n = F.when(F.col("finite") > 0, F.col("mean") - F.col("_mean")).otherwise(0.0), F.col("finite")
    return shifted.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("rows", "count", "finite", "lowest", "highest")],
        F.min("min").alias("min"), F.max("max").alias("max"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + n * off * off).alias("m2"),
        F.sum(F.col("m3") + 3 * off * F.col("m2") + n * off * off * off).alias("m3"),
        F.kll_merge_agg_double("ranks", F.lit(RANK_K)).alias("ranks"))


def merge_text(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The states of the groups ``keys``, in the shape they came in."""
    return states.groupBy(*keys, "column").agg(
        F.sum("rows").alias("rows"), F.sum("count").alias("count"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("frequent")).alias("frequent"))


def numeric_profile(merged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Profile rows of merged states, by the rules of ``quality.numeric_profile``.

    All but ``median`` equal a profile of the rows. The rank of ``median`` is off by at most
    ``rank_error`` of the rows, 99 % of the time.
    """
    n = F.col("finite").cast("double")
    whole = F.col("count") == F.col("finite")
    spread = F.try_divide(F.col("m2"), n)
    skewness = F.try_divide(F.try_divide("m3", n), F.pow(spread, F.lit(1.5)))
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    mean = F.when(whole & (n > 0), F.col("mean")) \
        .when((F.col("lowest") > 0) & (F.col("highest") > 0), None) \
        .when(F.col("highest") > 0, F.lit(INFINITE)).when(F.col("lowest") > 0, F.lit(-INFINITE))
    return merged.select(
        *keys, "column", "rows", (F.col("rows") - F.col("count")).alias("nulls"), "count", "min", "max",
        mean.alias("mean"),
        F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(0.5))).alias("median"),
        F.when(whole & (n > 1), F.sqrt(F.try_divide("m2", n - 1))).alias("std"),
        F.when(whole & (n > 2), skewness * factor).alias("skewness"),
        F.lit(RANK_ERROR).alias("rank_error"))


def text_profile(merged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts, and the number of distinct values with its relative standard error."""
    return merged.select(
        *keys, "column", "rows", (F.col("rows") - F.col("count")).alias("nulls"), "count",
        F.hll_sketch_estimate("distinct").alias("unique"), F.lit(DISTINCT_ERROR).alias("unique_error"))


def top_values(merged: DataFrame, keys: Sequence[str] = (), most: int = 10) -> DataFrame:
    """The most frequent values: (column, rank, value, rows).

    Exact while a column has at most ``TRACKED`` values; beyond that a count is off by at
    most ``COUNT_ERROR`` of the rows.
    """
    found = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(TRACKED))
    known = F.filter(found, lambda e: e["item"].isNotNull())
    order = F.transform(known, lambda e: F.struct((-e["count"]).alias("n"), e["item"].alias("value")))
    return (merged.select(*keys, "column", F.posexplode(F.slice(F.array_sort(order), 1, most)).alias("at", "e"))
            .select(*keys, "column", (F.col("at") + 1).alias("rank"), "e.value", (-F.col("e.n")).alias("rows")))


# --- checks -------------------------------------------------------------------

def check_states(visits: DataFrame, keys: Sequence[str], as_of: str | None = None) -> DataFrame:
    """The counters of all row rules and nulls, per group: they add up."""
    return Q.row_rules(visits, as_of).counted(visits, keys)


def row_checks(states: DataFrame, like: DataFrame, as_of: str | None = None) -> DataFrame:
    """The rows of ``quality.row_checks`` from stored counters; ``like`` gives the columns of the visits."""
    rules = Q.row_rules(like, as_of)
    return rules.checks(states.agg(*[F.coalesce(F.sum(f"`{name}`"), F.lit(0)).alias(name) for name in rules.counters]))


# --- the stored table ---------------------------------------------------------

def write_states(states: DataFrame, path: str, batch: int) -> None:
    """Adds the states of whole days, by month and batch; the highest batch of a day counts.

    Late rows are added by building the states of their days again in a higher batch, so a
    repeated job, which writes its batch again, changes nothing. A day that has lost all its
    rows has no state to replace the stored one.
    """
    month = (F.year("day") * 100 + F.month("day")).cast("int")
    (states.withColumns({"month": month, "batch": F.lit(batch).cast("int")})
     .repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "batch").parquet(path))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The states of every day as written last. Rows without a day share one state."""
    stored = spark.read.parquet(path)
    last = stored.groupBy(F.col("month").alias("_month"), F.col("day").alias("_day")).agg(F.max("batch").alias("_batch"))
    same = F.col("day").eqNullSafe(F.col("_day")) & F.col("month").eqNullSafe(F.col("_month"))
    return stored.join(last, same & (F.col("batch") == F.col("_batch")), "left_semi").drop("month", "batch")
