"""Order-independent arithmetic.

Sums of doubles depend on how rows were partitioned. Durations are therefore
summed as whole seconds plus whole microseconds and money as whole cents, both
bigint, and divided once at the end: the result is the same on any cluster and
after any task retry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.session import cut_lineage

DIGITS = (20, 22, 22)  # bits of each step of the radix selection
SECONDS_PER_DAY = 86400.0


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def sum_days(micros: Column) -> Column:
    """Sum of durations in days; cannot overflow below ~10^13 rows."""
    seconds = F.sum(F.floor(micros / F.lit(1_000_000)).cast("bigint"))
    rest = F.sum(F.pmod(micros, F.lit(1_000_000)))
    return (seconds + rest / 1e6) / SECONDS_PER_DAY


def mean_days(micros: Column) -> Column:
    return F.try_divide(sum_days(micros), F.count(micros))


def cents(amount: Column) -> Column:
    return F.rint(amount * 100).cast("bigint")


def sum_money(amount: Column) -> Column:
    """Sum of amounts that are already whole cents; null when all are null."""
    return F.sum(cents(amount)) / 100.0


def mean_money(amount: Column) -> Column:
    return F.try_divide(sum_money(amount), F.count(amount))


def half_even_cents(amount: Column) -> Column:
    """``amount`` rounded to cents, ties to the even cent.

    Goes through whole millionths so that binary noise cannot decide a tie;
    ``rint`` rounds ties to even and stays on primitive doubles.
    """
    return F.rint(F.rint(amount * 1e6) / 1e4) / 100.0


def ordered_bits(value: Column) -> Column:
    """The IEEE bits of a double as a bigint in the order of the doubles, zeros as one.

    Scaling by powers of two is exact, so the mantissa comes out whole: below 2^-1022 as a
    multiple of 2^-1074, else behind the exponent. Negative numbers mirror positive ones.
    Infinities follow the largest finite numbers. Null for null and NaN.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(F.greatest(size, F.lit(_LEAST_NORMAL))))
    exponent = F.least(F.greatest(guess, F.lit(-1022)), F.lit(1023))
    # the logarithm may be off by one next to a power of two
    exponent = exponent + F.when(_power(exponent) > size, -1).when(
        (exponent < 1023) & (_power(F.least(exponent + 1, F.lit(1023))) <= size), 1).otherwise(0)
    mantissa = size * _power(-exponent) - 1
    bits = F.when(size == float("inf"), F.lit(2047 << 52)) \
        .when(size < _LEAST_NORMAL, (size * 2.0 ** 537 * 2.0 ** 537).cast("bigint")) \
        .otherwise((exponent + 1023).cast("bigint") * (1 << 52) + (mantissa * 2.0 ** 52).cast("bigint"))
    return F.when(~F.isnan(value), F.when(value < 0, -bits).otherwise(bits))


_LEAST_NORMAL = 2.0 ** -1022


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _between(low: Column, high: Column, share: Column) -> Column:
    """Linear interpolation; an infinite end wins over a finite one, and two different ones give null."""
    endless = lambda x: F.abs(x) == float("inf")
    plain = low + (high - low) * share
    return F.when((low == high) | (share == 0), low).when(endless(low) & endless(high), None) \
        .when(endless(low), low).otherwise(plain)


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Exact, linearly interpolated quantiles: (keys..., prob, quantile).

    ``percentile`` keeps every distinct value of a group in one task's memory. Here
    equal values are counted first (combined map-side, so a hot value or a hot group
    costs nothing) and the counts are written once, so the input is read once. Wanted
    ranks are then found by radix selection over the 64 ordered bits of the values: counted
    by their first ``DIGITS[0]`` bits, then by the next within the cells that hold a rank,
    and so on to the last bit. A step ranks at most 2^22 cells of a group in one task,
    however values crowd; most data have some thousands.

    NaN counts as missing, as null does. Infinite values are ranked like others; between
    a finite and an infinite value lies the infinite one, between both infinities null.
    """
    keys = list(keys)
    number = F.col(value).cast("double")
    counts = cut_lineage(
        df.where(number.isNotNull() & ~F.isnan(number))
        .groupBy(*keys, (number + 0.0).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bits", ordered_bits(F.col("_v"))))
    points = [float(p) for p in probs]
    group = [F.col(k) for k in keys] or [F.lit(0)]
    rows, shift, found = counts, 64, None
    for step, width in enumerate(DIGITS):
        shift -= width
        prefix = F.shiftright("_bits", shift).alias("_cell")
        base = F.lit(0).cast("bigint") if found is None else F.col("_base")
        held = [] if found is None else ["_base", "_ranks", "_total", "_inside"]
        cells = rows.groupBy(*keys, *held, prefix).agg(F.sum("_n").alias("_m"))
        inside = Window.partitionBy(*group, *([] if found is None else [F.col("_inside")]))
        cells = cells.withColumn("_before", base + F.sum("_m").over(inside.orderBy("_cell")) - F.col("_m"))
        if found is None:
            cells = cells.withColumn("_total", F.sum("_m").over(inside)).withColumn("_ranks", _ranks(points))
        mine = F.filter("_ranks", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_m")))
        found = cells.withColumn("_ranks", mine).where(F.size("_ranks") > 0).select(
            *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_cell").alias("_inside"),
            F.col("_before").alias("_base"), "_ranks", "_total")
        same = F.shiftright("_bits", shift) == F.col("_inside")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        rows = counts.join(found, same).drop(*[f"_k_{k}" for k in keys])
    at = F.map_from_entries(F.flatten(F.collect_list(F.transform("_ranks", lambda r: F.struct(r, F.col("_v"))))))
    whole = rows.groupBy(*keys, "_total").agg(at.alias("_at"))
    place = F.col("prob") * (F.col("_total") - 1)
    picked = whole.select(*keys, "_at", "_total", F.explode(F.array(*[F.lit(p) for p in points])).alias("prob"))
    low, high = F.element_at("_at", F.floor(place)), F.element_at("_at", F.ceil(place))
    return picked.select(*keys, "prob", _between(low, high, place - F.floor(place)).alias("quantile"))


def _ranks(probs: Sequence[float]) -> Column:
    """The ranks on both sides of every quantile of ``_total`` values."""
    places = [F.lit(p) * (F.col("_total") - 1) for p in probs]
    return F.array_distinct(F.array(*[f(x) for x in places for f in (F.floor, F.ceil)]))


def quantiles_wide(
    df: DataFrame, value: str, named: dict[str, float], keys: Sequence[str] = (),
) -> DataFrame:
    """One column per quantile, e.g. ``{"median": .5, "p95": .95}``."""
    long = quantiles(df, value, sorted(set(named.values())), keys)
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(name)
        for name, p in named.items()
    ])
