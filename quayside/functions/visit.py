"""Column expressions at visit grain (all native, one codegen'd projection)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.exact import half_even_cents, micros_between
from quayside.params import DEFAULT_FREE_DAYS, TariffConfig

# --- fixed values: ISO 6346 code letters -------------------------------------
ISO_SIZE = {"2": 20, "4": 40, "L": 45}
ISO_HIGH_CUBE = "5"
ISO_GROUP = {
    "G": "dry", "B": "dry", "R": "reefer", "T": "tank", "U": "special", "P": "special",
}
# -----------------------------------------------------------------------------


def lookup(key: Column, table: dict) -> Column:
    """A small literal lookup; null for a key that is absent."""
    value = None
    for name, found in table.items():
        value = (F.when if value is None else value.when)(key == name, found)
    return value


def _iso_char(code: Column, position: int) -> Column:
    return F.when(F.length(code) >= 4, F.substring(code, position, 1))


def iso_size(code: Column) -> Column:
    return lookup(_iso_char(code, 1), ISO_SIZE)


def is_high_cube(code: Column) -> Column:
    return F.coalesce(_iso_char(code, 2) == ISO_HIGH_CUBE, F.lit(False))


def iso_group(code: Column, fallback: Column) -> Column:
    return F.coalesce(lookup(_iso_char(code, 3), ISO_GROUP), fallback)


def dwell_micros() -> Column:
    return micros_between(F.col("gate_in_time"), F.col("gate_out_time"))


def dwell_hours() -> Column:
    return dwell_micros() / 1e6 / 3600.0


def age_days(as_of: Column) -> Column:
    """Elapsed days of a visit that is still open; null once it has left."""
    micros = micros_between(F.col("gate_in_time"), as_of)
    return F.when(F.col("gate_out_time").isNull(), micros / 1e6 / 3600.0 / 24.0)


def teu(size_ft: Column, teu_for_45ft: float = 2) -> Column:
    other = F.when(size_ft == 20, 1)
    if teu_for_45ft != 2:
        return (other.when(size_ft == 45, F.lit(float(teu_for_45ft)))
                .otherwise(2).cast("double"))
    return other.otherwise(2).cast("int")


def dwell_category(hours: Column, days: Column, threshold: float) -> Column:
    """First matching band. Exactly 24 h falls between two bands: unknown."""
    return (
        F.when(hours < 24, "short")
        .when((days > 1) & (days <= 3), "normal")
        .when((days > 3) & (days <= threshold), "long")
        .when(days > threshold, "overstay")
        .otherwise("unknown")
    )


def is_overstay(days: Column, threshold: float | Column) -> Column:
    return F.when(days > threshold, 1).otherwise(0).cast("int")


def free_days(movement: Column, tariff: TariffConfig) -> Column:
    if not tariff.free_days:
        return F.lit(DEFAULT_FREE_DAYS)
    return F.coalesce(lookup(movement, tariff.free_days), F.lit(DEFAULT_FREE_DAYS))


def storage_charge(
    days: Column, movement: Column, container_type: Column, teu_: Column,
    tariff: TariffConfig,
) -> Column:
    """Unrounded storage charge of one visit; null while dwell is unknown.

    Billable days fill the tiers in order of their first day. Only the widths
    matter, so the days in a tier are what is left beyond the summed widths of
    the tiers before it, which is known when the plan is built. The surcharge
    term is null for an unknown dwell and makes the whole charge null.
    """
    billable = F.greatest(F.lit(0.0), days - free_days(movement, tariff))
    base, offset = F.lit(0.0), 0
    for tier in sorted(tariff.storage_tiers, key=lambda t: t.from_day):
        in_tier = F.least(F.lit(float(tier.width)),
                          F.greatest(F.lit(0.0), billable - float(offset)))
        base = base + in_tier * float(tier.rate_per_teu_per_day) * teu_
        offset += tier.width
    per_day = (
        F.when(container_type == "reefer", F.lit(float(tariff.reefer_surcharge_per_day)))
        .when(container_type == "hazardous", F.lit(float(tariff.hazardous_surcharge_per_day)))
        .otherwise(F.lit(0.0))
    )
    return base + per_day * days * teu_


def storage_cost(
    days: Column, movement: Column, container_type: Column, teu_: Column,
    tariff: TariffConfig | None,
) -> Column:
    """Storage charge in whole cents; null without a tariff."""
    if tariff is None:
        return F.lit(None).cast("double")
    return half_even_cents(storage_charge(days, movement, container_type, teu_, tariff))


def flow_path(mode_in: Column, mode_out: Column) -> Column:
    both = mode_in.isNotNull() & mode_out.isNotNull()
    return F.when(both, F.concat(mode_in, F.lit("→"), mode_out)).otherwise("unknown")
