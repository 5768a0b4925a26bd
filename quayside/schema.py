"""Column names, value domains and the typed schema of the visit fact table."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: names and domains of the visit data model -----------------
REQUIRED_COLUMNS = [
    "container_id", "size_ft", "container_type", "weight_tons",
    "gate_in_time", "gate_out_time", "movement_type", "yard_block",
]
OPTIONAL_COLUMNS = [
    "iso_type_code", "yard_bay", "yard_row", "yard_tier", "vessel_name",
    "shipping_line", "cargo_category", "gate_in_mode", "gate_out_mode",
]
SIZES = [20, 40, 45]
CONTAINER_TYPES = ["dry", "reefer", "hazardous", "empty", "special", "tank"]
MOVEMENT_TYPES = ["import", "export", "transhipment"]
GATE_MODES = ["vessel", "truck", "rail", "barge"]
NUMERIC_PROFILE_COLUMNS = [
    "size_ft", "weight_tons", "yard_bay", "yard_row", "yard_tier",
]
CATEGORICAL_PROFILE_COLUMNS = [
    "container_type", "movement_type", "yard_block", "shipping_line",
    "gate_in_mode", "gate_out_mode", "cargo_category", "iso_type_code",
]
# -----------------------------------------------------------------------------

COLUMN_TYPES: dict[str, T.DataType] = {
    "container_id": T.StringType(),
    "size_ft": T.IntegerType(),
    "container_type": T.StringType(),
    "weight_tons": T.DoubleType(),
    "gate_in_time": T.TimestampNTZType(),
    "gate_out_time": T.TimestampNTZType(),
    "movement_type": T.StringType(),
    "yard_block": T.StringType(),
    "iso_type_code": T.StringType(),
    "yard_bay": T.IntegerType(),
    "yard_row": T.IntegerType(),
    "yard_tier": T.IntegerType(),
    "vessel_name": T.StringType(),
    "shipping_line": T.StringType(),
    "cargo_category": T.StringType(),
    "gate_in_mode": T.StringType(),
    "gate_out_mode": T.StringType(),
}

VISIT_SCHEMA = T.StructType(
    [T.StructField("visit_id", T.StringType(), False)]
    + [T.StructField(name, COLUMN_TYPES[name], True)
       for name in REQUIRED_COLUMNS + OPTIONAL_COLUMNS]
)

YARD_SCHEMA = T.StructType([
    T.StructField("terminal_name", T.StringType()),
    T.StructField("blocks", T.ArrayType(T.StructType([
        T.StructField("block_id", T.StringType()),
        T.StructField("rows", T.IntegerType()),
        T.StructField("bays", T.IntegerType()),
        T.StructField("max_tier", T.IntegerType()),
        T.StructField("teu_capacity", T.IntegerType()),
        T.StructField("accepts_types", T.ArrayType(T.StringType())),
        T.StructField("has_reefer_plugs", T.BooleanType()),
        T.StructField("reefer_plug_count", T.IntegerType()),
    ]))),
    T.StructField("gate_count_in", T.IntegerType()),
    T.StructField("gate_count_out", T.IntegerType()),
])

TARIFF_SCHEMA = T.StructType([
    T.StructField("currency", T.StringType()),
    T.StructField("free_days", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("storage_tiers", T.ArrayType(T.StructType([
        T.StructField("from_day", T.IntegerType()),
        T.StructField("to_day", T.IntegerType()),
        T.StructField("rate_per_teu_per_day", T.DoubleType()),
    ]))),
    T.StructField("reefer_surcharge_per_day", T.DoubleType()),
    T.StructField("hazardous_surcharge_per_day", T.DoubleType()),
    T.StructField("avg_throughput_revenue_per_teu", T.DoubleType()),
])


def missing_required(columns: list[str]) -> list[str]:
    """Required columns absent from ``columns`` (metadata only, no job)."""
    present = set(columns)
    return [c for c in REQUIRED_COLUMNS if c not in present]


def present_optional(columns: list[str]) -> list[str]:
    present = set(columns)
    return [c for c in OPTIONAL_COLUMNS if c in present]
