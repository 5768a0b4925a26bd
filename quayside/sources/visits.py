"""Reading container visits from files.

Files are read as text (CSV) or as stored (parquet) and coerced without
throwing: a value that cannot be read becomes null, and the raw text of times and
numbers is kept so that the quality checks can tell "absent" from "unreadable".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quayside.schema import COLUMN_TYPES
from quayside.session import cut_lineage

# Text that stands for "no value" in CSV files (fixed values).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

POSITION = "source_position"
RAW_IN, RAW_OUT = "gate_in_raw", "gate_out_raw"
# Raw text of the columns that are not text themselves.
RAW = {"gate_in_time": RAW_IN, "gate_out_time": RAW_OUT, **{
    name: f"{name}_raw" for name, kind in COLUMN_TYPES.items()
    if isinstance(kind, (T.IntegerType, T.DoubleType))}}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Visit CSV files with a header; every column arrives as text.

    The files are parsed once, into a columnar stage in the shared folder (so this runs a
    job); all that is asked of the visits later reads the columns it needs from there.
    """
    raw = spark.read.option("header", True).csv(path)
    cleaned = [
        F.when(~F.col(f"`{c}`").isin(NULL_TOKENS), F.col(f"`{c}`")).alias(c)
        for c in raw.columns
    ]
    split = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_offset")]
    rows = cut_lineage(raw.select(*cleaned, *split, F.monotonically_increasing_id().alias("_id")), "zstd")
    # A split is read front to back by one task, so ids run on within it. How files are
    # cut into splits depends on the session; the row's number in its file does not.
    splits = rows.groupBy("_file", "_offset").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_file").orderBy("_offset").rowsBetween(Window.unboundedPreceding, -1)
    splits = cut_lineage(splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    position = F.struct(F.col("_file").alias("file"),
                        (F.col("_before") + F.col("_id") - F.col("_first")).alias("row")).alias(POSITION)
    return rows.join(splits, ["_file", "_offset"]).select(*[F.col(f"`{c}`") for c in raw.columns], position)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Visit parquet files; the position is the row's index in its file."""
    raw = spark.read.parquet(path)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    ).alias(POSITION)
    return raw.select("*", position)


def _coerced(df: DataFrame, name: str) -> F.Column:
    source, target = df.schema[name].dataType, COLUMN_TYPES[name]
    column = F.col(name)
    if isinstance(target, T.IntegerType) and isinstance(source, T.StringType):
        as_double = column.try_cast("double")  # "20.0" is a valid 20
        return F.when(as_double == F.floor(as_double), as_double.try_cast("int"))
    if isinstance(target, T.DoubleType):
        value = column.try_cast("double")
        return F.when(~F.isnan(value), value)
    return column.try_cast(target)


def coerce(raw: DataFrame) -> DataFrame:
    """Known columns in their visit types, unreadable values as null.

    Adds ``visit_id`` from the source position unless the input has one, and
    keeps the raw text of times and numbers under the names in ``RAW``.
    """
    out = []
    for name in raw.columns:
        out.append(_coerced(raw, name).alias(name) if name in COLUMN_TYPES else F.col(name))
    out += [F.col(name).cast("string").alias(kept) for name, kept in RAW.items() if name in raw.columns
            and (name in ("gate_in_time", "gate_out_time") or raw.schema[name].dataType == T.StringType())]
    if "visit_id" not in raw.columns:
        p = F.col(POSITION)
        out.append(F.concat_ws(
            "-", F.hex(F.xxhash64(p["file"])), p["row"].cast("string")).alias("visit_id"))
    return raw.select(*out)


def load_visits(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    reader = {"csv": read_csv, "parquet": read_parquet}[fmt]
    return coerce(reader(spark, path))


def with_absent_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Absent optional columns as typed nulls, so later schemas stay stable."""
    absent = [F.lit(None).cast(COLUMN_TYPES[n]).alias(n)
              for n in names if n not in df.columns]
    return df.select("*", *absent) if absent else df
