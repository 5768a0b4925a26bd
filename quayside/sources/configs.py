"""Yard and tariff configuration files (small nested JSON)."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.params import (
    DEFAULT_THROUGHPUT_RATE, Block, TariffConfig, Tier, YardConfig,
)
from quayside.schema import TARIFF_SCHEMA, YARD_SCHEMA

BLOCK_COLUMNS = [
    ("yard_block", "string"), ("teu_capacity", "int"), ("reefer_plug_count", "int"),
    ("yard_rows", "int"), ("yard_bays", "int"), ("max_tier", "int"),
]


def scan_yard(spark: SparkSession, path: str) -> DataFrame:
    """One row per block of the yard file(s)."""
    yard = spark.read.schema(YARD_SCHEMA).option("multiLine", True).json(path)
    block = F.col("block")
    return yard.select(F.explode("blocks").alias("block")).select(
        block["block_id"].alias("yard_block"),
        block["teu_capacity"].alias("teu_capacity"),
        F.when(block["has_reefer_plugs"], block["reefer_plug_count"])
         .alias("reefer_plug_count"),
        block["rows"].alias("yard_rows"),
        block["bays"].alias("yard_bays"),
        block["max_tier"].alias("max_tier"),
    )


def _documents(spark: SparkSession, path: str, schema) -> list:
    """All configuration documents under a path (a handful, fetched whole)."""
    return spark.read.schema(schema).option("multiLine", True).json(path).collect()


def read_yard(spark: SparkSession, path: str) -> YardConfig:
    """The yard configuration as a plan-time object.

    Blocks of several documents are joined in their order; names and gate counts come
    from the first document that has them.
    """
    rows = _documents(spark, path, YARD_SCHEMA)
    blocks = tuple(
        Block(b.block_id, b.teu_capacity, b.reefer_plug_count,
              bool(b.has_reefer_plugs), b.rows, b.bays, b.max_tier,
              tuple(b.accepts_types or ()))
        for row in rows for b in (row.blocks or [])
    )
    head = lambda name: next((row[name] for row in rows if row[name] is not None), None)
    return YardConfig(blocks, head("terminal_name"), head("gate_count_in"), head("gate_count_out"))


def read_tariff(spark: SparkSession, path: str) -> TariffConfig:
    """The tariff as a plan-time object; absent parts fall back to defaults.

    Tariffs cannot be joined, so more than one document is an error.
    """
    rows = _documents(spark, path, TARIFF_SCHEMA)
    if len(rows) != 1:
        raise ValueError(f"{path} holds {len(rows)} tariffs; one is needed")
    row = rows[0]
    tiers = tuple(Tier(t.from_day, t.to_day, t.rate_per_teu_per_day)
                  for t in (row.storage_tiers or []))
    rate = row.avg_throughput_revenue_per_teu
    return TariffConfig(
        free_days=dict(row.free_days or {}),
        storage_tiers=tiers,
        reefer_surcharge_per_day=row.reefer_surcharge_per_day or 0.0,
        hazardous_surcharge_per_day=row.hazardous_surcharge_per_day or 0.0,
        avg_throughput_revenue_per_teu=(
            DEFAULT_THROUGHPUT_RATE if rate is None else rate),
        currency=row.currency or "USD",
    )


def _write_document(spark: SparkSession, document: dict, path: str) -> None:
    """One JSON document, written through Spark to any file system; replaces what is there."""
    text = json.dumps(document, ensure_ascii=False)
    spark.range(1).select(F.lit(text).alias("value")).write.mode("overwrite").text(path)


def write_yard(spark: SparkSession, yard: YardConfig, path: str) -> None:
    """The yard as a document that ``read_yard`` reads back as it is."""
    _write_document(spark, asdict(yard), path)


def write_tariff(spark: SparkSession, tariff: TariffConfig, path: str) -> None:
    """The tariff as a document that ``read_tariff`` reads back as it is."""
    _write_document(spark, asdict(tariff), path)


def block_dimension(spark: SparkSession, yard: YardConfig | None) -> DataFrame:
    """The blocks of a yard as a DataFrame.

    Built from literals on a one-row range, so its size is known to Spark,
    which then decides by itself whether a lookup join may broadcast it.
    """
    rows = [
        F.struct(*[
            F.lit(value).cast(kind).alias(name)
            for (name, kind), value in zip(BLOCK_COLUMNS, (
                b.block_id, b.teu_capacity,
                b.reefer_plug_count if b.has_reefer_plugs else None,
                b.rows, b.bays, b.max_tier))
        ])
        for b in (yard.blocks if yard else ())
    ]
    if not rows:
        schema = ", ".join(f"{name} {kind}" for name, kind in BLOCK_COLUMNS)
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*rows)))
