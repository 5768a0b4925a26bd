"""Container visits derived from order lines.

The test tables hold no container data; this view turns every order line into
one visit by fixed arithmetic (no randomness), so that all operators run over
whole tables whose size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_returnflag", "l_shipdate",
]


def _after(start: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("bigint"), start)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*LINE_COLUMNS)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_orderpriority")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One container visit per order line (17 columns)."""
    o, p, s, n = (F.col(c) for c in
                  ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    kind, slot = p % 10, n % 5
    entry_s = (o * 7 + n * 5) % 24 * 3600 + (p % 60) * 60
    dwell_s = ((6 + (o * 13 + p * 7 + s * 3) % 120)
               * F.when((o + p) % 20 == 0, 6).otherwise(1) * 3600)
    flag, priority = F.col("l_returnflag"), F.col("o_orderpriority")
    inland = (F.when(priority == "2-HIGH", "rail")
              .when(priority == "3-MEDIUM", "barge").otherwise("truck"))
    text = lambda c: c.cast("string")

    return order_lines(spark, sf_dir).select(
        F.concat(text(o), F.lit("-"), text(n), F.lit("-"), text(p), F.lit("-"),
                 text(s), F.lit("-"), text(F.col("l_shipdate").cast("date")),
                 F.lit("-"),
                 text(F.rint(F.col("l_extendedprice") * 100).cast("bigint")),
                 ).alias("visit_id"),
        F.concat(F.lit("MSCU"), F.lpad(text(o), 7, "0")).alias("container_id"),
        F.when(slot.isin(0, 1), 20).when(p % 41 == 0, 45).otherwise(40).alias("size_ft"),
        F.when(kind < 6, "dry").when(kind < 8, "reefer")
         .when(kind == 8, "hazardous").otherwise("empty").alias("container_type"),
        (1.0 + F.col("l_quantity") * 0.6).alias("weight_tons"),
        _after(F.col("l_shipdate"), entry_s).alias("gate_in_time"),
        F.when(p % 33 != 0, _after(F.col("l_shipdate"), entry_s + dwell_s))
         .alias("gate_out_time"),
        F.when(flag == "N", "import").when(flag == "A", "export")
         .otherwise("transhipment").alias("movement_type"),
        F.when(kind < 6, F.when(s % 3 == 0, "A01").when(s % 3 == 1, "A02").otherwise("B01"))
         .when(kind < 8, F.when(s % 2 == 0, "R01").otherwise("R02"))
         .when(kind == 8, "H01").otherwise("E01").alias("yard_block"),
        F.when(p % 17 != 0, F.concat(
            F.when(slot.isin(0, 1), "2").when(p % 41 == 0, "L").otherwise("4"),
            F.when(s % 4 == 0, "5").otherwise("2"),
            F.when((kind < 6) | (kind == 9), "G").when(kind < 8, "R").otherwise("T"),
            F.lit("1"))).alias("iso_type_code"),
        (1 + p % 40).cast("int").alias("yard_bay"),
        (1 + s % 8).cast("int").alias("yard_row"),
        (1 + n % 5).cast("int").alias("yard_tier"),
        F.concat(F.lit("VESSEL_"), text(s % 16)).alias("vessel_name"),
        F.concat(F.lit("LINE_"), text(s % 9)).alias("shipping_line"),
        F.when(flag == "A", inland).otherwise("vessel").alias("gate_in_mode"),
        F.when(flag == "N", inland).otherwise("vessel").alias("gate_out_mode"),
    )
