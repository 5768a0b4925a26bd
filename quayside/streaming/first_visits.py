"""Clean visits from a stream of visit files: the first copy of every visit, once it is certain.

State holds one row per (container, entry) until the watermark passes the entry, so it is
bounded by the visits of one batch and of the last ``late``, not by all there were. The watermark
moves between batches: stored visits need files in order of entry (``write_in_order``), some of
them per batch. A finished visit is appended by the file sink, which with its checkpoint writes
each batch once, restarts included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quayside.operators import quality as Q
from quayside.session import in_turn
from quayside.streaming.gate_counts import instant

ROWS_PER_FILE, FILES_PER_BATCH = 250_000, 32


def write_in_order(visits: DataFrame, path: str) -> None:
    """Stored visits as files of bounded size, each later than the one before it by entry.

    Copies of a visit share a file; those at one moment, or without one, may fill several.
    """
    files = max(1, -(-visits.count() // ROWS_PER_FILE))
    visits.repartitionByRange(files, "gate_in_time", "container_id").write.parquet(path)
    in_turn(visits.sparkSession, path)


def read_in_order(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The files of ``write_in_order`` as a stream, a bounded number of rows in each batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(path)


def first_visits(visits: DataFrame, late: str = "7 days") -> DataFrame:
    """The first row of each (container, entry) in source order.

    ``late`` says how far behind the newest entry seen in earlier batches a row may come; later
    ones are dropped (``with_held_visits`` finds those whose visit was not written at all).
    No watermark ever passes visits without an entry time; they are left to the end of the stream.
    """
    order = Q.source_order(visits)
    if not order:
        raise ValueError("visits need a visit_id or a source position")
    stamped = visits.withColumn("_entry", instant(F.col("gate_in_time"), dict(visits.dtypes)["gate_in_time"]))
    return (
        stamped.where(F.col("_entry").isNotNull()).withWatermark("_entry", late).groupBy("_entry", "container_id")
        .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in visits.columns]), F.struct(*order)).alias("_first"))
        .select("_first.*"))


def write_first_visits(visits: DataFrame, path: str, checkpoint: str, late: str = "7 days") -> StreamingQuery:
    """Appends finished visits to parquet until all files that are there are read."""
    return (first_visits(visits, late).writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def came_in_time(stream: StreamingQuery) -> bool:
    """Whether no row of a stream that has ended was dropped as late, as far as its progress still tells of all batches."""
    told = {p.batchId: p for p in stream.recentProgress}
    return bool(told) and sorted(told) == [*range(len(told))] and not any(
        state.numRowsDroppedByWatermark for p in told.values() for state in p.stateOperators)


def with_held_visits(written: DataFrame, visits: DataFrame, in_time: bool = False) -> DataFrame:
    """What a stream has written, and the first rows of the visits that it had not when it ended.

    Where all rows came in time, every visit up to the last written entry is written; else all
    visits are held against the written ones.
    """
    if in_time:
        past, entry = written.agg(F.max("gate_in_time")).scalar(), F.col("gate_in_time")
        return written.unionByName(Q.keep_first(visits.where(past.isNull() | entry.isNull() | (entry > past))))
    done = written.select(F.col("container_id").alias("_container"), F.col("gate_in_time").alias("_in"))
    same = F.col("container_id").eqNullSafe(F.col("_container")) & F.col("gate_in_time").eqNullSafe(F.col("_in"))
    return written.unionByName(Q.keep_first(visits.join(done, same, "left_anti")))


def clean_visits(written: DataFrame, visits: DataFrame, as_of: str | None = None, in_time: bool = False) -> DataFrame:
    """The clean visits of a stream that has ended, as ``quality.clean_visits`` gives them for its files."""
    bad = Q.is_reversed() | Q.is_future("gate_in_time", as_of) | Q.is_future("gate_out_time", as_of)
    return with_held_visits(written, visits, in_time).where(~bad)
