"""Hourly counts over a stream of timestamped events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def hourly_counts(events: DataFrame, late: str = "2 hours", time: str = "ts", *keys: str) -> DataFrame:
    """Events per hour (and key).

    On a stream, an hour is emitted once the watermark has passed it and later
    arrivals for it are dropped; on a batch frame the watermark has no effect.
    Hours are those of UTC (of the plain time, if it has no zone), whatever the
    zone of the session.
    """
    stamped = events.withColumn("_ts", instant(F.col(time), dict(events.dtypes)[time]))
    if events.isStreaming:
        stamped = stamped.withWatermark("_ts", late)
    return (
        stamped.groupBy(F.window("_ts", "1 hour").alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("gate_throughput_hr"))
        .withColumn("_h", F.floor(F.unix_seconds("w.start") / 3600))
        .select(F.date_from_unix_date(F.floor(F.col("_h") / 24).cast("int")).alias("date"),
                F.pmod(F.col("_h"), F.lit(24)).cast("int").alias("hour"), *keys, "gate_throughput_hr")
    )


def instant(time: Column, kind: str) -> Column:
    """A timestamp; a time without a zone is read as UTC, not in the session's zone."""
    if kind != "timestamp_ntz":
        return time
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", start, time))


def read_events(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = 1) -> DataFrame:
    """The files as a stream; ``None`` takes all that are there as one batch.

    The watermark moves between batches, so files that are not in order of time
    need to share one, or their older events are late.
    """
    stream = spark.readStream.schema(schema)
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.parquet(path)


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished hours to parquet; exactly once with the given checkpoint."""
    return (counts.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def with_open_hours(written: DataFrame, events: DataFrame, time: str = "ts", *keys: str) -> DataFrame:
    """Counts that a stream has written, and those of the hours it still held when it ended.

    A watermark never reaches the last hours of a stream that ends. They are counted
    from the events behind the last written hour, as a batch.
    """
    past = written.agg(F.max(F.timestamp_add("HOUR", F.col("hour") + 1, F.col("date").cast("timestamp_ntz")))).scalar()
    rest = events.where(past.isNull() | (F.col(time) >= past))
    return written.unionByName(hourly_counts(rest, "0 seconds", time, *keys))
