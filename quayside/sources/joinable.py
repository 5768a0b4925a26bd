"""Visit tables stored for joins: bucketed by visit, sorted, partitioned by month.

Visits, features and labels that are stored with one number of buckets join by ``visit_id``
without a shuffle, and a window of entry months reads the folders of those months only.
The tables live in the session's catalog, at a path of the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64  # of a cluster's table; a bucket of one month is one file
ROWS_PER_BUCKET = 1_000_000  # a bucket is written, and joined, by one task
KEY = "visit_id"


def month_of(time: str = "gate_in_time") -> Column:
    """The month of a time as a number such as 202501; null where the time is."""
    return (F.year(time) * 100 + F.month(time)).cast("int")


def buckets_for(rows: int, least: int = BUCKETS) -> int:
    """The number of buckets for so many rows, so that a task's share stays as it is when tables grow."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


def write_joinable(df: DataFrame, table: str, path: str, buckets: int = BUCKETS, by_month: bool = True) -> None:
    """Stores ``df`` as ``table``, by month of entry where ``by_month``.

    One shuffle by visit brings each bucket to one task, so a bucket is one file per month.
    The table is replaced if it exists; an existing column ``month`` is not allowed by month.
    """
    if by_month and "month" in df.columns:
        raise ValueError("the table has a column named month already")
    stored = df.withColumn("month", month_of()) if by_month else df
    writer = (stored.repartition(buckets, KEY).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, KEY).sortBy(KEY).option("path", path))
    (writer.partitionBy("month") if by_month else writer).saveAsTable(table)


def read_window(spark: SparkSession, table: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The rows of a table by month with an entry from ``start`` to the end of the day ``end``.

    Both are days such as ``2025-01-31``. The months prune folders, the days prune rows.
    Without bounds all rows come back, those without an entry time included.
    """
    rows = spark.table(table)
    month = lambda day: int(day[:4]) * 100 + int(day[5:7])
    day = F.to_date("gate_in_time")
    if start is not None:
        rows = rows.where((F.col("month") >= month(start)) & (day >= F.lit(start).cast("date")))
    if end is not None:
        rows = rows.where((F.col("month") <= month(end)) & (day <= F.lit(end).cast("date")))
    return rows.drop("month")


def with_labels(visits: DataFrame, labels: DataFrame) -> DataFrame:
    """Visits with their segment, by visit: no shuffle where both are stored with the same buckets.

    A visit without a label keeps a null segment. The merge hint keeps Spark from broadcasting labels,
    whose number grows with the visits.
    """
    return visits.join(labels.select(KEY, "cluster").hint("merge"), KEY, "left")
