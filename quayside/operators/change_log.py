"""Yard occupancy kept up to date by signed changes.

Occupancy is the running sum of changes per (block, type, day), and sums can take
back what they were given. A late gate-out or a corrected visit is therefore a
retraction of its old version and an entry of its new one: their net changes are
appended to a stored table and touch only the blocks and months that the visit
touched before or touches now. Nothing is rebuilt.

The table is stored by month and batch. A batch that is written again replaces
itself, so a job that is repeated after a failure does not count twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.operators.occupancy import MEASURES, visit_changes

GROUP = ["yard_block", "container_type"]
KEY = [*GROUP, "date"]
SUMS = [*MEASURES, "entries"]


def net_changes(changes: DataFrame) -> DataFrame:
    """One row per (block, type, day), without those that cancel out; an unknown weight is zero."""
    some = F.lit(False)
    for name in SUMS:
        some = some | (F.col(name) != 0)
    return changes.groupBy(*KEY).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in SUMS]).where(some)


def edit_changes(stored: DataFrame, edited: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """What ``edited`` versions and ``deleted`` ids change about the ``stored`` visits.

    All are keyed by ``visit_id``; ``edited`` holds at most one version of a visit, new visits
    included, with the feature columns of ``stored``. Ids that are not stored are deleted
    without effect; a visit both edited and deleted keeps its edited version.
    """
    ids = edited.select("visit_id")
    if deleted is not None:
        ids = ids.unionByName(deleted.select("visit_id"))
    old = visit_changes(stored.join(ids, "visit_id", "left_semi"))
    retracted = old.select(*KEY, *[(-F.col(name)).alias(name) for name in SUMS])
    return net_changes(retracted.unionByName(visit_changes(edited)))


def replace_visits(stored: DataFrame, edited: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """The visits after the edits, with the columns of ``stored``."""
    gone = edited.select("visit_id")
    if deleted is not None:
        gone = gone.unionByName(deleted.select("visit_id"))
    return stored.join(gone, "visit_id", "left_anti").unionByName(edited.select(stored.columns))


def append_changes(changes: DataFrame, path: str, batch: int) -> None:
    """Adds a batch to the stored table; the same batch again replaces itself.

    Only the months with changes are written, one file each.
    """
    month = (F.year("date") * 100 + F.month("date")).cast("int")
    (changes.withColumns({"month": month, "batch": F.lit(batch).cast("int")})
     .repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "batch").parquet(path))


def read_changes(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Net changes of the stored table; ``first`` and ``last`` are months (``202501``) and prune folders."""
    table = spark.read.parquet(path)
    if first is not None:
        table = table.where(F.col("month") >= first)
    if last is not None:
        table = table.where(F.col("month") <= last)
    return net_changes(table)


def compact(spark: SparkSession, path: str, into: str) -> None:
    """All batches as one, in a new folder; readers switch when it is complete."""
    append_changes(read_changes(spark, path), into, 0)


def occupancy_of_changes(changes: DataFrame) -> DataFrame:
    """Dense (block, type, day) occupancy from stored net changes.

    The calendar runs from the first to the last day with an entry and comes from a narrow
    aggregate, so each group's days stay in the task of that group. A group without any
    visit left is not in the grid; visits without a block count for the calendar only.
    """
    entered = F.when(F.col("entries") > 0, F.col("date"))
    ends = changes.agg(F.min(entered).alias("lo"), F.max(entered).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    groups = (
        changes.where(F.col("yard_block").isNotNull()).groupBy(*GROUP)
        .agg(F.collect_list(F.struct("date", *MEASURES)).alias("days"), F.sum("entries").alias("visits"))
        .where(F.col("visits") > 0).withColumn("calendar", F.sequence(lo, hi)))
    days = groups.select(*GROUP, F.inline(F.concat("days", _zeros(changes))))
    daily = days.groupBy(*KEY).agg(*[F.sum(m).alias(m) for m in MEASURES])
    running = Window.partitionBy(*GROUP).orderBy("date")
    return daily.select(*KEY, *[F.sum(m).over(running).alias(m) for m in MEASURES]).where(F.col("date") <= hi)


def _zeros(changes: DataFrame) -> Column:
    types = dict(changes.dtypes)
    zero = [F.lit(0).cast(types[m]).alias(m) for m in MEASURES]
    return F.transform("calendar", lambda day: F.struct(day.alias("date"), *zero))
