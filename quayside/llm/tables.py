"""Small shared steps of the operators: whole-table writes, word-free row digests."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import quayside
from quayside.session import cut_lineage

__all__ = ["arrow_schema", "cut_lineage", "discard", "documents", "free_shuffles", "ship_package", "utf8_sha256"]

_shipped: set[str] = set()


ROWS_PER_BATCH = 2000


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application, and keeps batches small.

    For jobs that were not submitted with it; Spark serves the archive itself. Texts are
    long, so ten thousand of them, Spark's default for a batch, are more than a worker
    should hold at a time.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) > ROWS_PER_BATCH:
        spark.conf.set(rows, str(ROWS_PER_BATCH))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(quayside.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quayside-code-"), "quayside-code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("quayside", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps that are written and no longer referenced.

    It does so when the driver collects its garbage, which a driver with little to do
    may put off until the whole job has ended.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*stages: DataFrame) -> None:
    """Deletes the files behind stages that ``cut_lineage`` wrote, once their successors are written."""
    for df in stages:
        files = df.inputFiles()
        if files:
            jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
            folder = jvm.org.apache.hadoop.fs.Path(files[0].rpartition("/")[0])
            folder.getFileSystem(conf).delete(folder, True)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text under fixed names, whatever else the table holds; null text is empty."""
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def utf8_sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def arrow_schema(ddl: str):
    """The Arrow schema of a Spark DDL string, for functions that build their own batches."""
    import pyarrow as pa

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
             "binary": pa.binary(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in
                      (part.strip().split(" ") for part in ddl.split(","))])
