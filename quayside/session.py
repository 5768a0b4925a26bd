"""Session helpers: defaults for local runs and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "quayside") -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the given session."""
    n = 8 if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster, or a private one for local tests.

    It comes from ``spark.checkpoint.dir`` or an earlier ``setCheckpointDir``;
    only where neither is set, and only in local mode, a folder is made.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master.split("[")[0] != "local":
                raise RuntimeError("spark.checkpoint.dir must name a shared folder")
            folder = tempfile.mkdtemp(prefix="quayside-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once for each application.

    For jobs that were not submitted with it; Spark serves the archive itself.
    """
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quayside-code-"), "quayside-core.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("quayside", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _sent.add(context.applicationId)


_made: list[str] = []
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)
# Deletes what a query shuffled when it ends; Spark reads it for each query anew.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate files, next to the checkpoints."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes intermediate files that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        if name in _made:
            _made.remove(name)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the intermediate files of this driver, once nothing reads them any more."""
    discard(spark, *_made)


@contextmanager
def passing_files(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the scratch folders made within, and what a query shuffled once that query has ended.

    For work whose result is written to a folder made before; nothing that was made within may be read afterwards.
    """
    token, before = _passing.set(made := []), spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
        _passing.reset(token)
        discard(spark, *made)


def in_turn(spark: SparkSession, path: str) -> None:
    """Dates the files of a folder a second apart, in order of their names.

    A stream takes files by their time, while tasks end in any order. Where the store
    does not keep given times, files come as they were written.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(conf)
    files = [f for f in store.listStatus(folder) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    start = min((f.getModificationTime() for f in files), default=0) // 1000 * 1000
    for i, f in enumerate(sorted(files, key=lambda f: f.getPath().getName())):
        store.setTimes(f.getPath(), start + 1000 * i, -1)


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark would rather send ``df`` to all tasks than shuffle what it is joined with."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read on from there.

    The files outlive the executors that wrote them. Parquet rather than an RDD
    checkpoint, so that later reads stay columnar and Spark knows their size
    when it chooses joins.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, "stage")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
