"""Local sessions for tests and benches, and the shared folder for intermediate data."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session. On a cluster, pass your own session to the plans instead."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_scratch: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_scratch:
        made = tempfile.mkdtemp(prefix="ledgerlark-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_scratch[context.applicationId] = made
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{scratch_root(spark)}/ledgerlark/{label}-{uuid.uuid4().hex}"


def located(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables written inside, once the work inside is done.

    No frame that reads them may be used afterwards.
    """
    with noted_scratch() as paths:
        try:
            yield
        finally:
            delete_scratch(spark, paths)


@contextmanager
def noted_scratch() -> Iterator[list[str]]:
    """The paths of the intermediate tables written inside, for ``delete_scratch`` later on."""
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append([])
    paths = stack[-1]
    try:
        yield paths
    finally:
        stack.pop()


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables that nothing reads any more."""
    while paths:
        files, target = located(spark, paths.pop())
        files.delete(target, True)


def written(df: DataFrame, label: str, partition: str | None = None, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends there.

    Compressed well, as the folder is shared by all that runs. ``path`` is a ``scratch_path`` taken before.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    if stack := getattr(_scopes, "stack", None):
        stack[-1].append(path)
    writer = df.write.option("compression", "zstd")
    writer = writer.partitionBy(partition) if partition else writer
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def show_package(spark: SparkSession) -> None:
    """Let local Python workers import this package, whatever folder the driver was started in.

    On a cluster the package is installed on the executors or sent with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        paths = os.pathsep.join([root, *filter(None, known)])
        spark.sparkContext.environment["PYTHONPATH"] = paths
