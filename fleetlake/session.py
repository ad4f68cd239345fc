"""Session set-up, the shared scratch folder, and staging of intermediate tables."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

LISTING_TASKS = 128  # starting a task takes longer than listing a folder


def build_session(app: str = "fleetlake", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session. Partition counts are left to adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
        .config("spark.executor.extraJavaOptions", "-Duser.timezone=UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # Call-site capture costs several JVM calls for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def size_conf(input_bytes: int, task_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a run over ``input_bytes``, for ``build_session(**size_conf(...))``.

    Scan tasks and shuffle partitions of about ``task_bytes``; adaptive execution merges
    partitions that turn out smaller and splits skewed ones.
    """
    partitions = min(max(input_bytes // task_bytes, 200), 400_000)
    return {
        "spark__sql__shuffle__partitions": str(partitions),
        "spark__sql__files__maxPartitionBytes": str(task_bytes),
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": str(task_bytes),
        "spark__sql__adaptive__skewJoin__enabled": "true",
    }


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for what is started inside, put back afterwards.

    A streaming query takes a copy of the session's settings when it starts and keeps it.
    """
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def listing_settings(spark: SparkSession):
    """Settings under which folders are listed by few tasks; by default every folder, and every file of a micro-batch, is a task."""
    return settings(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=str(LISTING_TASKS))


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are UTC instants throughout, so the session zone must be UTC too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back on a temporary folder of its own; on a cluster a
    machine-local folder would be lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="fleetlake-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; no two calls return the same one."""
    return f"{scratch_dir(spark)}/fleetlake/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where a plan needs several passes over an expensive input, or where a value that
    Spark only fixes at run time (a row's position in a sorted output) must not change
    between two uses. Parquet keeps column pruning for the later passes, and a lost
    executor costs a re-read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def expire_scratch(spark: SparkSession, hours: float) -> int:
    """Delete staged tables that were last written more than ``hours`` ago; how many went.

    Choose more hours than the longest run takes: a run reads its own staged tables to its end.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/fleetlake")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    oldest = time.time() * 1000 - hours * 3_600_000
    gone = [status.getPath() for status in fs.listStatus(folder) if status.getModificationTime() < oldest]
    for path in gone:
        fs.delete(path, True)
    return len(gone)
