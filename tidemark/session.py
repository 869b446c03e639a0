"""Session defaults and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"
ARROW_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "tidemark", cpus: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and benches; on a cluster use the session it hands out."""
    cpus = cpus or os.cpu_count() or 1
    settings = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    Only a local session may fall back to a temporary folder of its own.
    """
    named = spark.conf.get(SHARED_DIR_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_CONF} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(SHARED_DIR_CONF, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below a folder of this application, which may be removed once it has ended."""
    return f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point iterative jobs (boosting) at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs that start within it hand rows to Python functions in batches of about ``most`` bytes, unless the session sets a size itself.

    Without it batches of 10,000 rows or 64 MB are held by the executor and again by Python.
    """
    if spark.conf.get(ARROW_BYTES_CONF, None) is not None:
        yield
        return
    spark.conf.set(ARROW_BYTES_CONF, f"{most}b")
    try:
        yield
    finally:
        spark.conf.unset(ARROW_BYTES_CONF)


def materialize(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For a result that several branches read: computed once, it survives the loss of
    executors, and every branch sees the same rows. ``file_rows`` bounds the rows of a file, for rows of megabytes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the folders of frames that ``materialize`` returned, once nothing reads them any more.

    Only for frames whose every dependant has been written: a lost task could not be repeated without them.
    """
    for df in frames:
        files = df.inputFiles()
        if files:
            sc = df.sparkSession.sparkContext
            folder = sc._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            if f"tidemark-{sc.applicationId}" in folder.toString():
                folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
