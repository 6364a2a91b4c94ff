"""Session settings and scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: event times are cut in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def get_session(app_name: str = "eventlake", **conf: str) -> SparkSession:
    """A session with adaptive execution; master and sizes come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which every executor shares, in a folder
    of its own that goes when the application ends.

    Only a local master may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="eventlake-")
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{path}/data"


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage, so several readers share the work
    and the loss of an executor does not repeat it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def side_by_side(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Run steps that do not need each other at once, so that the small stages and the last tasks of
    one leave no cores idle. Returns their results in order once all have ended; the first error is
    raised then. Their jobs keep the job group of the caller, so a stream that is stopped stops them."""
    with ThreadPoolExecutor(len(steps)) as threads:
        running = [threads.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]
