"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("lotwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir.

    Where it is unset, a temporary folder on a single machine and an error on a cluster, whose
    executors could not see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if context_dir.isDefined():
        return context_dir.get()
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lotwise-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Used where a result feeds several branches of a plan: the branches read columns
    and row groups of a finished table, Catalyst knows its true size (which decides
    broadcast or shuffle), and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/lotwise-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*jobs: Callable[[], object]) -> list:
    """Results of independent jobs that run side by side."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
        return list(pool.map(lambda job: job(), [inherit(job) for job in jobs]))
