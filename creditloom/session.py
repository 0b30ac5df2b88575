"""Spark session defaults and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Runtime settings the operators are written for. Partition counts are left to adaptive execution, which
# merges small shuffle partitions and splits large ones from the sizes it measures.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Tables in buckets by customer are joined on customer and month without a shuffle; hot customers are salted instead.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python line of every column expression makes tables with hundreds of columns slow to plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "creditloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the library's settings; `master` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`, which every executor can read.

    A session in one process may do without that setting; it then has one temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _own_folder()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="creditloom-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_root(spark)}/creditloom-{uuid.uuid4().hex}"


def scratch_folder(spark: SparkSession, name: str, source: str) -> str:
    """The folder of a query over a source, the same on every call, for tables that each call overwrites."""
    return f"{shared_root(spark)}/creditloom/{name}-{zlib.crc32(source.encode()):08x}"


def side_by_side(spark: SparkSession, parts: Mapping[str, Callable]) -> dict:
    """Results by name of parts that need nothing of each other, run at the same time so that a small one fills the cores that the last tasks
    of a large one leave idle. Each keeps the caller's local properties; all have ended when one that failed is raised."""
    with ThreadPoolExecutor(len(parts)) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(part)) for name, part in parts.items()}
    return {name: job.result() for name, job in begun.items()}
