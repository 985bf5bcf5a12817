"""Session settings and the shared folder that jobs write their scratch tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key in a sort-merge join is split, also where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # A run has some hundreds of generated stages; keep them compiled for the next run.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build_session(app: str = "syncloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session may fall back to a temporary folder of the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    fallback = tempfile.mkdtemp(prefix="syncloom-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def together(*actions: Callable) -> list:
    """Run independent Spark actions side by side, so that none leaves the cluster idle."""
    spark = SparkSession.active()
    with ThreadPoolExecutor(len(actions)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]
        return [action.result() for action in started]


def no_rows(spark: SparkSession, ddl: str) -> DataFrame:
    """An empty table, which the planner knows to be empty."""
    fields = T.StructType.fromDDL(ddl).fields
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return spark.range(1).where(F.lit(False)).select(*columns)


class Workspace:
    """Tables that one run writes once and reads several times.

    A written table survives lost executors, cuts the lineage, and gives the
    planner true sizes, so that it broadcasts a side only when that side is small.
    """

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark = spark
        # A folder of its own, also for a run that starts over while the first may linger.
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))
