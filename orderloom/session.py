"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from orderloom.sources import files

# Needed for right results or for surviving skew, so set whatever the cluster's defaults are.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when the split costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hash instead of sorting both sides where every partition of one side is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}

#: How the warehouse's tables are written: a third less than Spark's default, for some CPU time.
COMPACT = {"compression": "zstd"}

#: The planner guesses a table's size from its files, and broadcasts a small side as a hash table through the driver. Packed as
#: above, files hold about a tenth of the bytes that are read from them, and a hash table of short rows three to four times as
#: many as the rows: so many times its files' size a table counts.
UNPACKED = {"spark.sql.sources.fileCompressionFactor": "40.0"}


def spark_session(master: str | None = None, app_name: str = "orderloom", **conf) -> SparkSession:
    """A session with the required settings; sizes are left to spark-submit or ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session made elsewhere."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def size_unpacked(spark: SparkSession) -> SparkSession:
    """Let joins over packed tables be sized by what is made of their files, unless that is set higher."""
    for key, value in UNPACKED.items():
        if float(spark.conf.get(key)) < float(value):
            spark.conf.set(key, value)
    return spark


def in_parallel(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run independent jobs side by side, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in running]


_FALLBACK = threading.Lock()


def _scratch_root(spark: SparkSession) -> str:
    """This application's folder under the shared checkpoint folder.

    Only where driver and executors are one process may it be a temporary folder.
    """
    context = spark.sparkContext
    with _FALLBACK:
        shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not shared:
            if not is_one_process(context.master):
                raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="orderloom-"))
            shared = context.getCheckpointDir()
    return f"{shared.rstrip('/')}/orderloom-{context.applicationId}"


def is_one_process(master: str) -> bool:
    """Whether executors run inside the driver, as with ``local`` and ``local[8]``."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder that every executor can read, kept until ``release_scratch``."""
    return f"{_scratch_root(spark)}/{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch; frames that read from it cannot run any more."""
    files.remove(spark, _scratch_root(spark))


def settle(df: DataFrame, path: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back; ``options`` are the writer's.

    The lineage ends at files that outlive any executor, generated ids are fixed
    by the write, and the planner knows the true size of what it reads next.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
