"""Session settings and staging of intermediate tables in the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER: dict[str, str] = {}


def build_session(app: str = "flowgauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE, skew handling)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # joins may use buckets by a part of their keys
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # call-site capture costs more than the calls on wide plans
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDER:
        _OWN_FOLDER[app] = tempfile.mkdtemp(prefix="flowgauge-")
    return _OWN_FOLDER[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    root = shared_folder(spark)
    return f"{root}/flowgauge/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, in another session if one is given.

    The copy cuts the lineage, survives lost executors, and carries file sizes, so
    Catalyst itself broadcasts it when it is below the broadcast threshold and uses a
    shuffled join when it is not.
    """
    spark = spark or df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage independent frames at the same time, so their jobs share the executors."""
    spark = next(iter(frames.values())).sparkSession
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(spark)(stage), df, name) for name, df in frames.items()}
        return {name: job.result() for name, job in jobs.items()}


def spread(df: DataFrame) -> DataFrame:
    """Input of CPU-heavy work in parts of even size, however it is stored (unsplittable or uneven files too)."""
    return df.hint("rebalance")


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application staged."""
    root = f"{shared_folder(spark)}/flowgauge/{spark.sparkContext.applicationId}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def table_path(folder: str, name: str) -> str:
    return os.path.join(folder, f"{name}.parquet")
