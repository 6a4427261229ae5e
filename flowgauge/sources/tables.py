"""Fact tables: year-partitioned scans, pending source years, other stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowgauge.functions import labels
from flowgauge.operators.allocate import expand_bands
from flowgauge.session import new_folder, stage
from flowgauge.sources.sinks import append_ledger, read_ledger


def write_facts(wide: DataFrame, path: str, mode: str = "append") -> None:
    """Wide rows into one table partitioned by year."""
    wide.withColumn("year", F.year("date")).write.mode(mode).partitionBy("year").parquet(path)


def read_facts(spark: SparkSession, path: str, years: list[int] | None = None, totals: bool = False) -> DataFrame:
    """All years as one table; the year filter prunes partitions, the label filter reaches the scan."""
    rows = spark.read.parquet(path)
    if years:
        rows = rows.filter(F.col("year").isin(years))
    return rows if totals else rows.filter(~labels.is_total(F.col("time_period")))


def store_bucketed(df: DataFrame, label: str, keys: list[str], buckets: int) -> DataFrame:
    """Store ``df`` as a catalog table in the shared folder, bucketed and sorted by ``keys``, and read it.

    Tables with the same buckets are joined and grouped on these keys where they lie, without a
    shuffle. A join whose keys hold more than these needs the setting `co_located` makes. The
    rows are dealt to the buckets first, so each is one file. Choose ``buckets`` by the size of
    the largest table: a bucket is the work of one task, so a key that holds much of the rows
    belongs into an unbucketed table, where adaptive execution splits it.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    name = f"{label.replace('-', '_')}_{path.rsplit('-', 1)[-1]}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def co_located(spark: SparkSession) -> None:
    """Let joins use buckets by a part of their keys."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def union_years(frames: list[DataFrame]) -> DataFrame:
    """Per-year tables of the same columns as one."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def pending_years(sources: DataFrame, processed: DataFrame) -> DataFrame:
    """Years present in ``sources`` and absent from the ``processed`` manifest."""
    return sources.select("year").distinct().join(processed.select("year").distinct(), "year", "left_anti")


def transform_pending(banded: DataFrame, out_path: str, manifest_path: str) -> DataFrame:
    """Expand every unprocessed year in one job, store it, and record it as processed.

    Returns the years handled. ``banded`` is the year-partitioned banded table. The list of
    years is stored first, so the facts and the manifest speak of the same ones. Whole years
    are overwritten: a pass that died before it recorded them is simply done again.
    """
    spark = banded.sparkSession
    todo = stage(pending_years(banded, read_ledger(spark, manifest_path, "year int")), "pending")
    rows = banded.join(todo, "year", "left_semi")
    hours = expand_bands(rows.drop("year")).withColumn("year", F.year("date"))
    hours.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(out_path)
    append_ledger(todo, manifest_path)
    return todo


def discover_years(
    spark: SparkSession, source: str, schema: T.StructType, out_path: str, checkpoint: str, files_per_trigger: int | None = None
) -> StreamingQuery:
    """Expand what has arrived below ``source`` since the last run, and end; the checkpoint is the manifest.

    Files are found by a file stream, so each is taken once and none is missed, also a late one of a
    year that was there before, which a list of years would pass over. Each batch is a part
    ``batch_id=N`` of the hours, by year; a replayed batch overwrites its own part. `read_discovered`
    reads them all. ``schema`` is that of the banded table with its year.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = stage(batch.drop("year"), "arrived", spark)
        hours = expand_bands(rows).withColumn("year", F.year("date"))
        hours.write.mode("overwrite").partitionBy("year").parquet(f"{out_path}/batch_id={batch_id}")

    writer = reader.parquet(source).writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(availableNow=True).start()


def read_discovered(spark: SparkSession, out_path: str, years: list[int] | None = None) -> DataFrame:
    """The hours of all batches; the year filter prunes partitions."""
    rows = spark.read.parquet(out_path).drop("batch_id")
    return rows.filter(F.col("year").isin(years)) if years else rows


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: str, upper: str, parts: int, **options: str
) -> DataFrame:
    """A live table read by many tasks, split on ``column``."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=str(parts), **options)
        .load()
    )


def publish(views: dict[str, DataFrame]) -> None:
    """Register frames as temporary views for SQL users."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
