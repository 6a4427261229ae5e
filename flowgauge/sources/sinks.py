"""Keyed merges, append-only ledgers, replaced tables and change logs on plain Parquet."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last change of each key by ``order``; combined map-side, so a hot key is cheap."""
    rest = [c for c in changes.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    picked = changes.groupBy(*keys).agg(best)
    return picked.select(*[F.col("_last")[c].alias(c) if c in rest else F.col(c) for c in changes.columns])


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], update: list[str] | None = None) -> DataFrame:
    """``target`` with ``changes`` (one row per key) applied.

    A known key takes the change's values in the ``update`` columns (all by default)
    and keeps the rest; an unknown key is inserted whole. One shuffled outer join.
    """
    columns = target.columns
    update = update if update is not None else [c for c in columns if c not in keys]
    new = changes.select(
        *keys, *[F.col(c).alias(f"_new_{c}") if c in changes.columns else F.lit(None).alias(f"_new_{c}") for c in columns if c not in keys]
    ).withColumn("_changed", F.lit(True))
    joined = target.withColumn("_old", F.lit(True)).join(new, keys, "full_outer")

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in update:
            return F.when(F.col("_changed"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c)

    return joined.select(*[value(c) for c in columns])


def delete_matching(target: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the keys listed in ``doomed``."""
    return target.join(doomed.select(*keys).distinct(), keys, "left_anti")


def append_ledger(df: DataFrame, path: str) -> None:
    """Append-only write."""
    df.write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows of a ledger; none if nothing was appended yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Write one run's part of a ledger; a run that is done again overwrites its own part."""
    df.write.mode("overwrite").parquet(f"{path}/run={quote(run_id, safe='')}")


def other_runs(spark: SparkSession, path: str, schema: str, run_id: str) -> DataFrame:
    """What other runs have written to a ledger."""
    # Spark gives a folder's name unquoted
    return read_ledger(spark, path, f"{schema}, run string").filter(F.col("run") != run_id).drop("run")


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Truncate and reload a stored table; ``df`` must not read ``path``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def snapshot_once(df: DataFrame, path: str) -> None:
    """Keep the first state ever seen; later calls leave it untouched."""
    df.write.mode("ignore").parquet(path)


def log_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch to a change log; a replay overwrites its own part only."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_log(spark: SparkSession, path: str, schema) -> DataFrame:
    """All logged changes with their ``batch_id``; the schema is given, so nothing is inferred."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    fields = [f for f in schema.fields if f.name != "batch_id"]
    return spark.read.schema(T.StructType([*fields, T.StructField("batch_id", T.LongType())])).parquet(path)


def current_rows(log: DataFrame, keys: list[str], order: list[str], removed: str | None = None) -> DataFrame:
    """The live state of a change log: last change per key, removed keys left out."""
    rows = latest_per_key(log, keys, order)
    return rows.filter(~F.col(removed)) if removed else rows


def compact_log(log: DataFrame, keys: list[str], order: list[str], path: str) -> None:
    """Write the last change per key as the first part of a new, shorter log.

    The new log needs a folder of its own. Stop the stream, compact, start it again on the
    new log with a new checkpoint that begins where the old one ended, then drop the old log:
    a stream still running would go on writing to the old one.
    """
    if any(f.startswith((path, f"file:{path}", f"file://{path}")) for f in log.inputFiles()):
        raise ValueError("a log cannot be compacted onto itself")
    latest = latest_per_key(log, keys, order).drop("batch_id")
    log_batch(latest, path, 0)
