"""Stored state that micro-batches change in place: tables cut into buckets, and small marks.

A bucket table holds rows in a fixed number of buckets by a hash of their keys. A batch reads
and rewrites the buckets of its own keys and no others, so its cost follows the keys it
touches, however many batches came before. ``heads`` says which batch wrote each bucket last:
a new version is complete before the heads of its batch name it, a replayed batch starts
from the heads before it and writes the same again, and readers only follow heads that are
complete. Versions that the last two heads no longer name are deleted.

A mark is one small table per batch of which only the latest is wanted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.session import stage

BUCKETS = 64
#: How many heads or marks stay: the last, and the one a replay starts from.
KEPT = 2

Fold = Callable[[DataFrame, DataFrame], DataFrame]


def _place(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if there is no such folder."""
    files, place = _place(spark, path)
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The batches of which a complete part lies below ``path``, in order."""
    found = [int(n.removeprefix("batch=")) for n in children(spark, path) if n.startswith("batch=")]
    return sorted(n for n in found if "_SUCCESS" in children(spark, f"{path}/batch={n}"))


def write_mark(df: DataFrame, path: str, batch_id: int) -> None:
    """Write what the next batch goes on from; older marks but the one before are deleted."""
    spark = df.sparkSession
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    for old in [n for n in versions(spark, path) if n < batch_id][: 1 - KEPT or None]:
        remove(spark, f"{path}/batch={old}")


def read_mark(spark: SparkSession, path: str, schema: T.StructType | str, before: int | None = None) -> DataFrame | None:
    """The last mark, or the last one before a batch; None if there is none."""
    found = [n for n in versions(spark, path) if before is None or n < before]
    return spark.read.schema(schema).parquet(f"{path}/batch={found[-1]}") if found else None


@dataclass(frozen=True)
class BucketTable:
    """Rows of ``schema`` below ``path`` in ``buckets`` parts by the hash of ``keys``.

    ``buckets`` is fixed when the table is first written; choose it so that a bucket of the
    largest state expected is cheap to write again.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def heads(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """Which batch wrote each bucket last; at most ``buckets`` entries."""
        mark = read_mark(spark, f"{self.path}/heads", "bucket int, written long", before)
        return {r.bucket: r.written for r in mark.collect()} if mark else {}

    def read(self, spark: SparkSession, heads: dict[int, int] | None = None) -> DataFrame:
        """All rows, or those of the given versions of buckets."""
        heads = self.heads(spark) if heads is None else heads
        paths = [f"{self.path}/data/batch={written}/bucket={bucket}" for bucket, written in sorted(heads.items())]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def merge(self, changes: DataFrame, batch_id: int, fold: Fold, spark: SparkSession | None = None) -> list[int]:
        """Let ``fold(stored rows, changes)`` give the new rows of the buckets that ``changes`` touches.

        ``changes`` has the key columns; ``fold`` may shuffle as it likes but must neither add nor
        move keys. A stream's own session plans without adaptive execution, so the work is done
        in ``spark`` if given. Returns the touched buckets.
        """
        spark = spark or changes.sparkSession
        heads = self.heads(spark, before=batch_id)
        fresh = stage(changes.withColumn("_bucket", self.bucket()), "changes", spark)
        # at most one number a bucket
        touched = sorted(r._bucket for r in fresh.select("_bucket").distinct().collect())
        stored = self.read(spark, {b: heads[b] for b in touched if b in heads})
        rows = fold(stored, fresh.drop("_bucket")).select(*self.schema.names)
        target = f"{self.path}/data/batch={batch_id}"
        # one file a bucket, more where adaptive execution splits a large one
        dealt = rows.withColumn("bucket", self.bucket()).hint("rebalance", F.col("bucket"))
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(target)
        written = {int(n.removeprefix("bucket=")) for n in children(spark, target) if n.startswith("bucket=")}
        # a touched bucket may have lost all its rows
        new = {b: w for b, w in heads.items() if b not in touched} | dict.fromkeys(sorted(written), batch_id)
        write_mark(spark.createDataFrame(sorted(new.items()), "bucket int, written long"), f"{self.path}/heads", batch_id)
        self._sweep(spark, heads, new, batch_id)
        return touched

    def _sweep(self, spark: SparkSession, before: dict[int, int], now: dict[int, int], batch_id: int) -> None:
        """Delete the versions that neither these heads nor the ones before name."""
        named = set(before.items()) | set(now.items())
        for folder in children(spark, f"{self.path}/data"):
            written = int(folder.removeprefix("batch="))
            if written >= batch_id:
                continue
            path = f"{self.path}/data/{folder}"
            buckets = [n for n in children(spark, path) if n.startswith("bucket=")]
            gone = [n for n in buckets if (int(n.removeprefix("bucket=")), written) not in named]
            for name in gone if len(gone) < len(buckets) else []:
                remove(spark, f"{path}/{name}")
            if len(gone) == len(buckets):
                remove(spark, path)
