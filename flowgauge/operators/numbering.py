"""Consecutive numbers over a global order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions.labels import padded
from flowgauge.session import stage

_LOW_BITS = (1 << 33) - 1


def number_rows(
    df: DataFrame, order_by: list[str], within: list[str] | None = None, name: str = "number"
) -> DataFrame:
    """Number rows 1, 2, ... by ``order_by``, restarting for each value of ``within``.

    Rows are range-partitioned on the whole order plus a row hash, so neither a hot
    group nor equal sort keys pile up in one task. Chunk and in-chunk position are
    written to the shared folder before they are used; a lost executor cannot change
    them. Only one row per chunk (and one per group) is gathered to add up offsets.
    """
    within = within or []
    keys = [*within, *order_by]
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    chunked = (
        df.withColumn("_tie", tie)
        .repartitionByRange(*[F.col(c) for c in keys], F.col("_tie"))
        .sortWithinPartitions(*keys, "_tie")
        .withColumn("_chunk", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_tie")
    )
    rows = stage(chunked, "numbered")
    # one row per chunk: as many rows as the stage above had tasks
    sizes = rows.groupBy("_chunk").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(F.broadcast(offsets), "_chunk").withColumn("_place", F.col("_before") + F.col("_at"))
    if not within:
        return placed.withColumn(name, F.col("_place") + 1).select(*df.columns, name)
    starts = stage(
        placed.groupBy(*within).agg(F.min("_place").alias("_start")), "group-starts"
    ).select(*[F.col(c).alias(f"_g_{c}") for c in within], "_start")
    same = None
    for c in within:
        test = F.col(c).eqNullSafe(F.col(f"_g_{c}"))
        same = test if same is None else same & test
    return placed.join(starts, same).withColumn(name, F.col("_place") - F.col("_start") + 1).select(*df.columns, name)


def sequential_ids(
    df: DataFrame,
    prefix: str | Column,
    width: int,
    order_by: list[str],
    within: list[str] | None = None,
    name: str = "id",
    after: int | Column = 0,
) -> DataFrame:
    """``number_rows`` rendered as prefix plus zero-padded number, going on after the number ``after``."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    numbered = number_rows(df, order_by, within, "_number")
    number = F.col("_number") + (F.lit(after) if isinstance(after, int) else after)
    return numbered.withColumn(name, F.concat(head, padded(number, width))).drop("_number")


def last_number(ledger: DataFrame, column: str, prefix: str) -> Column:
    """The largest number among the ids of a ledger, 0 if it is empty, as a scalar subquery."""
    number = F.substring(column, len(prefix) + 1, 20).cast("long")
    return ledger.agg(F.coalesce(F.max(number), F.lit(0).cast("long"))).scalar()
