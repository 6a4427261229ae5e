"""Day spines and nearest-day matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import labels


def day_spine(spark: SparkSession, start: str, days: int) -> DataFrame:
    """``days`` consecutive dates from ``start``."""
    first = F.lit(start).cast("date")
    return spark.range(1).select(F.explode(F.sequence(first, F.date_add(first, days - 1))).alias("date"))


def station_hour_grid(dates: DataFrame, stations: list[str] | None = None) -> DataFrame:
    """Every station and hour for each distinct date (one output row per cell)."""
    names = F.array(*[F.lit(s) for s in stations or fixed.STATIONS])
    return (
        dates.select("date").distinct()
        .withColumn("station_name", F.explode(names))
        .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    )


def nearest_days(days: DataFrame, base_year: int) -> DataFrame:
    """For each date the base-year date of the same month and weekday closest in day of month.

    Candidates lie seven days apart, so two are never equally close. The join is on
    (month, weekday) against at most 366 rows, and the minimum is pre-aggregated.
    """
    spark = days.sparkSession
    base = spark.range(1).select(
        F.explode(labels.range_step(f"{base_year}-01-01", f"{base_year}-12-31")).alias("baseline_date")
    ).select(
        "baseline_date",
        F.month("baseline_date").alias("_m"),
        labels.iso_weekday(F.col("baseline_date")).alias("_w"),
    )
    wanted = days.select("date").distinct().withColumn("_m", F.month("date")).withColumn(
        "_w", labels.iso_weekday(F.col("date"))
    )
    gap = F.abs(F.dayofmonth("baseline_date") - F.dayofmonth("date"))
    return (
        wanted.join(F.broadcast(base), ["_m", "_w"])
        .groupBy("date")
        .agg(F.min(F.struct(gap.alias("gap"), "baseline_date")).alias("best"))
        .select("date", F.col("best.baseline_date").alias("baseline_date"))
    )
