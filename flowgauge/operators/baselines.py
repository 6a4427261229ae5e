"""Percentile baselines per station, weekday, hour and flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions import indices
from flowgauge.functions.labels import iso_weekday

KEYS = ["station_name", "day_of_week", "hour_period", "flow_type"]
LEVELS = {"median_volume": 0.5, "warning_threshold": 0.8, "critical_threshold": 0.9}


def continuous_percentiles(df: DataFrame, keys: list[str], value: str, levels: dict[str, float]) -> DataFrame:
    """Exact interpolated percentiles from a histogram, ties rounded to even.

    First shuffle: counts per (keys, value), combined map-side, so a hot key spreads
    over its values. Second shuffle: one row per distinct value; the running count
    streams through a sort that can spill. Nothing holds a key's raw rows.
    """
    counts = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*keys)
    ranked = counts.withColumn(
        "_through", F.sum("_n").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("_all", F.sum("_n").over(group))

    def spot(level: float) -> Column:
        return F.lit(level) * (F.col("_all") - 1)

    picks = []
    for name, level in levels.items():
        low = F.floor(spot(level))
        high = F.ceil(spot(level))
        picks += [
            F.min(F.when(F.col("_through") > low, F.col("_v"))).alias(f"_low_{name}"),
            F.min(F.when(F.col("_through") > high, F.col("_v"))).alias(f"_high_{name}"),
            F.max(spot(level) - low).alias(f"_part_{name}"),
        ]
    edges = ranked.groupBy(*keys).agg(*picks)
    out = []
    for name in levels:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        out.append(indices.half_even(low + (high - low) * F.col(f"_part_{name}")).cast("int").alias(name))
    return edges.select(*keys, *out)


def with_weekday(actuals: DataFrame) -> DataFrame:
    """Actuals with their weekday, computed only where it is not stored."""
    return actuals if "day_of_week" in actuals.columns else actuals.withColumn("day_of_week", iso_weekday(F.col("date")))


def threshold_baselines(actuals: DataFrame, approximate: int | None = None) -> DataFrame:
    """P50 / P80 / P90 of volume per key; missing volumes count as zero.

    ``approximate`` (an accuracy such as 10000) trades exactness for one shuffle of
    fixed-size sketches; the default is exact.
    """
    rows = with_weekday(actuals).select(
        "station_name",
        "day_of_week",
        "hour_period",
        "flow_type",
        F.coalesce(F.col("volume"), F.lit(0)).alias("_volume"),
    )
    if approximate:
        marks = F.percentile_approx("_volume", list(LEVELS.values()), approximate)
        sketched = rows.groupBy(*KEYS).agg(marks.alias("_p"))
        return sketched.select(*KEYS, *[F.col("_p")[i].cast("int").alias(n) for i, n in enumerate(LEVELS)])
    return continuous_percentiles(rows, KEYS, "_volume", LEVELS)


def with_baselines(actuals: DataFrame, baselines: DataFrame, how: str = "left") -> DataFrame:
    """Actuals beside the baseline of their station, weekday, hour and flow.

    Actuals that are stored with their weekday keep it, and with it the buckets they lie in.
    """
    return with_weekday(actuals).join(baselines, KEYS, how)


def congestion_levels(actuals: DataFrame, baselines: DataFrame) -> DataFrame:
    """Actuals graded against their baseline."""
    return with_baselines(actuals, baselines).select(
        "date",
        "hour_period",
        "station_name",
        "flow_type",
        "volume",
        "median_volume",
        "warning_threshold",
        "critical_threshold",
        indices.congestion(F.col("volume"), F.col("warning_threshold"), F.col("critical_threshold")).alias(
            "congestion_level"
        ),
    )
