"""Mergeable sketches by key and day: percentiles (KLL) and distinct counts (HLL) of any period.

For groups too large for the exact operators. A day's rows are read once and stored as one
sketch per key; a period is answered by merging the sketches of its days, and a new or corrected
day costs that day alone. Sketches have a fixed size whatever they have seen, are combined
map-side, and merge in any order.

The rank of a KLL estimate lies within ``RANK_ERROR`` of the level asked for, and a distinct
count within ``COUNT_ERROR`` of the true one (relative), with a probability far beyond 99.99 %:
both are several times the published error at 99 % for the sizes used here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.labels import iso_weekday
from flowgauge.operators.baselines import KEYS, LEVELS

#: Size of a KLL sketch: its rank error at 99 % is about 0.36 %.
KLL_SIZE = 800
RANK_ERROR = 0.015
#: Binary logarithm of the registers of an HLL sketch: its relative standard error is about 0.65 %.
HLL_SIZE = 14
COUNT_ERROR = 0.04


def day_sketches(rows: DataFrame, keys: list[str], day: str, value: str | None = None, item: str | None = None) -> DataFrame:
    """Per key and day the number of rows with a value, and the sketches of ``value`` (whole numbers) and ``item``."""
    made = []
    if value:
        made += [F.count(value).alias("n"), F.kll_sketch_agg_bigint(F.col(value).cast("long"), KLL_SIZE).alias("ranks")]
    if item:
        made.append(F.hll_sketch_agg(item, HLL_SIZE).alias("items"))
    return rows.groupBy(*keys, day).agg(*made)


def of_period(sketches: DataFrame, day: str, first: dt.date | str | None = None, last: dt.date | str | None = None) -> DataFrame:
    """The sketches of the days from ``first`` to ``last``; on a table stored by day only their files are read."""
    kept = sketches
    if first is not None:
        kept = kept.filter(F.col(day) >= F.lit(str(first)).cast("date"))
    if last is not None:
        kept = kept.filter(F.col(day) <= F.lit(str(last)).cast("date"))
    return kept


def merged_percentiles(sketches: DataFrame, by: list[str | Column], levels: dict[str, float]) -> DataFrame:
    """Estimated percentiles of all days of a group, each a value that occurred, and the number of values."""
    merged = sketches.filter("n > 0").groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("ranks", KLL_SIZE).alias("_ranks"))
    marks = [F.kll_sketch_get_quantile_bigint("_ranks", F.lit(float(level))).alias(name) for name, level in levels.items()]
    return merged.select(*[c for c in merged.columns if c != "_ranks"], *marks)


def sketched_baselines(days: DataFrame, first: dt.date | str | None = None, last: dt.date | str | None = None) -> DataFrame:
    """Estimated thresholds per station, weekday, hour and flow from day sketches (station_name, hour_period, flow_type, date).

    The same columns as the exact baselines, for any period; missing volumes are not counted.
    """
    keyed = of_period(days, "date", first, last).withColumn("day_of_week", iso_weekday(F.col("date")))
    found = merged_percentiles(keyed, KEYS, LEVELS)
    return found.select(*KEYS, *[F.col(c).cast("int").alias(c) for c in LEVELS])


def merged_distinct(sketches: DataFrame, by: list[str | Column], name: str = "items") -> DataFrame:
    """Estimated number of different items of all days of a group."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("items")).alias(name))


def rank_checks(rows: DataFrame, keys: list[str], value: str, estimates: DataFrame, levels: dict[str, float], error: float = RANK_ERROR) -> DataFrame:
    """Per group, whether each estimate's rank among the values lies within ``error`` of its level.

    An estimate covers the ranks from the share of smaller values to that of values not larger.
    One aggregate combined map-side over the rows joined with one row a group.
    """
    both = rows.join(estimates, keys)
    seen = F.col(value)
    counts = both.groupBy(*keys).agg(
        F.count(value).alias("observations"),
        *[F.count_if(seen < F.col(c)).alias(f"_below_{c}") for c in levels],
        *[F.count_if(seen <= F.col(c)).alias(f"_through_{c}") for c in levels],
    )
    total = F.col("observations")
    tests = [
        ((F.col(f"_below_{c}") / total - error <= level) & (F.col(f"_through_{c}") / total + error >= level)).alias(f"{c}_within_error")
        for c, level in levels.items()
    ]
    return counts.select(*keys, "observations", *tests)
