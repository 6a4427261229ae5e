"""The stored year: forecast sums by day, of which only days that something changed are made again.

The store holds three tables. ``facts``: the hourly actuals by weekday and year; ``baselines``
by weekday; ``daily``: per prediction date, station and flow the sums that the long horizons
add up. A forecast day depends on

* the weather and the events of its own date,
* the actuals a week before, through the model,
* the baselines of its weekday, hence on all actuals of that weekday, but only if these
  change a baseline.

A refresh is told which dates of which source changed. It reads these dates from the sources,
replaces them in ``facts``, works out the baselines of their weekdays again, and finds the
forecast days that depend on any of this; only these are made again, and their partitions
overwritten. The baselines are stored last: a refresh that died is simply done again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions.labels import iso_weekday
from flowgauge.operators import baselines, evaluate, forecast, triggers
from flowgauge.operators.calendar import day_spine
from flowgauge.session import stage, stage_all
from flowgauge.sources.buckets import children

Dates = list[dt.date]
FACT = "hour_period string, station_name string, flow_type string, volume long, date date, day_of_week int, year int"
BASELINE = "station_name string, hour_period string, flow_type string, median_volume int, warning_threshold int, critical_threshold int, day_of_week int"


@dataclass(frozen=True)
class Sources:
    """The rows of given dates, or all: hourly actuals, scored weather, calendar events."""

    facts: Callable[[Dates | None], DataFrame]
    weather: Callable[[Dates | None], DataFrame]
    events: Callable[[Dates | None], DataFrame]


@dataclass(frozen=True)
class Changes:
    """The dates that changed in each source, whole dates; a date may have lost all its rows."""

    facts: Dates = field(default_factory=list)
    weather: Dates = field(default_factory=list)
    events: Dates = field(default_factory=list)


@dataclass(frozen=True)
class YearStore:
    root: str
    as_of: str
    days: int = 366

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def horizon(self) -> Dates:
        first = dt.date.fromisoformat(self.as_of[:10])
        return [first + dt.timedelta(days=n) for n in range(self.days)]

    def facts(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(FACT).parquet(self.path("facts"))

    def baselines(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(BASELINE).parquet(self.path("baselines"))

    def daily(self, spark: SparkSession) -> DataFrame:
        """The stored days of the horizon."""
        first, last = self.horizon()[0], self.horizon()[-1]
        return spark.read.parquet(self.path("daily")).filter(F.col("prediction_date").between(F.lit(first), F.lit(last)))


def by_weekday(facts: DataFrame) -> DataFrame:
    keyed = facts.withColumns({"day_of_week": iso_weekday(F.col("date")).cast("int"), "year": F.year("date")})
    return keyed.select("hour_period", "station_name", "flow_type", F.col("volume").cast("long").alias("volume"), "date", "day_of_week", "year")


def store_parts(df: DataFrame, path: str, *by: str) -> None:
    """Overwrite the partitions that ``df`` has rows of; all others stay."""
    spread = df.repartition(*by)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def daily_sums(
    store: YearStore, base: DataFrame, sources: Sources, dates: Dates | None
) -> DataFrame:
    """The sums of the given forecast days (all of the horizon by default) from the sources of just these days."""
    wanted = store.horizon() if dates is None else dates
    model = evaluate.prior_week_model(sources.facts([d - dt.timedelta(days=7) for d in wanted]))
    parts = stage_all(
        {
            "weather": triggers.hourly_weather(sources.weather(wanted)),
            "scores": triggers.station_scores(triggers.scope_scores(sources.events(wanted), triggers.FORECAST_CIVIC, hour_aware=False)),
        }
    )
    rows = forecast.forecast(base, model, parts["weather"], parts["scores"], store.as_of, store.days, only=dates)
    return rows.groupBy("station_name", "flow_type", "prediction_date").agg(
        F.sum("baseline_mean_forecast").alias("baseline_mean_forecast"),
        F.sum("adjusted_forecast_volume").alias("adjusted_forecast_volume"),
        F.max("cfi").alias("cfi"),
    )


def build_year(store: YearStore, sources: Sources) -> None:
    """Fill an empty store from all rows of the sources."""
    spark = SparkSession.active()
    store_parts(by_weekday(sources.facts(None)), store.path("facts"), "day_of_week", "year")
    base = stage(baselines.threshold_baselines(store.facts(spark)), "baselines")
    store_parts(daily_sums(store, base, sources, None), store.path("daily"), "prediction_date")
    store_parts(base, store.path("baselines"), "day_of_week")


def changed_weekdays(old: DataFrame, new: DataFrame) -> list[int]:
    """The weekdays, seven at most, of which some baseline is not what it was."""
    new = new.select(*old.columns)
    differ = old.exceptAll(new).unionAll(new.exceptAll(old)).select("day_of_week").distinct()
    return sorted(r.day_of_week for r in differ.collect())


def refresh_year(store: YearStore, sources: Sources, changes: Changes) -> Dates:
    """Bring the store up to date after ``changes``; returns the forecast days that were made again.

    Days of the horizon that the store has none of yet, as when ``as_of`` has moved on, are made too.
    """
    spark = SparkSession.active()
    days = sorted(set(changes.facts))
    moved: list[int] = []
    base = store.baselines(spark)
    if days:
        touched = sorted({(d.isoweekday(), d.year) for d in days})
        part = F.struct("day_of_week", "year").isin([F.struct(F.lit(w), F.lit(y)) for w, y in touched])
        weekdays = sorted({w for w, _ in touched})
        # the partitions of these weekdays and years only
        kept = store.facts(spark).filter(F.col("day_of_week").isin(weekdays) & F.col("year").isin(sorted({y for _, y in touched})) & part & ~F.col("date").isin(days))
        fresh = stage(kept.unionByName(by_weekday(sources.facts(days))), "changed-facts")
        store_parts(fresh, store.path("facts"), "day_of_week", "year")
        of_days = F.col("day_of_week").isin(weekdays)
        again = stage(baselines.threshold_baselines(store.facts(spark).filter(of_days)), "changed-baselines")
        again = again.withColumn("day_of_week", F.col("day_of_week").cast("int")).select(*base.columns)
        moved = changed_weekdays(base.filter(of_days), again)
        base = base.filter(~of_days).unionByName(again)
    horizon = store.horizon()
    there = {n.removeprefix("prediction_date=") for n in children(spark, store.path("daily"))}
    due = {*changes.weather, *changes.events, *(d + dt.timedelta(days=7) for d in days)}
    due |= {d for d in horizon if d.isoweekday() in moved or d.isoformat() not in there}
    dates = sorted(due & set(horizon))
    if dates:
        # of the baselines too only the weekdays of these days are read
        needed = base.filter(F.col("day_of_week").isin(sorted({d.isoweekday() for d in dates})))
        store_parts(daily_sums(store, needed, sources, dates), store.path("daily"), "prediction_date")
    if moved:
        store_parts(stage(base.filter(F.col("day_of_week").isin(moved)), "baselines"), store.path("baselines"), "day_of_week")
    return dates


def stored_year(store: YearStore) -> DataFrame:
    """The year view from the stored days."""
    return forecast.forecast_1y(store.daily(SparkSession.active()), store.as_of)

