"""Forecast rows, horizons, drift, station status and the known-events feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices, labels
from flowgauge.operators import triggers
from flowgauge.operators.calendar import day_spine

HORIZON_KEYS = {
    "day": ["date"],
    "month": ["year", "month_num", "month_name"],
    "quarter": ["year", "quarter"],
}


def local_day(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp").cast("date")


def forecast(
    baselines: DataFrame,
    model: DataFrame | None,
    weather_scores: DataFrame,
    event_scores: DataFrame,
    as_of: str,
    days: int = 366,
    only: list[dt.date] | None = None,
) -> DataFrame:
    """One row per day, hour, station and flow from ``as_of`` (local time) on; ``only`` picks days of these.

    The base is the model's output where there is one, else the median. The calendar
    has ``days`` rows and joins on weekday; every score joins on equality.

    Baselines are a small table in one or two files while the forecast is hundreds of
    times larger, so they are spread over all cores before the calendar multiplies them.
    """
    spark = baselines.sparkSession
    spine = day_spine(spark, as_of[:10], days).withColumn("day_of_week", labels.iso_weekday(F.col("date")))
    if only is not None:
        spine = spine.filter(F.col("date").isin(only))
    cores = spark.sparkContext.defaultParallelism
    spread_out = baselines.repartition(cores, "station_name", "hour_period", "flow_type")
    rows = spread_out.join(F.broadcast(spine), "day_of_week")
    keys = ["station_name", "date", "hour_period", "flow_type"]
    if model is None:
        rows = rows.withColumn("_model", F.lit(None).cast("decimal(12,3)"))
    else:
        outputs = model.select(
            "station_name",
            F.col("prediction_date").alias("date"),
            "hour_period",
            "flow_type",
            F.col("baseline_mean_forecast").alias("_model"),
        ).filter(F.col("date").between(F.lit(as_of[:10]).cast("date"), F.date_add(F.lit(as_of[:10]).cast("date"), days - 1)))
        rows = rows.join(outputs, keys, "left")
    rows = triggers.with_cfi(triggers.with_scores(rows, weather_scores, event_scores))
    scores = [F.col(c) for c in triggers.SCORES]
    weather, academic, civic, operational = scores
    base = F.coalesce(F.col("_model").cast("decimal(12,3)"), F.col("median_volume").cast("decimal(12,3)"), F.lit(0))
    factor = indices.calendar_factor(F.col("date"), F.col("hour_period"), F.col("station_name"), F.col("flow_type"))
    rows = rows.withColumn(
        "adjusted_forecast_volume", indices.adjusted_volume(base, factor, weather, academic, civic, operational)
    )
    return rows.select(
        F.col("date").alias("prediction_date"),
        "hour_period",
        "station_name",
        "flow_type",
        "day_of_week",
        F.coalesce(F.col("median_volume"), F.lit(0)).alias("baseline_mean_forecast"),
        *triggers.SCORES,
        "cfi",
        "adjusted_forecast_volume",
        "warning_threshold",
        "critical_threshold",
        indices.threat(
            indices.raw_cfi(*scores),
            F.col("adjusted_forecast_volume"),
            F.col("warning_threshold"),
            F.col("critical_threshold"),
        ).alias("predicted_threat_level"),
    )


def forecast_24h(metrics: DataFrame, as_of: str) -> DataFrame:
    """Hours from one before ``as_of`` to 24 after it, both ends included."""
    now = F.lit(as_of).cast("timestamp")
    at = F.to_timestamp(F.concat_ws(" ", F.col("prediction_date").cast("string"), F.col("hour_period")), "yyyy-MM-dd HH:mm")
    first_day = F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 1 HOUR")
    window = metrics.filter(
        F.col("prediction_date").between(first_day.cast("date"), F.date_add(now.cast("date"), 1))
        & (at >= first_day)
        & (at <= now + F.expr("INTERVAL 24 HOURS"))
    )
    base, adjusted = F.col("baseline_mean_forecast"), F.col("adjusted_forecast_volume")
    return window.select(
        "station_name",
        "flow_type",
        F.col("prediction_date").alias("date"),
        F.col("hour_period").alias("time"),
        base.alias("baseline"),
        adjusted.alias("predicted"),
        (adjusted - base).alias("surge_volume"),
        indices.surge_percent(adjusted, base).alias("surge_variance_percentage"),
        *triggers.SCORES,
        "cfi",
        "warning_threshold",
        "critical_threshold",
        "predicted_threat_level",
    )


def rollup_horizon(metrics: DataFrame, period: str, first: Column, after: Column) -> DataFrame:
    """Sums and peak index per station, flow and ``period`` in ``[first, after)``."""
    day = F.col("prediction_date")
    rows = metrics.filter((day >= first) & (day < after)).select(
        "station_name",
        "flow_type",
        day.alias("date"),
        F.year(day).alias("year"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"),
        "baseline_mean_forecast",
        "adjusted_forecast_volume",
        "cfi",
    )
    sums = rows.groupBy("station_name", "flow_type", *HORIZON_KEYS[period]).agg(
        F.sum("baseline_mean_forecast").alias("baseline"),
        F.sum("adjusted_forecast_volume").alias("predicted"),
        F.max("cfi").alias("max_cfi"),
    )
    surge = F.col("predicted") - F.col("baseline")
    return sums.withColumn("surge_volume", surge).withColumn(
        "surge_variance_percentage", indices.surge_percent(F.col("predicted"), F.col("baseline"))
    )


_MEASURES = ["baseline", "predicted", "surge_volume", "surge_variance_percentage", "max_cfi"]


def forecast_1w(metrics: DataFrame, as_of: str) -> DataFrame:
    today = local_day(as_of)
    out = rollup_horizon(metrics, "day", today, F.date_add(today, 7))
    return out.select("station_name", "flow_type", "date", F.date_format("date", "EEEE").alias("time"), *_MEASURES)


def forecast_1m(metrics: DataFrame, as_of: str) -> DataFrame:
    today = local_day(as_of)
    out = rollup_horizon(metrics, "day", today, F.date_add(today, 30))
    return out.select("station_name", "flow_type", "date", F.date_format("date", "yyyy-MM-dd").alias("time"), *_MEASURES)


def forecast_quarterly(metrics: DataFrame, as_of: str) -> DataFrame:
    """Four quarters from the current one; the first is partial, as forecasts start today."""
    start = F.trunc(local_day(as_of), "quarter")
    out = rollup_horizon(metrics, "quarter", start, F.add_months(start, 12))
    label = F.concat_ws(" ", F.col("quarter"), F.col("year").cast("string"))
    return out.select("station_name", "flow_type", "year", "quarter", label.alias("time"), *_MEASURES)


def forecast_1y(metrics: DataFrame, as_of: str) -> DataFrame:
    """Twelve months from the current one; the first is partial."""
    start = F.trunc(local_day(as_of), "month")
    out = rollup_horizon(metrics, "month", start, F.add_months(start, 12))
    return out.select("station_name", "flow_type", "year", F.col("month_name").alias("time"), "month_num", *_MEASURES)


def model_drift(model: DataFrame, actuals: DataFrame) -> DataFrame:
    """Error and absolute percentage error of every prediction that has an actual.

    If both sides are stored with their weekday it is a join key too, so that tables bucketed
    by the baselines' keys meet where they lie.
    """
    weekday = [c for c in ("day_of_week",) if c in model.columns and c in actuals.columns]
    made = model.select(
        *weekday,
        F.col("prediction_date").alias("date"),
        "hour_period",
        "station_name",
        "flow_type",
        F.col("baseline_mean_forecast").alias("predicted_volume"),
    )
    both = made.join(actuals, [*weekday, "date", "hour_period", "station_name", "flow_type"])
    error = F.col("volume") - F.col("predicted_volume")
    share = F.round(
        F.abs(error).cast("decimal(20,4)") / F.nullif(F.col("volume").cast("decimal(12,0)"), F.lit(0).cast("decimal(12,0)")) * 100, 2
    )
    return both.select(
        "date",
        "hour_period",
        "station_name",
        "flow_type",
        F.col("volume").alias("actual_volume"),
        "predicted_volume",
        error.alias("error"),
        F.when(F.col("volume") == 0, indices.num("0.00")).otherwise(share).alias("absolute_percentage_error"),
    )


def station_status(baselines: DataFrame, descriptive: DataFrame, next_day: DataFrame, as_of: str) -> DataFrame:
    """Load and class of every station and flow in the hour of ``as_of``."""
    now = F.lit(as_of).cast("timestamp")
    this_hour = labels.hour_label(F.hour(now))
    keys = ["station_name", "flow_type"]
    seen = descriptive.filter((F.col("date") == now.cast("date")) & (F.col("time_period") == this_hour)).select(
        *keys, F.col("actual_volume").alias("_current")
    )
    coming = next_day.filter((F.col("date") == now.cast("date")) & (F.col("time") == this_hour)).select(
        *keys, F.col("predicted").alias("_predicted")
    )
    rows = (
        baselines.filter((F.col("day_of_week") == labels.iso_weekday(now.cast("date"))) & (F.col("hour_period") == this_hour))
        .join(seen, keys, "left")
        .join(coming, keys, "left")
    )
    hour = F.hour(now)
    median, warning, critical = F.col("median_volume"), F.col("warning_threshold"), F.col("critical_threshold")
    load = (hour, F.col("_predicted"), F.col("_current"), median, warning, critical)
    closed = indices.gates_closed(hour)
    return rows.select(
        labels.display_id(F.col("station_name")).alias("station_id"),
        *keys,
        F.when(closed, 0).otherwise(F.coalesce(F.col("_current"), median, F.lit(0))).alias("current_occupancy"),
        F.when(closed, 0).otherwise(F.coalesce(F.col("_predicted"), median, F.lit(0))).alias("predicted_occupancy"),
        F.greatest(warning, F.lit(100)).alias("threshold"),
        indices.capacity_percent(*load).alias("capacity_percentage"),
        indices.capacity_status(*load).alias("status_classification"),
    )


def notable_events(events: DataFrame) -> DataFrame:
    """Named events that are worth showing; repeats are left in."""
    name = F.col("event_name")
    keep = name.isNotNull() & (name != "") & ~F.col("event_category").isin(fixed.NOTABLE_EXCLUDED_CATEGORIES)
    for pattern in fixed.NOTABLE_EXCLUDED_WORDS:
        keep = keep & ~name.ilike(pattern)
    return events.filter(keep).select(
        "event_date", "event_name", "event_category", "trigger_category", "source_name", "normalized_score"
    )


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group; Spark trims each map task to ``k`` before shuffling."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def known_events(events: DataFrame, as_of: str) -> DataFrame:
    """Seven horizons: today, the week by day, four quarters and the year by month.

    Today's list removes repeats and keeps three. The other six horizons keep one event
    each per day or month, which is a minimum over (score, names): it is combined
    map-side in one pass over the events, with no sort and no shuffle of the rows.
    """
    rows = notable_events(events)
    today = local_day(as_of)
    day = F.col("event_date")
    # highest score first, a missing score before all
    rank = [F.col("normalized_score").isNotNull(), -F.col("normalized_score"), F.col("event_name"), F.col("source_name")]

    now = (
        rows.filter((day == today) & F.col("trigger_category").isin(fixed.TODAY_TRIGGERS))
        .distinct()
        .select(
            F.lit(0).alias("horizon_index"),
            labels.lookup(F.col("trigger_category"), fixed.TODAY_TIMES, F.lit(fixed.TODAY_TIME_DEFAULT)).alias("time"),
            "event_name",
            "source_name",
            "normalized_score",
        )
    )
    first = top_per_group(now, ["horizon_index"], [*rank, F.col("time")], 3)

    in_week = day.between(today, F.date_add(today, 6)) & F.col("trigger_category").isin(fixed.WEEK_TRIGGERS)
    in_season = F.col("trigger_category").isin(fixed.SEASON_TRIGGERS) & F.col("event_category").isin(fixed.SEASON_CATEGORIES)
    for pattern in fixed.SUSPENSION_WORDS:
        in_season = in_season & ~F.col("event_name").ilike(pattern)

    def slot(test: Column, index: Column, time: str) -> Column:
        return F.when(test, F.struct(index.cast("int").alias("horizon_index"), F.date_format(day, time).alias("time")))

    # a month shows in its quarter (2..5) and in the year (6)
    slots = F.array(
        slot(in_week, F.lit(1), "EEE"), slot(in_season, F.quarter(day) + 1, "MMM"), slot(in_season, F.lit(6), "MMM")
    )
    placed = rows.select(F.explode(F.array_compact(slots)).alias("_slot"), "event_name", "source_name", "normalized_score")
    best = (
        placed.groupBy("_slot.horizon_index", "_slot.time")
        .agg(F.min(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(rank)])).alias("_best"))
        .select("horizon_index", "time", F.col("_best.k2").alias("event"), F.col("_best.k3").alias("source_name"))
    )
    return first.select("horizon_index", "time", F.col("event_name").alias("event"), "source_name").unionByName(best)
