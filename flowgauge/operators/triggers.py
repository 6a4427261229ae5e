"""Weather and event scores per hour, and the disruption index built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices, labels
from flowgauge.operators.baselines import with_baselines
from flowgauge.operators.calendar import station_hour_grid

DESCRIPTIVE_CIVIC = ["class_suspension", "school_break"]
DESCRIPTIVE_ALL_DAY = ["school_break"]
FORECAST_CIVIC = ["class_suspension", "school_break", "holiday"]
SCORES = ["weather_score", "academic_surge_score", "civic_mandate_score", "operational_score"]


def hourly_weather(weather: DataFrame, zone: str = fixed.LOCAL_ZONE) -> DataFrame:
    """Highest score per weather date and local hour."""
    hour = F.hour(F.from_utc_timestamp("observed_or_forecasted_at", zone))
    return weather.groupBy(F.col("weather_date").alias("date"), hour.alias("hour")).agg(
        F.coalesce(F.max("normalized_score"), F.lit(0)).cast(indices.SCORE).alias("weather_score")
    )


def _merged() -> list[Column]:
    return [
        F.max("_academic").alias("_academic"),
        F.max("_operational").alias("_operational"),
        F.max("_all_day").alias("_all_day"),
        F.max("_plain").alias("_plain"),
        F.min("_first_notice").alias("_first_notice"),
        F.max("_last_notice").alias("_last_notice"),
    ]


def scope_scores(
    events: DataFrame,
    civic: list[str] = DESCRIPTIVE_CIVIC,
    all_day: list[str] = DESCRIPTIVE_ALL_DAY,
    hour_aware: bool = True,
    zone: str = fixed.LOCAL_ZONE,
) -> DataFrame:
    """One row per event date and scope (null = whole network).

    The hour-dependent civic score is kept as four facts that merge by min and max -
    an all-day notice, a non-civic event, the first and the last midday notice hour -
    so events are combined map-side and never expanded over hours or stations first.
    """
    notice = F.col("announcement_time")
    local_hour = F.hour(F.from_utc_timestamp(notice, zone))
    is_civic = F.coalesce(F.col("event_category").isin(civic), F.lit(False))
    if hour_aware:
        whole = (
            F.col("event_category").isin(all_day)
            | notice.isNull()
            | (F.to_date(notice) < F.col("event_date"))
            | (local_hour < fixed.EARLY_NOTICE_HOUR)
        )
    else:
        whole = F.lit(True)
    midday = is_civic & ~whole
    return events.groupBy("event_date", labels.scope_of(F.col("station")).alias("scope")).agg(
        F.max(F.when(F.col("event_category") == "major_event", F.col("normalized_score"))).alias("_academic"),
        F.max(F.when(F.col("friction_domain") == "operational", F.col("normalized_score"))).alias("_operational"),
        F.max(is_civic & whole).alias("_all_day"),
        F.max(~is_civic).alias("_plain"),
        F.min(F.when(midday, local_hour)).alias("_first_notice"),
        F.max(F.when(midday, local_hour)).alias("_last_notice"),
    )


def station_scores(scoped: DataFrame, stations: list[str] | None = None, fanout: bool = False) -> DataFrame:
    """Scope rows brought to stations: network-wide rows apply to each of them.

    Only the pre-aggregated network rows (one per date) are repeated. With ``fanout``
    a station row and a network row on the same date stay two rows, which doubles the
    sums of whatever joins them; otherwise they merge into one.
    """
    every = F.array(*[F.lit(s) for s in stations or fixed.STATIONS])
    own = F.array(F.col("scope"))
    spread = scoped.withColumn("station_name", F.explode(F.when(F.col("scope").isNull(), every).otherwise(own)))
    if fanout:
        return spread.drop("scope")
    return spread.groupBy("event_date", "station_name").agg(*_merged())


def civic_at(hour: Column) -> Column:
    """Civic score of a station row at ``hour``.

    1 when any notice holds all day or its transition is over; 0 when any other event
    or a notice still to come is on the date; the exodus value inside the two
    transition hours of a notice that stands alone.
    """
    first, last = F.col("_first_notice"), F.col("_last_notice")
    return (
        F.when(F.col("_all_day") | (hour > first + 1), indices.num("1.0"))
        .when(F.col("_plain") | (last > hour), indices.num("0.0"))
        .when(first.isNotNull(), indices.num(fixed.MIDDAY_EXODUS))
        .otherwise(indices.num("0.0"))
        .cast(indices.SCORE)
    )


def event_hour_scores(events: DataFrame, stations: list[str] | None = None) -> DataFrame:
    """The full grid: three event scores per date, station and hour of day."""
    rows = station_scores(scope_scores(events), stations)
    known = rows.filter(F.col("station_name").isin(stations or fixed.STATIONS))
    # every date carries all stations, also those no event names
    dates = events.select(F.col("event_date").alias("date"))
    grid = station_hour_grid(dates, stations)
    return grid.join(known.withColumnRenamed("event_date", "date"), ["date", "station_name"], "left").select(
        "date",
        "station_name",
        "hour",
        indices.score(F.col("_academic")).alias("academic_surge_score"),
        F.coalesce(civic_at(F.col("hour")), F.lit(0)).cast(indices.SCORE).alias("civic_mandate_score"),
        indices.score(F.col("_operational")).alias("operational_score"),
    )


def with_scores(df: DataFrame, weather_scores: DataFrame, event_scores: DataFrame) -> DataFrame:
    """Attach the four scores to rows with ``date, hour_period, station_name``.

    ``weather_scores`` from :func:`hourly_weather`, ``event_scores`` from
    :func:`station_scores`; both far smaller than the rows, and left to Catalyst to
    broadcast when their stored size allows.
    """
    hour = labels.hour_of(F.col("hour_period"))
    joined = (
        df.withColumn("hour", hour)
        .join(weather_scores, ["date", "hour"], "left")
        .join(event_scores.withColumnRenamed("event_date", "date"), ["date", "station_name"], "left")
    )
    return (
        joined.withColumn("weather_score", indices.score(F.col("weather_score")))
        .withColumn("academic_surge_score", indices.score(F.col("_academic")))
        .withColumn("civic_mandate_score", indices.score(civic_at(F.col("hour"))))
        .withColumn("operational_score", indices.score(F.col("_operational")))
        .drop("_academic", "_operational", "_all_day", "_plain", "_first_notice", "_last_notice")
    )


def with_cfi(df: DataFrame, weights: dict | None = None) -> DataFrame:
    return df.withColumn("cfi", indices.cfi(*[F.col(c) for c in SCORES], weights))


def descriptive_metrics(
    actuals: DataFrame, baselines: DataFrame, weather_scores: DataFrame, event_scores: DataFrame
) -> DataFrame:
    """Actuals with baseline, scores, index and congestion level."""
    rows = with_cfi(with_scores(with_baselines(actuals, baselines), weather_scores, event_scores))
    return rows.select(
        "date",
        F.col("hour_period").alias("time_period"),
        "station_name",
        "flow_type",
        F.col("volume").alias("actual_volume"),
        F.col("median_volume").alias("historical_median"),
        "warning_threshold",
        "critical_threshold",
        *SCORES,
        "cfi",
        indices.congestion(F.col("volume"), F.col("warning_threshold"), F.col("critical_threshold")).alias(
            "congestion_level"
        ),
    )


def predictive_features(actuals: DataFrame, weather_scores: DataFrame, event_scores: DataFrame) -> DataFrame:
    """Training rows: scores and index beside the observed volume."""
    rows = with_cfi(with_scores(actuals, weather_scores, event_scores))
    return rows.select(
        "date",
        "hour_period",
        labels.iso_weekday(F.col("date")).alias("day_of_week"),
        "station_name",
        "flow_type",
        F.col("volume").alias("historical_actual_volume"),
        *SCORES,
        "cfi",
    )
