"""The live feed of weather and event triggers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices

COLUMNS = ["trigger_id", "source_type", "source", "message", "time", "urgency", "station_name", "source_url", "description"]


def weather_feed(current: DataFrame, today: str, source: str, source_url: str, description: str) -> DataFrame:
    """Today's station weather as feed rows; a missing part empties the message."""
    level = F.coalesce(F.nullif(F.col("computed_rainfall_level"), F.lit("None")), F.lit("Normal"))
    message = F.concat(
        F.lit("Station: "),
        F.col("station"),
        F.lit(" - Temp: "),
        F.col("temperature").cast("string"),
        F.lit("°C, Rain: "),
        F.col("rainfall_mm").cast("string"),
        F.lit("mm ("),
        level,
        F.lit(")"),
    )
    local = F.from_utc_timestamp("observed_at", fixed.LOCAL_ZONE)
    return current.filter(F.to_date(local) == F.lit(today).cast("date")).select(
        F.col("id").cast("string").alias("trigger_id"),
        F.lit("weather").alias("source_type"),
        F.lit(source).alias("source"),
        message.alias("message"),
        F.col("observed_at").alias("time"),
        indices.weather_urgency(F.col("rainfall_mm"), F.col("computed_rainfall_level")).alias("urgency"),
        F.col("station").alias("station_name"),
        F.lit(source_url).alias("source_url"),
        F.lit(description).alias("description"),
    )


def event_groups(events: DataFrame) -> DataFrame:
    """Events of the same date, category, domain and name as one feed row.

    The joined name lists hold distinct values only; duplicates are dropped map-side
    by the set aggregate. Values are listed in ascending order.
    """
    keys = ["event_date", "event_category", "friction_domain", "event_name"]

    def listed(column: str, glue: str):
        return F.nullif(F.array_join(F.sort_array(F.collect_set(column)), glue), F.lit(""))

    grouped = events.groupBy(*keys).agg(
        F.min("id").alias("trigger_id"),
        listed("source_name", " / ").alias("source"),
        listed("station", ", ").alias("station_name"),
        F.max(F.coalesce("announcement_time", "updated_at")).alias("time"),
        F.max("normalized_score").alias("_top"),
        F.max("source_url").alias("source_url"),
        F.max("description").alias("description"),
    )
    name = F.col("event_name")
    lgu = (F.col("event_category") == "lgu") | (F.col("friction_domain") == "lgu")
    return grouped.select(
        "event_date",
        "trigger_id",
        F.when(lgu, "lgu").otherwise("academic").alias("source_type"),
        "source",
        F.concat(
            F.lit("Station: "), F.col("station_name"), F.lit(" - "), F.coalesce(name, F.lit("Event Notice"))
        ).alias("message"),
        "time",
        indices.event_urgency(name, F.col("_top")).alias("urgency"),
        "station_name",
        "source_url",
        "description",
    )


def live_event_feed(weather_rows: DataFrame, events: DataFrame, today: str) -> DataFrame:
    """Weather rows from :func:`weather_feed` and the event groups of ``today``."""
    groups = event_groups(events.filter(F.col("event_date") == F.lit(today).cast("date")))
    return weather_rows.select(*COLUMNS).unionByName(groups.select(*COLUMNS))
