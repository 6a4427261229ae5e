"""Domain-shaped frames derived from the given star-schema tables.

Stations come from a key modulo 13, hours and flows from line attributes, scores from
order keys. All measures are whole numbers and all scores exact decimals.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions.labels import hour_label
from flowgauge.session import table_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


def on_dates(rows: DataFrame, column: str, dates: Iterable[dt.date] | None) -> DataFrame:
    """The rows of whole dates by a stored time column (all by default), as ranges that reach the scan."""
    if dates is None:
        return rows
    runs: list[list[dt.date]] = []
    for d in sorted(set(dates)):
        if runs and (d - runs[-1][1]).days == 1:
            runs[-1][1] = d
        else:
            runs.append([d, d])
    kept = F.lit(False)
    for first, last in runs:
        low, high = (F.lit(x.isoformat()).cast("timestamp_ntz") for x in (first, last + dt.timedelta(days=1)))
        kept = kept | ((F.col(column) >= low) & (F.col(column) < high))
    return rows.filter(kept)


def station_at(key: Column) -> Column:
    names = F.array(*[F.lit(s) for s in fixed.STATIONS])
    return F.get(names, (key % 13).cast("int"))


def hundredths(key: Column, modulus: int) -> Column:
    return ((key % modulus).cast("decimal(6,0)") * F.lit(fixed.dec("0.01"))).cast("decimal(6,5)")


def flow(spark: SparkSession, folder: str, first: str | None = None, last: str | None = None, dates: Iterable[dt.date] | None = None) -> DataFrame:
    """Long hourly actuals from line items, of all dates, those from ``first`` to ``last``, or the given ones.

    The period is a filter on the stored column, so the scan skips what lies outside.
    """
    rows = on_dates(table(spark, folder, "lineitem"), "l_shipdate", dates)
    if first and last:
        shipped = F.col("l_shipdate")
        rows = rows.filter((shipped >= F.lit(first).cast("timestamp_ntz")) & (shipped < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")))
    hour = (F.lit(5) + (F.col("l_orderkey") + F.col("l_linenumber")) % 17).cast("int")
    return (
        rows.select(
            F.col("l_shipdate").cast("date").alias("date"),
            hour_label(hour).alias("hour_period"),
            station_at(F.col("l_suppkey")).alias("station_name"),
            F.when(F.col("l_linestatus") == "O", "entry").otherwise("exit").alias("flow_type"),
            (F.col("l_quantity").cast("long") * 10 * F.col("l_linenumber")).alias("_v"),
        )
        .groupBy("date", "hour_period", "station_name", "flow_type")
        .agg(F.sum("_v").alias("volume"))
    )


def order_time(hours: Column) -> Column:
    """Order date as a timestamp plus ``hours``."""
    return F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + hours.cast("long") * 3_600_000_000)


def calendar_events(spark: SparkSession, folder: str, dates: Iterable[dt.date] | None = None) -> DataFrame:
    return calendar_events_of(on_dates(table(spark, folder, "orders"), "o_orderdate", dates))


def calendar_events_of(orders: DataFrame) -> DataFrame:
    """Event calendar from orders."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    level = F.substring("o_orderpriority", 1, 1)
    station = (
        F.when(cust % 51 == 0, F.lit(None).cast("string"))
        .when((cust % 17 == 0) & (cust % 2 == 0), "All")
        .when(cust % 17 == 0, "All Stations")
        .otherwise(station_at(cust))
    )
    category = (
        F.when(level == "1", "class_suspension")
        .when(level == "2", "major_event")
        .when(level == "3", "holiday")
        .when((level == "4") & (cust % 5 == 0), "school_break")
        .when(level == "4", "regular_class_day")
        .otherwise("incident")
    )
    trigger = (
        F.when((level == "1") & (cust % 3 == 0), "Transport Strike")
        .when(level == "1", "Class Suspension")
        .when(level == "2", "Major Arena Event")
        .when(level == "3", "Holiday")
        .when((level == "4") & (cust % 5 == 0), "School Break")
        .when(level == "4", "Regular Class Day")
        .otherwise("Degraded Headway")
    )
    names = F.array(
        *[
            F.lit(n)
            for n in (
                "",
                "[Fallback] notice",
                "Grade Posting",
                None,
                "Walang Pasok advisory",
                "Arena Concert",
                "Foundation Day",
                "Budget deliberation",
                "Typhoon Signal",
                "Civic Rally",
                "Commencement",
                "Suspension of work",
                "City Fiesta",
            )
        ]
    )
    name = F.get(names, (key % 13).cast("int"))
    return orders.select(
        F.concat(F.lit("CAL-"), key.cast("string")).alias("id"),
        station.alias("station"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.lit("orders").alias("source_table"),
        key.cast("string").alias("source_id"),
        F.concat(F.lit("Source "), (cust % 5).cast("string")).alias("source_name"),
        name.alias("event_name"),
        category.alias("event_category"),
        F.when(level == "5", "operational").when(cust % 7 == 0, "lgu").otherwise("academic").alias("friction_domain"),
        trigger.alias("trigger_category"),
        hundredths(key, 101).alias("normalized_score"),
        F.when(key % 11 != 0, order_time(key % 48 - 24)).alias("announcement_time"),
        order_time(F.lit(1)).alias("updated_at"),
        F.concat(F.lit("https://example.org/"), (cust % 97).cast("string")).alias("source_url"),
        F.concat(F.lit("Notice "), (key % 1000).cast("string")).alias("description"),
    )


def weather(spark: SparkSession, folder: str, dates: Iterable[dt.date] | None = None) -> DataFrame:
    """Scored weather from orders; local hour = order key modulo 24."""
    return on_dates(table(spark, folder, "orders"), "o_orderdate", dates).select(
        F.col("o_orderdate").cast("date").alias("weather_date"),
        order_time(F.col("o_orderkey") % 24 - 8).alias("observed_or_forecasted_at"),
        hundredths((F.col("o_custkey") % 11) * 10, 1000).alias("normalized_score"),
    )


def weather_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw station weather from orders."""
    return readings_of(table(spark, folder, "orders"))


def readings_of(orders: DataFrame) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    colour = F.get(F.array(F.lit("None"), F.lit("Yellow"), F.lit("Orange"), F.lit("Red"), F.lit("None")), (cust % 5).cast("int"))
    level = F.get(F.array(F.lit("None"), F.lit("Light"), F.lit("Heavy"), F.lit("Torrential")), (cust % 4).cast("int"))
    return orders.select(
        key.alias("id"),
        station_at(cust).alias("station"),
        (key % 15 + 20).cast("decimal(5,1)").alias("temperature"),
        (key % 45).cast("decimal(5,1)").alias("rainfall_mm"),
        F.when(key % 10 != 0, level).alias("computed_rainfall_level"),
        colour.alias("advisory_level"),
        (cust % 4).cast("int").alias("wind_signal"),
        order_time(key % 24).alias("observed_at"),
    )


def monthly_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly targets: 37 x the orders of a month."""
    day = F.col("o_orderdate")
    return (
        table(spark, folder, "orders")
        .groupBy(F.year(day).alias("year"), F.month(day).alias("month_number"))
        .agg((F.count("*") * 37).alias("student_transactions"))
        .withColumn("is_total", F.lit(False))
    )


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    return incidents_of(table(spark, folder, "events"))


def incidents_of(events: DataFrame) -> DataFrame:
    """Incident changes: one incident per user and day; a signup resolves it."""
    at = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    return events.select(
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format(at, "dd")).alias("id"),
        F.when(F.col("user_id") % 7 == 0, F.lit("cubao")).otherwise(station_at(F.col("user_id"))).alias("station_name"),
        F.when(kind == "error", "Other")
        .when(kind == "click", "Sanitation")
        .when(kind == "view", "Contraband")
        .when(kind == "purchase", "Fare Collection")
        .otherwise("Facility Order")
        .alias("incident_type"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("note "), F.col("props"))).alias("description"),
        F.when(F.col("value") > 100, "Critical").otherwise("Warning").alias("severity"),
        F.when(kind == "signup", "resolved").otherwise("pending").alias("status"),
        at.alias("created_at"),
        at.alias("changed_at"),
        F.col("event_id").alias("change_id"),
    )


# phrases joined to real document texts, so that every rule and date form occurs
PHRASES = [
    "Coordination meeting on no classes in Recto",
    "Planning and discussion of the fair",
    "Walang Pasok bukas in Manila",
    "Semestral break starts July 2, 2026 in Quezon City",
    "Tigil pasada 3 August in Antipolo and Marikina",
    "UAAP game at the arena on Sept 5th",
    "Midterm exam week",
    "Enrollment for all, see you tomorrow",
    "Release of grades",
    "Job fair in Pasig",
    "Shift to online classes on 31 February 2026",
    "Rainfall advisory for San Juan",
    "Meeting: class suspension near V. Mapa on 12 of March 2027",
    "Nothing to report",
]


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return posts_of(table(spark, folder, "documents"))


def posts_of(documents: DataFrame) -> DataFrame:
    """Scraped posts: the whole document text plus a phrase chosen by its id."""
    phrase = F.get(F.array(*[F.lit(p) for p in PHRASES]), (F.col("doc_id") % len(PHRASES)).cast("int"))
    start = 1_782_864_000_000_000  # 2026-07-01 00:00 UTC
    return documents.select(
        F.col("doc_id").alias("id"),
        F.concat(F.col("text"), F.lit(" "), phrase).alias("post_text"),
        F.timestamp_micros(F.lit(start) + F.col("doc_id") * 3_600_000_000).alias("posted_at"),
        F.col("source").alias("source_name"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("source_url"),
        (F.col("doc_id") % 9 == 0).alias("is_cancellation"),
    )


def scenarios(spark: SparkSession, folder: str) -> DataFrame:
    """One what-if scenario per order; hours 4 and 22 have no baseline."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, folder, "orders").select(
        key.alias("scenario_id"),
        station_at(cust).alias("station_name"),
        (key % 7 + 1).cast("int").alias("day_of_week"),
        hour_label((key % 19 + 4).cast("int")).alias("hour_period"),
        F.when(cust % 2 == 0, "entry").otherwise("exit").alias("flow_type"),
        hundredths(key, 101).alias("weather_score"),
        hundredths(cust, 101).alias("academic_score"),
        hundredths(key + cust, 101).alias("civic_score"),
        F.when(key % 5 == 0, (cust * 3).cast("decimal(12,3)")).alias("baseline_override"),
        F.get(F.array(F.lit("Weather"), F.lit("Academic"), F.lit("Civic")), (key % 3).cast("int")).alias("trigger_type"),
        F.when(key % 2 == 0, "High").otherwise("Low").alias("severity"),
    )


def protocol_source(spark: SparkSession, folder: str) -> DataFrame:
    """Protocol documents with bulleted tactics from parts."""
    key = F.col("p_partkey")
    bullets = F.concat(
        F.lit("• "), F.col("p_brand"), F.lit(": "), F.col("p_type"),
        F.lit(" •  • "), F.col("p_name"), F.lit(" : size "), F.col("p_size").cast("string"),
        F.when(key % 3 == 0, F.concat(F.lit(" •"), F.col("p_name"))).otherwise(F.lit("")),
    )
    return table(spark, folder, "part").select(
        F.concat(F.lit("STD-"), key.cast("string")).alias("apta_standard_code"),
        F.col("p_name").alias("official_document_title"),
        F.concat(F.lit("Scope "), F.col("p_brand")).alias("scope_relevance_to_surge_management"),
        bullets.alias("human_centric_ground_tactics"),
        F.concat(F.lit("https://example.org/"), key.cast("string")).alias("open_access_link_source"),
        F.timestamp_seconds(F.lit(1_700_000_000) + key % 7).alias("load_timestamp"),
    )


def incident_source(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        F.get(F.array(*[F.lit(c) for c in fixed.INCIDENT_TYPES]), (key % 12).cast("int")).alias("category"),
        F.col("s_name").alias("specific_incident_transgression"),
        F.timestamp_seconds(F.lit(1_700_000_000) + key % 7).alias("load_timestamp"),
    )


def capacity_source(spark: SparkSession, folder: str) -> DataFrame:
    """Platform rows from suppliers: known names in odd spelling, and unknown ones."""
    key = F.col("s_suppkey")
    known = F.concat(F.lit(" "), F.when(key % 2 == 0, F.upper(station_at(key))).otherwise(station_at(key)))
    name = F.when(key % 4 == 3, F.concat(F.lit("New "), F.col("s_name"))).otherwise(known)
    return table(spark, folder, "supplier").select(
        name.alias("station_name"), key.alias("row_id"), (key % 900 + 100).cast("int").alias("total_station_limit_pax")
    )


def weight_source(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    domain = F.get(F.array(F.lit("academic"), F.lit("pagasa"), F.lit("operational"), F.lit("lgu")), (key % 4).cast("int"))
    trigger = F.when(key % 10 == 0, F.lit("Mid-Day Class Suspension")).otherwise(F.col("c_name"))
    return table(spark, folder, "customer").select(
        domain.alias("friction_domain"),
        trigger.alias("trigger_category"),
        F.col("c_name").alias("specific_condition_api_input"),
        hundredths(key, 101).cast("decimal(3,2)").alias("friction_weight"),
        F.col("c_mktsegment").alias("ncr_literature_source_basis"),
        F.concat(F.lit("https://example.org/"), key.cast("string")).alias("open_access_link"),
        F.timestamp_seconds(F.lit(1_700_000_000) + key).alias("load_timestamp"),
    )


def capacities(spark: SparkSession, folder: str) -> DataFrame:
    """Platform capacities from suppliers' balances, some of them not positive."""
    limit = F.floor("s_acctbal").cast("int")
    return table(spark, folder, "supplier").select(F.col("s_name").alias("station_name"), limit.alias("max_safe_platform_capacity"))


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Contact rows from customers: eleven digits, some of them with a digit too few or a sign."""
    key = F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 11, "0")
    mobile = F.when(key % 97 == 0, F.substring(digits, 2, 10)).when(key % 89 == 0, F.concat(F.lit("+"), digits)).otherwise(digits)
    return table(spark, folder, "customer").select(F.col("c_name").alias("name"), mobile.alias("mobile"))


def deployments(spark: SparkSession, folder: str) -> DataFrame:
    """Deployment log from the event stream: known and unknown protocols, some unsent."""
    key = F.col("event_id")
    at = F.col("ts").cast("timestamp")
    sent = F.timestamp_micros(F.unix_micros(at) + (key % 5000) * 1000)
    return table(spark, folder, "events").select(
        F.concat(F.lit("DEP"), key.cast("string")).alias("deployment_id"),
        station_at(F.col("user_id")).alias("station_name"),
        F.when(key % 2 == 0, "entry").otherwise("exit").alias("flow_type"),
        F.concat(F.lit("APTA-"), F.lpad((key % 8).cast("string"), 2, "0")).alias("decision_action"),
        F.when(key % 6 == 0, "Lost").otherwise("Active").alias("status"),
        at.alias("ingestion_timestamp"),
        F.when(key % 7 != 0, sent).alias("broadcast_timestamp"),
    )


def evaluations(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluation ledger from orders; all measures are quarters, so sums are exact."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    volume = key % 2 == 0
    return table(spark, folder, "orders").select(
        F.concat(F.lit("run-"), (cust % 50).cast("string")).alias("run_id"),
        F.when(volume, fixed.VOLUME_MODEL).otherwise(fixed.THREAT_MODEL).alias("model_name"),
        ((key % 400) / F.lit(4.0)).alias("mape"),
        ((key % 1000) / F.lit(4.0)).alias("rmse"),
        ((cust % 400) / F.lit(4.0)).alias("classification_accuracy"),
        ((cust % 400) / F.lit(4.0)).alias("recall_score"),
        ((cust % 5) / F.lit(4.0)).alias("f1_score"),
        (key % 3 == 0).alias("all_targets_passed"),
        F.col("o_orderdate").cast("timestamp").alias("recorded_at"),
    )


def executions(spark: SparkSession, folder: str) -> DataFrame:
    """Execution ledger from the event stream; latency in quarter seconds."""
    key = F.col("event_id")
    seconds = (key % 20) / F.lit(4.0)
    return table(spark, folder, "events").select(
        F.concat(F.lit("run-"), (F.col("user_id") % 50).cast("string")).alias("run_id"),
        seconds.alias("latency_seconds"),
        (key % 9 != 0).alias("scr_compliant"),
        (seconds < fixed.LATENCY_GATE_SECONDS).alias("latency_sla_passed"),
        F.col("ts").cast("timestamp").alias("recorded_at"),
    )
