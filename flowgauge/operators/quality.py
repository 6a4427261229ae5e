"""Data-quality checks as one report: check, violations, passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import labels
from flowgauge.operators import prescribe
from flowgauge.operators.baselines import KEYS
from flowgauge.operators.reshape import station_columns


def _report(df: DataFrame, checks: list[str]) -> DataFrame:
    """A one-row frame of violation counts turned into report rows."""
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("check_name"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("violations")) for c in checks]))
    return df.select(rows).withColumn("passed", F.col("violations") == 0)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def wide_rules(wide: DataFrame, hourly_source_year: int | None = 2023) -> dict[str, Column]:
    """Rows that break the sums or have negative counts, as counts of a wide table."""
    entry, exits = station_columns(wide, "entry"), station_columns(wide, "exit")

    def total(cols: list[str]) -> Column:
        return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])

    exempt = labels.is_total(F.col("time_period"))
    if hourly_source_year is not None:
        exempt = exempt | ((F.year("date") == hourly_source_year) & labels.counted_hourly(F.col("date")))
    off = (total(entry) != F.col("total_entry")) | (total(exits) != F.col("total_exit"))
    negative = F.least(*[F.col(c) for c in [*entry, *exits, "total_entry", "total_exit"]]) < 0
    return {"row_sums": F.count_if(~exempt & off), "negative_counts": F.count_if(negative)}


def wide_checks(wide: DataFrame, hourly_source_year: int | None = 2023) -> DataFrame:
    """Row sums against totals, negative counts, duplicate ids - sums and signs in one scan."""
    rules = wide_rules(wide, hourly_source_year)
    sums = wide.agg(*[rule.alias(name) for name, rule in rules.items()])
    return _report(sums, list(rules)).unionByName(duplicate_keys(wide, ["id"], "unique_ids"))


def checked_on_write(df: DataFrame, rules: dict[str, Column], name: str) -> tuple[DataFrame, Observation]:
    """``df`` with counts of violations, and of its rows, taken by the job that writes it.

    The observation has them once that one job is done; nothing is read again. It sits on the
    rows as they are written, so a task that is tried again is counted once.
    """
    seen = Observation()
    counts = [rule.alias(check) for check, rule in rules.items()]
    return df.observe(seen, *counts, (1 - F.least(F.count(F.lit(1)), F.lit(1))).alias(f"not_empty_{name}")), seen


def observed_checks(spark: SparkSession, *observations: Observation) -> DataFrame:
    """The report rows of what was counted on write; waits until it is."""
    found = [(check, int(count or 0), not count) for seen in observations for check, count in seen.get.items()]
    return spark.createDataFrame(found, "check_name string, violations long, passed boolean")


def duplicate_keys(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows beyond the first of each key; counting is combined map-side."""
    repeats = df.groupBy(*keys).agg((F.count("*") - 1).alias("_extra"))
    return _report(repeats.agg(F.sum("_extra").alias(name)), [name])


def conservation(targets: DataFrame, expanded: DataFrame) -> DataFrame:
    """Monthly target against the expanded entries and exits of the month."""
    per_month = expanded.filter(~labels.is_total(F.col("time_period"))).groupBy(
        F.year("date").alias("year"), F.month("date").alias("month_number")
    ).agg(F.sum("total_entry").alias("expanded_entry"), F.sum("total_exit").alias("expanded_exit"))
    wanted = targets.filter(~F.col("is_total") & (F.col("student_transactions") > 0)).select(
        "year", "month_number", F.col("student_transactions").alias("original_total")
    )
    return wanted.join(per_month, ["year", "month_number"], "left").withColumn(
        "conserved",
        F.col("original_total").eqNullSafe(F.col("expanded_entry"))
        & F.col("original_total").eqNullSafe(F.col("expanded_exit")),
    )


def conservation_check(targets: DataFrame, expanded: DataFrame) -> DataFrame:
    rows = conservation(targets, expanded)
    return _report(rows.agg(F.count_if(~F.col("conserved")).alias("monthly_conservation")), ["monthly_conservation"])


def false_positives(events: DataFrame, posts: DataFrame, source_table: str = "academic_lgu_events") -> DataFrame:
    """Events from planning or meeting posts that were not filed as administrative."""
    text = F.col("post_text")
    planning = text.rlike(fixed.PLANNING_STRICT) | (
        text.rlike(fixed.PLANNING_LOOSE) & ~text.rlike(fixed.EXPLICIT_DISRUPTION)
    )
    suspects = posts.filter(planning).select(F.col("id").cast("string").alias("source_id"))
    filed = events.filter((F.col("source_table") == source_table) & (F.col("event_category") != "administrative"))
    hits = filed.join(suspects, "source_id", "left_semi")
    return _report(hits.agg(F.count("*").alias("classifier_false_positives")), ["classifier_false_positives"])


def event_checks(events: DataFrame, day: str | Column = "event_date") -> DataFrame:
    """Suspension and break scores, density consistency, and missing or out-of-range scores."""
    key = F.col(day) if isinstance(day, str) else day
    fixed_score = F.col("event_category").isin("class_suspension", "school_break")
    score = F.col("normalized_score")
    rows = events.agg(
        F.count_if(fixed_score & (score != 1)).alias("suspension_scores"),
        F.count_if((score < 0) | (score > 1)).alias("score_range"),
        F.count_if(F.col("event_date").isNull()).alias("event_dates"),
    )
    groups = (
        events.filter(F.col("event_category") == "major_event")
        .groupBy(key.alias("_day"), "station")
        .agg(F.count("*").alias("_n"), F.min(score).alias("_low"), F.max(score).alias("_high"))
    )
    wanted = F.when(F.col("_n") >= 3, F.lit(1.0)).otherwise(F.lit(0.5))
    off = groups.filter((F.col("_low") != wanted) | (F.col("_high") != wanted))
    density = off.agg(F.count("*").alias("surge_density"))
    return _report(rows, ["suspension_scores", "score_range", "event_dates"]).unionByName(
        _report(density, ["surge_density"])
    )


def baseline_check(baselines: DataFrame, expected: int) -> DataFrame:
    """Missing rows against ``expected`` (stations x weekdays x hours x flows) and duplicate keys."""
    missing = baselines.agg(F.greatest(F.lit(0), F.lit(expected) - F.count("*")).alias("baseline_rows"))
    return _report(missing, ["baseline_rows"]).unionByName(duplicate_keys(baselines, KEYS, "baseline_keys"))


def cfi_check(metrics: DataFrame) -> DataFrame:
    return _report(metrics.agg(F.count_if(F.col("cfi").isNull()).alias("cfi_present")), ["cfi_present"])


def not_empty(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per frame: violated when it has no row. ``limit(1)`` stops the scan early."""
    return _union(
        [
            _report(df.limit(1).agg((1 - F.count("*")).alias(f"not_empty_{name}")), [f"not_empty_{name}"])
            for name, df in frames.items()
        ]
    )


def columns_check(df: DataFrame, required: list[str], forbidden: list[str] = ()) -> DataFrame:
    """Required columns that are absent plus forbidden columns that are present."""
    wrong = [c for c in required if c not in df.columns] + [c for c in forbidden if c in df.columns]
    return df.sparkSession.createDataFrame(
        [("columns", len(wrong), not wrong)], "check_name string, violations long, passed boolean"
    )


def prescriptive_checks(capacities: DataFrame, protocols: DataFrame, deployments: DataFrame, recommended: DataFrame) -> DataFrame:
    """Integrity of the prescriptive layer.

    One capacity for each station, the six protocols at least, no deployment of an unknown
    protocol (a compliance of 100), and every alarm answered by the protocol of its level.
    """
    rows = capacities.agg(F.abs(F.count_distinct("station_name") - len(fixed.STATIONS)).alias("capacity_rows"))
    known = protocols.agg(F.greatest(F.lit(0), 6 - F.count("*")).alias("protocol_rows"))
    audit = prescribe.compliance_audit(deployments, protocols)
    unknown = audit.select((F.col("total_prescriptive_generations") - F.col("valid_protocol_generations")).alias("compliance"))
    answer = F.when(F.col("forecasted_threat_level") == "Warning", fixed.PROTOCOL_WARNING[0]).when(
        F.col("forecasted_threat_level") == "Critical", fixed.PROTOCOL_CRITICAL[0]
    )
    alarms = recommended.filter(answer.isNotNull()).groupBy("date", "time", "station_name", "flow_type")
    missing = alarms.agg(F.count_if(F.col("decision_action") == answer).alias("_n")).agg(F.count_if(F.col("_n") == 0).alias("expected_protocol"))
    parts = [_report(df, df.columns) for df in (rows, known, unknown, missing)]
    wanted = columns_check(deployments, ["ingestion_timestamp", "broadcast_timestamp"], ["turnstile_throttling_rate"])
    return _union([*parts, wanted])


def rule_check(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule; a rule that is null (unknown) is not broken. One scan for all."""
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return _report(counts, list(rules))


def incident_rules() -> dict[str, Column]:
    return {
        "incident_type": F.col("incident_type").isin(fixed.INCIDENT_TYPES),
        "incident_severity": F.col("severity").isin(fixed.INCIDENT_SEVERITIES),
        "incident_status": F.col("status").isin(fixed.INCIDENT_STATUSES),
    }


def deployment_rules() -> dict[str, Column]:
    return {
        "deployment_status": F.col("status").isin(fixed.DEPLOYMENT_STATUSES),
        "deployment_order": F.col("broadcast_timestamp") >= F.col("ingestion_timestamp"),
    }


def weight_rules() -> dict[str, Column]:
    return {"weight_range": F.col("friction_weight").between(0, 1)}


def capacity_rules() -> dict[str, Column]:
    return {"positive_capacity": F.col("max_safe_platform_capacity") > 0}


def contact_rules() -> dict[str, Column]:
    return {"mobile_format": F.col("mobile").rlike(fixed.MOBILE_PATTERN)}
