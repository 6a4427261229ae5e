"""Protocol recommendations, checklists, deployment ledgers and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices, labels
from flowgauge.operators.numbering import last_number, number_rows, sequential_ids
from flowgauge.session import stage
from flowgauge.sources.sinks import other_runs, write_run


# every id the protocol tree can recommend
RECOMMENDED = sorted(
    {
        *fixed.PROTOCOL_NORMAL,
        *fixed.PROTOCOL_WARNING_FULL,
        *fixed.PROTOCOL_CRITICAL_FULL,
        *fixed.PROTOCOL_EMERGENCY,
    }
)


def platform_capacities(spark: SparkSession) -> DataFrame:
    """13 rows: safe platform capacity per station."""
    return spark.createDataFrame(
        list(fixed.PLATFORM_CAPACITY.items()), "station_name string, max_safe_platform_capacity int"
    )


def recommendations(metrics: DataFrame, capacities: DataFrame | None = None) -> DataFrame:
    """One row per forecast row and recommended protocol.

    ``predicted_volume`` is the baseline; utilisation and surplus use
    ``adjusted_volume``. Without ``capacities`` the built-in 13 rows are broadcast.
    """
    if capacities is None:
        capacities = F.broadcast(platform_capacities(metrics.sparkSession))
    load, limit = F.col("adjusted_forecast_volume"), F.col("max_safe_platform_capacity")
    return metrics.join(capacities, "station_name").select(
        F.col("prediction_date").alias("date"),
        F.col("hour_period").alias("time"),
        "station_name",
        "flow_type",
        F.col("baseline_mean_forecast").alias("predicted_volume"),
        load.alias("adjusted_volume"),
        limit.alias("platform_capacity"),
        indices.percent(load, limit).alias("capacity_utilization"),
        F.greatest(F.lit(0), load - limit).alias("passenger_surplus"),
        F.col("predicted_threat_level").alias("forecasted_threat_level"),
        indices.trigger_context(
            F.col("weather_score"), F.col("academic_surge_score"), F.col("civic_mandate_score")
        ).alias("primary_trigger_context"),
        F.explode(indices.protocol_list(F.col("predicted_threat_level"), indices.ratio(load, limit))).alias(
            "decision_action"
        ),
    )


def active_checklists(recommended: DataFrame, protocols: DataFrame, tactics: DataFrame, as_of: str) -> DataFrame:
    """Tasks of the protocols recommended for the hour of ``as_of`` (local time)."""
    now = F.lit(as_of).cast("timestamp")
    current = recommended.filter(
        (F.col("date") == now.cast("date")) & (F.col("time") == labels.hour_label(F.hour(now)))
    )
    codes = protocols.filter(F.col("id").isin(RECOMMENDED)).select(F.col("id").alias("decision_action"), "apta_standard_code")
    steps = tactics.filter(F.col("protocol_id").isin(RECOMMENDED)).select(
        F.col("protocol_id").alias("decision_action"), F.col("id").alias("tactic_id"), "tactic_name", "tactic_description"
    )
    local = F.to_timestamp(F.concat_ws(" ", F.col("date").cast("string"), F.col("time")), "yyyy-MM-dd HH:mm")
    return (
        current.join(codes, "decision_action")
        .join(steps, "decision_action")
        .select(
            "station_name",
            "flow_type",
            "predicted_volume",
            "platform_capacity",
            "capacity_utilization",
            F.col("apta_standard_code").alias("active_action"),
            F.col("primary_trigger_context").alias("active_context"),
            indices.task_order(F.col("tactic_id")).alias("task_order"),
            F.col("tactic_name").alias("task_name"),
            indices.task_role(F.col("tactic_id")).alias("target_role"),
            indices.task_priority(F.col("tactic_id")).alias("priority"),
            F.col("tactic_description").alias("action_details"),
            F.to_utc_timestamp(local, fixed.LOCAL_ZONE).alias("ingestion_timestamp"),
        )
    )


def tactical_guidelines(protocols: DataFrame) -> DataFrame:
    """The protocol text that answers each threat level."""
    levels = protocols.sparkSession.createDataFrame(
        fixed.GUIDELINES, "threat_level string, threshold_indicator string, id string"
    )
    return protocols.join(F.broadcast(levels), "id").select(
        "threat_level",
        "threshold_indicator",
        F.concat(F.col("apta_standard_code"), F.lit(" - "), F.col("official_document_title")).alias(
            "prescribed_standard"
        ),
        F.col("scope_relevance_to_surge_management").alias("operational_guideline"),
    )


def known_flag(df: DataFrame, column: str, protocols: DataFrame, name: str, only: list[str] | None = None) -> DataFrame:
    """Whether ``column`` names a known protocol, as a flag on every row.

    With ``only`` (all values ``column`` can take) at most that many ids are broadcast.
    """
    known = protocols.select(F.col("id").alias(column))
    known = known.filter(F.col(column).isin(only)).distinct() if only else known.distinct()
    known = known.withColumn(name, F.lit(True))
    joined = df.join(F.broadcast(known) if only else known, column, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


#: Order in which ledger rows get their numbers.
ORDER = ["date", "time", "station_name", "flow_type", "decision_action"]
DEPLOYMENT = (
    "deployment_id string, station_name string, flow_type string, decision_action string, deployed_by string, status string, "
    "ingestion_timestamp timestamp, broadcast_timestamp timestamp, activated_at timestamp, completed_at timestamp"
)


def deployment_rows(
    recommended: DataFrame, source: str, ingested_at: str, broadcast_at: str, after: int | Column = 0
) -> DataFrame:
    """Deployments to append, one per recommendation, ids from ``DEP`` and the number after ``after`` on."""
    rows = sequential_ids(recommended.select(*ORDER), "DEP", 6, ORDER, name="deployment_id", after=after)
    received, sent = F.lit(ingested_at).cast("timestamp"), F.lit(broadcast_at).cast("timestamp")
    return rows.select(
        "deployment_id",
        "station_name",
        "flow_type",
        "decision_action",
        F.lit(source).alias("deployed_by"),
        F.lit("Active").alias("status"),
        received.alias("ingestion_timestamp"),
        sent.alias("broadcast_timestamp"),
        sent.alias("activated_at"),
        F.lit(None).cast("timestamp").alias("completed_at"),
    )


EXECUTION = (
    "id long, run_id string, trigger_source string, station_name string, friction_score decimal(3,2), recommended_protocol_id string, "
    "actual_dispatched_protocol_id string, ingestion_timestamp timestamp, broadcast_timestamp timestamp, latency_seconds double, "
    "scr_compliant boolean, latency_sla_passed boolean, tested_by string, recorded_at timestamp"
)


def execution_rows(
    recommended: DataFrame,
    protocols: DataFrame,
    run_id: str,
    source: str,
    ingested_at: str,
    broadcast_at: str,
    after: int | Column = 0,
) -> DataFrame:
    """Execution-ledger rows to append, one per recommendation, ids from the number after ``after`` on."""
    received, sent = F.lit(ingested_at).cast("timestamp"), F.lit(broadcast_at).cast("timestamp")
    latency = indices.seconds_between(received, sent)
    columns = ["station_name", "forecasted_threat_level", "decision_action"]
    numbered = number_rows(recommended.select(*ORDER, "forecasted_threat_level"), ORDER, name="_id").select(*columns, "_id")
    number = F.col("_id") + (F.lit(after) if isinstance(after, int) else after)
    return known_flag(numbered, "decision_action", protocols, "scr_compliant", RECOMMENDED).select(
        number.cast("long").alias("id"),
        F.lit(run_id).alias("run_id"),
        F.lit(source).alias("trigger_source"),
        "station_name",
        indices.ledger_score(F.col("forecasted_threat_level")).alias("friction_score"),
        F.col("decision_action").alias("recommended_protocol_id"),
        F.col("decision_action").alias("actual_dispatched_protocol_id"),
        received.alias("ingestion_timestamp"),
        sent.alias("broadcast_timestamp"),
        latency.alias("latency_seconds"),
        "scr_compliant",
        (latency < fixed.LATENCY_GATE_SECONDS).alias("latency_sla_passed"),
        F.lit(source).alias("tested_by"),
        sent.alias("recorded_at"),
    )


def record_dispatches(
    recommended: DataFrame,
    protocols: DataFrame,
    run_id: str,
    source: str,
    ingested_at: str,
    broadcast_at: str,
    deployments_path: str,
    ledger_path: str,
) -> int:
    """Log every recommendation to both ledgers in two set-based writes; returns how many.

    Meant to run on a cadence over the forecast rows of interest (filter them first).
    Ids go on from the last ones of other runs, so one run writes at a time. Each ledger gets
    a part named by the run: a run that died between the two is done again under its name.
    """
    rows = stage(recommended, "dispatches")
    spark = rows.sparkSession
    last = last_number(other_runs(spark, deployments_path, DEPLOYMENT, run_id), "deployment_id", "DEP")
    write_run(deployment_rows(rows, source, ingested_at, broadcast_at, last), deployments_path, run_id)
    logged = other_runs(spark, ledger_path, EXECUTION, run_id).agg(F.coalesce(F.max("id"), F.lit(0).cast("long"))).scalar()
    write_run(execution_rows(rows, protocols, run_id, source, ingested_at, broadcast_at, logged), ledger_path, run_id)
    return rows.count()


def compliance_audit(deployments: DataFrame, protocols: DataFrame) -> DataFrame:
    """Share of deployments whose protocol is known; 100 on an empty log.

    Deployments are counted per protocol before the join, so a hot protocol is one row.
    """
    per_action = deployments.groupBy("decision_action").agg(F.count("*").alias("_n"))
    totals = known_flag(per_action, "decision_action", protocols, "_ok").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_prescriptive_generations"),
        F.coalesce(F.sum(F.when(F.col("_ok"), F.col("_n"))), F.lit(0)).alias("valid_protocol_generations"),
    )
    made, valid = F.col("total_prescriptive_generations"), F.col("valid_protocol_generations")
    return totals.withColumn(
        "symbolic_heuristic_compliance_rate_scr",
        F.when(made == 0, indices.num("100.00")).otherwise(indices.percent(valid, made)),
    )


def latency_summary(deployments: DataFrame) -> DataFrame:
    """Average, maximum and pass share of ingestion-to-broadcast time; 0/0/100 when empty."""
    micros = F.unix_micros("broadcast_timestamp") - F.unix_micros("ingestion_timestamp")
    timed = deployments.filter(
        F.col("broadcast_timestamp").isNotNull() & F.col("ingestion_timestamp").isNotNull()
    ).select(micros.alias("_us"))
    gate = int(fixed.LATENCY_GATE_SECONDS * 1_000_000)
    totals = timed.agg(
        F.count("*").alias("total_audited_runs"),
        F.sum("_us").alias("_sum"),
        F.max("_us").alias("_max"),
        F.count_if(F.col("_us") < gate).alias("passed_runs"),
    )
    runs = F.col("total_audited_runs")

    def seconds(us):
        return F.coalesce(F.round(us / F.lit(1_000_000.0), 4), F.lit(0.0))

    return totals.select(
        runs,
        seconds(F.col("_sum").cast("double") / F.nullif(runs, F.lit(0).cast("long"))).alias("average_latency_seconds"),
        seconds(F.col("_max").cast("double")).alias("max_latency_seconds"),
        "passed_runs",
        F.when(runs == 0, indices.num("100.00"))
        .otherwise(indices.percent(F.col("passed_runs"), runs))
        .alias("latency_compliance_rate_pct"),
    )


def executive_summary(evaluations: DataFrame, executions: DataFrame) -> DataFrame:
    """One row over both ledgers."""
    volume = F.col("model_name") == fixed.VOLUME_MODEL
    threat = F.col("model_name") == fixed.THREAT_MODEL
    # distinct runs are counted from pre-aggregated rows, so a hot run id is one row
    per_run = evaluations.groupBy("run_id").agg(
        F.max("recorded_at").alias("_latest"),
        *[
            agg
            for name, test, value in (
                ("mape", volume, "mape"),
                ("rmse", volume, "rmse"),
                ("acc", threat, "classification_accuracy"),
                ("f1", threat, "f1_score"),
            )
            for agg in (
                F.sum(F.when(test, F.col(value))).alias(f"_s_{name}"),
                F.count(F.when(test, F.col(value))).alias(f"_n_{name}"),
            )
        ],
        F.count_if("all_targets_passed").alias("_passed"),
    )

    def mean(name: str, digits: int):
        return F.round(F.sum(f"_s_{name}") / F.nullif(F.sum(f"_n_{name}"), F.lit(0).cast("long")), digits)

    predictive = per_run.agg(
        F.count("run_id").alias("total_predictive_runs"),
        F.max("_latest").alias("latest_predictive_eval_at"),
        mean("mape", 4).alias("avg_volume_mape"),
        mean("rmse", 4).alias("avg_volume_rmse"),
        mean("acc", 2).alias("avg_classifier_accuracy"),
        mean("f1", 4).alias("avg_classifier_f1"),
        F.coalesce(F.sum("_passed"), F.lit(0)).alias("passed_predictive_runs"),
    )
    prescriptive = executions.agg(
        F.count("*").alias("total_prescriptive_executions"),
        F.max("recorded_at").alias("latest_prescriptive_eval_at"),
        F.count_if("scr_compliant").alias("scr_compliant_executions"),
        F.round(F.avg("latency_seconds"), 4).alias("avg_pipeline_latency_seconds"),
        F.count_if("latency_sla_passed").alias("_sla"),
    )
    # one row each; the second is read as a scalar subquery
    joined = predictive.withColumn("_runs", prescriptive.select(F.struct("*")).scalar()).select("*", "_runs.*")
    done = F.col("total_prescriptive_executions")

    def share(part):
        return F.when(done == 0, indices.num("100.00")).otherwise(indices.percent(part, done))

    return joined.select(
        *predictive.columns,
        "total_prescriptive_executions",
        "latest_prescriptive_eval_at",
        "scr_compliant_executions",
        share(F.col("scr_compliant_executions")).alias("overall_scr_compliance_pct"),
        "avg_pipeline_latency_seconds",
        share(F.col("_sla")).alias("overall_latency_sla_compliance_pct"),
    )


def kpi_prediction_accuracy(
    performance: DataFrame, audit: DataFrame, default_mape: float, default_rmse: float, certified: Column | None = None
) -> DataFrame:
    """Display figures of the volume model's snapshot row, one at most.

    The figures shown when no measurement exists are arguments, never silent constants.
    ``certified`` says whether the last evaluation passed all gates; without it, or while it
    is unknown, the model counts as not certified.
    """
    passed = F.lit(False) if certified is None else F.coalesce(certified, F.lit(False))
    mape = F.coalesce(F.col("mape"), F.lit(default_mape))
    shown = F.when(mape <= 0, F.lit(default_mape)).when(mape < 0.2, mape * 100.0).otherwise(mape)
    scr = audit.select("symbolic_heuristic_compliance_rate_scr").scalar()
    return performance.filter(F.col("model_name") == fixed.VOLUME_MODEL).select(
        "model_name",
        F.round(100.0 - shown, 1).alias("prediction_accuracy_pct"),
        F.round(shown, 1).alias("mape_error_rate_pct"),
        F.round(F.coalesce(F.col("rmse"), F.lit(default_rmse)), 1).alias("rmse_pax"),
        F.lit("High").alias("confidence_level"),
        F.lit("High (95% CI)").alias("confidence_label"),
        F.lit(95.0).alias("confidence_ci_pct"),
        F.coalesce(scr, indices.num("100.00")).alias("heuristic_compliance_scr_pct"),
        F.when(passed, fixed.STATUS_CERTIFIED).otherwise(fixed.STATUS_FAILED).alias("model_status"),
        "last_trained_timestamp",
    ).limit(1)
