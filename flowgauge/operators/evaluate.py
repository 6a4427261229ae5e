"""Chronological split, regression and classification metrics, evaluation ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices
from flowgauge.operators.baselines import with_baselines
from flowgauge.session import stage
from flowgauge.sources.sinks import append_ledger, read_ledger, upsert

MATCH = ["date", "hour_period", "station_name", "flow_type"]


def split_date(rows: DataFrame, share: str = fixed.TRAIN_SHARE) -> DataFrame:
    """One row: the first date after the earlier ``share`` of distinct dates.

    Only distinct dates (a few hundred a year) reach the ranking window.
    """
    dates = rows.select("date").distinct()
    order = Window.orderBy("date")
    ranked = dates.select(
        "date", F.row_number().over(order).alias("_at"), F.count("*").over(Window.partitionBy()).alias("_n")
    )
    wanted = F.floor(F.col("_n") * indices.num(share)) + 1
    return ranked.filter(F.col("_at") == wanted).select(F.col("date").alias("split_date"))


def chronological_split(rows: DataFrame, share: str = fixed.TRAIN_SHARE) -> DataFrame:
    """Rows marked ``train`` or ``test``; no date is in both."""
    cut = split_date(rows, share).scalar()
    return rows.withColumn("part", F.when(F.col("date") >= cut, "test").otherwise("train"))


def matched(model: DataFrame, actuals: DataFrame) -> DataFrame:
    """Predictions beside their actuals."""
    made = model.select(
        F.col("prediction_date").alias("date"),
        "hour_period",
        "station_name",
        "flow_type",
        F.col("baseline_mean_forecast").alias("predicted"),
    )
    return made.join(actuals.withColumnRenamed("volume", "actual"), MATCH)


def regression_metrics(pairs: DataFrame) -> DataFrame:
    """One row: sample_count, rmse, mean_volume, rmse_percentage, mape."""
    actual, predicted = F.col("actual").cast("double"), F.col("predicted").cast("double")
    gap = actual - predicted
    totals = pairs.agg(
        F.count("*").alias("sample_count"),
        F.round(F.sqrt(F.avg(gap * gap)), 4).alias("rmse"),
        F.round(F.avg(actual), 4).alias("mean_volume"),
        F.round(F.avg(F.abs(gap) / F.greatest(actual, F.lit(1.0))) * 100, 4).alias("mape"),
    )
    relative = F.round(F.col("rmse") / F.nullif(F.col("mean_volume"), F.lit(0.0)) * 100, 2)
    return totals.select("sample_count", "rmse", "mean_volume", relative.alias("rmse_percentage"), "mape")


def graded(pairs: DataFrame, baselines: DataFrame) -> DataFrame:
    """Actual and predicted congestion class of each pair."""
    rows = with_baselines(pairs, baselines, "inner")
    edges = F.col("warning_threshold"), F.col("critical_threshold")
    return rows.select(
        *MATCH,
        indices.congestion_class(F.col("actual"), *edges).alias("actual_class"),
        indices.congestion_class(F.col("predicted"), *edges).alias("predicted_class"),
    )


def class_scores(classes: DataFrame) -> DataFrame:
    """tp / fp / fn / support / f1 for each of the three classes."""
    # at most nine rows leave this aggregate
    counts = classes.groupBy("actual_class", "predicted_class").agg(F.count("*").alias("_n"))
    spread = counts.withColumn("class_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    is_actual = F.col("actual_class") == F.col("class_id")
    is_predicted = F.col("predicted_class") == F.col("class_id")

    def total(test):
        return F.coalesce(F.sum(F.when(test, F.col("_n"))), F.lit(0))

    rows = spread.groupBy("class_id").agg(
        total(is_actual & is_predicted).alias("tp"),
        total(~is_actual & is_predicted).alias("fp"),
        total(is_actual & ~is_predicted).alias("fn"),
        total(is_actual).alias("support"),
    )
    parts = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    f1 = F.when(parts == 0, F.lit(0.0)).otherwise(2.0 * F.col("tp") / parts)
    return rows.withColumn("f1", f1)


def weighted_f1(classes: DataFrame) -> DataFrame:
    """One row: weighted F1, and accuracy (which equals support-weighted recall)."""
    everything = F.nullif(F.sum("support"), F.lit(0).cast("long"))
    return class_scores(classes).agg(
        F.round(F.sum(F.col("f1") * F.col("support")) / everything, 4).alias("f1_score"),
        F.round(F.sum("tp") / everything * 100, 2).alias("classification_accuracy"),
        F.round(F.sum("tp") / everything * 100, 2).alias("recall_score"),
    )


def evaluation_rows(
    regression: DataFrame,
    classification: DataFrame,
    run_id: str,
    split: DataFrame,
    recorded_at: str,
    records: DataFrame,
    audit: DataFrame,
    latency: DataFrame,
) -> DataFrame:
    """Two ledger rows, one per model, with the gates they passed; ids 1 and 2, to be moved on when stored.

    ``records`` are all rows the features have, whose number is the sample count. ``audit``
    and ``latency`` are the compliance and latency summaries: every dispatch has to comply
    and to be in time. The targets are the two of the models; ``certified`` asks for all
    four gates. The volume gate is reported both ways: RMSE as a share of the mean, and MAPE.
    """
    row = regression.drop("sample_count").select(
        "*",
        classification.select(F.struct("*")).scalar().alias("_classes"),
        split.scalar().alias("split_date"),
        records.agg(F.count("*")).scalar().alias("sample_count"),
        (audit.select("symbolic_heuristic_compliance_rate_scr").scalar() == 100).alias("target_scr_passed"),
        (latency.select("latency_compliance_rate_pct").scalar() == 100).alias("target_latency_passed"),
    ).select("*", "_classes.*")
    rmse_ok = F.coalesce(F.col("rmse_percentage") < fixed.RMSE_GATE_PCT, F.lit(False))
    mape_ok = F.coalesce(F.col("mape") < fixed.RMSE_GATE_PCT, F.lit(False))
    f1_ok = F.coalesce(F.col("f1_score") >= fixed.F1_GATE, F.lit(False))
    zero = F.lit(0.0)
    shared = [
        F.lit(run_id).alias("run_id"),
        F.lit("model_validation").alias("evaluation_type"),
        F.col("split_date").alias("dataset_split_date"),
        "sample_count",
        F.lit(recorded_at).cast("timestamp").alias("recorded_at"),
        (rmse_ok & f1_ok).alias("all_targets_passed"),
        mape_ok.alias("target_mape_passed"),
        "target_scr_passed",
        "target_latency_passed",
        (rmse_ok & f1_ok & F.col("target_scr_passed") & F.col("target_latency_passed")).alias("certified"),
    ]
    volume = row.select(
        F.lit(1).cast("long").alias("id"),
        *shared,
        F.lit(fixed.VOLUME_MODEL).alias("model_name"),
        "rmse",
        "mean_volume",
        "rmse_percentage",
        "mape",
        zero.alias("classification_accuracy"),
        zero.alias("recall_score"),
        zero.alias("f1_score"),
        rmse_ok.alias("target_rmse_passed"),
        F.lit(True).alias("target_f1_passed"),
    )
    threat = row.select(
        F.lit(2).cast("long").alias("id"),
        *shared,
        F.lit(fixed.THREAT_MODEL).alias("model_name"),
        zero.alias("rmse"),
        zero.alias("mean_volume"),
        zero.alias("rmse_percentage"),
        zero.alias("mape"),
        "classification_accuracy",
        "recall_score",
        "f1_score",
        F.lit(True).alias("target_rmse_passed"),
        f1_ok.alias("target_f1_passed"),
    )
    return volume.unionByName(threat)


def performance_rows(ledger: DataFrame) -> DataFrame:
    """Ledger rows in the shape of the latest-performance snapshot."""
    return ledger.select(
        "model_name", "mape", "rmse", "classification_accuracy", "recall_score", F.col("recorded_at").alias("last_trained_timestamp")
    )


def history_rows(ledger: DataFrame) -> DataFrame:
    """Ledger rows in the shape of the performance history."""
    return ledger.select("id", "model_name", "mape", "rmse", "classification_accuracy", "recall_score", "recorded_at")


def record_evaluation(ledger: DataFrame, ledger_path: str, history_path: str, snapshot: DataFrame) -> DataFrame:
    """Append the run to the ledger and the history; returns the snapshot with it merged in.

    The ledger rows are staged first, so both writes hold the same run. The ids of each table
    go on from its last one.
    """
    rows = stage(ledger, "evaluation")
    for made, path in ((rows, ledger_path), (history_rows(rows), history_path)):
        stored = read_ledger(rows.sparkSession, path, made.schema)
        last = stored.agg(F.coalesce(F.max("id"), F.lit(0).cast("long"))).scalar()
        append_ledger(made.withColumn("id", F.col("id") + last), path)
    return upsert(snapshot, performance_rows(rows), ["model_name"])


def prior_week_model(actuals: DataFrame) -> DataFrame:
    """The simplest forecaster: last week's volume at the same station, hour and flow.

    A stored weekday, which seven days do not change, stays.
    """
    return actuals.select(
        *[c for c in ("day_of_week",) if c in actuals.columns],
        "station_name",
        F.date_add("date", 7).alias("prediction_date"),
        "hour_period",
        "flow_type",
        F.col("volume").alias("baseline_mean_forecast"),
    )
