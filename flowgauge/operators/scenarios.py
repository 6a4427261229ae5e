"""What-if scenarios in bulk, and their archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices
from flowgauge.operators.baselines import KEYS
from flowgauge.operators.numbering import last_number, sequential_ids
from flowgauge.session import stage
from flowgauge.sources.sinks import append_ledger, read_ledger


def simulate_scenarios(scenarios: DataFrame, baselines: DataFrame) -> DataFrame:
    """Adds base, simulated peak, variance and threat to every scenario row.

    Scenarios carry the four baseline keys, ``weather_score``, ``academic_score``,
    ``civic_score`` and ``baseline_override`` (null for the stored median). Any number
    of scenarios takes one join.
    """
    marked = baselines.withColumn("_known", F.lit(True))
    rows = scenarios.join(marked, KEYS, "left")
    exact = "decimal(12,3)"
    base = F.coalesce(F.col("baseline_override").cast(exact), F.col("median_volume").cast(exact), F.lit(0).cast(exact))
    warning = F.when(F.col("_known"), F.col("warning_threshold")).otherwise(fixed.WHATIF_DEFAULT_WARNING)
    critical = F.when(F.col("_known"), F.col("critical_threshold")).otherwise(fixed.WHATIF_DEFAULT_CRITICAL)
    factor = F.lit(1)
    for name, coefficient in fixed.WHATIF_SHOCKS.items():
        factor = factor + indices.num(coefficient) * F.col(f"{name}_score").cast(indices.SCORE)
    peak = F.round(F.col("baseline_mean_forecast") * factor.cast("decimal(12,8)"), 0).cast("decimal(18,0)")
    base_out = F.col("baseline_mean_forecast")
    variance = F.round(
        (F.col("simulated_forecasted_peak") - base_out) / F.nullif(base_out, F.lit(0).cast(exact)) * 100, 2
    )
    return (
        rows.withColumn("baseline_mean_forecast", base)
        .withColumn("simulated_forecasted_peak", peak)
        .withColumn(
            "forecasted_peak_variance", F.when(base_out == 0, indices.num("0.00")).otherwise(variance)
        )
        .withColumn(
            "simulated_threat_level", indices.congestion(F.col("simulated_forecasted_peak"), warning, critical)
        )
        .select(
            *scenarios.columns,
            "baseline_mean_forecast",
            "simulated_forecasted_peak",
            "forecasted_peak_variance",
            "simulated_threat_level",
        )
    )


def archive_rows(
    results: DataFrame, order_by: list[str], executed_at: str, run_number: int | Column = 1, after: int | Column = 0
) -> DataFrame:
    """Simulated scenarios as archive rows, ids from ``SIM`` and the number after ``after`` on."""
    numbered = sequential_ids(results, "SIM", 6, order_by, name="simulation_id", after=after)
    run = F.lit(run_number) if isinstance(run_number, int) else run_number
    return numbered.select(
        "simulation_id",
        run.cast("int").alias("run_number"),
        "station_name",
        "trigger_type",
        "severity",
        "weather_score",
        "academic_score",
        "civic_score",
        F.col("simulated_forecasted_peak").cast("int").alias("simulated_peak_volume"),
        F.col("forecasted_peak_variance").alias("variance_percentage"),
        "simulated_threat_level",
        F.lit(executed_at).cast("timestamp").alias("executed_at"),
        F.lit(False).alias("is_archived"),
    )


def record_scenarios(results: DataFrame, order_by: list[str], executed_at: str, path: str) -> None:
    """Append one run of scenarios to the archive; ids and run numbers go on from what is there."""
    rows = stage(results, "scenarios")
    archive = read_ledger(results.sparkSession, path, archive_rows(rows.limit(0), order_by, executed_at).schema)
    run = archive.agg(F.coalesce(F.max("run_number"), F.lit(0)) + 1).scalar()
    append_ledger(archive_rows(rows, order_by, executed_at, run, last_number(archive, "simulation_id", "SIM")), path)
