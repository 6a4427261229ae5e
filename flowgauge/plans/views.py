"""The dashboard surface: every published view as a DataFrame, by its public name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.operators import baselines, feeds, forecast, prescribe, reshape, triggers
from flowgauge.session import stage, stage_all
from flowgauge.sources.tables import publish


def build_views(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    as_of: str,
    default_mape: float = fixed.DEFAULT_MAPE,
    default_rmse: float = fixed.DEFAULT_RMSE,
) -> dict[str, DataFrame]:
    """All views over ``tables`` at local time ``as_of``.

    ``tables``: ``facts`` (hourly wide), ``events``, ``weather``, ``weather_current``,
    ``model_outputs``, ``protocols``, ``tactics``, ``deployments``, ``performance``,
    ``evaluations``, ``executions``; optionally ``capacities``.

    Baselines, scores and the forecast are stored once and shared by the views that
    read them; everything else stays lazy.
    """
    today = as_of[:10]
    actuals = reshape.hourly_actuals(tables["facts"])
    events = tables["events"]
    parts = stage_all(
        {
            "baselines": baselines.threshold_baselines(actuals),
            "weather": triggers.hourly_weather(tables["weather"]),
            "scores": triggers.station_scores(triggers.scope_scores(events)),
            "forecast_scores": triggers.station_scores(
                triggers.scope_scores(events, triggers.FORECAST_CIVIC, hour_aware=False)
            ),
        }
    )
    base = parts["baselines"]
    described = triggers.descriptive_metrics(actuals, base, parts["weather"], parts["scores"])
    metrics = stage(
        forecast.forecast(base, tables["model_outputs"], parts["weather"], parts["forecast_scores"], as_of), "forecast"
    )
    next_day = forecast.forecast_24h(metrics, as_of)
    year = stage(forecast.forecast_1y(metrics, as_of), "forecast-1y")
    recommended = prescribe.recommendations(metrics, tables.get("capacities"))
    audit = prescribe.compliance_audit(tables["deployments"], tables["protocols"])
    drift = forecast.model_drift(tables["model_outputs"], actuals)
    feed = feeds.weather_feed(
        tables["weather_current"],
        today,
        "Open-Meteo Weather Service",
        "https://open-meteo.com",
        "Station live weather metrics via Open-Meteo API",
    )
    return {
        "vw_hourly_actuals": actuals,
        "hourly_threshold_baselines": base,
        "descriptive_historical_threshold_baselines": base,
        "vw_descriptive_metrics": described,
        "descriptive_historical_capacity_benchmarking": described,
        "descriptive_live_event_feed": feeds.live_event_feed(feed, events, today),
        "vw_predictive_features": triggers.predictive_features(actuals, parts["weather"], parts["scores"]),
        "vw_predictive_metrics": metrics,
        "predictive_passenger_volume_forecast_24h": next_day,
        "predictive_passenger_volume_forecast_1w": forecast.forecast_1w(metrics, as_of),
        "predictive_passenger_volume_forecast_1m": forecast.forecast_1m(metrics, as_of),
        "predictive_passenger_volume_forecast_quarterly": forecast.forecast_quarterly(metrics, as_of),
        "predictive_passenger_volume_forecast_1y": year,
        "vw_model_auditing": drift,
        "descriptive_model_auditing_drift_tracking": drift,
        "predictive_topological_route_map": forecast.station_status(base, described, next_day, as_of),
        "predictive_known_events": forecast.known_events(events, as_of),
        "prescriptive_action_recommendations": recommended,
        "prescriptive_active_checklists": prescribe.active_checklists(
            recommended, tables["protocols"], tables["tactics"], as_of
        ),
        "prescriptive_tactical_interventions": prescribe.tactical_guidelines(tables["protocols"]),
        "prescriptive_compliance_audit": audit,
        "prescriptive_latency_summary": prescribe.latency_summary(tables["deployments"]),
        "vw_uat_executive_summary": prescribe.executive_summary(tables["evaluations"], tables["executions"]),
        "vw_kpi_prediction_accuracy": prescribe.kpi_prediction_accuracy(
            tables["performance"], audit, default_mape, default_rmse, last_certified(tables["evaluations"])
        ),
    }


def last_certified(evaluations: DataFrame) -> Column | None:
    """Whether the last evaluation in the ledger passed all gates; unknown in a ledger without that column."""
    if "certified" not in evaluations.columns:
        return None
    return evaluations.agg(F.max_by("certified", "recorded_at")).scalar()


# Row order of the views that are published sorted; sorting happens where rows are shown
VIEW_ORDER = {
    "predictive_passenger_volume_forecast_24h": ["date", "time"],
    "predictive_passenger_volume_forecast_1w": ["date"],
    "predictive_passenger_volume_forecast_1m": ["date"],
    "predictive_passenger_volume_forecast_quarterly": ["year", "quarter"],
    "predictive_passenger_volume_forecast_1y": ["year", "month_num"],
    "prescriptive_active_checklists": ["station_name", "flow_type", "task_order"],
}


def ordered(name: str, views: dict[str, DataFrame]) -> DataFrame:
    """A view in its published row order, for output; the views themselves stay unsorted."""
    return views[name].orderBy(*VIEW_ORDER.get(name, []))


def publish_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """Temporary views under their public names, and the what-if as a table function."""
    publish(views)
    shocks = " + ".join(f"({c} * p_{name}_score)" for name, c in fixed.WHATIF_SHOCKS.items())
    for name in ("simulate_scenario", "predictive_what_if_scenario_simulator"):
        spark.sql(
            f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {name}(
              p_station_name STRING, p_day_of_week INT, p_hour_period STRING, p_flow_type STRING,
              p_weather_score DECIMAL(6,5), p_academic_score DECIMAL(6,5), p_civic_score DECIMAL(6,5),
              p_baseline_override DECIMAL(12,3) DEFAULT NULL)
            RETURNS TABLE (baseline_mean_forecast DECIMAL(12,3), simulated_forecasted_peak DECIMAL(18,0),
              forecasted_peak_variance DECIMAL(18,2), simulated_threat_level STRING)
            RETURN SELECT base, peak,
              CASE WHEN base = 0 THEN 0 ELSE round((peak - base) / base * 100, 2) END,
              CASE WHEN peak >= critical THEN 'Critical' WHEN peak >= warning THEN 'Warning' ELSE 'Normal' END
            FROM (SELECT base, warning, critical, round(base * CAST(1 + {shocks} AS DECIMAL(12,8)), 0) AS peak
              FROM (SELECT coalesce(p_baseline_override, max(median_volume), 0) AS base,
                  coalesce(max(warning_threshold), {fixed.WHATIF_DEFAULT_WARNING}) AS warning,
                  coalesce(max(critical_threshold), {fixed.WHATIF_DEFAULT_CRITICAL}) AS critical
                FROM hourly_threshold_baselines
                WHERE station_name = p_station_name AND day_of_week = p_day_of_week
                  AND hour_period = p_hour_period AND flow_type = p_flow_type))
            """
        )
