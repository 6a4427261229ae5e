from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from flowgauge.functions import indices
from flowgauge.operators import forecast, scenarios, triggers

MONDAY = dt.date(2026, 6, 15)
BASE = "station_name string, day_of_week int, hour_period string, flow_type string, median_volume int, warning_threshold int, critical_threshold int"


def baselines(spark, cells):
    return spark.createDataFrame(cells, BASE)


def every_day(station="Recto", hour="07:00", flow="exit", numbers=(1000, 1100, 1200)):
    return [(station, d, hour, flow, *numbers) for d in range(1, 8)]


def scores(spark, cells=()):
    weather = spark.createDataFrame(
        [(d, h, Decimal(str(w))) for d, h, w in cells], "date date, hour int, weather_score decimal(6,5)"
    )
    return weather


def events(spark, cells=()):
    df = spark.createDataFrame(
        [(d, s, c, dom, Decimal(str(v)), None) for d, s, c, dom, v in cells],
        "event_date date, station string, event_category string, friction_domain string, normalized_score decimal(6,5), announcement_time timestamp",
    )
    return triggers.station_scores(triggers.scope_scores(df, triggers.FORECAST_CIVIC, hour_aware=False))


def test_calendar_and_shocks(spark):
    table = baselines(spark, every_day())
    weather = scores(spark, [(MONDAY, 7, 0.8)])
    ev = events(spark, [(MONDAY, "Recto", "major_event", "academic", 0.5), (MONDAY, "All", "incident", "operational", 0.5)])
    out = {r["prediction_date"]: r for r in rows(forecast.forecast(table, None, weather, ev, "2026-06-15 07:30:00", 10))}
    assert len(out) == 10
    # 1 + .215 rush + .045 Monday - .186 June + .152 payday = 1.226
    want = Decimal(1000) * Decimal("1.226") * Decimal("1.1425") * 1 * Decimal("0.868") * Decimal("0.855")
    monday = out[MONDAY]
    assert monday["adjusted_forecast_volume"] == int(want.quantize(Decimal(1), "ROUND_HALF_UP"))
    assert float(monday["cfi"]) == round(0.25 * 0.8 + 0.15 * 0.5 + 0.25 * 0.5, 4)
    # Wednesday 17th: 1 + .215 - .186
    assert out[MONDAY + dt.timedelta(days=2)]["adjusted_forecast_volume"] == 1029
    # Sunday 21st: 1 + .215 - .440 - .186
    assert out[MONDAY + dt.timedelta(days=6)]["adjusted_forecast_volume"] == 589


def test_model_output_replaces_the_median_only_in_the_adjusted_volume(spark):
    model = spark.createDataFrame(
        [("Recto", MONDAY + dt.timedelta(days=2), "07:00", "exit", Decimal("2000.5"))],
        "station_name string, prediction_date date, hour_period string, flow_type string, baseline_mean_forecast decimal(12,2)",
    )
    out = forecast.forecast(baselines(spark, every_day()), model, scores(spark), events(spark), "2026-06-15 00:00:00", 7)
    r = out.filter(F.col("prediction_date") == MONDAY + dt.timedelta(days=2)).first()
    assert r.baseline_mean_forecast == 1000 and r.adjusted_forecast_volume == 2059  # 2000.5 x 1.029 = 2058.51


def test_threat_levels(spark):
    cells = [(0.9, 10, "Emergency"), (0.85, 10, "Normal"), (0.85, 1100, "Warning"), (0.1, 1200, "Critical")]
    df = spark.createDataFrame([(Decimal(str(c)), v, w) for c, v, w in cells], "c decimal(6,5), v int, w string")
    out = df.select("w", indices.threat(F.col("c"), F.col("v"), F.lit(1100), F.lit(1200)).alias("got"))
    assert all(r.w == r.got for r in out.collect())


def test_horizons(spark):
    table = baselines(spark, every_day())
    as_of = "2026-06-15 07:30:00"
    metrics = forecast.forecast(table, None, scores(spark), events(spark), as_of)
    assert metrics.count() == 366
    day = rows(forecast.forecast_24h(metrics, as_of), "date")
    assert [r["date"] for r in day] == [MONDAY, MONDAY + dt.timedelta(days=1)]
    # both ends count: 06:30 to 07:30 next day
    wide = forecast.forecast(
        baselines(spark, [("Recto", d, f"{h:02d}:00", "exit", 1, 2, 3) for d in range(1, 8) for h in range(24)]),
        None, scores(spark), events(spark), "2026-06-15 07:00:00", 3,
    )
    assert forecast.forecast_24h(wide, "2026-06-15 07:00:00").count() == 26
    week = rows(forecast.forecast_1w(metrics, as_of), "date")
    assert [r["time"] for r in week][:2] == ["Monday", "Tuesday"] and len(week) == 7
    assert forecast.forecast_1m(metrics, as_of).count() == 30
    quarters = rows(forecast.forecast_quarterly(metrics, as_of), "year", "quarter")
    assert [r["time"] for r in quarters] == ["Q2 2026", "Q3 2026", "Q4 2026", "Q1 2027"]
    assert quarters[0]["baseline"] == 16 * 1000  # partial: starts today
    year = rows(forecast.forecast_1y(metrics, as_of), "year", "month_num")
    assert len(year) == 12 and (year[0]["time"], year[-1]["time"]) == ("June", "May")


def test_zero_base_has_no_surge_percentage(spark):
    table = baselines(spark, every_day(numbers=(0, 0, 0)))
    r = forecast.forecast_1w(forecast.forecast(table, None, scores(spark), events(spark), "2026-06-15 00:00:00"), "2026-06-15 00:00:00").first()
    assert r.baseline == 0 and r.surge_variance_percentage is None


def test_drift_is_zero_on_zero_actuals(spark):
    schema = "station_name string, prediction_date date, hour_period string, flow_type string, baseline_mean_forecast int"
    model = spark.createDataFrame([("a", MONDAY, "07:00", "entry", 30), ("b", MONDAY, "07:00", "entry", 30)], schema)
    actual = spark.createDataFrame(
        [("a", MONDAY, "07:00", "entry", 0), ("b", MONDAY, "07:00", "entry", 40)],
        "station_name string, date date, hour_period string, flow_type string, volume long",
    )
    out = {r["station_name"]: (r["error"], float(r["absolute_percentage_error"])) for r in rows(forecast.model_drift(model, actual))}
    assert out == {"a": (-30, 0.0), "b": (10, 25.0)}


def test_capacity_branches(spark):
    cells = [  # hour, predicted, current, median, warning, critical, percent, status
        (4, 900, 900, 900, 100, 200, 0.0, "Normal"),
        (23, 900, 900, 900, 100, 200, 0.0, "Normal"),
        (7, 40, None, 10, 45, 60, 8.0, "Normal"),
        (7, None, None, 0, 100, 200, 0.0, "Normal"),
        (7, 60, None, 0, 0, 0, 0.0, "Normal"),
        (7, 50, None, 10, 100, 200, 40.0, "Normal"),
        (7, 150, None, 10, 100, 200, 85.0, "Warning"),
        (7, 250, None, 10, 100, 200, 92.5, "Critical"),
        (7, None, 999, 250, 100, 200, 92.5, "Critical"),
        (7, 55, None, 10, 30, 40, 91.5, "Critical"),
        (7, 49, None, 10, 60, 45, 65.33, "Normal"),
    ]
    df = spark.createDataFrame(cells, "h int, p int, c int, m int, w int, k int, pct double, status string")
    args = [F.col(x) for x in ("h", "p", "c", "m", "w", "k")]
    out = df.select("pct", "status", indices.capacity_percent(*args).cast("double").alias("a"), indices.capacity_status(*args).alias("b"))
    for r in out.collect():
        assert (r.a, r.b) == (r.pct, r.status)


def test_station_status_masks_closed_hours(spark):
    table = baselines(spark, [("V. Mapa", 1, "23:00", "entry", 500, 600, 700)])
    seen = spark.createDataFrame([], "date date, time_period string, station_name string, flow_type string, actual_volume long")
    coming = spark.createDataFrame([], "date date, time string, station_name string, flow_type string, predicted int")
    r = forecast.station_status(table, seen, coming, "2026-06-15 23:10:00").first()
    assert (r.station_id, r.current_occupancy, r.predicted_occupancy, r.threshold) == ("vmapa", 0, 0, 600)
    assert float(r.capacity_percentage) == 0 and r.status_classification == "Normal"


def test_whatif_golden(spark):
    schema = "station_name string, day_of_week int, hour_period string, flow_type string, weather_score double, academic_score double, civic_score double, baseline_override int"
    cases = spark.createDataFrame(
        [
            ("Katipunan", 1, "17:00", "entry", 0.8, 1.0, 0.0, 1000),
            ("Katipunan", 1, "03:00", "entry", 0.0, 0.0, 0.0, 1100),
            ("Katipunan", 1, "03:00", "entry", 0.0, 1.0, 0.0, None),
            ("Katipunan", 1, "17:00", "entry", 0.0, 0.0, 1.0, None),
        ],
        schema,
    )
    table = baselines(spark, [("Katipunan", 1, "17:00", "entry", 900, 1000, 1150)])
    out = scenarios.simulate_scenarios(cases, table)
    got = [
        (float(r.baseline_mean_forecast), float(r.simulated_forecasted_peak), float(r.forecasted_peak_variance), r.simulated_threat_level)
        for r in out.collect()
    ]
    assert sorted(got) == sorted(
        [(1000.0, 1160.0, 16.0, "Critical"), (1100.0, 1100.0, 0.0, "Warning"), (0.0, 0.0, 0.0, "Normal"), (900.0, 495.0, -45.0, "Normal")]
    )


def test_known_events(spark):
    schema = "event_date date, event_name string, event_category string, trigger_category string, source_name string, normalized_score decimal(6,5)"

    def event(day, name, category, trigger, score):
        return (day, name, category, trigger, "src", None if score is None else Decimal(str(score)))

    cells = [
        event(MONDAY, "Strike", "transport_strike", "Transport Strike", 0.9),
        event(MONDAY, "Strike", "transport_strike", "Transport Strike", 0.9),
        event(MONDAY, "Game", "major_event", "Major Arena Event", 0.5),
        event(MONDAY, "Rally", "civic", "Civic Rally & Public Mobilization", None),
        event(MONDAY, "Feast", "holiday", "Holiday", 0.1),
        event(MONDAY, "Grade posting", "holiday", "Holiday", 1),
        event(MONDAY, "Rain", "weather_advisory", "Holiday", 1),
        event(dt.date(2026, 12, 25), "Christmas", "holiday", "Holiday", 0.8),
        event(dt.date(2026, 12, 30), "No work suspension", "holiday", "Holiday", 0.9),
    ]
    out = rows(forecast.known_events(spark.createDataFrame(cells, schema), "2026-06-15 08:00:00"))
    got = sorted((r["horizon_index"], r["time"], r["event"]) for r in out)
    # a missing score sorts first
    assert got == [
        (0, "06:00", "Strike"), (0, "12:00", "Rally"), (0, "19:00", "Game"), (1, "Mon", "Rally"),
        (3, "Jun", "Game"), (5, "Dec", "Christmas"), (6, "Dec", "Christmas"), (6, "Jun", "Game"),
    ]


def test_archive_ids(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, "Recto", "Weather", "High", 0.1, 0.2, 0.3, 10.0, 1.5, "Normal") for i in range(30)],
        "k int, station_name string, trigger_type string, severity string, weather_score double, academic_score double, civic_score double, "
        "simulated_forecasted_peak double, forecasted_peak_variance double, simulated_threat_level string",
    )
    out = rows(scenarios.archive_rows(df, ["k"], "2026-01-01 00:00:00"), "simulation_id")
    assert [r["simulation_id"] for r in out][:2] == ["SIM000001", "SIM000002"] and out[0]["is_archived"] is False
    path = str(tmp_path / "archive")
    for _ in range(2):
        scenarios.record_scenarios(df, ["k"], "2026-01-01 00:00:00", path)
    stored = rows(spark.read.parquet(path), "simulation_id")
    assert [r["simulation_id"] for r in stored] == [f"SIM{k:06d}" for k in range(1, 61)]
    assert {r["run_number"] for r in stored[:30]} == {1} and {r["run_number"] for r in stored[30:]} == {2}
