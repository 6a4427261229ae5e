"""SQL twin of each registered query, by name."""

from __future__ import annotations

from flowgauge import fixed
from flowgauge.plans import settings
from flowgauge.plans.oracle import (
    CAP_CODE,
    LOCAL,
    NOTABLE,
    SEASON,
    STATUS_NOW,
    TODAY_SQL,
    WIDE,
    case,
    cents,
    cfi_sum,
    day,
    half_up,
    horizon,
    level_case,
    listing,
    moment,
    padded,
    station_at,
    text,
    wide_sum,
    with_fragments,
)

TWINS: dict[str, str] = {}


def twin(name: str, reads: list[str], sql: str) -> None:
    TWINS[name] = with_fragments(reads, sql)


def doubles(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


SCORES = doubles("weather_score", "academic_surge_score", "civic_mandate_score", "operational_score")
WIDE_LIST = ", ".join(WIDE)
TOTALS = listing([*fixed.TOTAL_LABELS, *fixed.TOTAL_LABELS.values()])


def unpivot(table: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT date, time_period AS hour_period, {text(s)} AS station_name, '{f}' AS flow_type, "
        f"{fixed.slug(s)}_{f} AS volume FROM {table} WHERE time_period NOT IN {TOTALS}"
        for s in fixed.STATIONS
        for f in fixed.FLOWS
    )
    return cells


twin(
    "hourly_actuals",
    ["hour_table"],
    f"SELECT {day('date')} AS date, hour_period, station_name, flow_type, volume FROM ({unpivot('hour_table')})",
)
twin(
    "unpivot_flows",
    ["bands"],
    f"""SELECT station_name, flow_type, count(*) AS cells, count(volume) AS filled, CAST(sum(volume) AS BIGINT) AS volume
    FROM ({unpivot('bands')}) GROUP BY ALL""",
)
twin("threshold_baselines", ["baselines"], "SELECT station_name, CAST(day_of_week AS INTEGER) AS day_of_week, hour_period, flow_type, median_volume, warning_threshold, critical_threshold FROM baselines")
twin(
    "congestion_levels",
    ["flow", "baselines"],
    f"""SELECT {day('f.date')} AS date, f.hour_period, f.station_name, f.flow_type, volume, median_volume,
      warning_threshold, critical_threshold, {level_case('volume')} AS congestion_level
    FROM flow f JOIN baselines b ON b.station_name = f.station_name AND b.day_of_week = isodow(f.date)
      AND b.hour_period = f.hour_period AND b.flow_type = f.flow_type""",
)
TWINS["bucketed_congestion"] = TWINS["congestion_levels"]
twin(
    "sketched_percentiles",
    [],
    f"""SELECT {station_at('l_suppkey')} AS station_name, CASE WHEN l_linestatus = 'O' THEN 'entry' ELSE 'exit' END AS flow_type,
      CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS observations, TRUE AS median_within_error, TRUE AS warning_within_error, TRUE AS critical_within_error
    FROM lineitem GROUP BY 1, 2, 3""",
)
twin(
    "sketched_baselines",
    ["flow"],
    f"""SELECT station_name, CAST(isodow(date) AS INTEGER) AS day_of_week, hour_period, flow_type, count(*) AS observations,
      TRUE AS median_volume_within_error, TRUE AS warning_threshold_within_error, TRUE AS critical_threshold_within_error FROM flow GROUP BY 1, 2, 3, 4""",
)
twin("sketched_distinct", [], "SELECT strftime(ts, '%Y-%m') AS month, event_type, count(DISTINCT user_id) AS users, TRUE AS within_error FROM events GROUP BY 1, 2")
twin("restore_bands", ["bands"], f"SELECT id, {day('date')} AS date, time_period, grain, {WIDE_LIST} FROM bands")
twin("expand_bands", ["expanded"], f"SELECT id, {day('date')} AS date, time_period, grain, {WIDE_LIST} FROM expanded")
twin("transform_years", ["expanded"], f"SELECT id, {day('date')} AS date, time_period, {WIDE_LIST} FROM expanded")
TWINS["discovered_years"] = TWINS["transform_years"]
twin("roundtrip_bands", ["bands"], f"SELECT id, {day('date')} AS date, time_period, total_entry, total_exit FROM bands")
twin("allocate_monthly", ["allocated"], f"SELECT id, {day('date')} AS date, time_period, {WIDE_LIST} FROM allocated")
twin(
    "nearest_date_map",
    [],
    f"""SELECT {day('d')} AS date, {day('(SELECT arg_min(b, abs(day(b) - day(d))) FROM base WHERE month(b) = month(d) AND isodow(b) = isodow(d))')} AS baseline_date
    FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
    """.replace(
        "FROM base", f"FROM (SELECT CAST(DATE '{settings.BASE_YEAR}-01-01' + to_days(CAST(i AS INTEGER)) AS DATE) AS b FROM range(365) r(i))"
    ),
)
twin("daily_totals", ["hour_wide"], f"SELECT {day('date')} AS date, 'DAILY_TOTAL' AS time_period, {wide_sum()} FROM hour_wide GROUP BY hour_wide.date")
twin("hourly_weather", ["hourly_weather"], f"SELECT {day('date')} AS date, CAST(hour AS INTEGER) AS hour, {doubles('weather_score')} FROM hourly_weather")
twin(
    "event_scores",
    ["event_hours"],
    f"SELECT {day('date')} AS date, station_name, CAST(hour AS INTEGER) AS hour, {doubles('academic_surge_score', 'civic_mandate_score', 'operational_score')} FROM event_hours",
)
twin(
    "suspension_decay",
    ["calendar_events"],
    f"""SELECT id, {day('event_date')} AS event_date, CAST(h AS INTEGER) AS hour,
      CASE WHEN announcement_time IS NULL OR CAST(announcement_time AS DATE) < event_date OR a < 8 THEN 1.0
           WHEN h < a THEN 0.0 WHEN h IN (a, a + 1) THEN -0.4444 ELSE 1.0 END::DOUBLE AS civic_mandate_score
    FROM (SELECT *, hour(announcement_time + {LOCAL}) AS a FROM calendar_events WHERE event_category = 'class_suspension')
    CROSS JOIN (SELECT unnest(range(24)) AS h)""",
)
twin(
    "friction_index",
    ["scored"],
    f"SELECT {day('date')} AS date, hour_period, station_name, flow_type, CAST(round({cfi_sum()}, 4) AS DOUBLE) AS cfi FROM scored",
)
twin(
    "descriptive_metrics",
    ["descriptive"],
    f"""SELECT {day('date')} AS date, time_period, station_name, flow_type, actual_volume, historical_median,
      warning_threshold, critical_threshold, {SCORES}, CAST(cfi AS DOUBLE) AS cfi, congestion_level FROM descriptive""",
)
twin(
    "predictive_features",
    ["scored"],
    f"""SELECT {day('date')} AS date, hour_period, CAST(isodow(date) AS INTEGER) AS day_of_week, station_name, flow_type,
      volume AS historical_actual_volume, {SCORES}, CAST(round({cfi_sum()}, 4) AS DOUBLE) AS cfi FROM scored""",
)
METRIC_COLUMNS = f"""{day('prediction_date')} AS prediction_date, hour_period, station_name, flow_type,
  CAST(day_of_week AS INTEGER) AS day_of_week, baseline_mean_forecast, {SCORES}, CAST(cfi AS DOUBLE) AS cfi,
  adjusted_forecast_volume, warning_threshold, critical_threshold, predicted_threat_level"""
twin("forecast_metrics", ["metrics"], f"SELECT {METRIC_COLUMNS} FROM metrics")
twin(
    "forecast_fanout",
    ["metrics_fanout"],
    """SELECT station_name, flow_type, count(*) AS rows, CAST(sum(baseline_mean_forecast) AS BIGINT) AS baseline,
      CAST(sum(adjusted_forecast_volume) AS BIGINT) AS predicted,
      CAST(count(*) FILTER (WHERE predicted_threat_level = 'Emergency') AS BIGINT) AS emergencies
    FROM metrics_fanout GROUP BY ALL""",
)
twin(
    "forecast_24h",
    ["next_day"],
    f"""SELECT station_name, flow_type, {day('date')} AS date, time, baseline, predicted, surge_volume,
      {doubles('surge_variance_percentage')}, {SCORES}, CAST(cfi AS DOUBLE) AS cfi, warning_threshold,
      critical_threshold, predicted_threat_level FROM next_day""",
)
twin(
    "forecast_1w",
    ["metrics"],
    horizon("prediction_date AS d", TODAY_SQL, f"{TODAY_SQL} + 7", "strftime(d, '%A')", f"{day('d')} AS date, "),
)
twin(
    "forecast_1m",
    ["metrics"],
    horizon("prediction_date AS d", TODAY_SQL, f"{TODAY_SQL} + 30", day("d"), f"{day('d')} AS date, "),
)
QUARTER = f"date_trunc('quarter', {TODAY_SQL})"
MONTH = f"date_trunc('month', {TODAY_SQL})"
twin(
    "forecast_quarterly",
    ["metrics"],
    horizon(
        "CAST(year(prediction_date) AS INTEGER) AS year, 'Q' || CAST(quarter(prediction_date) AS VARCHAR) AS quarter",
        QUARTER,
        f"{QUARTER} + INTERVAL 1 YEAR",
        "quarter || ' ' || CAST(year AS VARCHAR)",
        "year, quarter, ",
    ),
)
twin(
    "forecast_1y",
    ["metrics"],
    horizon(
        "CAST(year(prediction_date) AS INTEGER) AS year, CAST(month(prediction_date) AS INTEGER) AS month_num, strftime(prediction_date, '%B') AS month_name",
        MONTH,
        f"{MONTH} + INTERVAL 1 YEAR",
        "month_name",
        "year, month_num, ",
    ),
)
twin(
    "model_drift",
    ["pairs"],
    f"""SELECT {day('date')} AS date, hour_period, station_name, flow_type, actual AS actual_volume,
      predicted AS predicted_volume, actual - predicted AS error,
      CASE WHEN actual = 0 THEN 0.0 ELSE {half_up('abs(actual - predicted) * 100', 'actual')} END AS absolute_percentage_error
    FROM pairs""",
)
LOAD = f"""CASE WHEN w < 50 AND seen < 50 THEN {half_up('seen * 100', '500')}
           WHEN w = 0 OR load = 0 THEN 0.0
           WHEN load < warning_threshold THEN {half_up('load * 80', 'warning_threshold')}
           WHEN load < critical_threshold THEN {half_up('(80 * (critical_threshold - warning_threshold) + 10 * (load - warning_threshold))', '(critical_threshold - warning_threshold)')}
           ELSE {half_up('(90 * greatest(critical_threshold, 100) + 10 * (load - critical_threshold))', 'greatest(critical_threshold, 100)')} END"""
STATUS = """CASE WHEN w < 50 AND seen < 50 THEN 'Normal' WHEN w = 0 OR load = 0 THEN 'Normal'
           WHEN load >= greatest(critical_threshold, 50) THEN 'Critical'
           WHEN load >= greatest(warning_threshold, 40) THEN 'Warning' ELSE 'Normal' END"""
twin(
    "station_status",
    ["baselines", "flow", "metrics"],
    f"""SELECT {case('station_name', {k: text(v) for k, v in fixed.DISPLAY_IDS.items()}, 'lower(station_name)')} AS station_id,
      station_name, flow_type, coalesce(cur, median_volume, 0) AS current_occupancy,
      coalesce(pre, median_volume, 0) AS predicted_occupancy, greatest(warning_threshold, 100) AS threshold,
      {LOAD} AS capacity_percentage,
      {STATUS} AS status_classification
    FROM (SELECT b.*, f.volume AS cur, m.adjusted_forecast_volume AS pre, coalesce(b.warning_threshold, 0) AS w,
        coalesce(m.adjusted_forecast_volume, f.volume, b.median_volume, 0) AS seen,
        coalesce(m.adjusted_forecast_volume, b.median_volume, 0) AS load
      FROM baselines b
      LEFT JOIN flow f ON f.date = {TODAY_SQL} AND f.hour_period = b.hour_period AND f.station_name = b.station_name AND f.flow_type = b.flow_type
      LEFT JOIN metrics m ON m.prediction_date = {TODAY_SQL} AND m.hour_period = b.hour_period AND m.station_name = b.station_name AND m.flow_type = b.flow_type
      WHERE b.day_of_week = isodow({TODAY_SQL}) AND b.hour_period = strftime({STATUS_NOW}, '%H:00'))""",
)
twin(
    "capacity_classes",
    ["metrics"],
    f"""SELECT {day('prediction_date')} AS prediction_date, hour_period, station_name, flow_type, hour,
      (CASE WHEN hour < 5 OR hour >= 23 THEN 0.0 ELSE {LOAD} END)::DOUBLE AS capacity_percentage,
      CASE WHEN hour < 5 OR hour >= 23 THEN 'Normal' ELSE {STATUS} END AS status_classification
    FROM (SELECT *, adjusted_forecast_volume AS load, adjusted_forecast_volume AS seen, warning_threshold AS w,
        CAST((CAST(substr(hour_period, 1, 2) AS INTEGER) + 7 * length(station_name)) % 24 AS INTEGER) AS hour
      FROM metrics WHERE prediction_date < {TODAY_SQL} + INTERVAL 2 DAY)""",
)
RANKING = "ORDER BY normalized_score DESC NULLS FIRST, event_name, source_name, time"
TWINS["bucketed_drift"] = TWINS["model_drift"]
TWINS["refreshed_year"] = TWINS["forecast_1y"]
twin(
    "known_events",
    ["calendar_events"],
    f"""SELECT horizon_index, time, event, source_name FROM (
      SELECT horizon_index, time, event_name AS event, source_name,
        row_number() OVER (PARTITION BY horizon_index, CASE WHEN horizon_index > 0 THEN time END {RANKING}) AS n
      FROM (
        SELECT 0 AS horizon_index, {case('trigger_category', {k: text(v) for k, v in fixed.TODAY_TIMES.items()}, text(fixed.TODAY_TIME_DEFAULT))} AS time, *
          FROM notable WHERE event_date = {TODAY_SQL} AND trigger_category IN {listing(fixed.TODAY_TRIGGERS)}
        UNION ALL SELECT 1, strftime(event_date, '%a'), * FROM notable
          WHERE event_date BETWEEN {TODAY_SQL} AND {TODAY_SQL} + 6 AND trigger_category IN {listing(fixed.WEEK_TRIGGERS)}
        UNION ALL SELECT CAST(quarter(event_date) + 1 AS INTEGER), strftime(event_date, '%b'), * FROM notable WHERE {SEASON}
        UNION ALL SELECT 6, strftime(event_date, '%b'), * FROM notable WHERE {SEASON}))
    WHERE n <= CASE WHEN horizon_index = 0 THEN 3 ELSE 1 END""".replace(
        "FROM notable",
        f"FROM (SELECT DISTINCT event_date, event_name, event_category, trigger_category, source_name, normalized_score FROM calendar_events WHERE {NOTABLE})",
    ),
)
SCENARIOS = f"""SELECT o_orderkey AS scenario_id, {station_at('o_custkey')} AS station_name,
  CAST(o_orderkey % 7 + 1 AS INTEGER) AS day_of_week, lpad(CAST(o_orderkey % 19 + 4 AS VARCHAR), 2, '0') || ':00' AS hour_period,
  CASE WHEN o_custkey % 2 = 0 THEN 'entry' ELSE 'exit' END AS flow_type, {cents('o_orderkey', 101)} AS weather_score,
  {cents('o_custkey', 101)} AS academic_score, {cents('(o_orderkey + o_custkey)', 101)} AS civic_score,
  CASE WHEN o_orderkey % 5 = 0 THEN o_custkey * 3 END AS baseline_override,
  ['Weather', 'Academic', 'Civic'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS trigger_type,
  CASE WHEN o_orderkey % 2 = 0 THEN 'High' ELSE 'Low' END AS severity FROM orders"""
SIMULATED = f"""SELECT *, CASE WHEN base = 0 THEN 0.0 ELSE {half_up('CAST(peak - base AS BIGINT) * 100', 'base')} END AS variance,
    CASE WHEN peak >= c THEN 'Critical' WHEN peak >= w THEN 'Warning' ELSE 'Normal' END AS level
  FROM (SELECT s.*, coalesce(baseline_override, median_volume, 0) AS base,
      CASE WHEN b.station_name IS NULL THEN 1000 ELSE warning_threshold END AS w,
      CASE WHEN b.station_name IS NULL THEN 1200 ELSE critical_threshold END AS c,
      CAST(round(CAST(coalesce(baseline_override, median_volume, 0) AS DECIMAL(12,0)) *
        CAST(1 + 0.30 * academic_score - 0.45 * civic_score - 0.175 * weather_score AS DECIMAL(10,8)), 0) AS BIGINT) AS peak
    FROM ({SCENARIOS}) s LEFT JOIN baselines b ON b.station_name = s.station_name AND b.day_of_week = s.day_of_week
      AND b.hour_period = s.hour_period AND b.flow_type = s.flow_type)"""
twin(
    "scenario_whatif",
    ["baselines"],
    f"""SELECT scenario_id, station_name, day_of_week, hour_period, flow_type, {doubles('weather_score', 'academic_score', 'civic_score', 'baseline_override')},
      trigger_type, severity, CAST(base AS DOUBLE) AS baseline_mean_forecast, CAST(peak AS DOUBLE) AS simulated_forecasted_peak,
      CAST(variance AS DOUBLE) AS forecasted_peak_variance, level AS simulated_threat_level FROM ({SIMULATED})""",
)
twin(
    "whatif_function",
    ["baselines"],
    f"""SELECT call, CAST(base AS DOUBLE) AS baseline_mean_forecast, CAST(peak AS DOUBLE) AS simulated_forecasted_peak,
      CAST(CASE WHEN base = 0 THEN 0.0 ELSE {half_up('CAST(peak - base AS BIGINT) * 100', 'base')} END AS DOUBLE) AS forecasted_peak_variance,
      CASE WHEN peak >= c THEN 'Critical' WHEN peak >= w THEN 'Warning' ELSE 'Normal' END AS simulated_threat_level
    FROM (SELECT call, coalesce(own, median_volume, 0) AS base, coalesce(warning_threshold, 1000) AS w, coalesce(critical_threshold, 1200) AS c,
        CAST(round(CAST(coalesce(own, median_volume, 0) AS DECIMAL(12,0)) * CAST(1 + 0.30 * 1.0 - 0.175 * 0.8 AS DECIMAL(10,8)), 0) AS BIGINT) AS peak
      FROM (SELECT station_name AS call, station_name AS s, NULL AS own FROM (SELECT unnest({'[' + ', '.join(text(s) for s in fixed.STATIONS) + ']'}) AS station_name)
        UNION ALL SELECT 'base given', {text(fixed.STATIONS[0])}, 1000) calls
      LEFT JOIN baselines b ON b.station_name = s AND b.day_of_week = 1 AND b.hour_period = '17:00' AND b.flow_type = 'entry')""",
)
RECORDED = moment(f"TIMESTAMP '{settings.RECORDED_AT}'")
twin(
    "scenario_archive",
    ["baselines"],
    f"""SELECT 'SIM' || {padded('n + (run - 1) * total', 6)} AS simulation_id, CAST(run AS INTEGER) AS run_number, station_name, trigger_type, severity,
      {doubles('weather_score', 'academic_score', 'civic_score')}, CAST(peak AS INTEGER) AS simulated_peak_volume,
      CAST(variance AS DOUBLE) AS variance_percentage, level AS simulated_threat_level, {RECORDED} AS executed_at, false AS is_archived
    FROM (SELECT *, row_number() OVER (ORDER BY scenario_id) AS n, count(*) OVER () AS total FROM ({SIMULATED})), (VALUES (1), (2)) AS runs(run)""",
)
twin(
    "recommendations",
    ["recommended"],
    f"""SELECT {day('date')} AS date, time, station_name, flow_type, predicted_volume, adjusted_volume, platform_capacity,
      {doubles('capacity_utilization')}, passenger_surplus, forecasted_threat_level, primary_trigger_context, decision_action FROM recommended""",
)
twin(
    "active_checklists",
    ["recommended", "protocols", "tactics"],
    f"""SELECT station_name, flow_type, predicted_volume, platform_capacity, {doubles('capacity_utilization')},
      p.apta_standard_code AS active_action, primary_trigger_context AS active_context,
      CASE WHEN t.id LIKE '%-T01' THEN 1 WHEN t.id LIKE '%-T02' THEN 2 WHEN t.id LIKE '%-T03' THEN 3 ELSE 4 END AS task_order,
      tactic_name AS task_name,
      CASE WHEN t.id IN {listing(fixed.COMMAND_TACTICS)} THEN 'Command Center Officer' ELSE 'Ground Control Staff' END AS target_role,
      CASE WHEN t.id IN {listing(fixed.CRITICAL_TACTICS)} THEN 'Critical' WHEN t.id IN {listing(fixed.HIGH_TACTICS)} THEN 'High' ELSE 'Medium' END AS priority,
      tactic_description AS action_details, {moment(f'r.date + to_hours(CAST(substr(r.time, 1, 2) AS INTEGER) - 8)')} AS ingestion_timestamp
    FROM recommended r JOIN protocols p ON p.id = r.decision_action JOIN tactics t ON t.protocol_id = r.decision_action
    WHERE r.date = {TODAY_SQL} AND r.time = strftime({STATUS_NOW}, '%H:00')""",
)
twin(
    "tactical_guidelines",
    ["protocols"],
    "SELECT threat_level, threshold_indicator, apta_standard_code || ' - ' || official_document_title AS prescribed_standard, "
    "scope_relevance_to_surge_management AS operational_guideline FROM protocols JOIN (VALUES "
    + ", ".join(f"({text(a)}, {text(b)}, {text(c)})" for a, b, c in fixed.GUIDELINES)
    + ") AS g(threat_level, threshold_indicator, pid) ON pid = id",
)
SENT = moment("TIMESTAMP '1998-06-15 00:00:02'")
twin(
    "log_deployments",
    ["recommended"],
    f"""SELECT 'DEP' || {padded('n + (run - 1) * total', 6)} AS deployment_id, station_name, flow_type, decision_action,
      'validation_pipeline' AS deployed_by, 'Active' AS status, {RECORDED} AS ingestion_timestamp, {SENT} AS broadcast_timestamp,
      {SENT} AS activated_at, CAST(NULL AS VARCHAR) AS completed_at
    FROM (SELECT *, row_number() OVER (ORDER BY date, time, station_name, flow_type, decision_action) AS n, count(*) OVER () AS total FROM recommended),
      (VALUES (1), (2)) AS runs(run)""",
)
twin(
    "log_executions",
    ["recommended", "protocols"],
    f"""SELECT row_number() OVER (ORDER BY date, time, station_name, flow_type, decision_action) AS id, '{settings.RUN_ID}' AS run_id, 'validation_pipeline' AS trigger_source, station_name,
      CASE forecasted_threat_level WHEN 'Critical' THEN 0.9 WHEN 'Warning' THEN 0.6 ELSE 0.1 END::DOUBLE AS friction_score,
      decision_action AS recommended_protocol_id, decision_action AS actual_dispatched_protocol_id,
      {RECORDED} AS ingestion_timestamp, {SENT} AS broadcast_timestamp, 2.0::DOUBLE AS latency_seconds,
      EXISTS (SELECT 1 FROM protocols p WHERE p.id = decision_action AND p.id <> 'APTA-02') AS scr_compliant,
      true AS latency_sla_passed, 'validation_pipeline' AS tested_by, {SENT} AS recorded_at FROM recommended""",
)
AUDIT = f"""SELECT count(*) AS made, count(*) FILTER (WHERE decision_action IN (SELECT id FROM protocols)) AS valid FROM deployments"""
twin(
    "compliance_audit",
    ["deployments", "protocols"],
    f"""SELECT CAST(made AS BIGINT) AS total_prescriptive_generations, CAST(valid AS BIGINT) AS valid_protocol_generations,
      CASE WHEN made = 0 THEN 100.0 ELSE {half_up('valid * 100', 'made')} END::DOUBLE AS symbolic_heuristic_compliance_rate_scr FROM ({AUDIT})""",
)
twin(
    "latency_summary",
    ["deployments"],
    f"""SELECT CAST(n AS BIGINT) AS total_audited_runs, coalesce(round(CAST(s AS DOUBLE) / n / 1000000.0, 4), 0.0) AS average_latency_seconds,
      coalesce(round(CAST(m AS DOUBLE) / 1000000.0, 4), 0.0) AS max_latency_seconds, CAST(ok AS BIGINT) AS passed_runs,
      CASE WHEN n = 0 THEN 100.0 ELSE {half_up('ok * 100', 'n')} END::DOUBLE AS latency_compliance_rate_pct
    FROM (SELECT count(*) AS n, sum(us) AS s, max(us) AS m, count(*) FILTER (WHERE us < 3000000) AS ok
      FROM (SELECT epoch_us(sent) - epoch_us(received) AS us FROM deployments WHERE sent IS NOT NULL))""",
)
twin(
    "executive_summary",
    [],
    f"""SELECT p.*, CAST(n AS BIGINT) AS total_prescriptive_executions, {moment('latest')} AS latest_prescriptive_eval_at,
      CAST(scr AS BIGINT) AS scr_compliant_executions, {half_up('scr * 100', 'n')}::DOUBLE AS overall_scr_compliance_pct,
      seconds AS avg_pipeline_latency_seconds, {half_up('sla * 100', 'n')}::DOUBLE AS overall_latency_sla_compliance_pct
    FROM (SELECT count(DISTINCT o_custkey % 50) AS total_predictive_runs, {moment('max(CAST(o_orderdate AS TIMESTAMP))')} AS latest_predictive_eval_at,
        round(avg(CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 400) / 4.0 END), 4) AS avg_volume_mape,
        round(avg(CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 1000) / 4.0 END), 4) AS avg_volume_rmse,
        round(avg(CASE WHEN o_orderkey % 2 = 1 THEN (o_custkey % 400) / 4.0 END), 2) AS avg_classifier_accuracy,
        round(avg(CASE WHEN o_orderkey % 2 = 1 THEN (o_custkey % 5) / 4.0 END), 4) AS avg_classifier_f1,
        CAST(count(*) FILTER (WHERE o_orderkey % 3 = 0) AS BIGINT) AS passed_predictive_runs FROM orders) p,
      (SELECT count(*) AS n, max(ts) AS latest, count(*) FILTER (WHERE event_id % 9 <> 0) AS scr,
        round(avg((event_id % 20) / 4.0), 4) AS seconds, count(*) FILTER (WHERE (event_id % 20) / 4.0 < 3.0) AS sla FROM events) e""",
)
REGRESSION = """SELECT count(*) AS sample_count, round(sqrt(avg(CAST((actual - predicted) * (actual - predicted) AS DOUBLE))), 4) AS rmse,
  round(avg(CAST(actual AS DOUBLE)), 4) AS mean_volume,
  round(avg(abs(actual - predicted) / CAST(greatest(actual, 1) AS DOUBLE)) * 100, 4) AS mape FROM pairs"""
SPLIT = "(SELECT d FROM (SELECT d, row_number() OVER (ORDER BY d) AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT date AS d FROM flow)) WHERE pos = CAST(floor(n * 0.8) AS BIGINT) + 1)"
twin(
    "chrono_split",
    ["flow"],
    f"""SELECT CASE WHEN date >= {SPLIT} THEN 'test' ELSE 'train' END AS part, count(*) AS rows, {day('min(date)')} AS first_date,
      {day('max(date)')} AS last_date, CAST(sum(volume) AS BIGINT) AS volume FROM flow GROUP BY 1""",
)
twin(
    "regression_metrics",
    ["pairs"],
    f"SELECT sample_count, rmse, mean_volume, round(rmse / mean_volume * 100, 2) AS rmse_percentage, mape FROM ({REGRESSION})",
)
F1 = "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END::DOUBLE"
twin("class_scores", ["class_scores"], f"SELECT CAST(class_id AS INTEGER) AS class_id, tp, fp, fn, support, {F1} AS f1 FROM class_scores")
WEIGHTED = f"""SELECT round(sum({F1} * support) / sum(support), 4) AS f1_score,
  round(CAST(sum(tp) AS DOUBLE) / sum(support) * 100, 2) AS classification_accuracy,
  round(CAST(sum(tp) AS DOUBLE) / sum(support) * 100, 2) AS recall_score FROM class_scores"""
twin("weighted_f1", ["class_scores"], WEIGHTED)
LATENCY_OK = "(SELECT count(*) FILTER (WHERE epoch_us(sent) - epoch_us(received) >= 3000000) = 0 FROM deployments WHERE sent IS NOT NULL)"
SCR_OK = f"(SELECT made = 0 OR CAST({half_up('valid * 100', 'made')} AS DOUBLE) = 100 FROM ({AUDIT}))"


def ledger_rows(pairs: str, scores: str) -> str:
    return f"""SELECT id, '{settings.RUN_ID}' AS run_id, 'model_validation' AS evaluation_type, {day('split_date')} AS dataset_split_date,
      sample_count, {RECORDED} AS recorded_at, rmse_pct < 5 AND f1 >= 0.85 AS all_targets_passed, mape_v < 5 AS target_mape_passed,
      scr_ok AS target_scr_passed, latency_ok AS target_latency_passed, rmse_pct < 5 AND f1 >= 0.85 AND scr_ok AND latency_ok AS certified,
      model_name, CASE WHEN v THEN rmse_v ELSE 0.0 END AS rmse, CASE WHEN v THEN mean_v ELSE 0.0 END AS mean_volume,
      CASE WHEN v THEN rmse_pct ELSE 0.0 END AS rmse_percentage, CASE WHEN v THEN mape_v ELSE 0.0 END AS mape,
      CASE WHEN v THEN 0.0 ELSE acc END AS classification_accuracy, CASE WHEN v THEN 0.0 ELSE acc END AS recall_score,
      CASE WHEN v THEN 0.0 ELSE f1 END AS f1_score, NOT v OR rmse_pct < 5 AS target_rmse_passed, v OR f1 >= 0.85 AS target_f1_passed
    FROM (SELECT {SPLIT} AS split_date, (SELECT count(*) FROM flow) AS sample_count, r.rmse AS rmse_v, r.mean_volume AS mean_v, r.mape AS mape_v,
        round(r.rmse / r.mean_volume * 100, 2) AS rmse_pct, c.f1_score AS f1, c.classification_accuracy AS acc, {SCR_OK} AS scr_ok, {LATENCY_OK} AS latency_ok
      FROM ({REGRESSION.replace('FROM pairs', f'FROM {pairs}')}) r, ({WEIGHTED.replace('FROM class_scores', f'FROM {scores}')}) c),
      (VALUES (CAST(1 AS BIGINT), 'volume_forecast', true), (CAST(2 AS BIGINT), 'threat_classifier', false)) AS k(id, model_name, v)"""


GATE_READS = ["flow", "pairs", "baselines", "class_scores", "deployments", "protocols"]
twin("evaluation_ledger", GATE_READS, ledger_rows("test_pairs", "test_scores"))
# the test-part tables used above
TWINS["evaluation_ledger"] = TWINS["evaluation_ledger"].replace(
    "\nSELECT id, 'run-1'",
    f""",
test_pairs AS (SELECT * FROM pairs WHERE date >= {SPLIT}),
test_graded AS (SELECT CASE WHEN actual >= critical_threshold THEN 2 WHEN actual >= warning_threshold THEN 1 ELSE 0 END AS a,
  CASE WHEN predicted >= critical_threshold THEN 2 WHEN predicted >= warning_threshold THEN 1 ELSE 0 END AS p
  FROM test_pairs t JOIN baselines b ON b.station_name = t.station_name AND b.day_of_week = isodow(t.date)
    AND b.hour_period = t.hour_period AND b.flow_type = t.flow_type),
test_scores AS (SELECT k, CAST(count(*) FILTER (WHERE a = k AND p = k) AS BIGINT) AS tp, CAST(count(*) FILTER (WHERE a <> k AND p = k) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE a = k AND p <> k) AS BIGINT) AS fn, CAST(count(*) FILTER (WHERE a = k) AS BIGINT) AS support
  FROM test_graded CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) GROUP BY k)
SELECT id, 'run-1'""",
    1,
)
twin(
    "kpi_accuracy",
    GATE_READS,
    f"""SELECT model_name, round(100.0 - shown, 1) AS prediction_accuracy_pct, round(shown, 1) AS mape_error_rate_pct,
      round(rmse, 1) AS rmse_pax, 'High' AS confidence_level, 'High (95% CI)' AS confidence_label, 95.0::DOUBLE AS confidence_ci_pct,
      {half_up('valid * 100', 'made')}::DOUBLE AS heuristic_compliance_scr_pct,
      CASE WHEN certified THEN '{fixed.STATUS_CERTIFIED}' ELSE '{fixed.STATUS_FAILED}' END AS model_status, recorded_at AS last_trained_timestamp
    FROM (SELECT *, CASE WHEN mape <= 0 THEN {fixed.DEFAULT_MAPE} WHEN mape < 0.2 THEN mape * 100 ELSE mape END::DOUBLE AS shown
      FROM ({ledger_rows('pairs', 'class_scores')}) WHERE model_name = 'volume_forecast'), ({AUDIT})""",
)
FEATURES = ["weather_score", "academic_surge_score", "civic_mandate_score", "operational_score"]
TRAINING = f"""SELECT s.*, CAST(substr(s.hour_period, 1, 2) AS INTEGER) AS hour, isodow(s.date) AS day_of_week, month(s.date) AS month,
    median_volume, warning_threshold, critical_threshold, s.date >= {SPLIT} AS is_test,
    CASE WHEN s.volume >= critical_threshold THEN 2 WHEN s.volume >= warning_threshold THEN 1 ELSE 0 END AS k
  FROM scored s JOIN (SELECT station_name, isodow(date) AS dow, hour_period, flow_type,
      CAST(round_even(quantile_cont(volume, 0.5), 0) AS INTEGER) AS median_volume,
      CAST(round_even(quantile_cont(volume, 0.8), 0) AS INTEGER) AS warning_threshold,
      CAST(round_even(quantile_cont(volume, 0.9), 0) AS INTEGER) AS critical_threshold
    FROM flow WHERE date < {SPLIT} GROUP BY ALL) b
  ON b.station_name = s.station_name AND b.dow = isodow(s.date) AND b.hour_period = s.hour_period AND b.flow_type = s.flow_type"""
twin(
    "train_forecaster",
    ["flow", "scored"],
    f"""SELECT {day(SPLIT)} AS split_date, *, {', '.join(f'round(train_rows / (3.0 * train_class_{c}), 6)::DOUBLE AS weight_{c}' for c in range(3))},
      100 AS volume_trees, 100 AS threat_trees, true AS one_output_per_row, true AS no_negative_output, true AS one_class_per_row, true AS fits_better_than_mean
    FROM (SELECT count(*) FILTER (WHERE NOT is_test) AS train_rows, count(*) FILTER (WHERE is_test) AS test_rows,
      {', '.join(f"count(*) FILTER (WHERE {t} is_test AND k = {c}) AS {p}_class_{c}" for p, t in (('train', 'NOT'), ('test', '')) for c in range(3))},
      {', '.join(f'round(CAST(sum({c}) AS DOUBLE), 4) AS sum_{c}' for c in [*FEATURES, 'hour', 'day_of_week', 'month', 'median_volume', 'warning_threshold', 'critical_threshold'])}
      FROM ({TRAINING}))""",
)
twin(
    "tuned_forecaster",
    ["flow"],
    f"""SELECT fold, {day('train_last')} AS train_last, {day('test_first')} AS test_first, {day('test_last')} AS test_last,
      CAST(train_rows AS BIGINT) AS train_rows, CAST(test_rows AS BIGINT) AS test_rows, CAST(2 AS BIGINT) AS candidates,
      CAST(scored AS BIGINT) AS scored_rows, TRUE AS measured, TRUE AS reloaded_equal
    FROM (SELECT CAST(2 - ((dates - pos) // 56) AS INTEGER) AS fold, min(last) AS train_last, min(date) AS test_first, max(date) AS test_last, min(before) AS train_rows, sum(n) AS test_rows
      FROM (SELECT date, count(*) AS n, row_number() OVER (ORDER BY date) AS pos, count(*) OVER () AS dates, lag(date) OVER (ORDER BY date) AS last,
          coalesce(sum(count(*)) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM flow GROUP BY date)
      WHERE dates - pos < 112 GROUP BY 1) f
    JOIN (SELECT CAST(2 - ((dates - pos) // 56) AS INTEGER) AS fold, sum(known) AS scored FROM (
        SELECT date, count(*) OVER () AS dates, row_number() OVER (ORDER BY date) AS pos FROM (SELECT DISTINCT date FROM flow)) JOIN (
        SELECT f.date, count(*) AS known FROM flow f WHERE EXISTS (SELECT 1 FROM flow k WHERE k.station_name = f.station_name AND k.hour_period = f.hour_period
          AND k.flow_type = f.flow_type AND isodow(k.date) = isodow(f.date) AND k.date < (SELECT CASE WHEN f.date >= b2 THEN b2 ELSE b1 END FROM (
            SELECT max(date) FILTER (WHERE dates - pos = 111) AS b1, max(date) FILTER (WHERE dates - pos = 55) AS b2 FROM (
              SELECT date, count(*) OVER () AS dates, row_number() OVER (ORDER BY date) AS pos FROM (SELECT DISTINCT date FROM flow))))) GROUP BY f.date) USING (date)
      WHERE dates - pos < 112 GROUP BY 1) s USING (fold)
    WHERE train_last IS NOT NULL""",
)
YEAR_ROWS = TWINS["forecast_1y"]
SHOWN = {
    "forecast_1w": "date",
    "forecast_1m": "date",
    "forecast_quarterly": "CAST(year AS VARCHAR) || ' ' || quarter",
    "forecast_1y": "CAST(year AS VARCHAR) || ' ' || CAST(month_num AS VARCHAR)",
}
SHOWN_BY = {"forecast_1w": "date", "forecast_1m": "date", "forecast_quarterly": "year, quarter", "forecast_1y": "year, month_num"}
TWINS["ordered_views"] = " UNION ALL ".join(
    f"SELECT 'predictive_passenger_volume_{name}' AS view_name, {label} AS period, CAST(row_number() OVER (ORDER BY {SHOWN_BY[name]}) AS INTEGER) AS place, TRUE AS together "
    f"FROM (SELECT DISTINCT {SHOWN_BY[name]} FROM ({TWINS[name]}))"
    for name, label in SHOWN.items()
)
CALLS = {
    "refresh_predictive_forecast_1y": f"(SELECT count(*) FROM ({YEAR_ROWS}))",
    "evaluate_and_log_prescriptive_deployments": "(SELECT count(*) FROM recommended)",
    "scan_and_transform_new_ridership_tables": "CASE WHEN run = 1 THEN (SELECT count(DISTINCT year(date)) FROM bands) ELSE 0 END",
    "train_and_validate_models": "2 * run",
}
twin(
    "sql_procedures",
    ["recommended", "protocols", "expanded", "bands"],
    f"""SELECT CAST(run AS INTEGER) AS run, procedure, CAST(result AS BIGINT) AS result, (SELECT 2 * count(*) FROM recommended) AS deployments,
      (SELECT 2 * count(*) FROM recommended) AS last_execution, (SELECT 2 * count(*) FROM recommended WHERE decision_action IN (SELECT id FROM protocols)) AS compliant,
      (SELECT count(*) FROM expanded) AS hours, (SELECT CAST(sum(total_entry) AS BIGINT) FROM expanded) AS entries,
      (SELECT CAST(sum(predicted) AS DOUBLE) FROM ({YEAR_ROWS})) AS predicted, CAST(4 AS BIGINT) AS evaluations
    FROM (SELECT unnest([1, 2]) AS run) r CROSS JOIN LATERAL ({' UNION ALL '.join(f"SELECT {text(n)} AS procedure, {sql} AS result" for n, sql in CALLS.items())})""",
)
twin(
    "performance_snapshot",
    [],
    f"""SELECT model_name, mape, rmse, acc AS classification_accuracy, acc AS recall_score, {moment('loaded')} AS last_trained_timestamp
    FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY loaded DESC, mape DESC, rmse DESC, acc DESC) AS n FROM (
      SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'volume_forecast' ELSE 'threat_classifier' END AS model_name,
        ((o_orderkey % 400) / 4.0)::DOUBLE AS mape, ((o_orderkey % 1000) / 4.0)::DOUBLE AS rmse,
        ((o_custkey % 400) / 4.0)::DOUBLE AS acc, CAST(o_orderdate AS TIMESTAMP) AS loaded FROM orders)) WHERE n = 1
    UNION ALL SELECT 'retired_model', 1.0, 2.0, 3.0, 4.0, {moment("TIMESTAMP '1990-01-01'")}""",
)
twin(
    "evaluation_history",
    GATE_READS,
    f"""SELECT id + 2 * run AS id, model_name, mape, rmse, classification_accuracy, recall_score, recorded_at
    FROM ({ledger_rows('pairs', 'class_scores')}), (VALUES (0), (1)) AS runs(run)""",
)
twin(
    "pending_years",
    [],
    f"""SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem
    WHERE year(l_shipdate) NOT IN (SELECT year(o_orderdate) - 2 FROM orders)""",
)
LOADED = "TIMESTAMP '2023-11-14 22:13:20' + to_seconds({})"
twin(
    "incident_dim",
    [],
    f"""SELECT 'PSOR-' || {padded('n', 2)} AS id, category, specific_incident_transgression, {moment('loaded')} AS load_timestamp
    FROM (SELECT *, row_number() OVER (ORDER BY loaded, specific_incident_transgression) AS n FROM (
      SELECT [{', '.join(text(c) for c in fixed.INCIDENT_TYPES)}][CAST(s_suppkey % 12 AS INTEGER) + 1] AS category,
        s_name AS specific_incident_transgression, {LOADED.format('s_suppkey % 7')} AS loaded FROM supplier))""",
)
twin(
    "capacity_codes",
    [],
    f"""SELECT {CAP_CODE} AS id, station_name, row_id, total_station_limit_pax FROM (
      SELECT CASE WHEN s_suppkey % 4 = 3 THEN 'New ' || s_name
          ELSE ' ' || CASE WHEN s_suppkey % 2 = 0 THEN upper({station_at('s_suppkey')}) ELSE {station_at('s_suppkey')} END END AS station_name,
        s_suppkey AS row_id, CAST(s_suppkey % 900 + 100 AS INTEGER) AS total_station_limit_pax FROM supplier)""",
)
twin(
    "protocol_dim",
    ["protocols"],
    f"""SELECT id, apta_standard_code, official_document_title, scope_relevance_to_surge_management,
      open_access_link_source, {moment('load_timestamp')} AS load_timestamp FROM protocols""",
)
twin("tactics_normalised", ["tactics"], "SELECT id, protocol_id, tactic_name, tactic_description FROM tactics")
twin(
    "weight_dim",
    [],
    f"""SELECT id, friction_domain, CASE WHEN trigger_category = 'Mid-Day Class Suspension' THEN 'Class Suspension / Holiday' ELSE trigger_category END AS trigger_category,
      specific_condition_api_input, {doubles('friction_weight')}, ncr_literature_source_basis, open_access_link, {moment('loaded')} AS load_timestamp
    FROM (SELECT id, friction_domain, loaded, CASE WHEN id = 'FRI-AC06' THEN 'School Break' ELSE trigger_category END AS trigger_category,
        CASE WHEN id = 'FRI-AC06' THEN 'Semestral/Christmas/Summer Break' ELSE c_name END AS specific_condition_api_input,
        CASE WHEN id = 'FRI-AC06' THEN 0.85 ELSE w END AS friction_weight,
        CASE WHEN id = 'FRI-AC06' THEN {text(fixed.SCHOOL_BREAK_SEED[5])} ELSE c_mktsegment END AS ncr_literature_source_basis,
        CASE WHEN id = 'FRI-AC06' THEN {text(fixed.SCHOOL_BREAK_SEED[6])} ELSE 'https://example.org/' || c_custkey END AS open_access_link
      FROM (SELECT 'FRI-' || CASE friction_domain WHEN 'academic' THEN 'AC' WHEN 'pagasa' THEN 'PA' WHEN 'operational' THEN 'OP' ELSE 'XX' END || {padded('n', 2)} AS id, *
        FROM (SELECT *, row_number() OVER (PARTITION BY friction_domain ORDER BY loaded, trigger_category) AS n FROM (
          SELECT ['academic', 'pagasa', 'operational', 'lgu'][CAST(c_custkey % 4 AS INTEGER) + 1] AS friction_domain,
            CASE WHEN c_custkey % 10 = 0 THEN 'Mid-Day Class Suspension' ELSE c_name END AS trigger_category, c_name, c_mktsegment, c_custkey,
            CAST({cents('c_custkey', 101)} AS DECIMAL(3,2)) AS w, {LOADED.format('c_custkey')} AS loaded FROM customer))))""",
)
twin(
    "upsert_latest",
    ["incidents"],
    f"""SELECT id, CASE WHEN user_key % 7 = 0 THEN 'cubao' ELSE station END AS station_name, incident_type, description, severity, status,
      {moment('ts')} AS changed_at, event_id AS change_id
    FROM (SELECT *, CAST(split_part(id, '_', 1) AS BIGINT) AS user_key, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS n FROM incidents) WHERE n = 1""",
)
CALENDAR_COLUMNS = f"""id, station, {day('event_date')} AS event_date, source_table, source_id, source_name, event_name, event_category,
  friction_domain, trigger_category, {doubles('normalized_score')}, CAST(normalized_score AS DOUBLE) AS friction_weight_ref, {moment('announcement_time')} AS announcement_time"""
twin("delete_resolved", ["incident_calendar"], f"SELECT {CALENDAR_COLUMNS} FROM incident_calendar")
TWINS["stream_incident_sync"] = TWINS["delete_resolved"]
TWINS["stream_incident_log"] = TWINS["delete_resolved"]
twin(
    "resolved_times",
    ["incidents"],
    f"""SELECT id, arg_max(status, event_id) AS status,
      {moment("min(ts) FILTER (WHERE status = 'resolved' AND event_id > last_open)")} AS resolved_at
    FROM (SELECT *, max(event_id) FILTER (WHERE status <> 'resolved') OVER (PARTITION BY id) AS last_open FROM incidents) GROUP BY id""",
)
TWINS["stream_resolved_times"] = TWINS["resolved_times"]
twin("classify_posts", ["classified"], "SELECT id, event_category, trigger_category, affects_ridership FROM classified")
twin("post_event_dates", ["dated"], f"SELECT id, {day('event_date')} AS event_date FROM dated")
twin("city_propagation", ["spread"], "SELECT id, station FROM spread")
POST_COLUMNS = f"""id, station, {day('event_date')} AS event_date, source_id, source_name, event_name, event_category, trigger_category,
  {doubles('normalized_score', 'friction_weight_ref')}, {moment('announcement_time')} AS announcement_time, source_url, description"""
twin("consolidated_posts", ["consolidated"], f"SELECT {POST_COLUMNS} FROM consolidated")
TWINS["stream_post_sync"] = TWINS["consolidated_posts"]
twin(
    "cancellations",
    ["consolidated"],
    f"""SELECT id, source_id, station, {day('event_date')} AS event_date FROM consolidated c
    WHERE NOT is_cancellation AND NOT EXISTS (SELECT 1 FROM consolidated k WHERE k.is_cancellation
      AND k.station = c.station AND k.event_date = c.event_date AND k.event_category = c.event_category)""",
)
DENSITY = "CASE WHEN {0} >= 3 THEN 1.0 WHEN {0} >= 1 THEN 0.5 ELSE 0.0 END::DOUBLE"
twin(
    "surge_density",
    ["calendar_events"],
    f"""SELECT {day("date_trunc('month', event_date)")} AS event_day, station, count(*) AS major_events, {DENSITY.format('count(*)')} AS surge_score
    FROM calendar_events WHERE event_category = 'major_event' GROUP BY 1, 2""",
)
twin(
    "surge_density_daily",
    ["calendar_events"],
    f"""SELECT {day('event_date')} AS event_day, coalesce(station, '') AS place, {DENSITY.format('count(*)')} AS surge_score, count(*) AS major_events,
      count(*) FILTER (WHERE normalized_score <> CASE WHEN n >= 3 THEN 1.0 ELSE 0.5 END) AS changed, {DENSITY.format('count(*)')} AS rescored
    FROM (SELECT *, count(*) OVER (PARTITION BY event_date, station) AS n FROM calendar_events WHERE event_category = 'major_event') GROUP BY 1, 2""",
)
twin(
    "stream_surge_density",
    ["calendar_events"],
    f"""SELECT {day("date_trunc('month', event_date)")} AS event_day, coalesce(station, '(network)') AS station, count(*) AS major_events, {DENSITY.format('count(*)')} AS surge_score
    FROM calendar_events WHERE event_category = 'major_event' GROUP BY 1, 2""",
)
twin(
    "rescored_events",
    ["calendar_events"],
    f"""SELECT id, CASE WHEN major THEN {DENSITY.format('n')} ELSE normalized_score END::DOUBLE AS normalized_score,
      CASE WHEN major THEN n ELSE 0 END AS major_events, major AND {DENSITY.format('n')} <> CAST(normalized_score AS DOUBLE) AS changed
    FROM (SELECT *, event_category = 'major_event' AS major,
      count(*) FILTER (WHERE event_category = 'major_event') OVER (PARTITION BY date_trunc('month', event_date), station) AS n FROM calendar_events)""",
)
FRICTION = """CASE WHEN wind_signal >= 2 AND rainfall_mm > 40 THEN 1.0 WHEN wind_signal >= 2 OR rainfall_mm > 40 OR advisory_level IN ('Orange', 'Red') THEN 0.8
  WHEN wind_signal = 1 OR rainfall_mm >= 5 OR advisory_level = 'Yellow' THEN 0.4 ELSE 0.0 END::DOUBLE"""
twin(
    "weather_friction",
    ["readings"],
    f"""SELECT 'WTH-FCT-' || CAST(id AS VARCHAR) AS id, station, {day(f'observed_at + {LOCAL}')} AS weather_date,
      {moment('observed_at')} AS observed_or_forecasted_at, {FRICTION} AS normalized_score FROM readings""",
)
twin(
    "stream_weather_sync",
    ["readings"],
    f"""SELECT 'WTH-CUR-' || station AS id, station, {day(f'observed_at + {LOCAL}')} AS weather_date, {moment('observed_at')} AS observed_or_forecasted_at,
      {FRICTION} AS normalized_score, id AS reading_id
    FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY observed_at DESC, id DESC) AS n FROM readings) WHERE n = 1""",
)
EVENT_GROUPS = f"""SELECT event_date, min(id) AS trigger_id,
    CASE WHEN event_category = 'lgu' OR friction_domain = 'lgu' THEN 'lgu' ELSE 'academic' END AS source_type,
    string_agg(DISTINCT source_name, ' / ' ORDER BY source_name) AS source,
    'Station: ' || string_agg(DISTINCT station, ', ' ORDER BY station) || ' - ' || coalesce(event_name, 'Event Notice') AS message,
    max(coalesce(announcement_time, updated_at)) AS time,
    CASE WHEN regexp_matches(coalesce(event_name, ''), {text(fixed.FEED_CRITICAL_WORDS)}) OR max(normalized_score) >= 0.80 THEN 'critical'
         WHEN max(normalized_score) >= 0.45 OR regexp_matches(coalesce(event_name, ''), {text(fixed.FEED_WARNING_WORDS)}) THEN 'warning' ELSE 'low' END AS urgency,
    string_agg(DISTINCT station, ', ' ORDER BY station) AS station_name, max(source_url) AS source_url, max(description) AS description
  FROM calendar_events GROUP BY event_date, event_category, friction_domain, event_name"""
FEED = f"trigger_id, source_type, source, message, {moment('time')} AS time, urgency, station_name, source_url, description"
twin("event_groups", ["calendar_events"], f"SELECT {day('event_date')} AS event_date, {FEED} FROM ({EVENT_GROUPS})")
twin(
    "live_feed",
    ["calendar_events", "readings"],
    f"""SELECT {FEED} FROM ({EVENT_GROUPS}) WHERE event_date = {TODAY_SQL}
    UNION ALL SELECT CAST(id AS VARCHAR), 'weather', 'Weather Service', 'Station: ' || station || ' - Temp: ' || CAST(temperature AS VARCHAR) || '°C, Rain: ' ||
        CAST(rainfall_mm AS VARCHAR) || 'mm (' || coalesce(nullif(computed_rainfall_level, 'None'), 'Normal') || ')', {moment('observed_at')},
      CASE WHEN rainfall_mm >= 30 OR computed_rainfall_level IN ('Torrential', 'Monsoon') THEN 'critical'
           WHEN rainfall_mm >= 15 OR computed_rainfall_level = 'Heavy' THEN 'warning' ELSE 'low' END, station, 'https://example.org/w', 'Live weather'
    FROM readings WHERE CAST(observed_at + {LOCAL} AS DATE) = {TODAY_SQL}""",
)
CONSERVED = """SELECT y AS year, m AS month_number, target AS original_total, e AS expanded_entry, x AS expanded_exit,
    target IS NOT DISTINCT FROM e AND target IS NOT DISTINCT FROM x AS conserved
  FROM targets LEFT JOIN (SELECT year(date) AS ay, month(date) AS am, CAST(sum(total_entry) AS BIGINT) AS e, CAST(sum(total_exit) AS BIGINT) AS x
    FROM allocated WHERE time_period <> 'DAILY_TOTAL' GROUP BY ALL) ON ay = y AND am = m"""
twin("monthly_conservation", ["targets", "allocated"], f"SELECT CAST(year AS INTEGER) AS year, CAST(month_number AS INTEGER) AS month_number, original_total, expanded_entry, expanded_exit, conserved FROM ({CONSERVED})")
SPECIAL_DAY = f"(year(date) = {settings.HOURLY_SOURCE_YEAR} AND (month(date) = 6 OR (month(date) = 11 AND day(date) = 1)))"


def row_sum(flow: str) -> str:
    return " + ".join(f"coalesce({fixed.slug(s)}_{flow}, 0)" for s in fixed.STATIONS)


PLANNING = f"(regexp_matches(post_text, {text(fixed.PLANNING_STRICT)}) OR (regexp_matches(post_text, {text(fixed.PLANNING_LOOSE)}) AND NOT regexp_matches(post_text, {text(fixed.EXPLICIT_DISRUPTION)})))"
CHECKS = {
    "row_sums": f"(SELECT count(*) FROM expanded WHERE time_period NOT IN {TOTALS} AND NOT {SPECIAL_DAY} AND (({row_sum('entry')}) <> total_entry OR ({row_sum('exit')}) <> total_exit))",
    "negative_counts": "(SELECT count(*) FROM expanded WHERE " + " OR ".join(f"{c} < 0" for c in WIDE) + ")",
    "unique_ids": "(SELECT count(*) - count(DISTINCT id) FROM expanded)",
    "suspension_scores": "(SELECT count(*) FROM calendar_events WHERE event_category IN ('class_suspension', 'school_break') AND normalized_score <> 1)",
    "score_range": "(SELECT count(*) FROM calendar_events WHERE normalized_score < 0 OR normalized_score > 1)",
    "event_dates": "(SELECT count(*) FROM calendar_events WHERE event_date IS NULL)",
    "surge_density": "(SELECT count(*) FROM (SELECT count(*) AS n, min(normalized_score) AS lo, max(normalized_score) AS hi FROM calendar_events WHERE event_category = 'major_event' GROUP BY date_trunc('month', event_date), station) WHERE lo <> CASE WHEN n >= 3 THEN 1.0 ELSE 0.5 END OR hi <> CASE WHEN n >= 3 THEN 1.0 ELSE 0.5 END)",
    "baseline_rows": "(SELECT greatest(0, 3094 - count(*)) FROM baselines)",
    "baseline_keys": "(SELECT count(*) - count(DISTINCT (station_name, day_of_week, hour_period, flow_type)) FROM baselines)",
    "cfi_present": "(SELECT count(*) FROM descriptive WHERE cfi IS NULL)",
    "classifier_false_positives": f"(SELECT count(*) FROM classified WHERE event_category <> 'administrative' AND {PLANNING})",
    "monthly_conservation": f"(SELECT count(*) FROM ({CONSERVED}) WHERE NOT conserved)",
    "incident_type": f"(SELECT count(*) FROM incidents WHERE incident_type NOT IN {listing(fixed.INCIDENT_TYPES)})",
    "incident_severity": f"(SELECT count(*) FROM incidents WHERE severity NOT IN {listing(fixed.INCIDENT_SEVERITIES)})",
    "incident_status": f"(SELECT count(*) FROM incidents WHERE status NOT IN {listing(fixed.INCIDENT_STATUSES)})",
    "deployment_status": f"(SELECT count(*) FROM deployments WHERE status NOT IN {listing(fixed.DEPLOYMENT_STATUSES)})",
    "deployment_order": "(SELECT count(*) FROM deployments WHERE sent < received)",
    "weight_range": f"(SELECT count(*) FROM customer WHERE {cents('c_custkey', 101)} NOT BETWEEN 0 AND 1)",
    "positive_capacity": "(SELECT count(*) FROM supplier WHERE floor(s_acctbal) <= 0)",
    "mobile_format": "(SELECT count(*) FROM customer WHERE c_custkey % 97 = 0 OR c_custkey % 89 = 0)",
    "not_empty_events": "(SELECT CASE WHEN EXISTS (SELECT 1 FROM calendar_events) THEN 0 ELSE 1 END)",
    "not_empty_posts": "(SELECT CASE WHEN EXISTS (SELECT 1 FROM posts) THEN 0 ELSE 1 END)",
    "not_empty_hours": "(SELECT CASE WHEN EXISTS (SELECT 1 FROM expanded) THEN 0 ELSE 1 END)",
}
twin(
    "quality_report",
    ["expanded", "calendar_events", "baselines", "descriptive", "classified", "allocated", "targets", "incidents", "deployments"],
    "SELECT check_name, violations, violations = 0 AS passed FROM ("
    + " UNION ALL ".join(f"SELECT {text(n)} AS check_name, CAST({sql} AS BIGINT) AS violations" for n, sql in CHECKS.items())
    + ")",
)
twin(
    "stream_hour_windows",
    [],
    f"""SELECT {day('lt')} AS local_date, CAST(hour(lt) AS INTEGER) AS local_hour, event_type, count(*) AS events,
      CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents, max(event_id) AS last_event
    FROM (SELECT *, date_trunc('hour', ts + {LOCAL}) AS lt FROM events) GROUP BY lt, event_type""",
)
twin("stream_batch_ledger", [], "SELECT CAST(3 AS BIGINT) AS batches, count(*) AS rows, CAST(3 AS BIGINT) AS stamped FROM events")
twin(
    "stream_closed_windows",
    [],
    f"""SELECT {day('lt')} AS local_date, CAST(hour(lt) AS INTEGER) AS local_hour, event_type, count(*) AS events,
      CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents, max(event_id) AS last_event,
      any_value(date_trunc('hour', ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOURS AS is_closed
    FROM (SELECT *, date_trunc('hour', ts + {LOCAL}) AS lt FROM events) GROUP BY lt, event_type""",
)
twin(
    "stream_dispatches",
    ["recommended", "protocols"],
    """SELECT station_name, decision_action, count(*) AS dispatches, count(*) FILTER (WHERE decision_action IN (SELECT id FROM protocols)) AS compliant,
      count(*) AS stamped, (SELECT count(*) FROM recommended) AS deployments, (SELECT count(*) FROM recommended) AS last_id FROM recommended GROUP BY ALL""",
)
twin(
    "first_backup",
    ["protocols"],
    f"""SELECT id, apta_standard_code, official_document_title, scope_relevance_to_surge_management,
      open_access_link_source, {moment('load_timestamp')} AS load_timestamp FROM protocols""",
)
ALARMS = {"Warning": fixed.PROTOCOL_WARNING[0], "Critical": fixed.PROTOCOL_CRITICAL[0]}
ANSWERED = " OR ".join(f"(forecasted_threat_level = '{k}' AND decision_action = '{v}')" for k, v in ALARMS.items())
PRESCRIPTIVE = {
    "capacity_rows": "(SELECT abs(count(DISTINCT station_name) - 13) FROM capacities)",
    "protocol_rows": "(SELECT greatest(0, 6 - count(*)) FROM protocols)",
    "compliance": f"(SELECT made - valid FROM ({AUDIT}))",
    "expected_protocol": f"""(SELECT count(*) FROM (SELECT count(*) FILTER (WHERE {ANSWERED}) AS n FROM recommended
      WHERE forecasted_threat_level IN {listing(ALARMS)} GROUP BY date, time, station_name, flow_type) WHERE n = 0)""",
    "columns": "0",
}
twin(
    "prescriptive_report",
    ["capacities", "protocols", "deployments", "recommended"],
    "SELECT check_name, violations, violations = 0 AS passed FROM ("
    + " UNION ALL ".join(f"SELECT {text(n)} AS check_name, CAST({sql} AS BIGINT) AS violations" for n, sql in PRESCRIPTIVE.items())
    + ")",
)
