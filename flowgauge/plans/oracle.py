"""DuckDB SQL twins of the registered queries.

Each twin is written from the semantics, not from the Spark plan: events are expanded
over hours and joined by scope, percentiles use the engine's own aggregate, and splits
are spelled out column by column.
"""

from __future__ import annotations

from flowgauge import fixed
from flowgauge.operators import enrich
from flowgauge.plans.settings import (
    ALLOCATE_END,
    ALLOCATE_START,
    AS_OF,
    BASE_YEAR,
    HOURLY_SOURCE_YEAR,
    STATUS_AS_OF,
    TODAY,
)
from flowgauge.sources.adapters import PHRASES


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listing(values) -> str:
    return "(" + ", ".join(text(v) if isinstance(v, str) else str(v) for v in values) + ")"


def array(values) -> str:
    return "[" + ", ".join("NULL" if v is None else text(v) for v in values) + "]"


def station_at(key: str) -> str:
    return f"{array(fixed.STATIONS)}[CAST({key} % 13 AS INTEGER) + 1]"


def cents(key: str, modulus: int) -> str:
    return f"CAST(CAST({key} % {modulus} AS DECIMAL(6,0)) * 0.01 AS DECIMAL(6,5))"


def case(key: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN {text(k) if isinstance(k, str) else k} THEN {v}" for k, v in table.items())
    return f"CASE {key} {arms} ELSE {default} END"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def moment(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def half_up(top: str, bottom: str, digits: int = 2) -> str:
    """Quotient of whole numbers rounded half away from zero, by integer arithmetic."""
    scale = 10**digits
    return (
        f"(CASE WHEN ({bottom}) = 0 THEN NULL ELSE sign({top}) * "
        f"((2 * abs(CAST({top} AS HUGEINT)) * {scale} + ({bottom})) // (2 * CAST({bottom} AS HUGEINT))) / {scale}.0 END)"
    )


COLUMNS = [(s, f, f"{fixed.slug(s)}_{f}") for s in fixed.STATIONS for f in fixed.FLOWS]
WIDE = [c for _, _, c in COLUMNS] + ["total_entry", "total_exit"]
BAND_ORDER = {**{b: i + 1 for i, b in enumerate(fixed.BANDS)}, "Daily Total": 6}
HOUR = "CAST(substr(hour_period, 1, 2) AS INTEGER)"


def wide_sum(columns=WIDE) -> str:
    return ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in columns)


def split_columns(total: str, flow: str) -> list[str]:
    """Station shares of ``total`` by cumulative half-even rounding, last takes the rest."""
    cols = [f"{fixed.slug(s)}_{flow}" for s in fixed.STATIONS]
    whole = "(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + ")"

    def mark(n: int) -> str:
        if n == 0:
            return "0"
        run = " + ".join(f"coalesce({c}, 0)" for c in cols[:n])
        share = f"CAST(round_even({total} * CAST({run} AS DOUBLE) / {whole}, 0) AS BIGINT)"
        return f"(CASE WHEN {whole} > 0 THEN {share} ELSE 0 END)"

    out = [f"{mark(i + 1)} - {mark(i)} AS {c}" for i, c in enumerate(cols[:-1])]
    return [*out, f"{total} - {mark(len(cols) - 1)} AS {cols[-1]}"]


def hour_shares_values() -> str:
    rows = []
    for band, shares in fixed.HOUR_SHARES.items():
        run = fixed.dec("0")
        for hour, share in shares.items():
            through = fixed.dec("1") if hour == max(shares) else run + fixed.dec(share)
            rows.append(
                f"({text(band)}, '{hour:02d}:00', CAST('{run}' AS DECIMAL(16,15)), CAST('{through}' AS DECIMAL(16,15)))"
            )
            run = through
    return ", ".join(rows)


def hourly_id(date: str, label: str) -> str:
    return (
        f"CASE WHEN {label} IN ('Daily Total', 'DAILY_TOTAL') THEN 'YR' || strftime({date}, '%y-%m%d') || '-DT' "
        f"WHEN {label} IN ('Monthly Total', 'MONTHLY_TOTAL') THEN 'YR' || strftime({date}, '%y-%m') || '-MT' "
        f"WHEN {label} IN ('Peak Total', 'PEAK_TOTAL') THEN 'YR' || strftime({date}, '%y-%m') || '-PT' "
        f"ELSE 'YR' || strftime({date}, '%y-%m%d') || '-' || substr({label}, 1, 2) END"
    )


def band_case(label: str) -> str:
    table = {f"{h:02d}:00": text(b) for b, hs in fixed.HOUR_SHARES.items() for h in hs}
    table.update({v: text(k) for k, v in fixed.TOTAL_LABELS.items()})
    return case(label, table, label)


SPECIAL = (
    f"(year(date) = {HOURLY_SOURCE_YEAR} AND (month(date) = 6 OR (month(date) = 11 AND day(date) = 1)))"
)
RANGE = (
    "CASE WHEN regexp_matches(time_period, '^[0-2][0-9]:00$') THEN time_period || '-' || "
    "lpad(CAST((CAST(substr(time_period, 1, 2) AS INTEGER) + 1) % 24 AS VARCHAR), 2, '0') || ':00' "
    "ELSE " + case("time_period", {v: text(k) for k, v in fixed.TOTAL_LABELS.items()}, "time_period") + " END"
)


def grain_case(label: str) -> str:
    return (
        f"CASE WHEN {label} IN ('Daily Total', 'DAILY_TOTAL') THEN 'day' "
        f"WHEN {label} IN ('Monthly Total', 'MONTHLY_TOTAL') THEN 'month' "
        f"WHEN {label} IN ('Peak Total', 'PEAK_TOTAL') THEN 'peak' "
        f"WHEN regexp_matches({label}, '^\\d\\d:\\d\\d') THEN 'hour' ELSE 'band' END"
    )


ORDER_LEVEL = "substr(o_orderpriority, 1, 1)"
EVENT_NAMES = [
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
]
LOCAL = "INTERVAL 8 HOUR"  # the zone keeps one offset all years


def cfi_sum(prefix: str = "") -> str:
    w = fixed.CFI_WEIGHTS
    return (
        f"({w['weather']} * {prefix}weather_score + {w['academic']} * {prefix}academic_surge_score + "
        f"{w['civic']} * {prefix}civic_mandate_score + {w['operational']} * {prefix}operational_score)"
    )


def rush_case() -> str:
    arms = []
    for hours, direction, stations, factor in fixed.RUSH_FACTORS:
        flow = f" AND flow_type = '{direction}'" if direction else ""
        arms.append(f"WHEN {HOUR} IN {listing(hours)}{flow} AND station_name IN {listing(stations)} THEN {factor}")
    return "CASE " + " ".join(arms) + f" ELSE {fixed.RUSH_DEFAULT} END"


def modulation() -> str:
    months = {k: v for k, v in fixed.MONTH_FACTORS.items()}
    return (
        f"CAST(1.000 + {rush_case()} + {case('isodow(d)', fixed.WEEKDAY_FACTORS, '0.000')} + "
        f"{case('month(d)', months, '0.000')} + "
        f"CASE WHEN day(d) IN {listing(fixed.PAYDAYS)} THEN {fixed.PAYDAY_FACTOR} ELSE 0.000 END AS DECIMAL(5,3))"
    )


def shock(name: str, column: str) -> str:
    return f"CAST(1 + ({fixed.SHOCKS[name]}) * {column} AS DECIMAL(6,5))"


def level_case(volume: str) -> str:
    return (
        f"CASE WHEN {volume} >= critical_threshold THEN 'Critical' "
        f"WHEN {volume} >= warning_threshold THEN 'Warning' ELSE 'Normal' END"
    )


CIVIC_EVENT = """CASE WHEN category IN ('class_suspension', 'school_break') THEN
    CASE WHEN category = 'school_break' OR notice IS NULL OR CAST(notice AS DATE) < event_date
              OR hour(notice + INTERVAL 8 HOUR) < 8 THEN CAST(1 AS DECIMAL(6,5))
         WHEN h < hour(notice + INTERVAL 8 HOUR) THEN CAST(0 AS DECIMAL(6,5))
         WHEN h <= hour(notice + INTERVAL 8 HOUR) + 1 THEN CAST(-0.4444 AS DECIMAL(6,5))
         ELSE CAST(1 AS DECIMAL(6,5)) END
    ELSE CAST(0 AS DECIMAL(6,5)) END"""

NOTABLE = (
    "event_name IS NOT NULL AND event_name <> '' AND event_category NOT IN "
    + listing(fixed.NOTABLE_EXCLUDED_CATEGORIES)
    + "".join(f" AND event_name NOT ILIKE {text(p)}" for p in fixed.NOTABLE_EXCLUDED_WORDS)
)
SEASON = (
    f"trigger_category IN {listing(fixed.SEASON_TRIGGERS)} AND event_category IN {listing(fixed.SEASON_CATEGORIES)}"
    + "".join(f" AND event_name NOT ILIKE {text(p)}" for p in fixed.SUSPENSION_WORDS)
)

POST_START = "TIMESTAMP '2026-07-01 00:00:00'"


def rule_case(field: str, default: str) -> str:
    arms = []
    for rule in enrich.RULES:
        test = f"regexp_matches(post_text, {text(rule.pattern)})"
        if rule.unless:
            test += f" AND NOT regexp_matches(post_text, {text(rule.unless)})"
        value = getattr(rule, field)
        arms.append(f"WHEN {test} THEN {text(value) if isinstance(value, str) else str(value).lower()}")
    return "CASE " + " ".join(arms) + f" ELSE {default} END"


def date_part(*groups: int) -> str:
    return "coalesce(" + ", ".join(
        f"nullif(regexp_extract(post_text, {text(enrich.DATE_PATTERN)}, {g}), '')" for g in groups
    ) + ")"


def city_lists() -> str:
    arms = [
        f"CASE WHEN regexp_matches(post_text, {text(enrich._city_pattern(c, s))}) THEN {array(s)} ELSE [] END"
        for c, s in fixed.CITY_STATIONS.items()
    ]
    out = arms[0]
    for arm in arms[1:]:
        out = f"list_concat({out}, {arm})"
    return out


CAP_CODE = case(
    "upper(trim(station_name))",
    {k: text(v) for k, v in fixed.CAPACITY_CODES.items()},
    "'CAP-' || upper(substr(replace(station_name, ' ', ''), 1, 3))",
)

# name -> (other fragments it reads, SQL)
FRAGMENTS: dict[str, tuple[list[str], str]] = {}


def fragment(name: str, reads: list[str], sql: str) -> None:
    FRAGMENTS[name] = (reads, sql)


def with_fragments(reads: list[str], sql: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in FRAGMENTS[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in reads:
        visit(name)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({FRAGMENTS[n][1]})" for n in order) + "\n" + sql


fragment(
    "flow",
    [],
    f"""SELECT CAST(l_shipdate AS DATE) AS date,
      lpad(CAST(5 + (l_orderkey + l_linenumber) % 17 AS VARCHAR), 2, '0') || ':00' AS hour_period,
      {station_at('l_suppkey')} AS station_name,
      CASE WHEN l_linestatus = 'O' THEN 'entry' ELSE 'exit' END AS flow_type,
      CAST(sum(CAST(l_quantity AS BIGINT) * 10 * l_linenumber) AS BIGINT) AS volume
    FROM lineitem GROUP BY ALL""",
)
fragment(
    "hour_wide",
    ["flow"],
    "SELECT date, hour_period AS time_period, "
    + ", ".join(
        f"CAST(sum(volume) FILTER (WHERE station_name = {text(s)} AND flow_type = '{f}') AS BIGINT) AS {c}"
        for s, f, c in COLUMNS
    )
    + ", "
    + ", ".join(
        f"CAST(coalesce(sum(volume) FILTER (WHERE flow_type = '{f}'), 0) AS BIGINT) AS total_{f}" for f in fixed.FLOWS
    )
    + " FROM flow GROUP BY date, hour_period",
)
fragment(
    "hour_table",
    ["hour_wide"],
    f"""SELECT date, time_period, {', '.join(WIDE)} FROM hour_wide
    UNION ALL SELECT date, 'DAILY_TOTAL', {wide_sum()} FROM hour_wide GROUP BY date
    UNION ALL SELECT CAST(date_trunc('month', date) AS DATE), 'MONTHLY_TOTAL', {wide_sum()} FROM hour_wide
      WHERE year(date) = {HOURLY_SOURCE_YEAR} GROUP BY 1
    UNION ALL SELECT CAST(date_trunc('month', date) AS DATE), 'PEAK_TOTAL', {wide_sum()} FROM hour_wide
      WHERE year(date) = {HOURLY_SOURCE_YEAR} AND time_period IN ('07:00', '08:00', '17:00', '18:00') GROUP BY 1""",
)
fragment(
    "banded",
    ["hour_table"],
    f"""SELECT date, CASE WHEN {SPECIAL} THEN {RANGE} ELSE {band_case('time_period')} END AS band_label, {wide_sum()}
    FROM hour_table GROUP BY 1, 2""",
)
fragment(
    "bands",
    ["banded"],
    f"""SELECT 'YR' || CAST(year(date) AS VARCHAR) || '-' ||
      CASE WHEN n > 9999 THEN CAST(n AS VARCHAR) ELSE lpad(CAST(n AS VARCHAR), 4, '0') END AS id,
      date, band_label AS time_period, {grain_case('band_label')} AS grain, {', '.join(WIDE)}
    FROM (SELECT *, row_number() OVER (PARTITION BY year(date)
            ORDER BY date, {case('band_label', BAND_ORDER, '7')}, band_label) AS n FROM banded)""",
)
fragment(
    "hour_shares",
    [],
    f"SELECT * FROM (VALUES {hour_shares_values()}) AS v(band, hour_period, share_before, share_through)",
)
fragment(
    "band_hours",
    ["bands", "hour_shares"],
    "SELECT b.*, w.hour_period, "
    + ", ".join(
        f"coalesce(CAST(round(CAST(total_{f} AS DECIMAL(22,0)) * share_through, 0) AS BIGINT) - "
        f"CAST(round(CAST(total_{f} AS DECIMAL(22,0)) * share_before, 0) AS BIGINT), 0) AS hour_{f}"
        for f in fixed.FLOWS
    )
    + " FROM bands b JOIN hour_shares w ON b.time_period = w.band",
)
fragment(
    "expanded",
    ["band_hours"],
    f"""SELECT {hourly_id('date', 'hour_period')} AS id, date, hour_period AS time_period, 'hour' AS grain,
      {', '.join(split_columns('hour_entry', 'entry'))}, {', '.join(split_columns('hour_exit', 'exit'))},
      hour_entry AS total_entry, hour_exit AS total_exit FROM band_hours
    UNION ALL BY NAME
    SELECT {hourly_id('date', 'time_period')} AS id, date,
      CASE WHEN time_period LIKE '__:__-__:__' THEN substr(time_period, 1, 5)
           ELSE {case('time_period', {k: text(v) for k, v in fixed.TOTAL_LABELS.items()}, 'time_period')} END AS time_period,
      {grain_case('time_period')} AS grain, {', '.join(WIDE)}
    FROM bands WHERE time_period LIKE '__:__-__:__' OR time_period IN {listing(fixed.TOTAL_LABELS)}""",
)
fragment(
    "baselines",
    ["flow"],
    """SELECT station_name, isodow(date) AS day_of_week, hour_period, flow_type,
      CAST(round_even(quantile_cont(volume, 0.5), 0) AS INTEGER) AS median_volume,
      CAST(round_even(quantile_cont(volume, 0.8), 0) AS INTEGER) AS warning_threshold,
      CAST(round_even(quantile_cont(volume, 0.9), 0) AS INTEGER) AS critical_threshold
    FROM flow GROUP BY ALL""",
)
fragment(
    "calendar_events",
    [],
    f"""SELECT 'CAL-' || CAST(o_orderkey AS VARCHAR) AS id,
      CASE WHEN o_custkey % 51 = 0 THEN NULL WHEN o_custkey % 17 = 0 AND o_custkey % 2 = 0 THEN 'All'
           WHEN o_custkey % 17 = 0 THEN 'All Stations' ELSE {station_at('o_custkey')} END AS station,
      CAST(o_orderdate AS DATE) AS event_date, 'orders' AS source_table, CAST(o_orderkey AS VARCHAR) AS source_id,
      'Source ' || CAST(o_custkey % 5 AS VARCHAR) AS source_name,
      {array(EVENT_NAMES)}[CAST(o_orderkey % 13 AS INTEGER) + 1] AS event_name,
      CASE WHEN {ORDER_LEVEL} = '1' THEN 'class_suspension' WHEN {ORDER_LEVEL} = '2' THEN 'major_event'
           WHEN {ORDER_LEVEL} = '3' THEN 'holiday' WHEN {ORDER_LEVEL} = '4' AND o_custkey % 5 = 0 THEN 'school_break'
           WHEN {ORDER_LEVEL} = '4' THEN 'regular_class_day' ELSE 'incident' END AS event_category,
      CASE WHEN {ORDER_LEVEL} = '5' THEN 'operational' WHEN o_custkey % 7 = 0 THEN 'lgu' ELSE 'academic' END AS friction_domain,
      CASE WHEN {ORDER_LEVEL} = '1' AND o_custkey % 3 = 0 THEN 'Transport Strike'
           WHEN {ORDER_LEVEL} = '1' THEN 'Class Suspension' WHEN {ORDER_LEVEL} = '2' THEN 'Major Arena Event'
           WHEN {ORDER_LEVEL} = '3' THEN 'Holiday' WHEN {ORDER_LEVEL} = '4' AND o_custkey % 5 = 0 THEN 'School Break'
           WHEN {ORDER_LEVEL} = '4' THEN 'Regular Class Day' ELSE 'Degraded Headway' END AS trigger_category,
      {cents('o_orderkey', 101)} AS normalized_score,
      CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 48 - 24 AS INTEGER)) END AS announcement_time,
      CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR AS updated_at,
      'https://example.org/' || CAST(o_custkey % 97 AS VARCHAR) AS source_url,
      'Notice ' || CAST(o_orderkey % 1000 AS VARCHAR) AS description
    FROM orders""",
)
fragment(
    "weather",
    [],
    f"""SELECT CAST(o_orderdate AS DATE) AS weather_date,
      CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 - 8 AS INTEGER)) AS observed_at,
      {cents('(o_custkey % 11) * 10', 1000)} AS normalized_score FROM orders""",
)
fragment(
    "hourly_weather",
    ["weather"],
    f"""SELECT weather_date AS date, hour(observed_at + {LOCAL}) AS hour, max(normalized_score) AS weather_score
    FROM weather GROUP BY ALL""",
)
fragment("stations", [], f"SELECT unnest({array(fixed.STATIONS)}) AS station_name")
fragment(
    "event_hours",
    ["calendar_events", "stations"],
    f"""SELECT date, station_name, h AS hour,
      coalesce(max(CASE WHEN category = 'major_event' THEN normalized_score END), CAST(0 AS DECIMAL(6,5))) AS academic_surge_score,
      coalesce(max({CIVIC_EVENT}), CAST(0 AS DECIMAL(6,5))) AS civic_mandate_score,
      coalesce(max(CASE WHEN friction_domain = 'operational' THEN normalized_score END), CAST(0 AS DECIMAL(6,5))) AS operational_score
    FROM (SELECT d.event_date AS date, s.station_name, g.h, e.event_category AS category, e.friction_domain,
            e.normalized_score, e.announcement_time AS notice, e.event_date
          FROM (SELECT DISTINCT event_date FROM calendar_events) d
          CROSS JOIN stations s CROSS JOIN (SELECT unnest(range(24)) AS h) g
          LEFT JOIN calendar_events e ON e.event_date = d.event_date
            AND (e.station = s.station_name OR e.station IS NULL OR e.station IN ('All', 'All Stations')))
    GROUP BY ALL""",
)
fragment(
    "scored",
    ["flow", "hourly_weather", "event_hours"],
    f"""SELECT f.*, coalesce(w.weather_score, CAST(0 AS DECIMAL(6,5))) AS weather_score,
      coalesce(e.academic_surge_score, CAST(0 AS DECIMAL(6,5))) AS academic_surge_score,
      coalesce(e.civic_mandate_score, CAST(0 AS DECIMAL(6,5))) AS civic_mandate_score,
      coalesce(e.operational_score, CAST(0 AS DECIMAL(6,5))) AS operational_score
    FROM flow f
    LEFT JOIN hourly_weather w ON w.date = f.date AND w.hour = {HOUR.replace('hour_period', 'f.hour_period')}
    LEFT JOIN event_hours e ON e.date = f.date AND e.station_name = f.station_name
      AND e.hour = {HOUR.replace('hour_period', 'f.hour_period')}""",
)
fragment(
    "descriptive",
    ["scored", "baselines"],
    f"""SELECT s.date, s.hour_period AS time_period, s.station_name, s.flow_type, s.volume AS actual_volume,
      b.median_volume AS historical_median, b.warning_threshold, b.critical_threshold,
      weather_score, academic_surge_score, civic_mandate_score, operational_score,
      round({cfi_sum()}, 4) AS cfi, {level_case('s.volume')} AS congestion_level
    FROM scored s LEFT JOIN baselines b ON b.station_name = s.station_name AND b.day_of_week = isodow(s.date)
      AND b.hour_period = s.hour_period AND b.flow_type = s.flow_type""",
)
fragment(
    "model",
    ["flow"],
    """SELECT station_name, CAST(date + INTERVAL 7 DAY AS DATE) AS prediction_date, hour_period, flow_type,
      volume AS predicted FROM flow""",
)
fragment(
    "scope_events",
    ["calendar_events"],
    """SELECT event_date, CASE WHEN station IS NULL OR station = 'All Stations' THEN 'All' ELSE station END AS scope,
      coalesce(max(CASE WHEN event_category = 'major_event' THEN normalized_score END), CAST(0 AS DECIMAL(6,5))) AS academic,
      coalesce(max(CASE WHEN friction_domain = 'operational' THEN normalized_score END), CAST(0 AS DECIMAL(6,5))) AS operational,
      max(CASE WHEN event_category IN ('class_suspension', 'school_break', 'holiday') THEN CAST(1 AS DECIMAL(6,5))
          ELSE CAST(0 AS DECIMAL(6,5)) END) AS civic
    FROM calendar_events GROUP BY ALL""",
)
fragment("days", [], f"SELECT CAST(DATE '{TODAY}' + to_days(CAST(i AS INTEGER)) AS DATE) AS d FROM range(366) r(i)")


def metrics_sql(collapse: bool) -> str:
    if collapse:
        events = """SELECT event_date, station_name, max(academic) AS academic, max(operational) AS operational,
          max(civic) AS civic FROM scope_events JOIN stations ON scope = 'All' OR scope = station_name GROUP BY ALL"""
    else:
        events = "SELECT event_date, station_name, academic, operational, civic FROM scope_events JOIN stations ON scope = 'All' OR scope = station_name"
    zero = "CAST(0 AS DECIMAL(6,5))"
    return f"""SELECT d AS prediction_date, hour_period, station_name, flow_type, isodow(d) AS day_of_week,
      median_volume AS baseline_mean_forecast, weather_score, academic_surge_score, civic_mandate_score, operational_score,
      round({cfi_sum()}, 4) AS cfi, adjusted AS adjusted_forecast_volume, warning_threshold, critical_threshold,
      CASE WHEN {cfi_sum()} > {fixed.EMERGENCY_CFI} THEN 'Emergency' ELSE {level_case('adjusted')} END AS predicted_threat_level
    FROM (SELECT *, CAST(round(CAST(coalesce(predicted, median_volume) AS DECIMAL(9,0)) * {modulation()}
            * {shock('academic', 'academic_surge_score')} * {shock('civic', 'civic_mandate_score')}
            * {shock('weather', 'weather_score')} * {shock('operational', 'operational_score')}, 0) AS INTEGER) AS adjusted
      FROM (SELECT d, b.*, m.predicted, coalesce(w.weather_score, {zero}) AS weather_score,
          coalesce(e.academic, {zero}) AS academic_surge_score, coalesce(e.civic, {zero}) AS civic_mandate_score,
          coalesce(e.operational, {zero}) AS operational_score
        FROM days JOIN baselines b ON b.day_of_week = isodow(d)
        LEFT JOIN model m ON m.station_name = b.station_name AND m.prediction_date = d
          AND m.hour_period = b.hour_period AND m.flow_type = b.flow_type
        LEFT JOIN hourly_weather w ON w.date = d AND w.hour = {HOUR.replace('hour_period', 'b.hour_period')}
        LEFT JOIN ({events}) e ON e.event_date = d AND e.station_name = b.station_name))"""


_METRIC_READS = ["days", "baselines", "model", "hourly_weather", "scope_events", "stations"]
fragment("metrics", _METRIC_READS, metrics_sql(True))
fragment("metrics_fanout", _METRIC_READS, metrics_sql(False))


def surge(base: str, predicted: str) -> str:
    return half_up(f"(({predicted} - {base}) * 100)", base)


def horizon(keys: str, first: str, after: str, time: str, extra: str = "") -> str:
    return f"""SELECT station_name, flow_type, {extra}{time} AS time, CAST(baseline AS BIGINT) AS baseline,
      CAST(predicted AS BIGINT) AS predicted, CAST(predicted - baseline AS BIGINT) AS surge_volume,
      {surge('baseline', 'predicted')} AS surge_variance_percentage, CAST(max_cfi AS DOUBLE) AS max_cfi
    FROM (SELECT station_name, flow_type, {keys}, sum(baseline_mean_forecast) AS baseline,
        sum(adjusted_forecast_volume) AS predicted, max(cfi) AS max_cfi
      FROM metrics WHERE prediction_date >= {first} AND prediction_date < {after} GROUP BY ALL)"""


NOW = f"TIMESTAMP '{AS_OF}'"
STATUS_NOW = f"TIMESTAMP '{STATUS_AS_OF}'"
TODAY_SQL = f"DATE '{TODAY}'"
fragment(
    "next_day",
    ["metrics"],
    f"""SELECT station_name, flow_type, prediction_date AS date, hour_period AS time,
      baseline_mean_forecast AS baseline, adjusted_forecast_volume AS predicted,
      adjusted_forecast_volume - baseline_mean_forecast AS surge_volume,
      {surge('baseline_mean_forecast', 'adjusted_forecast_volume')} AS surge_variance_percentage,
      weather_score, academic_surge_score, civic_mandate_score, operational_score, cfi,
      warning_threshold, critical_threshold, predicted_threat_level
    FROM metrics WHERE prediction_date + to_hours({HOUR})
      BETWEEN {NOW} - INTERVAL 1 HOUR AND {NOW} + INTERVAL 24 HOUR""",
)
fragment(
    "capacities",
    [],
    "SELECT * FROM (VALUES "
    + ", ".join(f"({text(s)}, {n})" for s, n in fixed.PLATFORM_CAPACITY.items())
    + ") AS c(station_name, platform_capacity)",
)
fragment(
    "recommended",
    ["metrics", "capacities"],
    f"""SELECT prediction_date AS date, hour_period AS time, station_name, flow_type,
      baseline_mean_forecast AS predicted_volume, adjusted_forecast_volume AS adjusted_volume, platform_capacity,
      {half_up('adjusted_forecast_volume * 100', 'platform_capacity')} AS capacity_utilization,
      greatest(0, adjusted_forecast_volume - platform_capacity) AS passenger_surplus,
      predicted_threat_level AS forecasted_threat_level,
      CASE WHEN weather_score > 0 AND weather_score >= academic_surge_score AND weather_score >= civic_mandate_score THEN 'Weather'
           WHEN academic_surge_score > 0 AND academic_surge_score >= civic_mandate_score THEN 'Academic'
           WHEN civic_mandate_score > 0 THEN 'Civic' ELSE 'General' END AS primary_trigger_context,
      unnest(CASE predicted_threat_level
        WHEN 'Warning' THEN CASE WHEN adjusted_forecast_volume * 100 >= 80 * platform_capacity THEN ['APTA-02', 'APTA-05'] ELSE ['APTA-02'] END
        WHEN 'Critical' THEN CASE WHEN adjusted_forecast_volume * 100 >= 90 * platform_capacity THEN ['APTA-04', 'APTA-02'] ELSE ['APTA-04'] END
        WHEN 'Emergency' THEN ['APTA-01', 'APTA-04'] ELSE ['APTA-03'] END) AS decision_action
    FROM metrics JOIN capacities USING (station_name)""",
)


def padded(number: str, width: int) -> str:
    return f"CASE WHEN length(CAST({number} AS VARCHAR)) >= {width} THEN CAST({number} AS VARCHAR) ELSE lpad(CAST({number} AS VARCHAR), {width}, '0') END"


fragment(
    "protocol_source",
    [],
    """SELECT 'STD-' || CAST(p_partkey AS VARCHAR) AS apta_standard_code, p_name AS official_document_title,
      'Scope ' || p_brand AS scope_relevance_to_surge_management,
      '• ' || p_brand || ': ' || p_type || ' •  • ' || p_name || ' : size ' || CAST(p_size AS VARCHAR) ||
        CASE WHEN p_partkey % 3 = 0 THEN ' •' || p_name ELSE '' END AS tactics,
      'https://example.org/' || CAST(p_partkey AS VARCHAR) AS open_access_link_source,
      TIMESTAMP '2023-11-14 22:13:20' + to_seconds(p_partkey % 7) AS load_timestamp
    FROM part""",
)
fragment(
    "protocols",
    ["protocol_source"],
    f"""SELECT 'APTA-' || {padded('n', 2)} AS id, * EXCLUDE (n)
    FROM (SELECT *, row_number() OVER (ORDER BY load_timestamp, apta_standard_code) AS n FROM protocol_source)""",
)
fragment(
    "tactics",
    ["protocols"],
    f"""SELECT protocol_id || '-T' || {padded('pos', 2)} AS id, protocol_id,
      trim(split_part(tactic, ':', 1)) AS tactic_name, trim(split_part(tactic, ':', 2)) AS tactic_description
    FROM (SELECT id AS protocol_id, unnest(kept) AS tactic, unnest(range(1, len(kept) + 1)) AS pos
      FROM (SELECT id, list_filter(regexp_split_to_array(tactics, '•\\s*'), lambda t: trim(t) <> '') AS kept FROM protocols))""",
)
fragment(
    "allocate_hours",
    ["hour_wide"],
    f"""SELECT c.date, h.time_period, {', '.join(f'coalesce(h.{c}, 0) AS {c}' for c in WIDE)}
    FROM (SELECT date, (SELECT arg_min(b, abs(day(b) - day(date)))
            FROM (SELECT CAST(DATE '{BASE_YEAR}-01-01' + to_days(CAST(i AS INTEGER)) AS DATE) AS b FROM range(365) r(i))
            WHERE month(b) = month(date) AND isodow(b) = isodow(date)) AS base_date
          FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '{ALLOCATE_START}', TIMESTAMP '{ALLOCATE_END}', INTERVAL 1 DAY)) AS DATE) AS date)) c
    JOIN hour_wide h ON h.date = c.base_date""",
)
fragment(
    "targets",
    [],
    """SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(count(*) * 37 AS BIGINT) AS target
    FROM orders GROUP BY ALL""",
)


def allocated_mark(flow: str, frame: str) -> str:
    return (
        f"CASE WHEN sum(total_{flow}) OVER (PARTITION BY year(date), month(date)) > 0 THEN "
        f"CAST(round_even(coalesce(target, 0) * CAST(coalesce(sum(total_{flow}) OVER (PARTITION BY year(date), month(date) "
        f"ORDER BY date, time_period ROWS BETWEEN UNBOUNDED PRECEDING AND {frame}), 0) AS DOUBLE) / "
        f"sum(total_{flow}) OVER (PARTITION BY year(date), month(date)), 0) AS BIGINT) ELSE 0 END"
    )


fragment(
    "allocate_rows",
    ["allocate_hours", "targets"],
    f"""SELECT *, {allocated_mark('entry', 'CURRENT ROW')} - {allocated_mark('entry', '1 PRECEDING')} AS row_entry,
      {allocated_mark('exit', 'CURRENT ROW')} - {allocated_mark('exit', '1 PRECEDING')} AS row_exit
    FROM allocate_hours LEFT JOIN targets ON y = year(date) AND m = month(date)""",
)
fragment(
    "allocated_hours",
    ["allocate_rows"],
    f"""SELECT date, time_period, {', '.join(split_columns('row_entry', 'entry'))},
      {', '.join(split_columns('row_exit', 'exit'))}, row_entry AS total_entry, row_exit AS total_exit FROM allocate_rows""",
)
fragment(
    "allocated",
    ["allocated_hours"],
    f"""SELECT 'ST' || strftime(date, '%y-%m%d') || '-' || substr(time_period, 1, 2) AS id, date, time_period, {', '.join(WIDE)} FROM allocated_hours
    UNION ALL SELECT 'ST' || strftime(date, '%y-%m%d') || '-DT', date, 'DAILY_TOTAL', {wide_sum()} FROM allocated_hours GROUP BY date""",
)
fragment(
    "incidents",
    [],
    f"""SELECT CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%d') AS id,
      CASE WHEN user_id % 7 = 0 THEN 'Araneta Center Cubao' ELSE {station_at('user_id')} END AS station,
      CASE event_type WHEN 'error' THEN 'Other' WHEN 'click' THEN 'Sanitation' WHEN 'view' THEN 'Contraband'
        WHEN 'purchase' THEN 'Fare Collection' ELSE 'Facility Order' END AS incident_type,
      CASE WHEN event_id % 3 <> 0 THEN 'note ' || props END AS description,
      CASE WHEN value > 100 THEN 'Critical' ELSE 'Warning' END AS severity,
      CASE WHEN event_type = 'signup' THEN 'resolved' ELSE 'pending' END AS status, ts, event_id
    FROM events""",
)
fragment(
    "incident_calendar",
    ["incidents"],
    """SELECT 'INC-' || strftime(ts, '%m%d') || '-' || id AS id, station, CAST(ts AS DATE) AS event_date,
      'incidents' AS source_table, id AS source_id, 'Ground Control System' AS source_name,
      CASE WHEN incident_type = 'Other' AND coalesce(description, '') <> '' THEN 'Other: ' || description
           ELSE incident_type END || ' (' || severity || ')' AS event_name,
      'incident' AS event_category, 'operational' AS friction_domain,
      CASE severity WHEN 'Critical' THEN 'Code Red / Standstill' ELSE 'Degraded Headway' END AS trigger_category,
      CASE severity WHEN 'Critical' THEN 1.0 ELSE 0.5 END AS normalized_score, ts AS announcement_time
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS n FROM incidents)
    WHERE n = 1 AND status <> 'resolved'""",
)
fragment(
    "posts",
    [],
    f"""SELECT doc_id AS id, text || ' ' || {array(PHRASES)}[CAST(doc_id % {len(PHRASES)} AS INTEGER) + 1] AS post_text,
      {POST_START} + to_hours(CAST(doc_id AS INTEGER)) AS posted_at, source AS source_name,
      'https://example.org/' || CAST(doc_id AS VARCHAR) AS source_url, doc_id % 9 = 0 AS is_cancellation
    FROM documents""",
)
fragment(
    "classified",
    ["posts"],
    f"""SELECT *, {rule_case('category', "'unclassified'")} AS event_category,
      {rule_case('trigger', "'Unclassified'")} AS trigger_category, {rule_case('affects', 'false')} AS affects_ridership
    FROM posts""",
)
fragment(
    "dated",
    ["classified"],
    f"""SELECT *, coalesce(CAST(try_strptime(year_text || '-' || CAST(month_number AS VARCHAR) || '-' || day_text, '%Y-%m-%d') AS DATE),
        CASE WHEN regexp_matches(post_text, {text(enrich.TOMORROW_PATTERN)}) THEN CAST(post_day + INTERVAL 1 DAY AS DATE) ELSE post_day END) AS event_date
    FROM (SELECT *, coalesce(y, CAST(year(post_day) AS VARCHAR)) AS year_text,
        nullif(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower(substr(mon, 1, 3))), 0) AS month_number
      FROM (SELECT *, CAST(posted_at + {LOCAL} AS DATE) AS post_day, {date_part(1, 5)} AS mon,
          {date_part(2, 4)} AS day_text, {date_part(3, 6)} AS y FROM classified))""",
)
fragment(
    "spread",
    ["dated"],
    f"""SELECT * EXCLUDE (places), unnest(CASE WHEN len(places) > 0 THEN places ELSE ['All Stations'] END) AS station
    FROM (SELECT *, {city_lists()} AS places FROM dated)""",
)
fragment(
    "consolidated",
    ["spread"],
    f"""SELECT 'SCR-' || {case('event_category', {k: text(v) for k, v in enrich.CATEGORY_CODES.items()}, "'GN'")} || '-' ||
        strftime(event_date, '%m%d') || '-' || CAST(id AS VARCHAR) || '-' ||
        regexp_replace({CAP_CODE.replace('station_name', 'station')}, '^CAP-', '') AS id,
      station, event_date, CAST(id AS VARCHAR) AS source_id, source_name, trigger_category AS event_name, event_category,
      trigger_category,
      CASE WHEN event_category IN {listing(enrich.FULL_SCORE_CATEGORIES)} THEN 1.0 ELSE
        {case('trigger_category', {t: w for _, t, w in fixed.FRICTION_WEIGHTS}, '0.00')} END AS normalized_score,
      {case('trigger_category', {t: w for _, t, w in fixed.FRICTION_WEIGHTS}, '0.00')} AS friction_weight_ref,
      posted_at AS announcement_time, source_url, post_text AS description, is_cancellation
    FROM spread WHERE affects_ridership""",
)
fragment(
    "readings",
    [],
    f"""SELECT o_orderkey AS id, {station_at('o_custkey')} AS station,
      CAST(o_orderkey % 15 + 20 AS DECIMAL(5,1)) AS temperature, CAST(o_orderkey % 45 AS DECIMAL(5,1)) AS rainfall_mm,
      CASE WHEN o_orderkey % 10 <> 0 THEN ['None','Light','Heavy','Torrential'][CAST(o_custkey % 4 AS INTEGER) + 1] END AS computed_rainfall_level,
      ['None','Yellow','Orange','Red','None'][CAST(o_custkey % 5 AS INTEGER) + 1] AS advisory_level,
      CAST(o_custkey % 4 AS INTEGER) AS wind_signal,
      CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS observed_at
    FROM orders""",
)
fragment(
    "deployments",
    [],
    f"""SELECT event_id, {station_at('user_id')} AS station_name,
      'APTA-' || lpad(CAST(event_id % 8 AS VARCHAR), 2, '0') AS decision_action,
      CASE WHEN event_id % 6 = 0 THEN 'Lost' ELSE 'Active' END AS status, ts AS received,
      CASE WHEN event_id % 7 <> 0 THEN ts + to_milliseconds(event_id % 5000) END AS sent
    FROM events""",
)
fragment(
    "pairs",
    ["flow", "model"],
    """SELECT f.*, f.volume AS actual, m.predicted FROM model m JOIN flow f ON f.date = m.prediction_date
      AND f.hour_period = m.hour_period AND f.station_name = m.station_name AND f.flow_type = m.flow_type""",
)
fragment(
    "graded",
    ["pairs", "baselines"],
    """SELECT CASE WHEN actual >= critical_threshold THEN 2 WHEN actual >= warning_threshold THEN 1 ELSE 0 END AS a,
      CASE WHEN predicted >= critical_threshold THEN 2 WHEN predicted >= warning_threshold THEN 1 ELSE 0 END AS p
    FROM pairs JOIN baselines b ON b.station_name = pairs.station_name AND b.day_of_week = isodow(pairs.date)
      AND b.hour_period = pairs.hour_period AND b.flow_type = pairs.flow_type""",
)
fragment(
    "class_scores",
    ["graded"],
    """SELECT k AS class_id, CAST(count(*) FILTER (WHERE a = k AND p = k) AS BIGINT) AS tp,
      CAST(count(*) FILTER (WHERE a <> k AND p = k) AS BIGINT) AS fp,
      CAST(count(*) FILTER (WHERE a = k AND p <> k) AS BIGINT) AS fn,
      CAST(count(*) FILTER (WHERE a = k) AS BIGINT) AS support
    FROM graded CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) GROUP BY k""",
)
