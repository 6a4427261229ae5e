"""Scores, adjusted volume, threat and capacity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions.labels import hour_of, iso_weekday, lookup

SCORE = "decimal(6,5)"


def num(text: str) -> Column:
    """An exact decimal literal."""
    return F.lit(fixed.dec(text))


def half_even(value: Column) -> Column:
    """Nearest integer, ties to even, as binary floats are rounded."""
    return F.rint(value.cast("double")).cast("long")


def score(value: Column) -> Column:
    """Missing scores count as zero."""
    return F.coalesce(value.cast(SCORE), F.lit(0).cast(SCORE))


def raw_cfi(weather: Column, academic: Column, civic: Column, operational: Column, weights: dict | None = None) -> Column:
    w = weights or fixed.CFI_WEIGHTS
    return (
        num(w["weather"]) * weather
        + num(w["academic"]) * academic
        + num(w["civic"]) * civic
        + num(w["operational"]) * operational
    )


def cfi(weather: Column, academic: Column, civic: Column, operational: Column, weights: dict | None = None) -> Column:
    return F.round(raw_cfi(weather, academic, civic, operational, weights), 4)


def congestion(volume: Column, warning: Column, critical: Column) -> Column:
    return F.when(volume >= critical, "Critical").when(volume >= warning, "Warning").otherwise("Normal")


def congestion_class(volume: Column, warning: Column, critical: Column) -> Column:
    return F.when(volume >= critical, 2).when(volume >= warning, 1).otherwise(0)


def threat(raw_index: Column, volume: Column, warning: Column, critical: Column) -> Column:
    return F.when(raw_index > num(fixed.EMERGENCY_CFI), "Emergency").otherwise(congestion(volume, warning, critical))


def calendar_factor(day: Column, label: Column, station: Column, flow: Column) -> Column:
    """1 + rush hour + weekday + month + payday."""
    hour = hour_of(label)
    rush = None
    for hours, direction, stations, factor in fixed.RUSH_FACTORS:
        hit = hour.isin(hours) & station.isin(stations)
        if direction:
            hit = hit & (flow == direction)
        rush = F.when(hit, num(factor)) if rush is None else rush.when(hit, num(factor))
    rush = rush.otherwise(num(fixed.RUSH_DEFAULT))

    def pick(key: Column, table: dict) -> Column:
        return lookup(key, {k: fixed.dec(v) for k, v in table.items()}, num("0.000"))

    payday = F.when(F.dayofmonth(day).isin(fixed.PAYDAYS), num(fixed.PAYDAY_FACTOR)).otherwise(num("0.000"))
    total = (
        num("1.000")
        + rush
        + pick(iso_weekday(day), fixed.WEEKDAY_FACTORS)
        + pick(F.month(day), fixed.MONTH_FACTORS)
        + payday
    )
    return total.cast("decimal(5,3)")


def adjusted_volume(
    base: Column, calendar: Column, weather: Column, academic: Column, civic: Column, operational: Column
) -> Column:
    """Base volume under calendar and shocks, rounded half away from zero."""
    scores = {"academic": academic, "civic": civic, "weather": weather, "operational": operational}
    # eight fraction digits hold coefficient x score exactly; the product keeps >= 14
    out = base.cast("decimal(12,3)") * calendar
    for name, coefficient in fixed.SHOCKS.items():
        out = out * (F.lit(1) + num(coefficient) * scores[name]).cast("decimal(10,8)")
    return F.round(out, 0).cast("int")


def ratio(top: Column, bottom: Column) -> Column:
    """Exact-enough decimal quotient of two integers, null on a zero divisor."""
    return top.cast("decimal(20,0)") / F.nullif(bottom.cast("decimal(12,0)"), F.lit(0).cast("decimal(12,0)"))


def percent(top: Column, bottom: Column, digits: int = 2) -> Column:
    return F.round(ratio(top, bottom) * 100, digits)


def surge_percent(adjusted: Column, base: Column) -> Column:
    return percent(adjusted - base, base)


def gates_closed(hour: Column) -> Column:
    return (hour < 5) | (hour >= 23)


def capacity_percent(
    hour: Column, predicted: Column, current: Column, median: Column, warning: Column, critical: Column
) -> Column:
    """Piecewise load: 0-80 up to warning, 80-90 up to critical, then open-ended."""
    load = F.coalesce(predicted, median)
    seen = F.coalesce(predicted, current, median, F.lit(0))
    warn = F.coalesce(warning, F.lit(0))
    return (
        F.when(gates_closed(hour), num("0.00"))
        .when((warn < 50) & (seen < 50), F.round(ratio(seen, F.lit(500)) * 100, 2))
        .when((warn == 0) | (F.coalesce(load, F.lit(0)) == 0), num("0.00"))
        .when(load < warning, F.round(ratio(load, warning) * 80, 2))
        .when(load < critical, F.round(80 + ratio(load - warning, critical - warning) * 10, 2))
        .otherwise(F.round(90 + ratio(load - critical, F.greatest(critical, F.lit(100))) * 10, 2))
    )


def capacity_status(
    hour: Column, predicted: Column, current: Column, median: Column, warning: Column, critical: Column
) -> Column:
    load = F.coalesce(predicted, median)
    seen = F.coalesce(predicted, current, median, F.lit(0))
    warn = F.coalesce(warning, F.lit(0))
    return (
        F.when(gates_closed(hour), "Normal")
        .when((warn < 50) & (seen < 50), "Normal")
        .when((warn == 0) | (F.coalesce(load, F.lit(0)) == 0), "Normal")
        .when(load >= F.greatest(critical, F.lit(50)), "Critical")
        .when(load >= F.greatest(warning, F.lit(40)), "Warning")
        .otherwise("Normal")
    )


def trigger_context(weather: Column, academic: Column, civic: Column) -> Column:
    """Strongest positive trigger; ties go weather, academic, civic."""
    top = F.greatest(weather, academic, civic)
    return (
        F.when(top <= 0, "General")
        .when(weather == top, "Weather")
        .when(academic == top, "Academic")
        .otherwise("Civic")
    )


def protocol_list(level: Column, utilisation: Column) -> Column:
    def ids(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    return (
        F.when((level == "Warning") & (utilisation >= num(fixed.WARNING_FULL_AT)), ids(fixed.PROTOCOL_WARNING_FULL))
        .when(level == "Warning", ids(fixed.PROTOCOL_WARNING))
        .when((level == "Critical") & (utilisation >= num(fixed.CRITICAL_FULL_AT)), ids(fixed.PROTOCOL_CRITICAL_FULL))
        .when(level == "Critical", ids(fixed.PROTOCOL_CRITICAL))
        .when(level == "Emergency", ids(fixed.PROTOCOL_EMERGENCY))
        .otherwise(ids(fixed.PROTOCOL_NORMAL))
    )


def task_order(tactic_id: Column) -> Column:
    """1, 2 or 3 from the tactic's own number; every later tactic is 4."""
    step = F.regexp_extract(tactic_id, r"-T0([123])$", 1)
    return F.when(step == "", 4).otherwise(step.try_cast("int"))


def task_role(tactic_id: Column) -> Column:
    return F.when(tactic_id.isin(fixed.COMMAND_TACTICS), "Command Center Officer").otherwise("Ground Control Staff")


def task_priority(tactic_id: Column) -> Column:
    return (
        F.when(tactic_id.isin(fixed.CRITICAL_TACTICS), "Critical")
        .when(tactic_id.isin(fixed.HIGH_TACTICS), "High")
        .otherwise("Medium")
    )


def weather_urgency(rain_mm: Column, level: Column) -> Column:
    return (
        F.when((rain_mm >= 30) | level.isin("Torrential", "Monsoon"), "critical")
        .when((rain_mm >= 15) | (level == "Heavy"), "warning")
        .otherwise("low")
    )


def event_urgency(name: Column, top_score: Column) -> Column:
    text = F.coalesce(name, F.lit(""))
    return (
        F.when(text.rlike(fixed.FEED_CRITICAL_WORDS) | (top_score >= num("0.80")), "critical")
        .when((top_score >= num("0.45")) | text.rlike(fixed.FEED_WARNING_WORDS), "warning")
        .otherwise("low")
    )


def weather_friction(signal: Column, rain_mm: Column, level: Column) -> Column:
    """0 / .4 / .8 / 1.0 from wind signal, rain and advisory colour."""
    wind = F.coalesce(signal, F.lit(0))
    rain = F.coalesce(rain_mm, F.lit(0))
    return (
        F.when((wind >= 2) & (rain > 40), num("1.0"))
        .when((wind >= 2) | (rain > 40) | level.isin("Orange", "Red"), num("0.8"))
        .when((wind == 1) | (rain >= 5) | (level == "Yellow"), num("0.4"))
        .otherwise(num("0.0"))
        .cast(SCORE)
    )


def surge_density(events: Column) -> Column:
    return F.when(events >= 3, num("1.0")).when(events >= 1, num("0.5")).otherwise(num("0.0")).cast(SCORE)


def severity_trigger(severity: Column) -> Column:
    return lookup(severity, fixed.SEVERITY_TRIGGERS, F.lit(fixed.SEVERITY_DEFAULT))


def ledger_score(level: Column) -> Column:
    table = {k: fixed.dec(v) for k, v in fixed.LEDGER_SCORES.items()}
    return lookup(level, table, num(fixed.LEDGER_SCORE_DEFAULT))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)
