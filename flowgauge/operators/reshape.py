"""Between the wide table (one column per station and flow) and long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import labels


def station_columns(df: DataFrame, flow: str) -> list[str]:
    """Station columns of one flow, found by suffix in table order, junk left out."""
    junk = fixed.JUNK_COLUMNS[flow]
    return [c for c in df.columns if c.endswith(f"_{flow}") and c not in junk]


def hourly_actuals(wide: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Long form ``date, hour_period, station_name, flow_type, volume`` without totals.

    ``names`` maps a column stem to the station's name; unknown stems stay as they are.
    A narrow operation: no shuffle, and the total-row filter reaches the scan.
    """
    names = names or {fixed.slug(s): s for s in fixed.STATIONS}
    cells = []
    for flow in fixed.FLOWS:
        for col in station_columns(wide, flow):
            stem = col[: -len(flow) - 1]
            name = names.get(stem, stem).replace("'", "\\'")
            cells.append(f"'{name}', '{flow}', CAST({col} AS BIGINT)")
    kept = wide.filter(~labels.is_total(F.col("time_period")))
    stacked = f"stack({len(cells)}, {', '.join(cells)}) AS (station_name, flow_type, volume)"
    return kept.selectExpr("date", "time_period AS hour_period", stacked)


def widen(actuals: DataFrame, stations: list[str] | None = None) -> DataFrame:
    """Long form back to one row per date and hour, with both totals."""
    stations = stations or fixed.STATIONS
    cells = [
        F.expr(f"sum(CASE WHEN station_name = '{station}' AND flow_type = '{flow}' THEN volume END) AS {fixed.slug(station)}_{flow}")
        for station in stations
        for flow in fixed.FLOWS
    ]
    totals = [
        F.expr(f"coalesce(sum(CASE WHEN flow_type = '{flow}' THEN volume END), 0) AS total_{flow}") for flow in fixed.FLOWS
    ]
    return actuals.groupBy("date", F.col("hour_period").alias("time_period")).agg(*cells, *totals)


def total_rows(wide: DataFrame, label: str) -> DataFrame:
    """Daily, monthly or peak-hour total rows of an hourly wide table."""
    measures = [c for c in wide.columns if c not in ("id", "date", "time_period", "grain", "load_timestamp")]
    rows = wide.filter(~labels.is_total(F.col("time_period")))
    day = F.col("date")
    if label == "MONTHLY_TOTAL":
        day = F.trunc("date", "month")
    elif label == "PEAK_TOTAL":
        rows = rows.filter(labels.hour_of(F.col("time_period")).isin(7, 8, 17, 18))
        day = F.trunc("date", "month")
    return (
        rows.groupBy(day.alias("date"))
        .agg(*[F.sum(c).alias(c) for c in measures])
        .select("date", F.lit(label).alias("time_period"), *measures)
    )
