"""Sum-preserving splits by cumulative rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices, labels
from flowgauge.operators.calendar import nearest_days
from flowgauge.operators.reshape import station_columns, total_rows

_ROW_COLUMNS = ("id", "date", "time_period", "grain", "load_timestamp")


def hour_shares(spark) -> DataFrame:
    """17 rows: band, hour label, cumulative share before and through the hour."""
    rows = []
    for band, shares in fixed.HOUR_SHARES.items():
        so_far = fixed.dec("0.000000000000000")
        last = max(shares)
        for hour, share in shares.items():
            through = fixed.dec("1.000000000000000") if hour == last else so_far + fixed.dec(share)
            rows.append((band, f"{hour:02d}:00", so_far, through))
            so_far = through
    return spark.createDataFrame(
        rows, "band string, hour_period string, share_before decimal(16,15), share_through decimal(16,15)"
    )


def steps_of(total: str, columns: list[str]) -> dict[str, str]:
    """Integers that add up to ``total``: steps between marks, the last takes the rest."""
    marked = [f"_mark_{total}_{c}" for c in columns[:-1]]
    steps = {columns[0]: f"{marked[0]} AS {columns[0]}"}
    for before, through, c in zip(marked, marked[1:], columns[1:]):
        steps[c] = f"{through} - {before} AS {c}"
    steps[columns[-1]] = f"{total} - {marked[-1]} AS {columns[-1]}"
    return steps


def running_parts(flow: str, columns: list[str]) -> list[str]:
    """Prefix sums of ``columns`` and their whole (null when not positive), as doubles."""
    parts = [f"coalesce({c}, 0)" for c in columns]
    runs = [f"CAST({' + '.join(parts[: i + 1])} AS DOUBLE) AS _run_{c}" for i, c in enumerate(columns[:-1])]
    whole = " + ".join(parts)
    return [*runs, f"CAST(CASE WHEN {whole} > 0 THEN {whole} END AS DOUBLE) AS _whole_{flow}"]


def marks(total: str, flow: str, columns: list[str]) -> list[str]:
    """Rounded running shares of ``total``; all zero when the columns sum to zero."""
    return [
        f"coalesce(CAST(rint(CAST({total} AS DOUBLE) * _run_{c} / _whole_{flow}) AS BIGINT), 0) AS _mark_{total}_{c}"
        for c in columns[:-1]
    ]


def spread_out(df: DataFrame, keep: list[str], totals: dict[str, str], columns: dict[str, list[str]]) -> DataFrame:
    """Both flows' totals split over their stations, entry and exit columns interleaved."""
    marked = df.selectExpr(
        *keep, *totals.values(), *[m for f, total in totals.items() for m in marks(total, f, columns[f])]
    )
    steps = {f: steps_of(total, columns[f]) for f, total in totals.items()}
    pairs = zip(columns["entry"], columns["exit"])
    return marked.selectExpr(
        *keep,
        *[x for a, b in pairs for x in (steps["entry"][a], steps["exit"][b])],
        *[f"{total} AS total_{f}" for f, total in totals.items()],
    )


def expand_bands(bands: DataFrame) -> DataFrame:
    """Banded wide rows to hourly wide rows; row totals and their sums are kept.

    Bands are split over their hours, then each hour's total over the stations in the
    band row's proportions. Rows that were hourly already and total rows pass through.
    The 17-row share table is the only join side, so no row is shuffled.
    """
    columns = {flow: station_columns(bands, flow) for flow in fixed.FLOWS}
    label = F.col("time_period")
    shares = hour_shares(bands.sparkSession)

    def hour_total(col: str) -> Column:
        value = F.col(col).cast("decimal(18,0)")
        through = F.round(value * F.col("share_through"), 0)
        before = F.round(value * F.col("share_before"), 0)
        return F.coalesce((through - before).cast("long"), F.lit(0))

    # shares of a row are the same in all its hours, so they are summed before the join
    shaped = bands.filter(label.isin(fixed.BANDS)).selectExpr(
        "date",
        "time_period AS band",
        "total_entry",
        "total_exit",
        *running_parts("entry", columns["entry"]),
        *running_parts("exit", columns["exit"]),
    )
    split = (
        shaped.join(F.broadcast(shares), "band")
        .withColumns({"hour_entry": hour_total("total_entry"), "hour_exit": hour_total("total_exit")})
        .withColumnRenamed("hour_period", "time_period")
    )
    hourly = spread_out(split, ["date", "time_period"], {"entry": "hour_entry", "exit": "hour_exit"}, columns)
    hourly = hourly.select(
        labels.hour_id(F.col("date"), F.col("time_period")).alias("id"),
        "date",
        "time_period",
        F.lit("hour").alias("grain"),
        *hourly.columns[2:],
    )
    kept_label = F.when(label.like(labels.RANGE_LABEL), F.substring(label, 1, 5)).otherwise(labels.stored_total(label))
    passed = bands.filter(label.like(labels.RANGE_LABEL) | labels.is_total(label)).select(
        labels.hourly_id(F.col("date"), label).alias("id"),
        "date",
        kept_label.alias("time_period"),
        labels.grain_of(label).alias("grain"),
        *hourly.columns[4:],
    )
    return hourly.unionByName(passed)


def restore_bands(hourly: DataFrame, hourly_source_year: int | None = 2023) -> DataFrame:
    """Hourly wide rows summed back into bands, numbered within each year.

    In ``hourly_source_year`` the days that were counted hourly keep one row per hour
    under a range label. Grouping leaves at most 32 labels a day, so the yearly
    numbering window holds a bounded number of rows.
    """
    day, label = F.col("date"), F.col("time_period")
    measures = [c for c in hourly.columns if c not in _ROW_COLUMNS]
    special = (F.year(day) == F.lit(hourly_source_year)) & labels.counted_hourly(day)
    shown = F.when(special, labels.range_label(label)).otherwise(labels.band_of(label))
    banded = hourly.groupBy("date", shown.alias("band_label")).agg(*[F.sum(c).alias(c) for c in measures])
    year = Window.partitionBy(F.year("date")).orderBy("date", labels.band_rank(F.col("band_label")), "band_label")
    return banded.select(
        F.concat(
            F.lit("YR"), F.year("date").cast("string"), F.lit("-"), labels.padded(F.row_number().over(year), 4)
        ).alias("id"),
        "date",
        F.col("band_label").alias("time_period"),
        labels.grain_of(F.col("band_label")).alias("grain"),
        *measures,
    )


def allocate_monthly(targets: DataFrame, template: DataFrame, start: str, end: str, base_year: int) -> DataFrame:
    """Spread monthly targets over hours and stations in the template's proportions.

    ``targets``: year, month_number, student_transactions, is_total. ``template``:
    hourly wide rows holding the base year. Each day takes the hours of the nearest
    same-month, same-weekday day of the base year.

    The running sum of a month is built from day totals (at most 31 per month) plus
    the running sum inside a day (at most 24 hours), so no task holds a month.
    """
    spark = template.sparkSession
    columns = {flow: station_columns(template, flow) for flow in fixed.FLOWS}
    days = spark.range(1).select(F.explode(labels.range_step(start, end)).alias("date"))
    matched = nearest_days(days, base_year)
    hours = template.filter(
        ~labels.is_total(F.col("time_period")) & (F.year("date") == base_year)
    ).selectExpr(
        "date AS baseline_date",
        "time_period",
        *running_parts("entry", columns["entry"]),
        *running_parts("exit", columns["exit"]),
        "coalesce(total_entry, 0) AS seen_entry",
        "coalesce(total_exit, 0) AS seen_exit",
    )
    # the calendar has one row per requested day
    rows = hours.join(F.broadcast(matched), "baseline_date").withColumn("_year", F.year("date")).withColumn(
        "_month", F.month("date")
    )
    per_day = rows.groupBy("_year", "_month", "date").agg(
        F.sum("seen_entry").alias("_day_entry"), F.sum("seen_exit").alias("_day_exit")
    )
    month = Window.partitionBy("_year", "_month")
    earlier = month.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    day_offsets = per_day.select(
        "date",
        F.coalesce(F.sum("_day_entry").over(earlier), F.lit(0)).alias("_before_entry"),
        F.coalesce(F.sum("_day_exit").over(earlier), F.lit(0)).alias("_before_exit"),
        F.sum("_day_entry").over(month).alias("_month_entry"),
        F.sum("_day_exit").over(month).alias("_month_exit"),
    )
    monthly = targets.filter(~F.col("is_total")).select(
        F.col("year").alias("_year"), F.col("month_number").alias("_month"), F.col("student_transactions").alias("_target")
    )
    in_day = Window.partitionBy("date").orderBy("time_period").rowsBetween(Window.unboundedPreceding, 0)
    target = F.coalesce(F.col("_target"), F.lit(0))
    located = rows.join(day_offsets, "date").join(monthly, ["_year", "_month"], "left")

    def row_total(flow: str) -> Column:
        through = F.col(f"_before_{flow}") + F.sum(f"seen_{flow}").over(in_day)
        before = through - F.col(f"seen_{flow}")
        whole = F.col(f"_month_{flow}")

        def mark(run: Column) -> Column:
            return indices.half_even(target * run.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)))

        return F.coalesce(mark(through) - mark(before), F.lit(0))

    placed = located.withColumns({"row_entry": row_total("entry"), "row_exit": row_total("exit")})
    hourly = spread_out(placed, ["date", "time_period"], {"entry": "row_entry", "exit": "row_exit"}, columns)
    both = hourly.unionByName(total_rows(hourly, "DAILY_TOTAL"))
    return both.select(labels.allocated_id(F.col("date"), F.col("time_period")).alias("id"), *hourly.columns)
