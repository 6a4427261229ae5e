"""Sum-preserving splits: hand rows, properties and round trips."""

from __future__ import annotations

import datetime as dt

import numpy as np
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.operators import allocate, calendar, quality, reshape
from flowgauge.sources import adapters

COLUMNS = [f"{fixed.slug(s)}_{f}" for s in fixed.STATIONS for f in fixed.FLOWS]
SCHEMA = "date date, time_period string, " + ", ".join(f"{c} long" for c in [*COLUMNS, "total_entry", "total_exit"])


def wide(spark, cells):
    """cells: (date, label, entry list or None items, exit list)"""
    out = []
    for day, label, entry, exits in cells:
        pairs = [v for e, x in zip(entry, exits) for v in (e, x)]
        out.append((day, label, *pairs, sum(e or 0 for e in entry), sum(x or 0 for x in exits)))
    return spark.createDataFrame(out, SCHEMA)


def by_hand(total, parts):
    whole, run, last, out = sum(p or 0 for p in parts), 0, 0, []
    for p in parts[:-1]:
        run += p or 0
        mark = int(np.rint(total * float(run) / whole)) if whole > 0 else 0
        out.append(mark - last)
        last = mark
    return [*out, total - last]


DAY = dt.date(2024, 3, 5)


def test_expand_keeps_band_totals(spark):
    bands = wide(spark, [(DAY, b, [i * 7 + 1] * 13, [None, *range(12)]) for i, b in enumerate(fixed.BANDS)])
    out = allocate.expand_bands(bands)
    assert out.count() == 17
    total = out.agg(F.sum("total_entry").alias("e"), F.sum("total_exit").alias("x")).first()
    assert (total.e, total.x) == (sum(13 * (i * 7 + 1) for i in range(5)), 5 * 66)
    assert rows(quality.wide_checks(out, None).filter("not passed")) == []
    hour = out.filter("time_period = '05:00'").first()
    assert hour.id == "YR24-0305-05"
    assert hour.total_entry == 4  # round(13 x 0.29497...)
    assert [hour[c] for c in COLUMNS[::2]] == by_hand(4, [1] * 13)


def test_all_stations_zero_gives_everything_to_the_last(spark):
    row = wide(spark, [(DAY, "7-9am (AM PEAK)", [0] * 13, [0] * 13)]).withColumn("total_entry", F.lit(10).cast("long"))
    out = rows(allocate.expand_bands(row), "time_period")
    assert [r["v_mapa_entry"] for r in out] == [5, 5]
    assert all(r[c] == 0 for r in out for c in COLUMNS[:-2])


def test_totals_and_hourly_rows_pass_through(spark):
    cells = [
        (DAY, "Daily Total", [1] * 13, [2] * 13),
        (DAY, "Monthly Total", [1] * 13, [2] * 13),
        (DAY, "Peak Total", [1] * 13, [2] * 13),
        (DAY, "23:00-00:00", [1] * 13, [2] * 13),
        (DAY, "unknown band", [1] * 13, [2] * 13),
    ]
    out = {r["time_period"]: r for r in rows(allocate.expand_bands(wide(spark, cells)))}
    assert {k: v["id"] for k, v in out.items()} == {
        "DAILY_TOTAL": "YR24-0305-DT",
        "MONTHLY_TOTAL": "YR24-03-MT",
        "PEAK_TOTAL": "YR24-03-PT",
        "23:00": "YR24-0305-23",
    }
    assert out["23:00"]["grain"] == "hour" and out["MONTHLY_TOTAL"]["grain"] == "month"


def test_restore_keeps_counted_hours_of_the_special_year(spark):
    cells = [
        (dt.date(2023, 6, 2), "23:00", [1] * 13, [1] * 13),
        (dt.date(2023, 11, 1), "05:00", [1] * 13, [1] * 13),
        (dt.date(2023, 11, 2), "05:00", [1] * 13, [1] * 13),
        (dt.date(2023, 11, 2), "06:00", [1] * 13, [1] * 13),
        (dt.date(2023, 11, 2), "DAILY_TOTAL", [2] * 13, [2] * 13),
        (dt.date(2024, 6, 2), "05:00", [1] * 13, [1] * 13),
    ]
    out = rows(allocate.restore_bands(wide(spark, cells)), "id")
    assert [(r["id"], r["time_period"], r["total_entry"]) for r in out] == [
        ("YR2023-0001", "23:00-00:00", 13),
        ("YR2023-0002", "05:00-06:00", 13),
        ("YR2023-0003", "5-7am (OFF PEAK)", 26),
        ("YR2023-0004", "Daily Total", 26),
        ("YR2024-0001", "5-7am (OFF PEAK)", 13),
    ]


counts = st.lists(st.one_of(st.none(), st.integers(0, 5000)), min_size=13, max_size=13)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(counts, counts), min_size=20, max_size=40))
def test_expand_properties(spark, cells):
    days = [DAY + dt.timedelta(days=i) for i in range(len(cells))]
    table = wide(spark, [(d, fixed.BANDS[i % 5], e, x) for i, (d, (e, x)) in enumerate(zip(days, cells))])
    hours = allocate.expand_bands(table)
    report = {r["check_name"]: r["violations"] for r in rows(quality.wide_checks(hours, None))}
    assert report == {"row_sums": 0, "negative_counts": 0, "unique_ids": 0}
    back = allocate.restore_bands(hours.drop("id", "grain"), None).select("date", "time_period", "total_entry", "total_exit")
    want = table.select("date", "time_period", "total_entry", "total_exit")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    sample = rows(hours, "date", "time_period")[0]
    entry = cells[0][0]
    assert [sample[c] for c in COLUMNS[::2]] == by_hand(sample["total_entry"], entry)


def test_allocation_conserves_and_follows_running_marks(spark):
    rng = np.random.default_rng(5)
    cells = []
    for i in range(365):
        for hour in (5, 8, 17):
            day = dt.date(2025, 1, 1) + dt.timedelta(days=i)
            if day.month == 9:
                continue  # a month without template: its target is lost
            cells.append((day, f"{hour:02d}:00", rng.integers(0, 50, 13).tolist(), rng.integers(0, 50, 13).tolist()))
    template = wide(spark, cells).unionByName(wide(spark, [(dt.date(2025, 7, 1), "DAILY_TOTAL", [9] * 13, [9] * 13)]))
    targets = spark.createDataFrame(
        [(2025, 7, 1001, False), (2025, 8, 77, False), (2025, 9, 50, False), (2026, 1, 12345, False), (2025, 7, 5, True)],
        "year int, month_number int, student_transactions long, is_total boolean",
    )
    out = allocate.allocate_monthly(targets, template, "2025-07-01", "2026-01-31", 2025)
    kept = {(r["year"], r["month_number"]): r for r in rows(quality.conservation(targets, out))}
    assert kept[2025, 7]["conserved"] and kept[2025, 8]["conserved"] and kept[2026, 1]["conserved"]
    assert not kept[2025, 9]["conserved"]
    assert rows(quality.wide_checks(out, None).filter("not passed")) == []
    # October has no target: all zero, none lost
    assert out.filter("month(date) = 10").agg(F.sum("total_entry")).first()[0] == 0
    july = [c for c in cells if c[0].month == 7]
    run, whole, last, want = 0, sum(sum(c[2]) for c in july), 0, []
    for c in july:
        run += sum(c[2])
        mark = int(np.rint(1001 * float(run) / whole))
        want.append(mark - last)
        last = mark
    got = rows(out.filter("month(date) = 7 and time_period <> 'DAILY_TOTAL'"), "date", "time_period")
    assert [r["total_entry"] for r in got] == want
    assert got[0]["id"] == "ST25-0701-05"
    daily = out.filter("date = '2025-07-01' and time_period = 'DAILY_TOTAL'").first()
    assert daily.id == "ST25-0701-DT" and daily.total_entry == sum(r["total_entry"] for r in got[:3])


def test_nearest_day(spark):
    days = spark.createDataFrame([(dt.date(2026, 1, 2),), (dt.date(2024, 2, 29),), (dt.date(2025, 5, 5),)], "date date")
    out = {r["date"]: r["baseline_date"] for r in rows(calendar.nearest_days(days, 2025))}
    assert out == {
        dt.date(2026, 1, 2): dt.date(2025, 1, 3),
        dt.date(2024, 2, 29): dt.date(2025, 2, 27),
        dt.date(2025, 5, 5): dt.date(2025, 5, 5),
    }


def test_junk_columns_are_left_out(spark):
    df = spark.createDataFrame([(1, 1, 1, 1, 1)], "a_entry int, entry_entry int, exit_entry int, total_entry int, b_entry int")
    assert reshape.station_columns(df, "entry") == ["a_entry", "b_entry"]


def test_unpivot_is_the_inverse_of_widen(spark, small):
    flow = adapters.flow(spark, small)
    back = reshape.hourly_actuals(reshape.widen(flow)).filter("volume is not null")
    columns = ["date", "hour_period", "station_name", "flow_type", "volume"]
    assert back.select(columns).exceptAll(flow.select(columns)).count() == 0
    assert back.count() == flow.count()
