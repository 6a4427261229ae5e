from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices
from flowgauge.operators import triggers

DAY = dt.date(2026, 7, 2)
SCHEMA = (
    "event_date date, station string, event_category string, friction_domain string, "
    "normalized_score decimal(6,5), announcement_time timestamp"
)


def events(spark, cells):
    full = [(d, s, c, dom, None if v is None else Decimal(str(v)), a) for d, s, c, dom, v, a in cells]
    return spark.createDataFrame(full, SCHEMA)


def notice(hour, day=DAY, minute=0):
    """Announced at local ``hour`` of ``day``."""
    return dt.datetime(day.year, day.month, day.day, hour, minute) - dt.timedelta(hours=8)


def civic(spark, cells, station="Recto"):
    grid = triggers.event_hour_scores(events(spark, cells))
    return {r["hour"]: float(r["civic_mandate_score"]) for r in rows(grid.filter(F.col("station_name") == station))}


def test_midday_suspension_alone(spark):
    got = civic(spark, [(DAY, "Recto", "class_suspension", "academic", 1, notice(13))])
    assert [got[h] for h in (5, 12, 13, 14, 15, 23)] == [0, 0, -0.4444, -0.4444, 1, 1]


def test_other_event_in_the_group_hides_the_exodus(spark):
    cells = [
        (DAY, "Recto", "class_suspension", "academic", 1, notice(13)),
        (DAY, None, "major_event", "academic", 0.5, None),
    ]
    got = civic(spark, cells)
    assert [got[h] for h in (12, 13, 14, 15)] == [0, 0, 0, 1]


def test_early_or_unknown_notice_holds_all_day(spark):
    for when in (notice(7), None, notice(20, DAY - dt.timedelta(days=1))):
        got = civic(spark, [(DAY, "All", "class_suspension", "academic", 1, when)])
        assert set(got.values()) == {1.0}
    assert set(civic(spark, [(DAY, "Recto", "school_break", "academic", 1, notice(15))]).values()) == {1.0}


def test_zone_mix_of_date_and_hour(spark):
    """23:16 UTC the day before is 07:16 local on the day: earlier by date and early by hour."""
    late = dt.datetime(2026, 7, 1, 23, 16)
    assert set(civic(spark, [(DAY, "Recto", "class_suspension", "academic", 1, late)]).values()) == {1.0}
    # 17:00 UTC on the day itself is 01:00 local on the next day: the hour rule fires
    odd = dt.datetime(2026, 7, 2, 17, 0)
    assert set(civic(spark, [(DAY, "Recto", "class_suspension", "academic", 1, odd)]).values()) == {1.0}


def test_grid_matches_per_event_brute_force(spark):
    rng = random.Random(3)
    cells = []
    for _ in range(400):
        day = DAY + dt.timedelta(days=rng.randrange(12))
        station = rng.choice([None, "All", "All Stations", "Recto", "Gilmore", "Pureza", "Elsewhere"])
        category = rng.choice(["class_suspension"] * 4 + ["school_break", "major_event", "holiday", None])
        when = rng.choice([None, notice(rng.randrange(24), day), notice(rng.randrange(24), day - dt.timedelta(days=1))])
        cells.append((day, station, category, rng.choice(["operational", "academic"]), rng.randrange(100) / 100, when))
    # days with one suspension only
    cells += [(DAY + dt.timedelta(days=20 + i), "Recto", "class_suspension", "academic", 1, notice(8 + i, DAY + dt.timedelta(days=20 + i))) for i in range(15)]

    def one(e, h):
        day, _, category, _, _, when = e
        if category not in ("class_suspension", "school_break"):
            return 0.0
        if category == "school_break" or when is None:
            return 1.0
        local = when + dt.timedelta(hours=8)
        if when.date() < day or local.hour < 8:
            return 1.0
        return 0.0 if h < local.hour else -0.4444 if h <= local.hour + 1 else 1.0

    want = {}
    for day in {e[0] for e in cells}:
        for s in fixed.STATIONS:
            here = [e for e in cells if e[0] == day and e[1] in (None, "All", "All Stations", s)]
            for h in range(24):
                want[day, s, h] = (
                    max([one(e, h) for e in here], default=0.0),
                    max([e[4] for e in here if e[2] == "major_event"], default=0.0),
                    max([e[4] for e in here if e[3] == "operational"], default=0.0),
                )
    got = triggers.event_hour_scores(events(spark, cells))
    assert {
        (r["date"], r["station_name"], r["hour"]): (
            float(r["civic_mandate_score"]),
            float(r["academic_surge_score"]),
            float(r["operational_score"]),
        )
        for r in rows(got)
    } == want


def test_fanout_keeps_station_and_network_rows(spark):
    cells = [(DAY, "Recto", "holiday", "academic", 1, None), (DAY, None, "major_event", "academic", 0.5, None)]
    scoped = triggers.scope_scores(events(spark, cells), triggers.FORECAST_CIVIC, hour_aware=False)
    assert triggers.station_scores(scoped).count() == 13
    assert triggers.station_scores(scoped, fanout=True).filter("station_name = 'Recto'").count() == 2


def test_forecast_civic_has_no_hours(spark):
    scoped = triggers.scope_scores(
        events(spark, [(DAY, "Recto", "class_suspension", "academic", 1, notice(13))]), triggers.FORECAST_CIVIC, hour_aware=False
    )
    hours = triggers.station_scores(scoped).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(23))))
    assert {float(r[0]) for r in hours.select(triggers.civic_at(F.col("h"))).collect()} == {1.0}


def test_weather_takes_the_local_hour_maximum(spark):
    df = spark.createDataFrame(
        [(DAY, dt.datetime(2026, 7, 1, 23, 16), Decimal("0.4")), (DAY, dt.datetime(2026, 7, 1, 23, 50), Decimal("0.8"))],
        "weather_date date, observed_or_forecasted_at timestamp, normalized_score decimal(6,5)",
    )
    r = triggers.hourly_weather(df).first()
    assert (r.date, r.hour, float(r.weather_score)) == (DAY, 7, 0.8)


def test_index_weights(spark):
    r = spark.range(1).select(
        indices.cfi(indices.num("1.0"), indices.num("0.5"), indices.num("-0.4444"), indices.num("0.33333")).alias("a")
    ).first()
    assert float(r.a) == 0.2528  # .25 + .075 - .15554 + .0833325 = .2527925
