from __future__ import annotations

import datetime as dt

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from flowgauge.operators import baselines


def actuals(spark, cells):
    return spark.createDataFrame(
        cells, "date date, hour_period string, station_name string, flow_type string, volume long"
    )


MONDAY = dt.date(2024, 1, 1)


def test_percentiles_match_the_interpolated_definition(spark):
    rng = np.random.default_rng(1)
    cells, want = [], {}
    for key in range(40):
        values = rng.integers(0, 60 if key % 2 else 5000, rng.integers(1, 60)).tolist()
        station = f"s{key}"
        cells += [(MONDAY + dt.timedelta(days=7 * i), "07:00", station, "entry", v) for i, v in enumerate(values)]
        want[station] = [int(np.rint(x)) for x in np.percentile(values, [50, 80, 90])]
    got = baselines.threshold_baselines(actuals(spark, cells))
    for r in rows(got):
        assert [r["median_volume"], r["warning_threshold"], r["critical_threshold"]] == want[r["station_name"]]
        assert r["day_of_week"] == 1


def test_missing_volume_counts_as_zero_and_ties_round_to_even(spark):
    cells = [(MONDAY, "07:00", "a", "exit", None), (MONDAY + dt.timedelta(days=7), "07:00", "a", "exit", 5)]
    r = baselines.threshold_baselines(actuals(spark, cells)).first()
    assert (r.median_volume, r.warning_threshold, r.critical_threshold) == (2, 4, 4)  # 2.5, 4.0, 4.5


def test_hot_key_is_exact(spark):
    """One key holds nearly all rows; its histogram has few rows."""
    df = spark.range(200_000).select(
        F.lit(MONDAY).alias("date"),
        F.lit("07:00").alias("hour_period"),
        F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("station_name"),
        F.lit("entry").alias("flow_type"),
        (F.col("id") % 1000).alias("volume"),
    )
    got = {r["station_name"]: r for r in rows(baselines.threshold_baselines(df))}
    values = [i % 1000 for i in range(200_000) if i % 100]
    assert got["hot"]["critical_threshold"] == int(np.rint(np.percentile(values, 90)))
    assert got["hot"]["median_volume"] == int(np.rint(np.percentile(values, 50)))


def test_approximate_option(spark):
    cells = [(MONDAY + dt.timedelta(days=7 * i), "07:00", "a", "entry", i) for i in range(101)]
    r = baselines.threshold_baselines(actuals(spark, cells), approximate=1000).first()
    assert (r.median_volume, r.warning_threshold, r.critical_threshold) == (50, 80, 90)


def test_congestion_levels(spark):
    cells = [(MONDAY + dt.timedelta(days=7 * i), "07:00", "a", "entry", i) for i in range(101)]
    base = baselines.threshold_baselines(actuals(spark, cells))
    out = baselines.congestion_levels(actuals(spark, cells), base)
    counts = {r["congestion_level"]: r["n"] for r in rows(out.groupBy("congestion_level").agg(F.count("*").alias("n")))}
    assert counts == {"Normal": 80, "Warning": 10, "Critical": 11}
    unknown = actuals(spark, [(MONDAY, "08:00", "zz", "entry", 7)])
    assert baselines.congestion_levels(unknown, base).first().congestion_level == "Normal"
