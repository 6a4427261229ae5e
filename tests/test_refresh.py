"""The stored year after changes, sketches by day, and tables that are joined where they lie."""

from __future__ import annotations

import dataclasses
import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from flowgauge.operators import baselines, evaluate, forecast, refresh, sketches
from flowgauge.plans import queries, settings
from flowgauge.sources import adapters, tables

D = dt.date


def same(got, want):
    want = want.select(got.columns)
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.fixture(scope="module")
def built(spark, small, tmp_path_factory):
    """A year built on the sources as they were before the changes, and what a build on the changed ones gives."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root = tmp_path_factory.mktemp("year")
    store = refresh.YearStore(str(root / "old"), settings.AS_OF, 60)
    refresh.build_year(store, queries.year_sources_before(spark, small, settings.CHANGES))
    new = refresh.YearStore(str(root / "new"), settings.AS_OF, 60)
    refresh.build_year(new, queries.year_sources(spark, small))
    return store, new


def copy_of(store, folder):
    import shutil

    shutil.copytree(store.root, folder)
    return dataclasses.replace(store, root=str(folder))


def written(store, name):
    """Partition to its files, below one table of the store."""
    out = {}
    for folder, _, files in os.walk(store.path(name)):
        if any(f.endswith(".parquet") for f in files):
            out[os.path.relpath(folder, store.path(name))] = {f for f in files if f.endswith(".parquet")}
    return out


def test_a_refresh_equals_a_build(spark, small, built, tmp_path):
    store, new = copy_of(built[0], tmp_path / "s"), built[1]
    assert not same(store.daily(spark), new.daily(spark))
    dates = refresh.refresh_year(store, queries.year_sources(spark, small), settings.CHANGES)
    for name in ("facts", "baselines", "daily"):
        assert same(getattr(store, name)(spark), getattr(new, name)(spark)), name
    assert same(refresh.stored_year(store), refresh.stored_year(new))
    assert {D(1998, 6, 19), D(1998, 7, 4)} <= set(dates) <= set(store.horizon())
    # done again, nothing but the named days is due: no baseline moves any more
    assert refresh.refresh_year(store, queries.year_sources(spark, small), settings.CHANGES) == [D(1998, 6, 19), D(1998, 7, 4)]
    assert same(store.daily(spark), new.daily(spark))


def test_only_partitions_of_the_changed_days_are_written(spark, small, built, tmp_path):
    store = copy_of(built[1], tmp_path / "s")
    before = {name: written(store, name) for name in ("facts", "baselines", "daily")}
    day = D(1998, 7, 10)
    asked = []
    now = queries.year_sources(spark, small)

    def facts(dates):
        asked.append(dates)
        return now.facts(dates)

    sources = refresh.Sources(facts, now.weather, now.events)
    assert refresh.refresh_year(store, sources, refresh.Changes(weather=[day])) == [day]
    after = {name: written(store, name) for name in before}
    moved = {name: {p for p in before[name] if before[name][p] != after[name][p]} for name in before}
    assert moved == {"facts": set(), "baselines": set(), "daily": {f"prediction_date={day}"}}
    assert asked == [[day - dt.timedelta(days=7)]]


def test_the_plan_of_one_day_reads_one_weekday(spark, small, built):
    store = built[1]
    day = D(1998, 7, 10)
    base = store.baselines(spark).filter(F.col("day_of_week").isin([day.isoweekday()]))
    df = refresh.daily_sums(store, base, queries.year_sources(spark, small), [day])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day_of_week" in plan or "PartitionFilters: [day_of_week" in plan or "PartitionFilters: [(day_of_week" in plan
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,1998-07-03" in plan
    assert df.select("prediction_date").distinct().count() == 1


def test_a_changed_fact_moves_its_weekday_only_if_a_baseline_moves(spark, small, built, tmp_path):
    store = copy_of(built[1], tmp_path / "s")
    now = queries.year_sources(spark, small)
    day = D(1998, 6, 12)

    def sources(volume):
        return refresh.Sources(lambda dates: now.facts(dates).withColumn("volume", F.when(F.col("date") == day, volume).otherwise(F.col("volume"))), now.weather, now.events)

    changes = refresh.Changes(facts=[day])
    all_fridays = [d for d in store.horizon() if d.isoweekday() == 5]
    assert refresh.refresh_year(store, sources(F.col("volume") * 1000 + 50_000), changes) == all_fridays
    fresh = refresh.YearStore(str(tmp_path / "fresh"), settings.AS_OF, 60)
    refresh.build_year(fresh, sources(F.col("volume") * 1000 + 50_000))
    assert same(store.daily(spark), fresh.daily(spark)) and same(store.baselines(spark), fresh.baselines(spark))
    assert refresh.refresh_year(store, sources(F.col("volume") * 1000 + 50_000), changes) == [day + dt.timedelta(days=7)]
    # a day that lost all its rows
    gone = refresh.Sources(lambda dates: now.facts(dates).filter(F.col("date") != day), now.weather, now.events)
    refresh.refresh_year(store, gone, changes)
    assert store.facts(spark).filter(F.col("date") == F.lit(day)).count() == 0
    again = refresh.YearStore(str(tmp_path / "again"), settings.AS_OF, 60)
    refresh.build_year(again, gone)
    assert same(store.daily(spark), again.daily(spark))


def test_a_refresh_that_died_is_done_again(spark, small, built, tmp_path, monkeypatch):
    store, new = copy_of(built[0], tmp_path / "s"), built[1]
    whole = refresh.store_parts

    def failing(df, path, *by):
        if path.endswith("baselines"):
            raise RuntimeError("lost")
        whole(df, path, *by)

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "store_parts", failing)
        with pytest.raises(RuntimeError):
            refresh.refresh_year(store, queries.year_sources(spark, small), settings.CHANGES)
    refresh.refresh_year(store, queries.year_sources(spark, small), settings.CHANGES)
    assert same(store.daily(spark), new.daily(spark)) and same(store.baselines(spark), new.baselines(spark))


def test_the_horizon_moves_on(spark, small, built, tmp_path):
    store = dataclasses.replace(copy_of(built[1], tmp_path / "s"), as_of="1998-06-18 07:30:00")
    made = refresh.refresh_year(store, queries.year_sources(spark, small), refresh.Changes())
    assert made == store.horizon()[-3:]
    fresh = refresh.YearStore(str(tmp_path / "fresh"), "1998-06-18 07:30:00", 60)
    refresh.build_year(fresh, queries.year_sources(spark, small))
    # days that both horizons hold rest on a model of the same actuals
    assert same(store.daily(spark), fresh.daily(spark))


def test_sketches_merge_over_days(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
        F.date_add(F.lit("2026-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)).cast("int")).alias("d"),
        F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"),
        (F.col("id") % 7000).alias("item"),
    )
    days = sketches.day_sketches(df, ["k"], "d", value="v", item="item")
    assert days.count() == 6 * 40
    levels = {"low": 0.01, "median": 0.5, "high": 0.99}
    found = sketches.merged_percentiles(days, ["k"], levels)
    checks = rows(sketches.rank_checks(df, ["k"], "v", found, levels))
    assert len(checks) == 6 and all(r[f"{c}_within_error"] for r in checks for c in levels)
    # an estimate far off is told
    wrong = found.withColumn("median", F.col("median") + 5000)
    assert not any(r["median_within_error"] for r in rows(sketches.rank_checks(df, ["k"], "v", wrong, levels)))
    # a period reads its days, and equals sketches of only these days' rows within the error
    part = sketches.of_period(days, "d", "2026-01-10", "2026-01-19")
    some = df.filter(F.col("d").between(F.lit("2026-01-10").cast("date"), F.lit("2026-01-19").cast("date")))
    assert part.count() == 60 and part.agg(F.sum("n")).first()[0] == some.count()
    checks = rows(sketches.rank_checks(some, ["k"], "v", sketches.merged_percentiles(part, ["k"], levels), levels))
    assert all(r[f"{c}_within_error"] for r in checks for c in levels)
    exact = {r["k"]: r["n"] for r in rows(df.groupBy("k").agg(F.count_distinct("item").alias("n")))}
    for r in rows(sketches.merged_distinct(days, ["k"])):
        assert abs(r["items"] - exact[r["k"]]) <= sketches.COUNT_ERROR * exact[r["k"]]


def test_sketches_of_nulls_and_no_rows(spark):
    df = spark.createDataFrame([("a", D(2026, 1, 1), None), ("a", D(2026, 1, 2), 5), ("b", D(2026, 1, 1), None)], "k string, d date, v long")
    found = sketches.merged_percentiles(sketches.day_sketches(df, ["k"], "d", value="v"), ["k"], {"m": 0.5})
    assert [(r["k"], r["n"], r["m"]) for r in rows(found)] == [("a", 1, 5)]
    assert sketches.merged_percentiles(sketches.day_sketches(df.limit(0), ["k"], "d", value="v"), ["k"], {"m": 0.5}).count() == 0


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_facts_are_not_shuffled(spark, small, no_broadcast):
    actuals = queries.bucketed_facts(spark, small)
    base = baselines.threshold_baselines(actuals)
    assert "Exchange" not in plan_of(base)
    stored = tables.store_bucketed(base, "test-baselines", baselines.KEYS, queries.BUCKETS)
    graded = baselines.congestion_levels(actuals, stored)
    assert "Exchange" not in plan_of(graded) and "SortMergeJoin" in plan_of(graded)
    drift = forecast.model_drift(evaluate.prior_week_model(actuals), actuals)
    assert "Exchange" not in plan_of(drift) and "SortMergeJoin" in plan_of(drift)
    plain = adapters.flow(spark, small)
    assert same(graded, baselines.congestion_levels(plain, baselines.threshold_baselines(plain)))
    assert same(drift, forecast.model_drift(evaluate.prior_week_model(plain), plain))


def test_baselines_of_other_buckets_still_join(spark, small, no_broadcast):
    actuals = queries.bucketed_facts(spark, small)
    other = tables.store_bucketed(baselines.threshold_baselines(actuals), "other-buckets", baselines.KEYS, 3)
    graded = baselines.congestion_levels(actuals, other)
    assert graded.count() == actuals.count()
    # the smaller side alone moves
    assert plan_of(graded).count("Exchange hashpartitioning") == 1
