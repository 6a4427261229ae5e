"""The published views, and the shape of the physical plans."""

from __future__ import annotations

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.operators import allocate, baselines, dims, evaluate, models, quality, reshape, triggers
from flowgauge.plans import queries, settings, views
from flowgauge.session import stage
from flowgauge.sources import adapters, tables


@pytest.fixture(scope="module")
def published(spark, small):
    source = adapters.protocol_source(spark, small)
    protocols = stage(dims.protocol_dim(source), "protocols")
    out = views.build_views(
        spark,
        {
            "facts": queries.hour_table(spark, small),
            "events": adapters.calendar_events(spark, small),
            "weather": adapters.weather(spark, small),
            "weather_current": adapters.weather_readings(spark, small),
            "model_outputs": queries.model(spark, small, 366),
            "protocols": protocols,
            "tactics": dims.tactics(source, protocols),
            "deployments": adapters.deployments(spark, small),
            "performance": adapters.evaluations(spark, small).withColumn("last_trained_timestamp", F.col("recorded_at")).limit(1),
            "evaluations": adapters.evaluations(spark, small),
            "executions": adapters.executions(spark, small),
        },
        settings.AS_OF,
    )
    views.publish_views(spark, out)
    return out


def test_every_view_is_queryable(spark, published):
    assert len(published) == 24
    for name in published:
        assert spark.sql(f"SELECT * FROM {name} LIMIT 1").columns, name
    filled = [n for n in published if n not in ("descriptive_live_event_feed", "prescriptive_active_checklists")]
    report = quality.not_empty({n: published[n] for n in filled})
    assert [r["check_name"] for r in rows(report.filter("not passed"))] == []


def test_dashboard_sql(spark, published):
    out = spark.sql(
        "SELECT station_name, predicted FROM predictive_passenger_volume_forecast_24h "
        "WHERE flow_type = 'entry' AND predicted_threat_level <> 'Emergency' ORDER BY predicted DESC LIMIT 3"
    )
    assert out.count() == 3


def test_whatif_table_function(spark, published):
    for name in ("simulate_scenario", "predictive_what_if_scenario_simulator"):
        r = spark.sql(f"SELECT * FROM {name}('Katipunan', 1, '17:00', 'entry', 0.8, 1.0, 0.0, 1000)").first()
        assert (float(r[0]), float(r[1]), float(r[2])) == (1000.0, 1160.0, 16.0)
    r = spark.sql("SELECT * FROM simulate_scenario('Nowhere', 1, '17:00', 'entry', 0, 0, 0, 1100)").first()
    assert r.simulated_threat_level == "Warning"
    known = published["hourly_threshold_baselines"].first()
    r = spark.sql(
        f"SELECT * FROM simulate_scenario('{known.station_name}', {known.day_of_week}, '{known.hour_period}', '{known.flow_type}', 0, 0, 0)"
    ).first()
    assert float(r.baseline_mean_forecast) == known.median_volume


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def details(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filters_and_columns_reach_the_scan(spark, small, tmp_path):
    path = str(tmp_path / "facts")
    tables.write_facts(queries.hour_table(spark, small), path)
    long = reshape.hourly_actuals(spark.read.parquet(path)).filter("date >= '1998-01-01'")
    text = details(long.select("volume"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(date,1998-01-01\)", text)
    assert "Not(In(time_period" in text
    text = details(adapters.flow(spark, small))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "l_extendedprice" not in schema and "l_tax" not in schema


def test_small_sides_are_broadcast_by_size_and_large_ones_are_not(spark, small):
    parts = queries.stored(spark, small, "baselines", "weather", "scores")
    facts = stage(adapters.flow(spark, small), "facts")
    joined = triggers.descriptive_metrics(facts, *parts)
    assert plan(joined).count("BroadcastHashJoin") == 3
    assert "Exchange hashpartitioning" not in plan(joined)  # the facts are not shuffled
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        wide = triggers.descriptive_metrics(facts, *parts)
        assert plan(wide).count("SortMergeJoin") == 3
        assert wide.exceptAll(joined).count() == 0 and wide.count() == facts.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_expansion_does_not_shuffle(spark, small):
    bands = stage(queries.bands(spark, small), "bands")
    assert "Exchange hashpartitioning" not in plan(allocate.expand_bands(bands))


def test_models_learn_and_stay_distributed(spark, small):
    actuals = stage(adapters.flow(spark, small), "actuals")
    base = stage(baselines.threshold_baselines(actuals), "base")
    features = triggers.predictive_features(actuals, *queries.stored(spark, small, "weather", "scores"))
    table = stage(evaluate.chronological_split(models.training_rows(features, base)), "rows")
    train, test = table.filter("part = 'train'"), table.filter("part = 'test'")
    assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]
    made = models.model_outputs(models.train_volume_model(train, trees=3, depth=3), test)
    assert made.count() == test.count() and made.agg(F.min("baseline_mean_forecast")).first()[0] >= 0
    error = evaluate.regression_metrics(evaluate.matched(made, actuals)).first()
    mean = train.agg(F.avg("label")).first()[0]
    flat = evaluate.regression_metrics(
        test.select(F.col("label").alias("actual"), F.lit(mean).alias("predicted"))
    ).first()
    assert error.rmse < flat.rmse
    weights = {r["threat_class"]: r["class_weight"] for r in rows(models.balanced_weights(train).select("threat_class", "class_weight").distinct())}
    sizes = {r["threat_class"]: r["n"] for r in rows(train.groupBy("threat_class").agg(F.count("*").alias("n")))}
    assert all(abs(weights[c] * sizes[c] - train.count() / len(sizes)) < 1e-6 for c in sizes)
    threat = models.train_threat_model(train, trees=3, depth=3).transform(test)
    assert threat.filter("predicted_class NOT IN (0, 1, 2)").count() == 0


def test_stations_and_capacities():
    assert len(fixed.STATIONS) == 13 and set(fixed.PLATFORM_CAPACITY) == set(fixed.STATIONS)
    for shares in fixed.HOUR_SHARES.values():
        assert abs(sum(fixed.dec(s) for s in shares.values()) - 1) < fixed.dec("0.00000000000001")


def test_views_can_be_shown_in_published_order(published):
    out = rows(views.ordered("predictive_passenger_volume_forecast_quarterly", published))
    assert [(r["year"], r["quarter"]) for r in out] == sorted((r["year"], r["quarter"]) for r in out)
