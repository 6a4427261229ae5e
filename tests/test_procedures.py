"""The SQL scripts against the Python calls."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from flowgauge.operators import prescribe
from flowgauge.plans import procedures, queries
from flowgauge.sources import sinks


@pytest.fixture(scope="module")
def scripts(spark, small):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    made = queries.published_scripts(spark, small)
    yield made
    procedures.withdraw(spark, made.schema)


def test_years_are_transformed_once(spark, scripts):
    assert spark.sql(scripts.scan_and_transform_new_ridership_tables()).first()[0] == spark.table("source_years").count()
    assert spark.sql(scripts.scan_and_transform_new_ridership_tables()).first()[0] == 0
    got, want = spark.table(f"{scripts.schema}.ridership_hourly"), spark.table("expanded_years")
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()
    year = rows(spark.table("source_years"), "year")[0]["year"]
    hours = spark.sql(scripts.transform_ridership_table(year)).first()[0]
    assert hours == want.filter(F.col("year") == year).count() and got.count() == want.count()


def test_dispatches_are_logged_like_python_does(spark, scripts, tmp_path):
    logged = [spark.sql(scripts.evaluate_and_log_prescriptive_deployments(run, "o'clock\\")).first()[0] for run in ("a", "b")]
    numbered = spark.table("numbered_recommendations")
    assert logged == [numbered.count()] * 2
    known = spark.createDataFrame([(p,) for p in prescribe.RECOMMENDED], "id string")
    log, ledger = str(tmp_path / "log"), str(tmp_path / "ledger")
    for run in ("a", "b"):
        prescribe.record_dispatches(numbered, known, run, "o'clock\\", "2026-01-01 00:00:00", "2026-01-01 00:00:01", log, ledger)
    sent = ["deployment_id", "station_name", "flow_type", "decision_action", "deployed_by", "status", "completed_at"]
    done = ["id", "run_id", "trigger_source", "station_name", "friction_score", "recommended_protocol_id", "actual_dispatched_protocol_id", "tested_by"]
    for name, path, columns in (("deployments", log, sent), ("executions", ledger, done)):
        got, want = spark.table(f"{scripts.schema}.{name}").select(*columns), spark.read.parquet(path).select(*columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_refresh_replaces_the_table(spark, scripts):
    want = spark.table("vw_predictive_forecast_1y")
    for _ in range(2):
        assert spark.sql(scripts.refresh_predictive_forecast_1y()).first()[0] == want.count()
    got = spark.table(f"{scripts.schema}.predictive_passenger_volume_forecast_1y")
    assert got.exceptAll(want).count() == 0


def test_evaluations_go_on(spark, scripts):
    assert [spark.sql(scripts.train_and_validate_models()).first()[0] for _ in range(2)] == [2, 4]
    assert sorted(r["id"] for r in rows(spark.table(f"{scripts.schema}.evaluations"))) == [1, 2, 3, 4]


def test_runs_with_odd_names_have_parts_of_their_own(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for run in ("2026-01-01", "7", "07", "a/b=c d"):
        sinks.write_run(spark.createDataFrame([(run,)], "r string"), path, run)
    for run in ("2026-01-01", "7", "07", "a/b=c d"):
        others = {r["r"] for r in rows(sinks.other_runs(spark, path, "r string", run))}
        assert others == {"2026-01-01", "7", "07", "a/b=c d"} - {run}
