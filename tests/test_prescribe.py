from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices
from flowgauge.operators import evaluate, prescribe, quality

DAY = dt.date(2026, 11, 18)


def metrics(spark, cells):
    full = [(DAY, "04:00", s, "exit", 100, v, *[Decimal(str(x)) for x in scores], level) for s, v, scores, level in cells]
    return spark.createDataFrame(
        full,
        "prediction_date date, hour_period string, station_name string, flow_type string, baseline_mean_forecast int, "
        "adjusted_forecast_volume int, weather_score decimal(6,5), academic_surge_score decimal(6,5), "
        "civic_mandate_score decimal(6,5), predicted_threat_level string",
    )


@pytest.fixture(scope="module")
def protocols(spark):
    return spark.createDataFrame(
        [(f"APTA-0{i}", f"STD-{i}", f"Title {i}", f"Scope {i}") for i in range(1, 7)],
        "id string, apta_standard_code string, official_document_title string, scope_relevance_to_surge_management string",
    )


def test_protocol_tree(spark):
    zero = (0, 0, 0)
    cells = [
        ("Legarda", 100, zero, "Normal"),
        ("Recto", 1999, zero, "Warning"),  # 79.96 %
        ("Pureza", 1440, zero, "Warning"),  # exactly 80 %
        ("V. Mapa", 1600, zero, "Critical"),
        ("Santolan", 1620, zero, "Critical"),  # exactly 90 %
        ("Anonas", 10, zero, "Emergency"),
        ("Nowhere", 10, zero, "Normal"),
    ]
    out = rows(prescribe.recommendations(metrics(spark, cells)))
    got = {}
    for r in out:
        got.setdefault(r["station_name"], []).append(r["decision_action"])
    assert {k: sorted(v) for k, v in got.items()} == {
        "Legarda": ["APTA-03"],
        "Recto": ["APTA-02"],
        "Pureza": ["APTA-02", "APTA-05"],
        "V. Mapa": ["APTA-04"],
        "Santolan": ["APTA-02", "APTA-04"],
        "Anonas": ["APTA-01", "APTA-04"],
    }
    santolan = next(r for r in out if r["station_name"] == "Santolan")
    assert (float(santolan["capacity_utilization"]), santolan["passenger_surplus"], santolan["predicted_volume"]) == (90.0, 0, 100)


def test_trigger_context_ties(spark):
    cells = [((0.5, 0.5, 0.5), "Weather"), ((0.4, 0.5, 0.5), "Academic"), ((0, 0, 1), "Civic"), ((0, 0, 0), "General"), ((0, 0, -0.4444), "General")]
    df = spark.createDataFrame([(*[Decimal(str(x)) for x in s], w) for s, w in cells], "a decimal(6,5), b decimal(6,5), c decimal(6,5), w string")
    out = df.select("w", indices.trigger_context(F.col("a"), F.col("b"), F.col("c")).alias("got"))
    assert all(r.w == r.got for r in out.collect())


def test_checklists(spark, protocols):
    rec = prescribe.recommendations(metrics(spark, [("Legarda", 1700, (0.5, 0, 0), "Critical")]))
    tactics = spark.createDataFrame(
        [("APTA-04-T01", "APTA-04"), ("APTA-04-T02", "APTA-04"), ("APTA-04-T12", "APTA-04"), ("APTA-02-T03", "APTA-02")],
        "id string, protocol_id string",
    ).withColumns({"tactic_name": F.col("id"), "tactic_description": F.lit("do")})
    out = rows(prescribe.active_checklists(rec, protocols, tactics, "2026-11-18 04:40:00"), "task_name")
    assert [(r["task_name"], r["task_order"], r["target_role"], r["priority"]) for r in out] == [
        ("APTA-02-T03", 3, "Ground Control Staff", "Critical"),
        ("APTA-04-T01", 1, "Ground Control Staff", "Medium"),
        ("APTA-04-T02", 2, "Command Center Officer", "High"),
        ("APTA-04-T12", 4, "Ground Control Staff", "Medium"),
    ]
    assert out[0]["ingestion_timestamp"] == dt.datetime(2026, 11, 17, 20, 0)
    assert out[0]["active_context"] == "Weather" and out[0]["active_action"] == "STD-2"
    assert prescribe.active_checklists(rec, protocols, tactics, "2026-11-18 05:00:00").count() == 0


def test_guidelines(spark, protocols):
    out = {r["threat_level"]: r["prescribed_standard"] for r in rows(prescribe.tactical_guidelines(protocols))}
    assert out == {"Normal": "STD-3 - Title 3", "Warning": "STD-2 - Title 2", "Critical": "STD-4 - Title 4", "Emergency": "STD-1 - Title 1"}


def test_empty_logs(spark, protocols):
    empty = spark.createDataFrame([], "decision_action string, ingestion_timestamp timestamp, broadcast_timestamp timestamp")
    audit = prescribe.compliance_audit(empty, protocols).first()
    assert (audit[0], audit[1], float(audit[2])) == (0, 0, 100.0)
    latency = prescribe.latency_summary(empty).first()
    assert [float(x) for x in latency] == [0, 0, 0, 0, 100.0]
    ledger = spark.createDataFrame(
        [], "run_id string, model_name string, mape double, rmse double, classification_accuracy double, f1_score double, all_targets_passed boolean, recorded_at timestamp"
    )
    runs = spark.createDataFrame([], "scr_compliant boolean, latency_seconds double, latency_sla_passed boolean, recorded_at timestamp")
    r = prescribe.executive_summary(ledger, runs).first()
    assert r.total_predictive_runs == 0 and r.avg_volume_mape is None
    assert float(r.overall_scr_compliance_pct) == 100.0 and float(r.overall_latency_sla_compliance_pct) == 100.0


def test_deployments_and_ledger(spark, protocols):
    rec = prescribe.recommendations(metrics(spark, [("Legarda", 1700, (0, 0, 0), "Critical"), ("Recto", 10, (0, 0, 0), "Normal")]))
    rows_out = rows(prescribe.deployment_rows(rec, "test", "2026-01-01 00:00:00", "2026-01-01 00:00:04"), "deployment_id")
    assert [r["deployment_id"] for r in rows_out] == ["DEP000001", "DEP000002", "DEP000003"]
    assert {r["status"] for r in rows_out} == {"Active"}
    known = protocols.filter("id <> 'APTA-04'")
    ledger = prescribe.execution_rows(rec, known, "r", "test", "2026-01-01 00:00:00", "2026-01-01 00:00:04")
    got = {r["recommended_protocol_id"]: (float(r["friction_score"]), r["scr_compliant"], r["latency_sla_passed"]) for r in rows(ledger)}
    assert got == {"APTA-04": (0.9, False, False), "APTA-02": (0.9, True, False), "APTA-03": (0.1, True, False)}
    log = prescribe.deployment_rows(rec, "test", "2026-01-01 00:00:00", "2026-01-01 00:00:04")
    audit = prescribe.compliance_audit(log, known).first()
    assert (audit[0], audit[1], float(audit[2])) == (3, 2, 66.67)
    assert quality.columns_check(log, ["ingestion_timestamp", "broadcast_timestamp"], ["turnstile_throttling_rate"]).first().passed
    assert rows(quality.rule_check(log, quality.deployment_rules()).filter("not passed")) == []


def test_kpi_normalisation(spark):
    audit = spark.createDataFrame([(100.0,)], "symbolic_heuristic_compliance_rate_scr double")
    for mape, shown in ((0.0, 1.2), (None, 1.2), (0.0119, 1.2), (8.5, 8.5)):
        perf = spark.createDataFrame(
            [(fixed.VOLUME_MODEL, mape, None, dt.datetime(2026, 1, 1)), ("other", 5.0, 1.0, None)],
            "model_name string, mape double, rmse double, last_trained_timestamp timestamp",
        )
        r = prescribe.kpi_prediction_accuracy(perf, audit, 1.19, 13.92).collect()
        assert len(r) == 1 and r[0].mape_error_rate_pct == shown
        assert r[0].prediction_accuracy_pct == round(100 - {1.2: 1.19 if mape != 0.0119 else 1.19}.get(shown, shown), 1)
        assert r[0].rmse_pax == 13.9 and r[0].model_status == fixed.STATUS_FAILED
        (r,) = prescribe.kpi_prediction_accuracy(perf, audit, 1.19, 13.92, F.lit(True)).collect()
        assert r.model_status == fixed.STATUS_CERTIFIED


def test_split_and_metrics(spark):
    df = spark.range(100).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("date"))
    parts = {r["part"]: r["n"] for r in rows(evaluate.chronological_split(df).groupBy("part").agg(F.count("*").alias("n")))}
    assert parts == {"train": 80, "test": 20}
    assert evaluate.split_date(df).first().split_date == dt.date(2024, 1, 9)
    pairs = spark.createDataFrame([(10, 13), (0, 4), (20, 20)], "actual int, predicted int")
    r = evaluate.regression_metrics(pairs).first()
    assert (r.sample_count, r.rmse, r.mean_volume, r.rmse_percentage, r.mape) == (3, 2.8868, 10.0, 28.87, 143.3333)


def test_weighted_f1(spark):
    truth = [0, 0, 0, 1, 1, 2]
    guess = [0, 0, 1, 1, 0, 2]
    df = spark.createDataFrame(list(zip(truth, guess)), "actual_class int, predicted_class int")
    by_class = {r["class_id"]: (r["tp"], r["fp"], r["fn"], r["support"]) for r in rows(evaluate.class_scores(df))}
    assert by_class == {0: (2, 1, 1, 3), 1: (1, 1, 1, 2), 2: (1, 0, 0, 1)}
    r = evaluate.weighted_f1(df).first()
    assert r.f1_score == round((2 / 3 * 3 + 0.5 * 2 + 1) / 6, 4) and r.classification_accuracy == 66.67


def test_dispatches_and_evaluation_are_recorded(spark, protocols, tmp_path):
    rec = prescribe.recommendations(metrics(spark, [("Legarda", 1700, (0, 0, 0), "Critical"), ("Recto", 10, (0, 0, 0), "Normal")]))
    log, ledger = str(tmp_path / "log"), str(tmp_path / "ledger")
    for run in ("a", "b"):
        made = prescribe.record_dispatches(rec, protocols, run, "cadence", "2026-01-01 00:00:00", "2026-01-01 00:00:01", log, ledger)
        assert made == 3
    # a run that died after its first part is done again, under the same ids
    import shutil

    shutil.rmtree(f"{ledger}/run=b")
    assert prescribe.record_dispatches(rec, protocols, "b", "cadence", "2026-01-01 00:00:00", "2026-01-01 00:00:01", log, ledger) == 3
    stored = spark.read.parquet(ledger)
    assert stored.count() == 6 and stored.select("run_id").distinct().count() == 2
    assert sorted(r["id"] for r in rows(stored)) == [1, 2, 3, 4, 5, 6]
    assert sorted(r["deployment_id"] for r in rows(spark.read.parquet(log))) == [f"DEP00000{k}" for k in range(1, 7)]
    pairs = spark.createDataFrame([(100, 101), (50, 50)], "actual int, predicted int")
    classes = spark.createDataFrame([(0, 0), (1, 1)], "actual_class int, predicted_class int")
    split = spark.createDataFrame([(DAY,)], "split_date date")
    audit = spark.createDataFrame([(100.0,)], "symbolic_heuristic_compliance_rate_scr double")
    late = spark.createDataFrame([(99.0,)], "latency_compliance_rate_pct double")
    rows_in = evaluate.evaluation_rows(
        evaluate.regression_metrics(pairs), evaluate.weighted_f1(classes), "r1", split, "2026-01-01 00:00:00", spark.range(7), audit, late
    )
    seed = spark.createDataFrame(
        [(fixed.VOLUME_MODEL, 8.5, 184.2, 0.0, 0.0, dt.datetime(2020, 1, 1))],
        "model_name string, mape double, rmse double, classification_accuracy double, recall_score double, last_trained_timestamp timestamp",
    )
    paths = str(tmp_path / "evals"), str(tmp_path / "history")
    snapshot = {r["model_name"]: r for r in rows(evaluate.record_evaluation(rows_in, *paths, seed))}
    assert snapshot[fixed.VOLUME_MODEL]["mape"] == 0.5 and snapshot[fixed.THREAT_MODEL]["classification_accuracy"] == 100.0
    stored = spark.read.parquet(paths[0])
    assert stored.filter("all_targets_passed AND target_scr_passed AND sample_count = 7").count() == 2
    assert stored.filter("target_latency_passed OR certified").count() == 0
    evaluate.record_evaluation(rows_in, *paths, seed)
    history = spark.read.parquet(paths[1])
    assert sorted(r["id"] for r in rows(history)) == [1, 2, 3, 4] and "recorded_at" in history.columns
    assert sorted(r["id"] for r in rows(spark.read.parquet(paths[0]))) == [1, 2, 3, 4]
