from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from flowgauge import fixed
from flowgauge.operators import dims, enrich
from flowgauge.session import new_folder, stage, stage_all
from flowgauge.sources import adapters, sinks, tables
from flowgauge.streaming import feeds as streams


def test_upsert_updates_listed_columns_and_inserts(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, n int")
    changes = spark.createDataFrame([(2, None, 99), (3, "c", 30)], "id int, name string, n int")
    out = {r["id"]: (r["name"], r["n"]) for r in rows(sinks.upsert(target, changes, ["id"], ["n"]))}
    assert out == {1: ("a", 10), 2: ("b", 99), 3: ("c", 30)}
    out = {r["id"]: (r["name"], r["n"]) for r in rows(sinks.upsert(target, changes, ["id"]))}
    assert out == {1: ("a", 10), 2: (None, 99), 3: ("c", 30)}


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(-1).alias("k"), "id", (F.col("id") * 2).alias("v"))
    out = {r["k"]: r["v"] for r in rows(sinks.latest_per_key(df, ["k"], ["id"]))}
    assert out[-1] == 39998 and len(out) == 401


def test_delete_snapshot_append_replace(spark, tmp_path):
    df = spark.range(5).toDF("id")
    assert sinks.delete_matching(df, spark.range(2).toDF("id"), ["id"]).count() == 3
    kept, ledger, stored = (str(tmp_path / n) for n in ("kept", "ledger", "stored"))
    sinks.snapshot_once(df, kept)
    sinks.snapshot_once(spark.range(99).toDF("id"), kept)
    assert spark.read.parquet(kept).count() == 5
    sinks.append_ledger(df, ledger)
    sinks.append_ledger(df, ledger)
    assert spark.read.parquet(ledger).count() == 10
    sinks.replace_table(df, stored)
    sinks.replace_table(spark.range(3).toDF("id"), stored)
    assert spark.read.parquet(stored).count() == 3


def test_log_replay_and_compaction(spark, tmp_path):
    path, short = str(tmp_path / "log"), str(tmp_path / "short")
    first = spark.createDataFrame([("a", 1, False), ("b", 1, False)], "id string, at int, removed boolean")
    second = spark.createDataFrame([("a", 2, True), ("b", 3, False)], "id string, at int, removed boolean")
    sinks.log_batch(first, path, 0)
    sinks.log_batch(second, path, 1)
    sinks.log_batch(second, path, 1)  # replayed
    log = sinks.read_log(spark, path, first.schema)
    assert log.count() == 4
    live = sinks.current_rows(log, ["id"], ["at"], "removed")
    assert [(r["id"], r["at"]) for r in rows(live)] == [("b", 3)]
    sinks.compact_log(log, ["id"], ["at"], short)
    again = sinks.current_rows(sinks.read_log(spark, short, first.schema), ["id"], ["at"], "removed")
    assert [(r["id"], r["at"]) for r in rows(again)] == [("b", 3)]


def test_facts_by_year_and_pending(spark, tmp_path):
    cells = [(dt.date(y, 1, d), b, 1, 2, 1, 2) for y in (2021, 2022, 2023) for d in (1, 2) for b in ("7-9am (AM PEAK)", "Daily Total")]
    banded = spark.createDataFrame(cells, "date date, time_period string, a_entry long, a_exit long, total_entry long, total_exit long")
    source = str(tmp_path / "bands")
    # one station is not enough to split over; give it two
    banded = banded.withColumns({"b_entry": F.lit(0).cast("long"), "b_exit": F.lit(0).cast("long")})
    tables.write_facts(banded, source)
    stored = spark.read.parquet(source)
    assert tables.read_facts(spark, source, [2021]).count() == 2
    plan = tables.read_facts(spark, source, [2021])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [year" in plan
    done = spark.createDataFrame([(2021,)], "year int")
    out, manifest = str(tmp_path / "hours"), str(tmp_path / "manifest")
    sinks.append_ledger(done, manifest)
    todo = tables.transform_pending(stored, out, manifest)
    assert sorted(r["year"] for r in rows(todo)) == [2022, 2023]
    hours = spark.read.parquet(out)
    assert hours.count() == 2 * 2 * 3  # two hours and one daily total a day
    assert sorted(r["year"] for r in rows(spark.read.parquet(manifest))) == [2021, 2022, 2023]
    assert tables.union_years([banded, banded]).count() == 24


def test_stage_keeps_rows_and_size(spark):
    df = spark.range(100).withColumn("x", F.rand(1))
    kept = stage(df, "t")
    assert sorted(r.x for r in kept.collect()) == sorted(r.x for r in kept.collect())
    both = stage_all({"a": df, "b": spark.range(3).toDF("k")})
    assert both["a"].count() == 100 and both["b"].count() == 3
    plan = spark.range(10).join(both["b"], F.col("id") == F.col("k"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan  # by file size, without a hint


def changes(spark, cells):
    start = dt.datetime(2026, 1, 5, 1, 0)
    full = [(i, "Cubao", t, d, sev, s, start, start + dt.timedelta(minutes=m), m) for i, t, d, sev, s, m in cells]
    return spark.createDataFrame(
        full,
        "id string, station_name string, incident_type string, description string, severity string, status string, "
        "created_at timestamp, changed_at timestamp, change_id long",
    )


def test_incident_events(spark):
    df = changes(spark, [("1", "Other", "wet floor", "Critical", "pending", 1), ("2", "Other", "", "Warning", "pending", 1), ("3", "Sanitation", "x", "Info", "resolved", 1)])
    out = {r["source_id"]: r for r in rows(streams.incident_events(df, dims.friction_weights(spark)))}
    assert out["1"]["event_name"] == "Other: wet floor (Critical)" and out["1"]["id"] == "INC-0105-1"
    assert out["1"]["station"] == "Araneta Center Cubao" and float(out["1"]["normalized_score"]) == 1.0
    assert out["2"]["event_name"] == "Other (Warning)" and out["2"]["trigger_category"] == "Degraded Headway"
    assert out["3"]["removed"] and out["3"]["trigger_category"] == "Code Green" and float(out["3"]["normalized_score"]) == 0


def test_unknown_weight_is_zero(spark):
    df = changes(spark, [("1", "Other", "x", "Critical", "pending", 1)])
    none = dims.friction_weights(spark).filter("friction_domain = 'pagasa'")
    assert float(streams.incident_events(df, none).first().normalized_score) == 0


def test_resolved_times(spark):
    cells = [
        ("open", "Other", "", "Warning", "pending", 1),
        ("done", "Other", "", "Warning", "pending", 1), ("done", "Other", "", "Warning", "resolved", 5), ("done", "Other", "", "Warning", "resolved", 9),
        ("back", "Other", "", "Warning", "pending", 1), ("back", "Other", "", "Warning", "resolved", 2), ("back", "Other", "", "Warning", "acknowledged", 3),
        ("twice", "Other", "", "Warning", "pending", 1), ("twice", "Other", "", "Warning", "resolved", 2), ("twice", "Other", "", "Warning", "pending", 3), ("twice", "Other", "", "Warning", "resolved", 8),
        ("born", "Other", "", "Warning", "resolved", 1),
    ]
    out = {r["id"]: r["resolved_at"] and (r["resolved_at"] - dt.datetime(2026, 1, 5, 1)).seconds // 60 for r in rows(streams.resolved_times(changes(spark, cells)))}
    assert out == {"open": None, "done": 5, "back": None, "twice": 8, "born": None}


@pytest.fixture()
def event_files(spark, small, tmp_path):
    """The events table as several files in time order, to run as several micro-batches."""
    events = adapters.table(spark, small, "events")
    folder = str(tmp_path / "events")
    for i in range(4):
        events.filter((F.col("event_id") >= 250 * i) & (F.col("event_id") < 250 * (i + 1))).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_incident_stream_over_batches_equals_batch(spark, small, event_files, tmp_path):
    weights = dims.friction_weights(spark)
    raw = adapters.table(spark, small, "events")
    stream = adapters.incidents_of(streams.open_stream(spark, event_files, "*.parquet", raw.schema, 1))
    path = str(tmp_path / "log")
    streams.sync_incidents(stream, weights, path, str(tmp_path / "mark")).awaitTermination()
    batch = streams.incident_events(adapters.incidents_of(raw), weights)
    log = sinks.read_log(spark, path, batch.schema)
    assert log.select("batch_id").distinct().count() == 4
    key, order = ["source_id"], ["updated_at", "change_id"]
    got = sinks.current_rows(log, key, order, "removed").drop("batch_id")
    want = sinks.current_rows(batch, key, order, "removed").select(got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a restart from the same checkpoint finds nothing new
    again = adapters.incidents_of(streams.open_stream(spark, event_files, "*.parquet", raw.schema, 1))
    streams.sync_incidents(again, weights, path, str(tmp_path / "mark")).awaitTermination()
    assert sinks.read_log(spark, path, batch.schema).count() == log.count()


def reversed_files(df, folder, key, n=4):
    """The rows in ``n`` files, the last rows in the file that a stream reads first."""
    import os
    import time

    numbered = df.withColumn("_n", F.ntile(n).over(Window.orderBy(key)))
    for k in range(n):
        numbered.filter(F.col("_n") == k + 1).drop("_n").coalesce(1).write.mode("append").parquet(folder)
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    first = {f: df.sparkSession.read.parquet(f"{folder}/{f}").agg(F.min(key)).first()[0] for f in files}
    for age, f in enumerate(sorted(files, key=lambda f: first[f])):
        os.utime(f"{folder}/{f}", (time.time() - 100 * age - 1000,) * 2)
    return folder


def test_windows_lose_no_late_row(spark, small, tmp_path):
    raw = adapters.table(spark, small, "events")
    folder, path = reversed_files(raw, str(tmp_path / "events"), "ts"), str(tmp_path / "log")
    measures = {"n": ("count", "1"), "cents": ("sum", "CAST(round(value * 100) AS BIGINT)"), "last": ("max", "event_id"), "first": ("min", "event_id")}
    stream = streams.open_stream(spark, folder, "*.parquet", raw.schema, 1)
    streams.window_log(stream, path, str(tmp_path / "mark"), "ts", measures, ["event_type"]).awaitTermination()
    want = streams.hour_windows(raw, "ts", measures, ["event_type"])
    log = sinks.read_log(spark, path, want.schema)
    assert log.select("batch_id").distinct().count() == 4
    got = streams.merged_windows(log, measures, ["event_type"]).select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.agg(F.sum("n")).first()[0] == raw.count()


def test_density_stream_over_batches(spark, small, tmp_path):
    orders = adapters.table(spark, small, "orders")
    folder, path = reversed_files(orders, str(tmp_path / "orders"), "o_orderdate"), str(tmp_path / "log")
    stream = adapters.calendar_events_of(streams.open_stream(spark, folder, "*.parquet", orders.schema, 1))
    streams.density_log(stream, path, str(tmp_path / "mark")).awaitTermination()
    got = streams.merged_density(sinks.read_log(spark, path, "event_day date, station string, major_events long"))
    want = enrich.density_groups(adapters.calendar_events_of(orders)).select(got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_weather_ties_go_to_the_later_reading(spark, small, tmp_path):
    orders = adapters.table(spark, small, "orders")
    twice = adapters.readings_of(orders)
    twice = twice.unionByName(twice.withColumn("id", F.col("id") + 1_000_000).withColumn("wind_signal", F.lit(0)).withColumn("rainfall_mm", F.lit(0).cast("decimal(5,1)")))
    path, source = str(tmp_path / "weather"), str(tmp_path / "readings")
    twice.repartition(3).write.parquet(source)
    stream = streams.open_stream(spark, source, "*.parquet", twice.schema, 1)
    streams.sync_weather(stream, path, str(tmp_path / "mark")).awaitTermination()
    schema = enrich.consolidate_weather(twice).schema
    live = rows(sinks.current_rows(sinks.read_log(spark, path, schema), ["id"], streams.LAST_READING))
    assert len(live) == 13 and all(r["reading_id"] > 1_000_000 and r["normalized_score"] is not None for r in live)


def test_pending_years_survive_a_repeat(spark, tmp_path, monkeypatch):
    from flowgauge.operators.allocate import expand_bands

    names = ["total_entry", "total_exit"] + [f"{fixed.slug(s)}_{f}" for s in fixed.STATIONS for f in fixed.FLOWS]
    day = lambda y, n: (f"x{y}", dt.date(y, 3, 1), "Daily Total", *[n] * len(names))
    schema = "id string, date date, time_period string, " + ", ".join(f"{n} long" for n in names)
    banded, out, manifest = (str(tmp_path / n) for n in ("banded", "out", "manifest"))
    tables.write_facts(spark.createDataFrame([day(2020, 26), day(2021, 52)], schema), banded)
    read = lambda: tables.read_facts(spark, banded, totals=True)
    # a pass that dies before it records its years
    with monkeypatch.context() as patch:
        patch.setattr(tables, "append_ledger", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            tables.transform_pending(read(), out, manifest)
    assert sorted(r["year"] for r in rows(tables.transform_pending(read(), out, manifest))) == [2020, 2021]
    want = expand_bands(read().drop("year")).count()
    assert spark.read.parquet(out).count() == want
    assert tables.transform_pending(read(), out, manifest).count() == 0 and spark.read.parquet(out).count() == want
    tables.write_facts(spark.createDataFrame([day(2022, 26)], schema), banded)
    assert [r["year"] for r in rows(tables.transform_pending(read(), out, manifest))] == [2022]


def test_a_log_is_not_compacted_onto_itself(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("a", 1)], "id string, at int")
    sinks.log_batch(df, path, 0)
    with pytest.raises(ValueError):
        sinks.compact_log(sinks.read_log(spark, path, df.schema), ["id"], ["at"], path)


def test_weather_and_post_streams(spark, small, tmp_path):
    orders = adapters.table(spark, small, "orders")
    path = str(tmp_path / "weather")
    stream = streams.open_stream(spark, small, "orders.parquet", orders.schema)
    streams.sync_weather(adapters.readings_of(stream), path, str(tmp_path / "m1"), kind="forecast").awaitTermination()
    batch = enrich.consolidate_weather(adapters.readings_of(orders), "forecast")
    assert sinks.read_log(spark, path, batch.schema).drop("batch_id").exceptAll(batch).count() == 0


@pytest.mark.parametrize("by", [[], ["lang"]])
def test_post_stream_of_a_table_in_parts(spark, small, tmp_path, by):
    """A table stored as a folder of files, with or without partition columns, gives the rows of one stored as a file."""
    documents = adapters.table(spark, small, "documents")
    documents.repartition(3, "doc_id").write.partitionBy(*by).parquet(str(tmp_path / "documents.parquet"))
    run = spark_entry.queries()["stream_post_sync"]
    want, got = run(spark, small), run(spark, str(tmp_path))
    assert want.count() and not want.exceptAll(got).count() and not got.exceptAll(want).count()


def test_stream_of_a_table_reads_all_of_its_files(spark, small, tmp_path):
    events = adapters.table(spark, small, "events")
    events.repartition(3, "event_id").write.partitionBy("event_type").parquet(str(tmp_path / "events.parquet"))
    for folder in (small, str(tmp_path)):
        raw = adapters.table(spark, folder, "events")
        log, mark = new_folder(spark, "log"), new_folder(spark, "mark")
        streams.to_log(streams.open_table(spark, f"{folder}/events.parquet", raw.schema), log, mark).awaitTermination()
        read = spark.read.parquet(log).select(*events.columns)
        assert read.count() == events.count() and not events.exceptAll(read).count()


def test_broadcast_stamp_and_latency(spark, small, tmp_path):
    raw = adapters.table(spark, small, "events")
    stream = streams.open_stream(spark, small, "events.parquet", raw.schema).select(
        "event_id", F.current_timestamp().alias("ingestion_timestamp")
    )
    path = str(tmp_path / "log")
    streams.to_log(stream, path, str(tmp_path / "mark"), stamp="broadcast_timestamp").awaitTermination()
    log = streams.with_latency(spark.read.parquet(path))
    assert log.count() == raw.count()
    r = log.agg(F.min("latency_seconds").alias("low"), F.count_if(F.col("latency_sla_passed").isNull()).alias("bad")).first()
    assert r.low >= 0 and r.bad == 0
