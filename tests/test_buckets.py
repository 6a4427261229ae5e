"""State by bucket: what a batch touches, replays, late changes, and windows that close."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from flowgauge.operators import dims
from flowgauge.sources import adapters, buckets, sinks
from flowgauge.sources.buckets import BucketTable
from flowgauge.streaming import feeds as streams

ROW = "k string, at long, v long"


def last(stored, fresh):
    return sinks.latest_per_key(stored.unionByName(fresh), ["k"], ["at"])


def same(got, want):
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def table_of(spark, path, n=8):
    return BucketTable(str(path), spark.createDataFrame([], ROW).schema, ("k",), n)


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", 16)
    table.merge(spark.createDataFrame([(f"k{i}", 0, i) for i in range(200)], ROW), 0, last)
    before = table.heads(spark)
    assert sorted(before) == list(range(16)) and set(before.values()) == {0}
    touched = table.merge(spark.createDataFrame([("k7", 1, 70)], ROW), 1, last)
    after = table.heads(spark)
    assert len(touched) == 1 and [b for b in after if after[b] == 1] == touched
    assert table.read(spark).count() == 200
    assert [r["v"] for r in rows(table.read(spark).filter("k = 'k7'"))] == [70]


def test_a_replay_starts_from_the_heads_before(spark, tmp_path):
    table = table_of(spark, tmp_path / "t")
    add = lambda stored, fresh: stored.unionByName(fresh).groupBy("k").agg(F.max("at").alias("at"), F.sum("v").alias("v"))
    table.merge(spark.createDataFrame([("a", 0, 1), ("b", 0, 1)], ROW), 0, add)
    for _ in range(3):
        table.merge(spark.createDataFrame([("a", 1, 10)], ROW), 1, add)
    table.merge(spark.createDataFrame([("b", 2, 5)], ROW), 2, add)
    assert {r["k"]: r["v"] for r in rows(table.read(spark))} == {"a": 11, "b": 6}


def test_a_batch_that_died_before_its_heads_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path / "t")
    table.merge(spark.createDataFrame([("a", 0, 1)], ROW), 0, last)
    with monkeypatch.context() as patch:
        patch.setattr(buckets, "write_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.merge(spark.createDataFrame([("a", 1, 2)], ROW), 1, last)
    assert [r["v"] for r in rows(table.read(spark))] == [1]
    table.merge(spark.createDataFrame([("a", 1, 2)], ROW), 1, last)
    assert [r["v"] for r in rows(table.read(spark))] == [2]


def test_a_bucket_may_lose_all_its_rows(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", 2)
    keep = lambda stored, fresh: last(stored, fresh).filter("v > 0")
    table.merge(spark.createDataFrame([("a", 0, 1)], ROW), 0, keep)
    table.merge(spark.createDataFrame([("a", 1, 0)], ROW), 1, keep)
    assert table.read(spark).count() == 0 and table.heads(spark) == {}
    table.merge(spark.createDataFrame([("a", 2, 3)], ROW), 2, keep)
    assert table.read(spark).count() == 1
    table.merge(spark.createDataFrame([], ROW), 3, keep)
    assert table.read(spark).count() == 1


def test_old_versions_go_and_files_per_batch_do_not_grow(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path / "t", 4)
    read = []
    whole = BucketTable.read

    def counted(self, spark, heads=None):
        out = whole(self, spark, heads)
        read.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(BucketTable, "read", counted)
    for n in range(12):
        table.merge(spark.createDataFrame([(f"k{i}", n, n) for i in range(20)], ROW), n, last)
    assert max(read[2:]) <= max(read[1:3]) <= 4
    named = set(table.heads(spark).items()) | set(table.heads(spark, 11).items())
    left = {(int(b.removeprefix("bucket=")), int(f.removeprefix("batch="))) for f in buckets.children(spark, f"{table.path}/data") for b in buckets.children(spark, f"{table.path}/data/{f}") if b.startswith("bucket=")}
    assert left == named
    assert len(buckets.children(spark, f"{table.path}/heads")) == buckets.KEPT


@pytest.fixture(scope="module")
def event_parts(spark, small, tmp_path_factory):
    """The events in eight files that mix all times, to run as eight micro-batches."""
    raw = adapters.table(spark, small, "events")
    folder = str(tmp_path_factory.mktemp("events") / "in")
    raw.repartition(8, F.xxhash64("event_id")).write.parquet(folder)
    return raw, folder


def test_calendar_in_buckets_equals_the_batch(spark, event_parts, tmp_path):
    raw, folder = event_parts
    weights = dims.friction_weights(spark)
    batch = streams.incident_events(adapters.incidents_of(raw), weights)
    table = streams.calendar_table(str(tmp_path / "calendar"), batch.schema, 8)
    stream = lambda: adapters.incidents_of(streams.open_stream(spark, folder, "*.parquet", raw.schema, 1))
    streams.sync_calendar(stream(), weights, table, str(tmp_path / "mark")).awaitTermination()
    want = sinks.latest_per_key(batch, ["source_id"], ["updated_at", "change_id"])
    assert same(table.read(spark), want.select(table.schema.names))
    assert max(table.heads(spark).values()) == 7
    # a restart finds nothing new
    streams.sync_calendar(stream(), weights, table, str(tmp_path / "mark")).awaitTermination()
    assert max(table.heads(spark).values()) == 7


def test_resolutions_in_buckets(spark, event_parts, tmp_path, monkeypatch):
    raw, folder = event_parts
    read = []
    whole = BucketTable.read

    def counted(self, spark, heads=None):
        out = whole(self, spark, heads)
        read.append((len(heads or {}), len(out.inputFiles())))
        return out

    changes = adapters.incidents_of(streams.open_stream(spark, folder, "*.parquet", raw.schema, 1)).select("id", "status", "changed_at", "change_id")
    table = streams.resolution_table(str(tmp_path / "t"), changes.schema, 8)
    with monkeypatch.context() as patch:
        patch.setattr(BucketTable, "read", counted)
        streams.sync_resolutions(changes, table, str(tmp_path / "mark")).awaitTermination()
    # the files read by a batch are those of its buckets, however many batches there were
    assert len(read) == 8 and all(files <= n for n, files in read)
    got, want = streams.resolved_times(table.read(spark)), streams.resolved_times(adapters.incidents_of(raw))
    assert same(got, want)
    assert table.read(spark).count() < raw.count()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deciding_changes_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    start = dt.datetime(2026, 1, 5)
    cells = [(f"i{rng.randrange(6)}", rng.choice(["pending", "resolved", "resolved"]), start + dt.timedelta(minutes=rng.randrange(20)), n) for n in range(60)]
    cells += cells[:9]
    schema = spark.createDataFrame([], streams.CHANGE).schema
    table = streams.resolution_table(str(tmp_path / "t"), schema, 4)
    rng.shuffle(cells)
    for n in range(6):
        table.merge(spark.createDataFrame(cells[n::6], schema), n, lambda stored, fresh: streams.deciding_changes(stored.unionByName(fresh)))
    whole = streams.resolved_times(spark.createDataFrame(cells, schema))
    assert same(streams.resolved_times(table.read(spark)), whole)


def test_a_hot_incident_stays_rows_and_is_pruned(spark, tmp_path):
    stamp = (F.lit(1_767_571_200) + F.col("change_id")).cast("timestamp").alias("changed_at")
    hot = spark.range(3000).toDF("change_id").select(F.lit("hot").alias("id"), F.lit("resolved").alias("status"), stamp, "change_id")
    table = streams.resolution_table(str(tmp_path / "t"), hot.schema, 4)
    fold = lambda stored, fresh: streams.deciding_changes(stored.unionByName(fresh))
    table.merge(hot.filter("change_id % 2 = 0"), 0, fold)
    table.merge(hot.filter("change_id % 2 = 1"), 1, fold)
    # never open: any of them may still be the first one after an open change
    assert table.read(spark).count() == 3000
    opened = spark.createDataFrame([("hot", "pending", 2000)], "id string, status string, change_id long").select("id", "status", stamp, "change_id")
    table.merge(opened, 2, fold)
    assert table.read(spark).count() == 1001  # the open change, the resolved one of its time, and those after
    got = streams.resolved_times(table.read(spark)).first()
    assert got.status == "resolved" and got.resolved_at == streams.resolved_times(hot.unionByName(opened)).first().resolved_at


MEASURES = {"n": ("count", "1"), "cents": ("sum", "CAST(round(value * 100) AS BIGINT)"), "last": ("max", "event_id"), "first": ("min", "event_id")}


def window_run(spark, raw, folder, root, files=1):
    store = streams.window_store(raw, f"{root}/w", "ts", MEASURES, ["event_type"])
    stream = streams.open_stream(spark, folder, "*.parquet", raw.schema, files)
    streams.close_windows(stream, store, f"{root}/mark", "ts").awaitTermination()
    return store


@pytest.mark.parametrize("order", ["mixed", "ordered", "reversed"])
def test_closed_windows_and_corrections_equal_the_batch(spark, small, event_parts, tmp_path, order):
    from test_sinks_streams import reversed_files

    raw, folder = event_parts
    if order == "reversed":
        folder = reversed_files(raw, str(tmp_path / "events"), "ts")
    elif order == "ordered":
        folder = str(tmp_path / "events")
        for k in range(4):
            raw.filter((F.col("event_id") >= 250 * k) & (F.col("event_id") < 250 * (k + 1))).coalesce(1).write.mode("append").parquet(folder)
    store = window_run(spark, raw, folder, tmp_path)
    got = store.windows(spark)
    want = streams.hour_windows(raw, "ts", MEASURES, ["event_type"])
    assert same(got.drop("is_closed").select(want.columns), want)
    # each window is published once, and only what closed is
    closed = store.closed(spark)
    assert closed.count() == closed.select(*store.keys).distinct().count()
    mark = store.latest(spark).first()[0]
    assert mark == raw.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    border = F.lit(mark) - F.expr("INTERVAL 3 HOURS")
    assert closed.filter(F.col("window_start") > border).count() == 0
    assert store.opened(spark).filter(F.col("window_start") <= border).count() == 0
    # late rows only where the order made them late
    late = store.corrections(spark).agg(F.sum("n")).first()[0] or 0
    assert (late == 0) if order == "ordered" else late > 100
    # the state is the open windows, in the last two marks
    assert len(buckets.children(spark, f"{store.path}/open")) <= buckets.KEPT
    # a restart publishes nothing again
    window_run(spark, raw, folder, tmp_path)
    assert store.closed(spark).count() == closed.count()


def test_a_replayed_window_batch_changes_nothing(spark, small, event_parts, tmp_path):
    import shutil

    raw, folder = event_parts
    store = window_run(spark, raw, folder, tmp_path, files=4)
    before = [r.asDict() for r in store.windows(spark).collect()]
    # the second batch is forgotten by the checkpoint, and run again
    copy = tmp_path / "again"
    shutil.copytree(tmp_path / "w", copy / "w")
    shutil.copytree(tmp_path / "mark", copy / "mark")
    for name in ("1", ".1.crc"):
        (copy / "mark" / "commits" / name).unlink(missing_ok=True)
    store = window_run(spark, raw, folder, copy, files=4)
    after = [r.asDict() for r in store.windows(spark).collect()]
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    assert sorted(map(key, before)) == sorted(map(key, after))


def test_dispatch_numbers_come_from_the_last_mark(spark, tmp_path, monkeypatch):
    from flowgauge.operators import prescribe

    cells = [(dt.date(2026, 1, 5), f"{h:02d}:00", "Recto", "entry", "APTA-02", "Warning") for h in range(12)]
    df = spark.createDataFrame(cells, "date date, time string, station_name string, flow_type string, decision_action string, forecasted_threat_level string")
    folder = str(tmp_path / "in")
    df.repartition(4, "time").write.parquet(folder)
    known = spark.createDataFrame([("APTA-02",)], "id string")
    read = []
    monkeypatch.setattr(streams, "read_ledger", lambda spark, path, schema: read.append(path) or sinks.read_ledger(spark, path, schema))
    log, ledger = str(tmp_path / "log"), str(tmp_path / "ledger")
    stream = streams.open_stream(spark, folder, "*.parquet", df.schema, 1)
    streams.dispatch_on_cadence(stream, known, "run", "test", log, ledger, str(tmp_path / "mark")).awaitTermination()
    # no ledger is looked into but by the first batch
    assert sorted(set(read)) == sorted([log, ledger]) and len(read) == 2
    sent = sinks.read_log(spark, log, prescribe.DEPLOYMENT)
    done = sinks.read_log(spark, ledger, prescribe.EXECUTION)
    assert sorted(r.deployment_id for r in sent.collect()) == [f"DEP{n:06d}" for n in range(1, 13)]
    assert sorted(r.id for r in done.collect()) == list(range(1, 13))
