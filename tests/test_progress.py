"""What streams report of themselves, checks made on write, years found by a file stream, and linear patterns."""

from __future__ import annotations

import time

from conftest import rows
from pyspark.sql import functions as F

from flowgauge.operators import allocate, enrich, quality
from flowgauge.plans import queries, settings
from flowgauge.session import stage
from flowgauge.sources import adapters, sinks, tables
from flowgauge.streaming import feeds as streams
from flowgauge.streaming import progress


def test_three_batches_give_three_ledger_rows(spark, small, tmp_path):
    raw = adapters.table(spark, small, "events")
    folder = str(tmp_path / "in")
    raw.repartition(3, "event_id").write.parquet(folder)
    ledger = progress.BatchLedger(spark, str(tmp_path / "ledger"))
    spark.streams.addListener(ledger)
    try:
        for _ in range(2):  # the second run has nothing to do, and adds nothing
            stream = progress.watched(streams.open_stream(spark, folder, "*.parquet", raw.schema, 1).withColumn("ingestion_timestamp", F.current_timestamp()))
            progress.run_watched(streams.to_log(stream, str(tmp_path / "log"), str(tmp_path / "mark")), ledger)
    finally:
        spark.streams.removeListener(ledger)
    found = rows(sinks.read_log(spark, ledger.path, progress.BATCH), "batch")
    assert [r["batch"] for r in found] == [0, 1, 2]
    assert sum(r["rows"] for r in found) == raw.count()
    assert all(r["first_received"] <= r["last_received"] <= r["dispatched_at"] and 0 <= r["latency_seconds"] < 60 for r in found)


def test_checks_are_counted_by_the_job_that_writes(spark, small):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    hours = allocate.expand_bands(allocate.restore_bands(queries.hour_table(spark, small), settings.HOURLY_SOURCE_YEAR))
    wrong = hours.withColumn("total_entry", F.when(F.dayofmonth("date") == 3, F.lit(-1).cast("long")).otherwise(F.col("total_entry")))
    for df in (hours, wrong, hours.limit(0)):
        watched, seen = quality.checked_on_write(df, quality.wide_rules(df, settings.HOURLY_SOURCE_YEAR), "hours")
        stored = stage(watched, "hours")
        got = quality.observed_checks(spark, seen)
        scanned = quality.wide_checks(stored, settings.HOURLY_SOURCE_YEAR).filter("check_name <> 'unique_ids'")
        want = scanned.unionByName(quality.not_empty({"hours": stored}))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_the_report_scans_the_hours_once(spark, small):
    plan = queries.QUERIES["quality_report"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    hours = [line for line in plan.splitlines() if "Relation [" in line and "total_entry" in line and "time_period" in line and "grain" in line]
    columns = [line for line in plan.splitlines() if "Relation [" in line and "grain" in line]
    assert len(columns) == 1 and len(hours) <= 1


def test_years_are_found_once(spark, small, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    banded = stage(queries.bands(spark, small).withColumn("year", F.year("date")), "banded")
    years = sorted(r.year for r in banded.select("year").distinct().collect())
    source, out, mark = (str(tmp_path / n) for n in ("banded", "hours", "mark"))

    def run():
        query = tables.discover_years(spark, source, banded.schema, out, mark)
        query.awaitTermination()
        return sum(p.numInputRows for p in query.recentProgress)

    banded.filter(F.col("year").isin(years[:2])).write.partitionBy("year").parquet(source)
    assert run() == banded.filter(F.col("year").isin(years[:2])).count()
    first = tables.read_discovered(spark, out).count()
    assert run() == 0 and tables.read_discovered(spark, out).count() == first
    # a new year, and a late file of an old one
    banded.filter(F.col("year") == years[2]).write.mode("append").partitionBy("year").parquet(source)
    banded.filter(F.col("year") == years[0]).limit(5).withColumn("id", F.concat("id", F.lit("-late"))).write.mode("append").partitionBy("year").parquet(source)
    assert run() == banded.filter(F.col("year") == years[2]).count() + 5
    got = tables.read_discovered(spark, out)
    want = allocate.expand_bands(banded.filter(F.col("year").isin(years[:3])).drop("year"))
    late = allocate.expand_bands(banded.filter(F.col("year") == years[0]).drop("year").limit(5))
    assert got.count() == want.count() + late.count()
    assert tables.read_discovered(spark, out, [years[2]]).count() == allocate.expand_bands(banded.filter(F.col("year") == years[2]).drop("year")).count()


TEXTS = [
    "class suspended", "classes will be\nsuspended", "suspend class", "suspend the class", "work is suspended", "suspension of work", "suspensions of work",
    "suspended  operations", "suspending transactions", "suspende class", "classy suspend", "class", "working suspend", "homework suspend", "suspension", "suspend suspend class",
    "CLASS x SUSPEND", "no suspension here, but office", "suspension office", "class suspension", "suspensionwork", "class suspend",
]


def test_the_linear_pattern_finds_the_same(spark):
    rule = next(r for r in enrich.RULES if r.linear)
    texts = [*TEXTS, *[f"{a} {b} {c}" for a in TEXTS for b in ("", "and") for c in TEXTS]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.filter(F.col("t").rlike(rule.pattern) != F.col("t").rlike(rule.linear)).count() == 0


def test_long_posts_cost_by_their_length(spark):
    rule = next(r for r in enrich.RULES if r.linear)
    for text in ("suspension class work ", "class work suspension of ", "suspended "):
        df = spark.createDataFrame([(1, text * 100_000)], "id long, post_text string")
        begin = time.monotonic()
        df.select(F.col("post_text").rlike(rule.linear)).collect()
        assert time.monotonic() - begin < 10
