"""Incident, weather, post and window streams into change logs and bucket tables.

A log job appends one part per micro-batch, named by the batch id, so a replayed
batch overwrites itself and the log is exactly-once. Readers take the last change per
key; ``compact_log`` shortens the log. What a batch has to know of earlier ones is kept as
state it can find without reading them all: rows by key in a bucket table, of which a batch
reads and rewrites the buckets of its keys, or a mark that the last batch left.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowgauge import fixed
from flowgauge.functions import indices, labels
from flowgauge.operators import enrich, prescribe
from flowgauge.operators.numbering import last_number
from flowgauge.session import stage
from flowgauge.sources.buckets import BUCKETS, BucketTable, read_mark, versions, write_mark
from flowgauge.sources.sinks import latest_per_key, log_batch, read_ledger, read_log

#: What a batch of dispatches leaves for the next: the last numbers used.
NUMBERS = "deployments long, executions long"
#: Order of weather readings of one place.
LAST_READING = ["observed_or_forecasted_at", "reading_id"]


def open_stream(spark: SparkSession, folder: str, glob: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def open_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stored table as a stream, whether it is one file or a folder of them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
    if status.isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    # a file stream begins at a folder
    return open_stream(spark, status.getPath().getParent().toString(), place.getName(), schema)


def to_log(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str] | None = None,
    order: list[str] | None = None,
    mode: str = "append",
    interval: str | None = None,
    stamp: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Run a stream into a change log.

    With ``keys`` only the last change per key of a batch is written, with ``prepare``
    what it makes of a batch. ``stamp`` names a column that takes the time the batch is
    sent out. Without ``interval`` everything available is processed and the query ends.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        rows = latest_per_key(rows, keys, order) if keys else rows
        if stamp:
            rows = rows.withColumn(stamp, F.current_timestamp())
        log_batch(rows, path, batch_id)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def incident_events(incidents: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Incident changes as event-calendar changes; works on streams and batches.

    ``incidents``: id, station_name, incident_type, description, severity, status,
    created_at, changed_at, change_id, and optionally ``deleted``. Without ``weights``
    the built-in table is a literal map and nothing is joined.
    """
    gone = F.col("status") == "resolved"
    if "deleted" in incidents.columns:
        gone = gone | F.col("deleted")
    named = F.when(
        (F.col("incident_type") == "Other") & (F.coalesce("description", F.lit("")) != ""),
        F.concat(F.lit("Other: "), F.col("description")),
    ).otherwise(F.col("incident_type"))
    day = F.to_date("created_at")
    weight = F.coalesce(F.col("_weight").cast(indices.SCORE), F.lit(0).cast(indices.SCORE))
    rows = incidents.withColumn("trigger_category", indices.severity_trigger(F.col("severity")))
    if weights is None:
        table = {t: fixed.dec(w) for domain, t, w in fixed.FRICTION_WEIGHTS if domain == "operational"}
        rows = rows.withColumn("_weight", labels.lookup(F.col("trigger_category"), table))
    else:
        used = [*fixed.SEVERITY_TRIGGERS.values(), fixed.SEVERITY_DEFAULT]
        mine = weights.filter((F.col("friction_domain") == "operational") & F.col("trigger_category").isin(used))
        # at most the three triggers a severity can map to
        per_trigger = mine.groupBy("trigger_category").agg(F.max("friction_weight").alias("_weight"))
        rows = rows.join(F.broadcast(per_trigger), "trigger_category", "left")
    return rows.select(
        F.concat_ws("-", F.lit("INC"), F.date_format(day, "MMdd"), F.col("id").cast("string")).alias("id"),
        labels.station_alias(F.col("station_name")).alias("station"),
        day.alias("event_date"),
        F.lit("incidents").alias("source_table"),
        F.col("id").cast("string").alias("source_id"),
        F.lit("Ground Control System").alias("source_name"),
        F.concat(named, F.lit(" ("), F.col("severity"), F.lit(")")).alias("event_name"),
        F.lit("incident").alias("event_category"),
        F.lit("operational").alias("friction_domain"),
        "trigger_category",
        weight.alias("normalized_score"),
        weight.alias("friction_weight_ref"),
        F.col("created_at").alias("announcement_time"),
        F.col("changed_at").alias("updated_at"),
        "change_id",
        F.coalesce(gone, F.lit(False)).alias("removed"),
    )


def sync_incidents(
    incidents: DataFrame, weights: DataFrame | None, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Incident stream to the event-calendar log; a resolved or deleted incident is marked removed."""
    return to_log(
        incident_events(incidents, weights), path, checkpoint, ["source_id"], ["updated_at", "change_id"], interval=interval
    )


def resolved_times(changes: DataFrame) -> DataFrame:
    """Per incident: last status and, while resolved, when it became so.

    The stamp is the first resolved change after the last open one; reopening clears
    it, and an incident that was never open carries none. Two aggregates, both
    combined map-side.
    """
    at = F.struct("changed_at", "change_id")
    resolved = F.col("status") == "resolved"
    bounds = changes.groupBy("id").agg(
        F.max(F.when(~resolved, at)).alias("_last_open"),
        F.max_by("status", at).alias("status"),
    )
    after = changes.filter(resolved).join(bounds.select("id", "_last_open"), "id").filter(at > F.col("_last_open"))
    stamps = after.groupBy("id").agg(F.min(at).alias("_first"))
    return bounds.join(stamps, "id", "left").select("id", "status", F.col("_first.changed_at").alias("resolved_at"))


def calendar_table(path: str, schema: T.StructType, buckets: int = BUCKETS) -> BucketTable:
    """The event calendar that `sync_calendar` keeps; ``schema`` is that of `incident_events`."""
    return BucketTable(path, schema, ("source_id",), buckets)


def to_buckets(
    changes: DataFrame, table: BucketTable, fold: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Run a stream into a bucket table; ``fold(stored, changes)`` gives the new rows of the touched buckets."""
    spark = changes.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, batch_id, fold, spark)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def sync_calendar(
    incidents: DataFrame, weights: DataFrame | None, table: BucketTable, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Incident stream to the event calendar itself: one row an incident, the last change of each.

    Removed incidents stay as rows with ``removed`` set, as an older change may come late.
    """

    def fold(stored: DataFrame, fresh: DataFrame) -> DataFrame:
        return latest_per_key(stored.unionByName(fresh), ["source_id"], ["updated_at", "change_id"])

    return to_buckets(incident_events(incidents, weights), table, fold, checkpoint, interval)


#: A change of an incident's status, as far as its resolution stamp needs it.
CHANGE = "id string, status string, changed_at timestamp, change_id long"


def resolution_table(path: str, schema: T.StructType, buckets: int = BUCKETS) -> BucketTable:
    """The changes that `sync_resolutions` keeps; `resolved_times` of them are the stamps."""
    return BucketTable(path, schema, ("id",), buckets)


def deciding_changes(changes: DataFrame) -> DataFrame:
    """The changes that can still decide an incident's stamp, whatever comes later.

    These are its last change, its last open change and the resolved ones after that: a late
    open change can make any of these the first. Repeated changes count once. Two aggregates
    combined map-side and a join with one row an incident; no row holds more than one change.
    """
    at = F.struct("changed_at", "change_id")
    changes = changes.distinct()
    bounds = changes.groupBy("id").agg(
        F.max(F.struct("changed_at", "change_id", "status")).alias("_last"), F.max(F.when(F.col("status") != "resolved", at)).alias("_open")
    )
    last = F.struct("changed_at", "change_id", "status") == F.col("_last")
    return changes.join(bounds, "id").filter(F.col("_open").isNull() | (at >= F.col("_open")) | last).select(*changes.columns)


def sync_resolutions(changes: DataFrame, table: BucketTable, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Incident changes (id, status, changed_at, change_id) to the table of those that decide stamps.

    Changes may come in any order. A batch reads and rewrites the buckets of the incidents it
    changes; what can no longer decide anything is dropped there.
    """

    def fold(stored: DataFrame, fresh: DataFrame) -> DataFrame:
        return deciding_changes(stored.unionByName(fresh))

    return to_buckets(changes, table, fold, checkpoint, interval)


#: Measures of a window: name to kind and SQL expression. All kinds add up from parts.
Measures = dict[str, tuple[str, str]]
_KINDS: dict[str, tuple[Callable, Callable]] = {
    "count": (F.count, F.sum),
    "sum": (F.sum, F.sum),
    "max": (F.max, F.max),
    "min": (F.min, F.min),
}


def hour_windows(
    rows: DataFrame, time: str, measures: Measures, by: list[str] | None = None, zone: str = fixed.LOCAL_ZONE
) -> DataFrame:
    """Measures of hourly tumbling windows in local time."""
    timed = rows.withColumn("_ts", F.col(time).cast("timestamp"))
    sums = timed.groupBy(F.window("_ts", "1 hour"), *(by or [])).agg(*[_KINDS[k][0](F.expr(c)).alias(n) for n, (k, c) in measures.items()])
    local = F.from_utc_timestamp(F.col("window.start"), zone)
    return sums.select(F.to_date(local).alias("local_date"), F.hour(local).alias("local_hour"), *(by or []), *measures)


def window_log(
    rows: DataFrame, path: str, checkpoint: str, time: str, measures: Measures, by: list[str] | None = None, interval: str | None = None
) -> StreamingQuery:
    """Hourly windows of a stream as parts, one for each batch.

    A batch writes the windows of its own rows, however late these are: no watermark drops
    any and no state is kept. `merged_windows` adds the parts up.
    """
    return to_log(rows, path, checkpoint, interval=interval, prepare=lambda batch: hour_windows(batch, time, measures, by))


def merged_windows(log: DataFrame, measures: Measures, by: list[str] | None = None) -> DataFrame:
    """The windows of all parts."""
    keys = ["local_date", "local_hour", *(by or [])]
    return log.groupBy(*keys).agg(*[_KINDS[k][1](n).alias(n) for n, (k, _) in measures.items()])


def window_ends(delay: str, time: str = "_mark") -> Column:
    """Whether a window (start ``window_start``) ended ``delay`` before the time in a column; never while that is null."""
    return F.coalesce(F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= F.col(time) - F.expr(f"INTERVAL {delay}"), F.lit(False))


@dataclass(frozen=True)
class WindowStore:
    """Where `close_windows` keeps its windows.

    ``closed``: a log in which every window stands once, as it was when it closed;
    ``corrections``: a log of what came after that, as parts to add up; ``open``: a mark with the
    windows still open and the latest time seen.
    """

    path: str
    measures: Measures
    by: tuple[str, ...]
    rows: T.StructType

    @property
    def keys(self) -> list[str]:
        return ["window_start", *self.by]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("window_start", T.TimestampType()), *[f for f in self.rows.fields if f.name in (*self.by, *self.measures)]])

    def _log(self, spark: SparkSession, name: str) -> DataFrame:
        """A log up to the last batch that is complete."""
        done = versions(spark, f"{self.path}/latest")
        if not done:
            return spark.createDataFrame([], self.schema()).withColumn("batch_id", F.lit(None).cast("long"))
        return read_log(spark, f"{self.path}/{name}", self.schema()).filter(F.col("batch_id") <= done[-1])

    def closed(self, spark: SparkSession) -> DataFrame:
        return self._log(spark, "closed")

    def corrections(self, spark: SparkSession) -> DataFrame:
        return self._log(spark, "corrections")

    def opened(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        done = versions(spark, f"{self.path}/latest")
        before = before if before is not None else done[-1] + 1 if done else 0
        mark = read_mark(spark, f"{self.path}/open", self.schema(), before)
        return mark if mark is not None else spark.createDataFrame([], self.schema())

    def latest(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The latest event time seen, in one row or none."""
        mark = read_mark(spark, f"{self.path}/latest", "_mark timestamp", before)
        return mark if mark is not None else spark.createDataFrame([], "_mark timestamp")

    def added_up(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys).agg(*[_KINDS[k][1](n).alias(n) for n, (k, _) in self.measures.items()])

    def windows(self, spark: SparkSession, zone: str = fixed.LOCAL_ZONE) -> DataFrame:
        """All windows as they stand, in local time; ``is_closed`` says which were published."""
        closed, late = self.closed(spark).drop("batch_id"), self.corrections(spark).drop("batch_id")
        parts = self.added_up(closed.unionByName(late)).withColumn("is_closed", F.lit(True))
        parts = parts.unionByName(self.opened(spark).withColumn("is_closed", F.lit(False)))
        local = F.from_utc_timestamp(F.col("window_start"), zone)
        return parts.select(F.to_date(local).alias("local_date"), F.hour(local).alias("local_hour"), *self.by, *self.measures, "is_closed")


def window_store(rows: DataFrame, path: str, time: str, measures: Measures, by: list[str] | None = None) -> WindowStore:
    """The store for windows of such rows."""
    by = by or []
    parts = hour_windows(rows, time, measures, by)
    return WindowStore(path, measures, tuple(by), parts.select(*by, *measures).schema)


def close_windows(
    rows: DataFrame, store: WindowStore, checkpoint: str, time: str, delay: str = "2 HOURS", interval: str | None = None
) -> StreamingQuery:
    """Hourly windows of a stream, each published once when it closes.

    A window closes when a row that is later than its end by ``delay`` has been seen. Rows of
    a window that has closed are no longer added to it but written as corrections, so no row
    is lost in any order of the input. The state is the windows still open: a batch reads
    what the batch before left and writes its own, and a replay does so again. Rows without
    a time belong to no window.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn("_ts", F.col(time).cast("timestamp")).filter(F.col("_ts").isNotNull())
        own = [_KINDS[k][0](F.expr(c)).alias(n) for n, (k, c) in store.measures.items()]
        parts = timed.groupBy(F.window("_ts", "1 hour").alias("_window"), *store.by).agg(*own, F.max("_ts").alias("_seen"))
        parts = stage(parts.withColumn("window_start", F.col("_window.start")).drop("_window"), "window-parts", spark)
        # one row at most
        before = store.latest(spark, batch_id)
        after = stage(before.unionByName(parts.select(F.col("_seen").alias("_mark"))).agg(F.max("_mark").alias("_mark")), "latest")
        gone = parts.withColumn("_mark", before.agg(F.max("_mark")).scalar())
        gone = gone.withColumn("_late", window_ends(delay))
        names = store.schema().names
        log_batch(gone.filter("_late").select(*names), f"{store.path}/corrections", batch_id)
        known = store.opened(spark, batch_id).select(*names).unionByName(gone.filter("NOT _late").select(*names))
        windows = store.added_up(known).withColumn("_mark", after.scalar())
        windows = stage(windows.withColumn("_ended", window_ends(delay)), "windows")
        log_batch(windows.filter("_ended").select(*names), f"{store.path}/closed", batch_id)
        write_mark(windows.filter("NOT _ended").select(*names), f"{store.path}/open", batch_id)
        write_mark(after, f"{store.path}/latest", batch_id)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def density_log(
    events: DataFrame, path: str, checkpoint: str, day: str | Column = "event_date", interval: str | None = None
) -> StreamingQuery:
    """Major events per date and station as parts, one for each batch; no state is kept."""
    return to_log(events, path, checkpoint, interval=interval, prepare=lambda batch: enrich.density_groups(batch, day).drop("surge_score"))


def merged_density(log: DataFrame) -> DataFrame:
    """Count and density score per date and station of all parts."""
    counts = log.groupBy("event_day", "station").agg(F.sum("major_events").alias("major_events"))
    return counts.withColumn("surge_score", indices.surge_density(F.col("major_events")))


def sync_weather(readings: DataFrame, path: str, checkpoint: str, kind: str = "current", interval: str | None = None) -> StreamingQuery:
    """Weather readings to the scored weather log, last reading per id; of two at one time the later reading id."""
    return to_log(enrich.consolidate_weather(readings, kind), path, checkpoint, ["id"], LAST_READING, interval=interval)


def sync_posts(
    posts: DataFrame, weights: DataFrame | None, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Scraped posts to the event-calendar log, last version per id."""
    return to_log(
        enrich.consolidate_posts(posts, weights), path, checkpoint, ["id"], ["announcement_time", "source_id"], interval=interval
    )


def dispatch_on_cadence(
    recommended: DataFrame,
    protocols: DataFrame,
    run_id: str,
    source: str,
    deployments_path: str,
    ledger_path: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Evaluate and log recommendations as they come, one run for each batch.

    A row is received when its batch begins and sent out when its ledger part is written.
    Numbers go on from those of the batch before, which it left as a mark beside the ledger;
    only where there is no mark are the parts of earlier batches read. A replay overwrites
    its own parts.
    """
    marks = f"{ledger_path}-numbers"

    def now() -> str:
        return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")

    def earlier(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
        return read_ledger(spark, path, f"{schema}, batch_id long").filter(F.col("batch_id") < batch_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        received, spark = now(), batch.sparkSession
        rows = stage(batch, "dispatches")
        # one row: the last numbers used, and how many this batch adds
        last = read_mark(spark, marks, NUMBERS, batch_id)
        if last is None:
            sent = last_number(earlier(spark, deployments_path, prescribe.DEPLOYMENT, batch_id), "deployment_id", "DEP")
            logged = earlier(spark, ledger_path, prescribe.EXECUTION, batch_id).agg(F.coalesce(F.max("id"), F.lit(0).cast("long"))).scalar()
            last = spark.range(1).select(sent.alias("deployments"), logged.alias("executions"))
        last = stage(last.withColumn("added", rows.agg(F.count("*")).scalar()), "last-numbers")
        dispatched = prescribe.deployment_rows(rows, source, received, now(), last.select("deployments").scalar())
        log_batch(dispatched, deployments_path, batch_id)
        executed = prescribe.execution_rows(rows, protocols, f"{run_id}-{batch_id}", source, received, now(), last.select("executions").scalar())
        log_batch(executed, ledger_path, batch_id)
        write_mark(last.select((F.col("deployments") + F.col("added")).alias("deployments"), (F.col("executions") + F.col("added")).alias("executions")), marks, batch_id)

    writer = recommended.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def with_latency(log: DataFrame, received: str = "ingestion_timestamp", sent: str = "broadcast_timestamp") -> DataFrame:
    """Latency and SLA flag of rows stamped on their way out."""
    seconds = indices.seconds_between(F.col(received), F.col(sent))
    return log.withColumn("latency_seconds", seconds).withColumn(
        "latency_sla_passed", seconds < fixed.LATENCY_GATE_SECONDS
    )
