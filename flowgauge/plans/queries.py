"""The registered queries: each reads whole given tables and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge import fixed
from flowgauge.functions import indices, labels
from flowgauge.operators import (
    allocate,
    baselines,
    calendar,
    dims,
    enrich,
    evaluate,
    feeds,
    forecast,
    models,
    prescribe,
    quality,
    refresh,
    reshape,
    scenarios,
    sketches,
    triggers,
)
from flowgauge.plans import procedures, settings, views
from flowgauge.session import new_folder, spread, stage, stage_all, table_path
from flowgauge.sources import adapters, sinks, tables
from flowgauge.streaming import feeds as streams
from flowgauge.streaming import progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(fn(spark, folder))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text, for value comparison."""
    out = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(col.alias(field.name))
    return df.select(*out)


# --- shared parts ---------------------------------------------------------------------


def hour_wide(spark: SparkSession, folder: str) -> DataFrame:
    return stage(reshape.widen(adapters.flow(spark, folder)), "hour-wide")


def hour_table(spark: SparkSession, folder: str) -> DataFrame:
    return with_totals(hour_wide(spark, folder))


def with_totals(wide: DataFrame) -> DataFrame:
    """Hourly wide rows with daily totals, and monthly and peak totals in one year."""
    year = wide.filter(F.year("date") == settings.HOURLY_SOURCE_YEAR)
    return (
        wide.unionByName(reshape.total_rows(wide, "DAILY_TOTAL"))
        .unionByName(reshape.total_rows(year, "MONTHLY_TOTAL"))
        .unionByName(reshape.total_rows(year, "PEAK_TOTAL"))
    )


def bands(spark: SparkSession, folder: str) -> DataFrame:
    return allocate.restore_bands(hour_table(spark, folder), settings.HOURLY_SOURCE_YEAR)


PARTS: dict[str, Query] = {
    "baselines": lambda spark, folder: baselines.threshold_baselines(adapters.flow(spark, folder)),
    "weather": lambda spark, folder: triggers.hourly_weather(adapters.weather(spark, folder)),
    "scores": lambda spark, folder: triggers.station_scores(
        triggers.scope_scores(adapters.calendar_events(spark, folder))
    ),
    "forecast_scores": lambda spark, folder: triggers.station_scores(forecast_scopes(spark, folder)),
    "fanout_scores": lambda spark, folder: triggers.station_scores(forecast_scopes(spark, folder), fanout=True),
}


def forecast_scopes(spark: SparkSession, folder: str) -> DataFrame:
    return triggers.scope_scores(adapters.calendar_events(spark, folder), triggers.FORECAST_CIVIC, hour_aware=False)


def stored(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    """Small derived tables, written side by side so their size is known to whoever joins them."""
    parts = stage_all({name: PARTS[name](spark, folder) for name in names})
    return [parts[name] for name in names]


def stored_baselines(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "baselines")[0]


def descriptive(spark: SparkSession, folder: str) -> DataFrame:
    parts = stored(spark, folder, "baselines", "weather", "scores")
    return triggers.descriptive_metrics(adapters.flow(spark, folder), *parts)


def model(spark: SparkSession, folder: str, days: int) -> DataFrame:
    """The prior-week model's output for ``days`` days from today on; the scan reads the days before only."""
    today = dt.date.fromisoformat(settings.TODAY)
    first, last = today - dt.timedelta(days=7), today + dt.timedelta(days=days - 8)
    return evaluate.prior_week_model(adapters.flow(spark, folder, str(first), str(last)))


def metrics(spark: SparkSession, folder: str, scores: str = "forecast_scores", days: int = 366) -> DataFrame:
    base, weather, events = stored(spark, folder, "baselines", "weather", scores)
    return forecast.forecast(base, model(spark, folder, days), weather, events, settings.AS_OF, days)


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly facts, aggregated once: model, actuals and baselines all come from this copy."""
    return stage(adapters.flow(spark, folder), "facts")


def recommended(spark: SparkSession, folder: str) -> DataFrame:
    return prescribe.recommendations(metrics(spark, folder))


def protocols(spark: SparkSession, folder: str) -> DataFrame:
    return dims.protocol_dim(adapters.protocol_source(spark, folder))


def pairs(actuals: DataFrame) -> DataFrame:
    """Each week's volume beside the one that the week before predicts."""
    return evaluate.matched(evaluate.prior_week_model(actuals), actuals)


def graded(spark: SparkSession, folder: str) -> DataFrame:
    actuals = facts(spark, folder)
    return evaluate.graded(pairs(actuals), stage(baselines.threshold_baselines(actuals), "baselines"))


def month_start():
    return F.trunc("event_date", "month")


def allocate_rows(spark: SparkSession, folder: str, wide: DataFrame | None = None) -> DataFrame:
    return allocate.allocate_monthly(
        adapters.monthly_targets(spark, folder),
        hour_wide(spark, folder) if wide is None else wide,
        settings.ALLOCATE_START,
        settings.ALLOCATE_END,
        settings.BASE_YEAR,
    )


# --- reshape and baselines ------------------------------------------------------------


@query
def hourly_actuals(spark, folder):
    """Wide hourly rows with totals, back to long form."""
    return reshape.hourly_actuals(hour_table(spark, folder))


@query
def unpivot_flows(spark, folder):
    """Volume and cell count per station and flow of the unpivoted band table."""
    long = reshape.hourly_actuals(bands(spark, folder))
    return long.groupBy("station_name", "flow_type").agg(
        F.count("*").alias("cells"), F.count("volume").alias("filled"), F.sum("volume").alias("volume")
    )


@query
def threshold_baselines(spark, folder):
    return baselines.threshold_baselines(adapters.flow(spark, folder))


@query
def congestion_levels(spark, folder):
    return baselines.congestion_levels(adapters.flow(spark, folder), stored_baselines(spark, folder))


@query
def pending_years(spark, folder):
    """Ship years that no processed year covers; processing lags two years behind the orders."""
    ships = adapters.table(spark, folder, "lineitem").select(F.year("l_shipdate").alias("year"))
    done = adapters.table(spark, folder, "orders").select((F.year("o_orderdate") - 2).alias("year"))
    return tables.pending_years(ships, done)


@query
def transform_years(spark, folder):
    """Banded facts stored by year, the pending years expanded twice over, and the hourly facts read back.

    The second pass finds nothing to do, and one that died after writing writes the same again.
    """
    root = new_folder(spark, "years")
    tables.write_facts(bands(spark, folder), f"{root}/banded")
    banded = tables.read_facts(spark, f"{root}/banded", totals=True)
    for _ in range(2):
        tables.transform_pending(banded, f"{root}/hourly", f"{root}/manifest")
    hours = tables.read_facts(spark, f"{root}/hourly", totals=True)
    return hours.drop("year", "grain")


@query
def discovered_years(spark, folder):
    """Banded facts found by a file stream and expanded, in two runs: the second finds only the years that came since."""
    root = new_folder(spark, "discovered")
    rows = stage(bands(spark, folder).withColumn("year", F.year("date")), "banded")
    for test in (F.col("year") % 2 == 0, F.col("year") % 2 == 1):
        rows.filter(test).write.mode("append").partitionBy("year").parquet(f"{root}/banded")
        tables.discover_years(spark, f"{root}/banded", rows.schema, f"{root}/hourly", f"{root}/checkpoint").awaitTermination()
    return tables.read_discovered(spark, f"{root}/hourly").drop("year", "grain")


# --- allocation -----------------------------------------------------------------------


BUCKETS = 16


def bucketed_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly facts in buckets by the keys of the baselines."""
    tables.co_located(spark)
    return tables.store_bucketed(baselines.with_weekday(adapters.flow(spark, folder)), "bucketed-facts", baselines.KEYS, BUCKETS)


@query
def bucketed_congestion(spark, folder):
    """Actuals graded against baselines where they lie: both are stored in buckets by the same keys."""
    actuals = bucketed_facts(spark, folder)
    base = tables.store_bucketed(baselines.threshold_baselines(actuals), "bucketed-baselines", baselines.KEYS, BUCKETS)
    return baselines.congestion_levels(actuals, base)


@query
def bucketed_drift(spark, folder):
    """Drift of the prior-week model where the facts lie."""
    actuals = bucketed_facts(spark, folder)
    return forecast.model_drift(evaluate.prior_week_model(actuals), actuals)


SKETCHED = {"median": 0.5, "warning": 0.8, "critical": 0.9}


def price_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Single fares by station, flow and day, far more than one for each key and day."""
    return adapters.table(spark, folder, "lineitem").select(
        adapters.station_at(F.col("l_suppkey")).alias("station_name"),
        F.when(F.col("l_linestatus") == "O", "entry").otherwise("exit").alias("flow_type"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
    )


@query
def sketched_percentiles(spark, folder):
    """Percentiles by station, flow and year from stored day sketches, beside the exact rank of each estimate."""
    rows, keys, path = price_rows(spark, folder), ["station_name", "flow_type"], new_folder(spark, "day-sketches")
    days = sketches.day_sketches(rows, keys, "date", value="cents").withColumn("year", F.year("date"))
    days.repartition("year").write.partitionBy("year").parquet(path)
    found = stage(sketches.merged_percentiles(spark.read.parquet(path), [*keys, "year"], SKETCHED), "estimates")
    return sketches.rank_checks(rows.withColumn("year", F.year("date")), [*keys, "year"], "cents", found, SKETCHED)


@query
def sketched_baselines(spark, folder):
    """Baselines from stored day sketches of the actuals, beside the exact rank of each estimate."""
    actuals, path = adapters.flow(spark, folder), new_folder(spark, "volume-sketches")
    days = sketches.day_sketches(actuals, ["station_name", "hour_period", "flow_type"], "date", value="volume").withColumn("year", F.year("date"))
    days.repartition("year").write.partitionBy("year").parquet(path)
    found = stage(sketches.sketched_baselines(spark.read.parquet(path)), "estimates")
    return sketches.rank_checks(baselines.with_weekday(actuals), baselines.KEYS, "volume", found, baselines.LEVELS)


@query
def sketched_distinct(spark, folder):
    """Different users by month and kind of event from stored day sketches, beside the exact count."""
    rows = adapters.table(spark, folder, "events").select(F.col("ts").cast("date").alias("day"), "event_type", "user_id")
    path, by = new_folder(spark, "item-sketches"), [F.date_format("day", "yyyy-MM").alias("month"), "event_type"]
    sketches.day_sketches(rows, ["event_type"], "day", item="user_id").write.parquet(path)
    found = sketches.merged_distinct(spark.read.parquet(path), by, "estimate")
    exact = rows.groupBy(*by).agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("estimate") - F.col("users")) <= sketches.COUNT_ERROR * F.col("users")
    return exact.join(found, ["month", "event_type"]).select("month", "event_type", "users", near.alias("within_error"))


@query
def restore_bands(spark, folder):
    return bands(spark, folder)


@query
def expand_bands(spark, folder):
    return allocate.expand_bands(bands(spark, folder))


@query
def roundtrip_bands(spark, folder):
    """Bands expanded to hours and summed back: totals per band must be the ones put in."""
    hours = allocate.expand_bands(bands(spark, folder)).drop("id", "grain")
    back = allocate.restore_bands(hours, settings.HOURLY_SOURCE_YEAR)
    return back.select("id", "date", "time_period", "total_entry", "total_exit")


@query
def allocate_monthly(spark, folder):
    return allocate_rows(spark, folder)


@query
def nearest_date_map(spark, folder):
    """Every ship date and its nearest day of the base year."""
    days = adapters.table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return calendar.nearest_days(days, settings.BASE_YEAR)


@query
def daily_totals(spark, folder):
    return reshape.total_rows(hour_wide(spark, folder), "DAILY_TOTAL")


# --- scores ---------------------------------------------------------------------------


@query
def hourly_weather(spark, folder):
    return triggers.hourly_weather(adapters.weather(spark, folder))


@query
def event_scores(spark, folder):
    """The full date x station x hour grid of event scores."""
    return triggers.event_hour_scores(adapters.calendar_events(spark, folder))


@query
def suspension_decay(spark, folder):
    """Civic score of each suspension on its own, per hour of its day."""
    events = adapters.calendar_events(spark, folder).filter(F.col("event_category") == "class_suspension")
    alone = triggers.scope_scores(events.withColumn("station", F.col("id")))
    hours = alone.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return hours.select(
        F.col("scope").alias("id"), "event_date", "hour", triggers.civic_at(F.col("hour")).alias("civic_mandate_score")
    )


@query
def friction_index(spark, folder):
    """Index per date, hour and station of the observed rows."""
    rows = triggers.with_scores(adapters.flow(spark, folder), *stored(spark, folder, "weather", "scores"))
    return triggers.with_cfi(rows).select("date", "hour_period", "station_name", "flow_type", "cfi")


@query
def descriptive_metrics(spark, folder):
    return descriptive(spark, folder)


@query
def predictive_features(spark, folder):
    return triggers.predictive_features(adapters.flow(spark, folder), *stored(spark, folder, "weather", "scores"))


# --- forecast -------------------------------------------------------------------------


@query
def forecast_metrics(spark, folder):
    return metrics(spark, folder)


@query
def forecast_fanout(spark, folder):
    """Station and network events kept as separate rows, summed per station and flow."""
    rows = metrics(spark, folder, "fanout_scores")
    return rows.groupBy("station_name", "flow_type").agg(
        F.count("*").alias("rows"),
        F.sum("baseline_mean_forecast").alias("baseline"),
        F.sum("adjusted_forecast_volume").alias("predicted"),
        F.count_if(F.col("predicted_threat_level") == "Emergency").alias("emergencies"),
    )


@query
def forecast_24h(spark, folder):
    return forecast.forecast_24h(metrics(spark, folder, days=2), settings.AS_OF)


@query
def forecast_1w(spark, folder):
    return forecast.forecast_1w(metrics(spark, folder, days=7), settings.AS_OF)


@query
def forecast_1m(spark, folder):
    return forecast.forecast_1m(metrics(spark, folder, days=30), settings.AS_OF)


@query
def forecast_quarterly(spark, folder):
    return forecast.forecast_quarterly(metrics(spark, folder), settings.AS_OF)


@query
def forecast_1y(spark, folder):
    """The year rollup, stored and read back."""
    path = new_folder(spark, "forecast-1y")
    sinks.replace_table(forecast.forecast_1y(metrics(spark, folder), settings.AS_OF), path)
    return spark.read.parquet(path)


def year_sources(spark: SparkSession, folder: str) -> refresh.Sources:
    return refresh.Sources(
        facts=lambda dates: adapters.flow(spark, folder, dates=dates),
        weather=lambda dates: adapters.weather(spark, folder, dates),
        events=lambda dates: adapters.calendar_events(spark, folder, dates),
    )


def year_sources_before(spark: SparkSession, folder: str, changes: refresh.Changes) -> refresh.Sources:
    """The sources as they were before ``changes``: other volumes, calm weather, fewer events."""
    now = year_sources(spark, folder)

    def facts(dates):
        rows = now.facts(dates)
        return rows.withColumn("volume", F.when(F.col("date").isin(changes.facts), F.col("volume") * 5 + 900).otherwise(F.col("volume")))

    def weather(dates):
        rows = now.weather(dates)
        calm = F.lit(0).cast(rows.schema["normalized_score"].dataType)
        return rows.withColumn("normalized_score", F.when(F.col("weather_date").isin(changes.weather), calm).otherwise(F.col("normalized_score")))

    return refresh.Sources(facts, weather, lambda dates: now.events(dates).filter(~F.col("event_date").isin(changes.events)))


@query
def refreshed_year(spark, folder):
    """The stored year after one day of each source has changed: only what depends on these days is made again."""
    store = refresh.YearStore(new_folder(spark, "year"), settings.AS_OF)
    refresh.build_year(store, year_sources_before(spark, folder, settings.CHANGES))
    refresh.refresh_year(store, year_sources(spark, folder), settings.CHANGES)
    return refresh.stored_year(store)


@query
def ordered_views(spark, folder):
    """The long horizons in their published order: the place of each period, and whether its rows stand together in it."""
    rows = stage(metrics(spark, folder), "forecast")
    horizons = {
        "predictive_passenger_volume_forecast_1w": forecast.forecast_1w(rows, settings.AS_OF),
        "predictive_passenger_volume_forecast_1m": forecast.forecast_1m(rows, settings.AS_OF),
        "predictive_passenger_volume_forecast_quarterly": forecast.forecast_quarterly(rows, settings.AS_OF),
        "predictive_passenger_volume_forecast_1y": forecast.forecast_1y(rows, settings.AS_OF),
    }
    out = []
    for name in horizons:
        # numbered as they come, a sort's parts one after the other
        shown = stage(views.ordered(name, horizons).withColumn("_at", F.monotonically_increasing_id()), "shown")
        keys = [F.col(c).cast("string") for c in views.VIEW_ORDER[name]]
        periods = shown.groupBy(F.concat_ws(" ", *keys).alias("period"), *views.VIEW_ORDER[name]).agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
        # one row a period
        order = Window.orderBy("_first")
        apart = F.coalesce(F.lag("_last").over(order) < F.col("_first"), F.lit(True))
        out.append(periods.select(F.lit(name).alias("view_name"), "period", F.row_number().over(order).alias("place"), apart.alias("together")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query
def model_drift(spark, folder):
    actuals = facts(spark, folder)
    return forecast.model_drift(evaluate.prior_week_model(actuals), actuals)


@query
def station_status(spark, folder):
    base, weather, scores, coming = stored(spark, folder, "baselines", "weather", "scores", "forecast_scores")
    actuals = adapters.flow(spark, folder, settings.TODAY, settings.TODAY)
    seen = triggers.descriptive_metrics(actuals, base, weather, scores)
    rows = forecast.forecast(base, model(spark, folder, 2), weather, coming, settings.AS_OF, days=2)
    return forecast.station_status(
        base, seen, forecast.forecast_24h(rows, settings.STATUS_AS_OF), settings.STATUS_AS_OF
    )


@query
def capacity_classes(spark, folder):
    """Load and class of every forecast row of two days, over all hours of the clock (closed ones too)."""
    rows = metrics(spark, folder, days=2)
    hour = ((labels.hour_of(F.col("hour_period")) + F.length("station_name") * 7) % 24).cast("int")
    load = (F.col("hour"), F.col("adjusted_forecast_volume"), F.lit(None).cast("int"), *[F.col(c) for c in baselines.LEVELS])
    rows = rows.withColumnRenamed("baseline_mean_forecast", "median_volume").withColumn("hour", hour)
    return rows.select(
        "prediction_date", "hour_period", "station_name", "flow_type", "hour",
        indices.capacity_percent(*load).alias("capacity_percentage"), indices.capacity_status(*load).alias("status_classification"),
    )


@query
def known_events(spark, folder):
    return forecast.known_events(adapters.calendar_events(spark, folder), settings.AS_OF)


def published_scripts(spark: SparkSession, folder: str) -> procedures.Scripts:
    """The SQL scripts, over tables of their own."""
    actuals = facts(spark, folder)
    base, split = stage(baselines.threshold_baselines(actuals), "baselines"), evaluate.split_date(actuals)
    rows = stage(metrics(spark, folder), "forecast")
    inputs = procedures.Inputs(
        year=stage(forecast.forecast_1y(rows, settings.AS_OF), "forecast-1y"),
        recommended=prescribe.recommendations(rows),
        protocols=stage(protocols(spark, folder), "protocols"),
        banded=stage(bands(spark, folder).withColumn("year", F.year("date")), "banded"),
        evaluation=stage(evaluated(spark, folder, stage(pairs(actuals), "pairs"), base, split, actuals), "evaluation"),
    )
    path = new_folder(spark, "scripts")
    return procedures.publish(spark, f"line_{path.rsplit('-', 1)[-1]}", path, inputs)


@query
def sql_procedures(spark, folder):
    """Every script called in SQL, two runs each: what it gives back, and what its tables hold after it."""
    scripts = published_scripts(spark, folder)
    s, source, out = scripts.schema, "it's a script", []
    for run in (1, 2):
        calls = {
            "refresh_predictive_forecast_1y": scripts.refresh_predictive_forecast_1y(),
            "evaluate_and_log_prescriptive_deployments": scripts.evaluate_and_log_prescriptive_deployments(f"run {run}", source),
            "scan_and_transform_new_ridership_tables": scripts.scan_and_transform_new_ridership_tables(),
            "train_and_validate_models": scripts.train_and_validate_models(),
        }
        # one number a call
        out += [(run, name, spark.sql(script).first()[0]) for name, script in calls.items()]
    given = spark.createDataFrame(out, "run int, procedure string, result long")
    spark.sql(scripts.transform_ridership_table(settings.HOURLY_SOURCE_YEAR))
    held = spark.sql(
        f"""SELECT (SELECT count(DISTINCT deployment_id) FROM {s}.deployments) AS deployments, (SELECT max(id) FROM {s}.executions) AS last_execution,
          (SELECT count(*) FROM {s}.executions WHERE scr_compliant AND latency_seconds >= 0 AND trigger_source = {procedures.text(source)}) AS compliant,
          (SELECT count(*) FROM {s}.ridership_hourly) AS hours, (SELECT CAST(sum(total_entry) AS BIGINT) FROM {s}.ridership_hourly) AS entries,
          (SELECT CAST(sum(predicted) AS DOUBLE) FROM {s}.predictive_passenger_volume_forecast_1y) AS predicted, (SELECT max(id) FROM {s}.evaluations) AS evaluations"""
    )
    return given.withColumn("_held", held.select(F.struct("*")).scalar()).select("run", "procedure", "result", "_held.*")


# --- scenarios ------------------------------------------------------------------------


@query
def scenario_whatif(spark, folder):
    return scenarios.simulate_scenarios(adapters.scenarios(spark, folder), stored_baselines(spark, folder))


@query
def whatif_function(spark, folder):
    """The published table function, called in SQL for every station and once with a base given."""
    views.publish_views(spark, {"hourly_threshold_baselines": stored_baselines(spark, folder)})
    calls = [(s, s, "CAST(NULL AS DECIMAL(12,3))") for s in fixed.STATIONS] + [("base given", fixed.STATIONS[0], "1000")]
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS call, f.* FROM simulate_scenario('{station}', 1, '17:00', 'entry', 0.8, 1.0, 0.0, {base}) f"
            for name, station, base in calls
        )
    )


@query
def scenario_archive(spark, folder):
    """Two runs into one archive, read back: the second run's ids go on."""
    results = stage(scenarios.simulate_scenarios(adapters.scenarios(spark, folder), stored_baselines(spark, folder)), "scenarios")
    path = new_folder(spark, "archive")
    for _ in range(2):
        scenarios.record_scenarios(results, ["scenario_id"], settings.RECORDED_AT, path)
    return spark.read.parquet(path)


# --- prescription and audit -----------------------------------------------------------


@query
def recommendations(spark, folder):
    return recommended(spark, folder)


@query
def active_checklists(spark, folder):
    source = adapters.protocol_source(spark, folder)
    ids = stage(dims.protocol_dim(source), "protocols")
    return prescribe.active_checklists(
        recommended(spark, folder), ids, dims.tactics(source, ids), settings.STATUS_AS_OF
    )


@query
def tactical_guidelines(spark, folder):
    return prescribe.tactical_guidelines(protocols(spark, folder))


@query
def log_deployments(spark, folder):
    """Two runs into the deployment ledger, read back: the second run's ids go on."""
    rows, known = stage(recommended(spark, folder), "recommended"), stage(protocols(spark, folder), "protocols")
    root = new_folder(spark, "deployments")
    for run in ("run-1", "run-2"):
        prescribe.record_dispatches(
            rows, known, run, "validation_pipeline", settings.RECORDED_AT, "1998-06-15 00:00:02", f"{root}/deployments", f"{root}/ledger"
        )
    return spark.read.parquet(f"{root}/deployments").drop("run")


@query
def log_executions(spark, folder):
    """Execution-ledger rows, appended to a ledger and read back."""
    known = protocols(spark, folder).withColumn("id", F.regexp_replace("id", "^APTA-02$", "APTA-RETIRED"))
    rows = prescribe.execution_rows(
        recommended(spark, folder), known, settings.RUN_ID, "validation_pipeline", settings.RECORDED_AT, "1998-06-15 00:00:02"
    )
    path = new_folder(spark, "executions")
    sinks.append_ledger(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query
def compliance_audit(spark, folder):
    """Deployments against the protocols: ids 00 and, at small scale, none else are unknown."""
    return prescribe.compliance_audit(adapters.deployments(spark, folder), protocols(spark, folder))


@query
def latency_summary(spark, folder):
    return prescribe.latency_summary(adapters.deployments(spark, folder))


@query
def executive_summary(spark, folder):
    return prescribe.executive_summary(adapters.evaluations(spark, folder), adapters.executions(spark, folder))


def evaluated(spark: SparkSession, folder: str, part: DataFrame, base: DataFrame, split: DataFrame, records: DataFrame) -> DataFrame:
    """Ledger rows of the prior-week forecaster on matched pairs, with all gates."""
    sent = adapters.deployments(spark, folder)
    return evaluate.evaluation_rows(
        evaluate.regression_metrics(part),
        evaluate.weighted_f1(evaluate.graded(part, base)),
        settings.RUN_ID,
        split,
        settings.RECORDED_AT,
        records,
        prescribe.compliance_audit(sent, protocols(spark, folder)),
        prescribe.latency_summary(sent),
    )


@query
def kpi_accuracy(spark, folder):
    """Display figures from the measured error of the prior-week forecaster, its status from the gates."""
    actuals = facts(spark, folder)
    base = stage(baselines.threshold_baselines(actuals), "baselines")
    ledger = stage(evaluated(spark, folder, stage(pairs(actuals), "pairs"), base, evaluate.split_date(actuals), actuals), "evaluation")
    audit = prescribe.compliance_audit(adapters.deployments(spark, folder), protocols(spark, folder))
    certified = ledger.agg(F.bool_and("certified")).scalar()
    return prescribe.kpi_prediction_accuracy(
        evaluate.performance_rows(ledger), audit, fixed.DEFAULT_MAPE, fixed.DEFAULT_RMSE, certified
    )


# --- evaluation -----------------------------------------------------------------------


@query
def chrono_split(spark, folder):
    """Rows and dates on either side of the split date."""
    parts = evaluate.chronological_split(adapters.flow(spark, folder).select("date", "volume"))
    return parts.groupBy("part").agg(
        F.count("*").alias("rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("volume").alias("volume"),
    )


@query
def regression_metrics(spark, folder):
    return evaluate.regression_metrics(pairs(facts(spark, folder)))


@query
def class_scores(spark, folder):
    return evaluate.class_scores(graded(spark, folder))


@query
def weighted_f1(spark, folder):
    return evaluate.weighted_f1(graded(spark, folder))


@query
def evaluation_ledger(spark, folder):
    """Both models' ledger rows for the test part of the prior-week forecaster."""
    actuals = facts(spark, folder)
    split = stage(evaluate.split_date(actuals), "split")
    test = stage(pairs(actuals).filter(F.col("date") >= split.scalar()), "test-pairs")
    base = stage(baselines.threshold_baselines(actuals), "baselines")
    return evaluated(spark, folder, test, base, split, actuals)


@query
def performance_snapshot(spark, folder):
    """Latest row per model after two evaluations, merged by key over the seeded snapshot."""
    ledger = adapters.evaluations(spark, folder)
    rows = evaluate.performance_rows(ledger)
    latest = sinks.latest_per_key(rows, ["model_name"], ["last_trained_timestamp", "mape", "rmse", "classification_accuracy"])
    seed = rows.sparkSession.createDataFrame(
        [(fixed.VOLUME_MODEL, fixed.SEED_MAPE, fixed.SEED_RMSE, 0.0, 0.0), ("retired_model", 1.0, 2.0, 3.0, 4.0)],
        "model_name string, mape double, rmse double, classification_accuracy double, recall_score double",
    ).withColumn("last_trained_timestamp", F.lit("1990-01-01").cast("timestamp"))
    return sinks.upsert(seed, latest, ["model_name"])


@query
def train_forecaster(spark, folder):
    """Train both models on the earlier part: what they were given, and whether the result holds.

    The percentiles among the features, and the borders of the classes, come from the train
    part alone. The measured errors depend on the learners and are not part of the row;
    checks that hold for any data are.
    """
    actuals = facts(spark, folder)
    split = stage(evaluate.split_date(actuals), "split")
    known = actuals.filter(F.col("date") < split.scalar())
    base = stage(baselines.threshold_baselines(known), "train-baselines")
    features = triggers.predictive_features(actuals, *stored(spark, folder, "weather", "scores"))
    rows = models.training_rows(features, base)
    rows = stage(rows.withColumn("part", F.when(F.col("date") >= split.scalar(), "test").otherwise("train")), "training")
    train, test = rows.filter(F.col("part") == "train"), rows.filter(F.col("part") == "test")
    volume, threat = models.train_volume_model(train), models.train_threat_model(train)
    outputs = stage(models.model_outputs(volume, test), "outputs")
    classes = threat.transform(test).select("threat_class", "predicted_class")
    fitted = evaluate.regression_metrics(evaluate.matched(models.model_outputs(volume, train), actuals))
    spread_of_train = train.agg(F.stddev_pop("label")).scalar()
    in_class = [F.count_if((F.col("part") == p) & (F.col("threat_class") == c)).alias(f"{p}_class_{c}") for p in ("train", "test") for c in range(3)]
    sums = [F.round(F.sum(c), 4).alias(f"sum_{c}") for c in models.NUMERIC]
    return rows.agg(
        F.count_if(F.col("part") == "train").alias("train_rows"), F.count_if(F.col("part") == "test").alias("test_rows"), *in_class, *sums
    ).select(
        split.scalar().alias("split_date"),
        "*",
        *[F.round(F.col("train_rows") / (F.lit(3.0) * F.col(f"train_class_{c}")), 6).alias(f"weight_{c}") for c in range(3)],
        F.lit(volume.stages[-1].getNumTrees).alias("volume_trees"),
        F.lit(threat.stages[-1].getNumTrees).alias("threat_trees"),
        (outputs.agg(F.count("*")).scalar() == F.col("test_rows")).alias("one_output_per_row"),
        (outputs.agg(F.min("baseline_mean_forecast")).scalar() >= 0).alias("no_negative_output"),
        (classes.agg(F.count_if(F.col("predicted_class").isin(0, 1, 2))).scalar() == F.col("test_rows")).alias("one_class_per_row"),
        (fitted.select("rmse").scalar() < spread_of_train).alias("fits_better_than_mean"),
    )


@query
def tuned_forecaster(spark, folder):
    """Folds by time, the candidates measured on each, and the chosen one trained, stored and loaded again."""
    actuals = facts(spark, folder)
    features = stage(triggers.predictive_features(actuals, *stored(spark, folder, "weather", "scores")), "features")
    folds = stage(models.rolling_folds(features, folds=2, days=56), "folds")
    candidates = {
        f"trees-{trees}-deep-{depth}": lambda rows, t=trees, d=depth: models.train_volume_model(rows, t, d) for trees, depth in ((3, 2), (6, 3))
    }
    errors = stage(models.fold_errors(actuals, features, folds, candidates), "fold-errors")
    best = models.best_candidate(errors)
    rows = stage(models.training_rows(features, stage(baselines.threshold_baselines(actuals), "baselines")), "training")
    model, path = candidates[best](rows), new_folder(spark, "models")
    models.save_model(model, path, settings.RUN_ID)
    first, again = (m.transform(rows).select("date", *baselines.KEYS, "predicted") for m in (model, models.load_model(path, settings.RUN_ID)))
    keys = ["date", *baselines.KEYS]
    differ = first.join(again.withColumnRenamed("predicted", "_again"), keys).agg(F.count_if(F.col("predicted") == F.col("_again")) == F.count("*"))
    measured = errors.groupBy("fold").agg(F.count("*").alias("candidates"), F.min("scored_rows").alias("scored_rows"), F.min(F.col("rmse") > 0).alias("measured"))
    return folds.join(measured, "fold").withColumn("reloaded_equal", differ.scalar())


@query
def evaluation_history(spark, folder):
    """Two evaluations recorded one after the other; the history they leave."""
    actuals = facts(spark, folder)
    everything = stage(pairs(actuals), "pairs")
    base = stage(baselines.threshold_baselines(actuals), "baselines")
    ledger = stage(evaluated(spark, folder, everything, base, evaluate.split_date(actuals), actuals), "evaluation")
    seed = evaluate.performance_rows(adapters.evaluations(spark, folder))
    old = sinks.latest_per_key(seed, ["model_name"], ["last_trained_timestamp", "mape", "rmse", "classification_accuracy"])
    root = new_folder(spark, "evaluation")
    for _ in range(2):
        evaluate.record_evaluation(ledger, f"{root}/ledger", f"{root}/history", old)
    return spark.read.parquet(f"{root}/history")


# --- dimensions and keyed merges ------------------------------------------------------


@query
def incident_dim(spark, folder):
    return dims.incident_dim(adapters.incident_source(spark, folder))


@query
def capacity_codes(spark, folder):
    return dims.capacity_dim(adapters.capacity_source(spark, folder))


@query
def protocol_dim(spark, folder):
    return protocols(spark, folder)


@query
def tactics_normalised(spark, folder):
    source = adapters.protocol_source(spark, folder)
    return dims.tactics(source, dims.protocol_dim(source))


@query
def weight_dim(spark, folder):
    """Friction weights: ids per domain, one seeded row by upsert, one category renamed."""
    rows = dims.weight_dim(adapters.weight_source(spark, folder))
    seed = spark.createDataFrame(
        [fixed.SCHOOL_BREAK_SEED],
        "id string, friction_domain string, trigger_category string, specific_condition_api_input string, w string, "
        "ncr_literature_source_basis string, open_access_link string",
    ).select(
        "id", "friction_domain", "trigger_category", "specific_condition_api_input",
        F.col("w").cast("decimal(3,2)").alias("friction_weight"), "ncr_literature_source_basis", "open_access_link",
        F.lit("2024-01-01").cast("timestamp").alias("load_timestamp"),
    )
    updated = ["trigger_category", "specific_condition_api_input", "friction_weight", "ncr_literature_source_basis", "open_access_link"]
    merged = sinks.upsert(rows, seed, ["id"], updated)
    return dims.rename_category(merged, "trigger_category", "Mid-Day Class Suspension", "Class Suspension / Holiday")


@query
def upsert_latest(spark, folder):
    """Last change of every incident."""
    rows = adapters.incidents(spark, folder)
    return sinks.latest_per_key(rows, ["id"], ["changed_at", "change_id"]).select(
        "id", "station_name", "incident_type", "description", "severity", "status", "changed_at", "change_id"
    )


@query
def delete_resolved(spark, folder):
    """Event calendar of the open incidents."""
    changes = streams.incident_events(adapters.incidents(spark, folder))
    live = sinks.current_rows(changes, ["source_id"], ["updated_at", "change_id"], "removed")
    return live.drop("updated_at", "change_id", "removed")


@query
def resolved_times(spark, folder):
    return streams.resolved_times(adapters.incidents(spark, folder))


# --- enrichment -----------------------------------------------------------------------


@query
def classify_posts(spark, folder):
    return enrich.classify(spread(adapters.posts(spark, folder))).select(
        "id", "event_category", "trigger_category", "affects_ridership"
    )


@query
def post_event_dates(spark, folder):
    return enrich.with_event_date(spread(adapters.posts(spark, folder))).select("id", "event_date")


@query
def city_propagation(spark, folder):
    return enrich.propagate(spread(adapters.posts(spark, folder))).select("id", "station")


@query
def consolidated_posts(spark, folder):
    return enrich.consolidate_posts(spread(adapters.posts(spark, folder))).drop(
        "source_table", "friction_domain"
    )


@query
def cancellations(spark, folder):
    """Events of ordinary posts that no cancelling post names by station, date and kind."""
    posts = spread(adapters.posts(spark, folder))
    rows = enrich.consolidate_posts(posts, keep=["is_cancellation"]).select("id", "source_id", *enrich.CANCELLED_BY, "is_cancellation")
    rows = stage(rows, "consolidated")
    return enrich.drop_cancelled(rows.filter("NOT is_cancellation"), rows.filter("is_cancellation")).drop("is_cancellation", "event_category")


@query
def surge_density(spark, folder):
    """Density score per month and station."""
    return enrich.density_groups(adapters.calendar_events(spark, folder), month_start())


@query
def surge_density_daily(spark, folder):
    """Density score per date and station, the default key, beside what each event is rescored to."""
    events = adapters.calendar_events(spark, folder)
    groups = enrich.density_groups(events).select("event_day", F.coalesce("station", F.lit("")).alias("place"), "surge_score")
    rescored = enrich.rescore_density(events).filter("event_category = 'major_event'")
    sums = rescored.groupBy(F.col("event_date").alias("event_day"), F.coalesce("station", F.lit("")).alias("place")).agg(
        F.max("major_events").alias("major_events"), F.count_if("changed").alias("changed"), F.max("normalized_score").alias("rescored")
    )
    return groups.join(sums, ["event_day", "place"])


@query
def rescored_events(spark, folder):
    """Every event with its density score and whether a merge must rewrite it."""
    return enrich.rescore_density(adapters.calendar_events(spark, folder), month_start()).select(
        "id", "normalized_score", "major_events", "changed"
    )


@query
def weather_friction(spark, folder):
    return enrich.consolidate_weather(adapters.weather_readings(spark, folder), "forecast").drop("event_category", "reading_id")


@query
def live_feed(spark, folder):
    rows = feeds.weather_feed(
        adapters.weather_readings(spark, folder), settings.TODAY, "Weather Service", "https://example.org/w", "Live weather"
    )
    return feeds.live_event_feed(rows, adapters.calendar_events(spark, folder), settings.TODAY)


@query
def event_groups(spark, folder):
    """Feed groups of every date."""
    return feeds.event_groups(adapters.calendar_events(spark, folder))


# --- quality --------------------------------------------------------------------------


@query
def quality_report(spark, folder):
    """Wide-table, event, baseline, incident, deployment and weight checks in one report."""
    wide = hour_wide(spark, folder)
    events = adapters.calendar_events(spark, folder)
    posts = adapters.posts(spark, folder)
    filed = enrich.classify(spread(posts)).select(
        F.lit("academic_lgu_events").alias("source_table"), F.col("id").cast("string").alias("source_id"), "event_category"
    )
    hours = allocate.expand_bands(allocate.restore_bands(with_totals(wide), settings.HOURLY_SOURCE_YEAR))
    hours, on_write = quality.checked_on_write(hours, quality.wide_rules(hours, settings.HOURLY_SOURCE_YEAR), "hours")
    parts = stage_all(
        {
            "hours": hours,
            "allocated": allocate_rows(spark, folder, wide),
            "filed": filed,
            **{name: PARTS[name](spark, folder) for name in ("baselines", "weather", "scores")},
        }
    )
    hours, base = parts["hours"], parts["baselines"]
    scored = triggers.descriptive_metrics(adapters.flow(spark, folder), base, parts["weather"], parts["scores"])
    frames = [
        quality.observed_checks(spark, on_write),
        quality.duplicate_keys(hours, ["id"], "unique_ids"),
        quality.event_checks(events, month_start()),
        quality.baseline_check(base, 13 * 7 * 17 * 2),
        quality.cfi_check(scored),
        quality.false_positives(parts["filed"], posts),
        quality.conservation_check(adapters.monthly_targets(spark, folder), parts["allocated"]),
        quality.rule_check(adapters.incidents(spark, folder), quality.incident_rules()),
        quality.rule_check(adapters.deployments(spark, folder), quality.deployment_rules()),
        quality.rule_check(adapters.weight_source(spark, folder), quality.weight_rules()),
        quality.rule_check(adapters.capacities(spark, folder), quality.capacity_rules()),
        quality.rule_check(adapters.contacts(spark, folder), quality.contact_rules()),
        quality.not_empty({"events": events, "posts": posts}),
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@query
def prescriptive_report(spark, folder):
    """Integrity checks of the prescriptive layer."""
    return quality.prescriptive_checks(
        prescribe.platform_capacities(spark), protocols(spark, folder), adapters.deployments(spark, folder), recommended(spark, folder)
    )


@query
def first_backup(spark, folder):
    """A table backed up twice: the copy holds its first state."""
    path, rows = new_folder(spark, "backup"), protocols(spark, folder)
    sinks.snapshot_once(rows, path)
    sinks.snapshot_once(rows.withColumn("id", F.lit("changed")), path)
    return spark.read.parquet(path)


@query
def monthly_conservation(spark, folder):
    """Targets beside what the allocation produced; months outside the period stay empty."""
    return quality.conservation(adapters.monthly_targets(spark, folder), allocate_rows(spark, folder))


# --- streams --------------------------------------------------------------------------


def run_log(query_start, spark: SparkSession, label: str) -> str:
    """Run a stream over everything available; returns the log it wrote."""
    root = new_folder(spark, label)
    running = query_start(f"{root}/log", f"{root}/checkpoint")
    running.awaitTermination()
    return f"{root}/log"


def source_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return streams.open_table(spark, table_path(folder, name), adapters.table(spark, folder, name).schema)


#: Buckets of the streams' state; a deployment takes as many as its state needs.
STATE_BUCKETS = 16


@query
def stream_incident_sync(spark, folder):
    """Incident stream to the event calendar, kept in buckets: its live rows."""
    changes = adapters.incidents_of(source_stream(spark, folder, "events"))
    weights = dims.friction_weights(spark)
    schema = streams.incident_events(adapters.incidents(spark, folder), weights).schema
    root = new_folder(spark, "incident-sync")
    calendar = streams.calendar_table(f"{root}/calendar", schema, STATE_BUCKETS)
    streams.sync_calendar(changes, weights, calendar, f"{root}/checkpoint").awaitTermination()
    return calendar.read(spark).filter("NOT removed").drop("updated_at", "change_id", "removed")


@query
def stream_incident_log(spark, folder):
    """Incident stream to a log of event-calendar changes; the live state of the log."""
    changes = adapters.incidents_of(source_stream(spark, folder, "events"))
    weights = dims.friction_weights(spark)
    path = run_log(lambda log, mark: streams.sync_incidents(changes, weights, log, mark), spark, "incident-log")
    schema = streams.incident_events(adapters.incidents(spark, folder), weights).schema
    log = sinks.read_log(spark, path, schema)
    live = sinks.current_rows(log, ["source_id"], ["updated_at", "change_id"], "removed")
    return live.drop("updated_at", "change_id", "removed", "batch_id")


WINDOW_MEASURES = {
    "events": ("count", "1"),
    "value_cents": ("sum", "CAST(round(value * 100) AS BIGINT)"),
    "last_event": ("max", "event_id"),
}


@query
def stream_hour_windows(spark, folder):
    """Hourly windows of the event stream by type, in local time."""
    stream, by = source_stream(spark, folder, "events"), ["event_type"]
    path = run_log(lambda log, mark: streams.window_log(stream, log, mark, "ts", WINDOW_MEASURES, by), spark, "hour-windows")
    schema = streams.hour_windows(adapters.table(spark, folder, "events"), "ts", WINDOW_MEASURES, by).schema
    return streams.merged_windows(sinks.read_log(spark, path, schema), WINDOW_MEASURES, by)


@query
def stream_batch_ledger(spark, folder):
    """The ledger of a stream's batches: how many, their rows, and whether all are stamped in order."""
    root, events = new_folder(spark, "batch-ledger"), adapters.table(spark, folder, "events")
    events.repartition(3, "event_id").write.parquet(f"{root}/in")
    stream = streams.open_stream(spark, f"{root}/in", "*.parquet", events.schema, files_per_trigger=1)
    stream = progress.watched(stream.withColumn("ingestion_timestamp", F.current_timestamp()))
    ledger = progress.BatchLedger(spark, f"{root}/ledger")
    spark.streams.addListener(ledger)
    try:
        progress.run_watched(streams.to_log(stream, f"{root}/log", f"{root}/checkpoint"), ledger)
    finally:
        spark.streams.removeListener(ledger)
    rows = sinks.read_log(spark, f"{root}/ledger", progress.BATCH)
    in_order = (F.col("first_received") <= F.col("last_received")) & (F.col("last_received") <= F.col("dispatched_at"))
    return rows.agg(
        F.count("*").alias("batches"), F.sum("rows").alias("rows"), F.count_if(in_order & (F.col("latency_seconds") >= 0)).alias("stamped")
    )


@query
def stream_surge_density(spark, folder):
    """Density per month and station from the order stream."""
    events = adapters.calendar_events_of(source_stream(spark, folder, "orders"))
    path = run_log(lambda log, mark: streams.density_log(events, log, mark, month_start()), spark, "density")
    density = streams.merged_density(sinks.read_log(spark, path, "event_day date, station string, major_events long"))
    # groups without a station are the network's
    return density.withColumn("station", F.coalesce("station", F.lit("(network)")))


@query
def stream_weather_sync(spark, folder):
    """Weather stream to its log; last reading per station, with its score."""
    readings = adapters.readings_of(source_stream(spark, folder, "orders"))
    path = run_log(lambda log, mark: streams.sync_weather(readings, log, mark), spark, "weather-sync")
    schema = enrich.consolidate_weather(adapters.weather_readings(spark, folder)).schema
    live = sinks.current_rows(sinks.read_log(spark, path, schema), ["id"], streams.LAST_READING)
    return live.drop("batch_id", "event_category")


@query
def stream_post_sync(spark, folder):
    """Post stream to the event-calendar log."""
    posts = adapters.posts_of(source_stream(spark, folder, "documents"))
    path = run_log(lambda log, mark: streams.sync_posts(posts, None, log, mark), spark, "post-sync")
    schema = enrich.consolidate_posts(adapters.posts(spark, folder)).schema
    log = sinks.read_log(spark, path, schema)
    live = sinks.current_rows(log, ["id"], ["announcement_time", "source_id"])
    return live.drop("batch_id", "source_table", "friction_domain")


@query
def stream_resolved_times(spark, folder):
    """Resolution stamps kept by a stream: each batch rewrites the buckets of the incidents it changes."""
    changes = adapters.incidents_of(source_stream(spark, folder, "events")).select("id", "status", "changed_at", "change_id")
    root = new_folder(spark, "resolved")
    table = streams.resolution_table(f"{root}/changes", changes.schema, STATE_BUCKETS)
    streams.sync_resolutions(changes, table, f"{root}/checkpoint").awaitTermination()
    return streams.resolved_times(table.read(spark))


@query
def stream_closed_windows(spark, folder):
    """Hourly windows published once when they close, with corrections, from files in which every tenth row comes late."""
    events, root = adapters.table(spark, folder, "events"), new_folder(spark, "closed-windows")
    late = F.when(F.col("event_id") % 10 == 3, 3).otherwise(0)
    # days in order, every tenth row with those three days later
    arrival = F.datediff(F.col("ts"), F.lit("1970-01-01")) + late
    events.repartitionByRange(5, arrival).write.parquet(f"{root}/in")
    stream = streams.open_stream(spark, f"{root}/in", "*.parquet", events.schema, files_per_trigger=1)
    store = streams.window_store(events, f"{root}/windows", "ts", WINDOW_MEASURES, ["event_type"])
    streams.close_windows(stream, store, f"{root}/checkpoint", "ts").awaitTermination()
    return store.windows(spark)


@query
def stream_dispatches(spark, folder):
    """Recommendations logged batch by batch: per station and protocol the dispatches, the compliant and the stamped ones."""
    root = new_folder(spark, "cadence")
    recommended(spark, folder).repartition(3, "station_name").write.parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    stream = streams.open_stream(spark, f"{root}/in", "*.parquet", schema, files_per_trigger=1)
    known = stage(protocols(spark, folder), "protocols")
    streams.dispatch_on_cadence(stream, known, "cadence", "cadence", f"{root}/log", f"{root}/ledger", f"{root}/mark").awaitTermination()
    ledger = streams.with_latency(sinks.read_log(spark, f"{root}/ledger", prescribe.EXECUTION))
    sent = sinks.read_log(spark, f"{root}/log", prescribe.DEPLOYMENT)
    return ledger.groupBy("station_name", F.col("recommended_protocol_id").alias("decision_action")).agg(
        F.count("*").alias("dispatches"),
        F.count_if("scr_compliant").alias("compliant"),
        F.count_if(F.col("latency_seconds") >= 0).alias("stamped"),
    ).withColumn("deployments", sent.agg(F.count_distinct("deployment_id")).scalar()).withColumn("last_id", ledger.agg(F.max("id")).scalar())
