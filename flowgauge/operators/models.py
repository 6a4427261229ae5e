"""Distributed training of the volume forecaster and the threat classifier, its tuning by time, and stored models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions import indices, labels
from flowgauge.operators import evaluate, triggers
from flowgauge.operators.baselines import KEYS, threshold_baselines
from flowgauge.session import stage

NUMERIC = [*triggers.SCORES, "hour", "day_of_week", "month", "median_volume", "warning_threshold", "critical_threshold"]


def training_rows(features: DataFrame, baselines: DataFrame) -> DataFrame:
    """Features beside their baselines, numeric columns as doubles, gaps as zero."""
    rows = features.join(baselines, KEYS)
    rows = rows.withColumn("hour", labels.hour_of(F.col("hour_period"))).withColumn("month", F.month("date"))
    edges = F.col("warning_threshold"), F.col("critical_threshold")
    rows = rows.withColumn("threat_class", indices.congestion_class(F.col("historical_actual_volume"), *edges).cast("double"))
    rows = rows.withColumn("label", F.col("historical_actual_volume").cast("double"))
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMERIC})


def balanced_weights(rows: DataFrame, label: str = "threat_class") -> DataFrame:
    """Adds ``class_weight``: rows / (classes x rows of the class)."""
    # one row per class
    counts = rows.groupBy(label).agg(F.count("*").alias("_n"))
    share = counts.agg(F.sum("_n") / F.count("*")).scalar()
    weights = counts.select(label, (share / F.col("_n")).alias("class_weight"))
    return rows.join(F.broadcast(weights), label)


def _features() -> list:
    index = StringIndexer(
        inputCols=["station_name", "flow_type"], outputCols=["_station", "_flow"], handleInvalid="keep"
    )
    return [
        index,
        OneHotEncoder(inputCols=["_station"], outputCols=["_station_vec"], handleInvalid="keep"),
        VectorAssembler(inputCols=[*NUMERIC, "_station_vec", "_flow"], outputCol="features"),
    ]


def train_volume_model(rows: DataFrame, trees: int = 100, depth: int = 4, seed: int = 42) -> PipelineModel:
    """Gradient-boosted regression trees on volume."""
    booster = GBTRegressor(
        featuresCol="features", labelCol="label", predictionCol="predicted", maxIter=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[*_features(), booster]).fit(rows)


def train_threat_model(rows: DataFrame, trees: int = 100, depth: int = 6, seed: int = 42) -> PipelineModel:
    """Random forest on the congestion class, classes weighted evenly."""
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="threat_class",
        predictionCol="predicted_class",
        weightCol="class_weight",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
    )
    return Pipeline(stages=[*_features(), forest]).fit(balanced_weights(rows))


def model_outputs(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predictions in the shape the forecast operators read, never negative."""
    made = model.transform(rows)
    return made.select(
        "station_name",
        F.col("date").alias("prediction_date"),
        "hour_period",
        "flow_type",
        F.greatest(F.lit(0).cast("long"), F.round("predicted").cast("long")).alias("baseline_mean_forecast"),
    )


#: What trains a model on rows of `training_rows`.
Trainer = Callable[[DataFrame], PipelineModel]


def rolling_folds(rows: DataFrame, folds: int = 3, days: int = 28) -> DataFrame:
    """Folds by time: each is tested on ``days`` dates that have rows, and trained on all earlier ones.

    The last fold is tested on the last dates, the one before on those before them, and so on: fold,
    train_last, test_first, test_last, train_rows, test_rows. Folds with nothing to train on are left
    out. Only one row a date reaches the ranking window.
    """
    counts = rows.groupBy("date").agg(F.count("*").alias("_n"))
    order = Window.orderBy("date")
    ranked = counts.select(
        "date", "_n", F.row_number().over(order).alias("_at"), F.count("*").over(Window.partitionBy()).alias("_dates"),
        F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"), F.lag("date").over(order).alias("_last"),
    )
    left = F.col("_dates") - F.col("_at")
    fold = folds - F.floor(left / days)
    tested = ranked.filter((left < folds * days)).withColumn("fold", fold.cast("int"))
    whole = tested.groupBy("fold").agg(
        F.min_by("_last", "date").alias("train_last"),
        F.min("date").alias("test_first"),
        F.max("date").alias("test_last"),
        F.min_by("_before", "date").alias("train_rows"),
        F.sum("_n").alias("test_rows"),
    )
    return whole.filter(F.col("train_last").isNotNull())


def fold_errors(actuals: DataFrame, features: DataFrame, folds: DataFrame, trainers: dict[str, Trainer]) -> DataFrame:
    """Error of every candidate on every fold: fold, candidate, scored rows, rmse.

    The percentiles among the features come from the dates a fold is trained on. One training
    job a candidate and fold; the folds, a few, are the loop.
    """
    spark = actuals.sparkSession
    out = []
    for fold in folds.orderBy("fold").collect():
        known = actuals.filter(F.col("date") < F.lit(fold.test_first))
        rows = features.filter(F.col("date") <= F.lit(fold.test_last))
        rows = stage(training_rows(rows, stage(threshold_baselines(known), "fold-baselines")), "fold")
        train, test = rows.filter(F.col("date") < F.lit(fold.test_first)), rows.filter(F.col("date") >= F.lit(fold.test_first))
        for name, trainer in trainers.items():
            made = evaluate.matched(model_outputs(trainer(train), test), actuals)
            measured = evaluate.regression_metrics(made).first()
            out.append((fold.fold, name, measured.sample_count, measured.rmse))
    return spark.createDataFrame(out, "fold int, candidate string, scored_rows long, rmse double")


def best_candidate(errors: DataFrame) -> str | None:
    """The candidate with the smallest mean error over the folds, each fold alike; ties by name."""
    mean = errors.groupBy("candidate").agg(F.avg("rmse").alias("_error"))
    best = mean.agg(F.min(F.struct("_error", "candidate")).alias("best")).first().best
    return best.candidate if best else None


def save_model(model: PipelineModel, store: str, run_id: str) -> None:
    """Keep a fitted model under its run; a run that is stored again replaces its model."""
    model.write().overwrite().save(f"{store}/{run_id}")


def load_model(store: str, run_id: str) -> PipelineModel:
    return PipelineModel.load(f"{store}/{run_id}")
