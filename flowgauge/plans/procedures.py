"""The integer and void functions of the published surface as SQL scripts.

``publish`` makes a catalog schema with the tables that the scripts write, and the temporary
views that they read; after that a SQL user runs them, and needs nothing else::

    scripts = publish(spark, "line", folder, sources)
    spark.sql(scripts.refresh_predictive_forecast_1y())
    spark.sql(scripts.evaluate_and_log_prescriptive_deployments("run-7", "dashboard")).show()

Every script is one ``BEGIN ... END`` block and ends with the function's result; a void function
gives the rows its table has. What needs more than SQL says well, such as consecutive numbers
over a large order, lies in the views, which are plans like any other: publish again when
the frames behind them have changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices
from flowgauge.operators import prescribe
from flowgauge.operators.allocate import expand_bands
from flowgauge.operators.numbering import number_rows
from flowgauge.session import stage


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Scripts:
    """The scripts over the tables of one catalog schema."""

    schema: str

    def refresh_predictive_forecast_1y(self) -> str:
        """Put the year view into its table again."""
        return f"""
        BEGIN
          INSERT OVERWRITE {self.schema}.predictive_passenger_volume_forecast_1y SELECT * FROM vw_predictive_forecast_1y;
          SELECT count(*) AS stored FROM {self.schema}.predictive_passenger_volume_forecast_1y;
        END"""

    def evaluate_and_log_prescriptive_deployments(self, run_id: str, source: str) -> str:
        """Log every recommendation to both ledgers; ids go on from the last ones. Gives the number logged."""
        s = self.schema
        return f"""
        BEGIN
          DECLARE received TIMESTAMP DEFAULT current_timestamp();
          DECLARE last_deployment BIGINT;
          DECLARE last_execution BIGINT;
          SET last_deployment = (SELECT coalesce(max(CAST(substring(deployment_id, 4) AS BIGINT)), 0) FROM {s}.deployments);
          SET last_execution = (SELECT coalesce(max(id), 0) FROM {s}.executions);
          INSERT INTO {s}.deployments
            SELECT concat('DEP', CASE WHEN length(n) < 6 THEN lpad(n, 6, '0') ELSE n END), station_name, flow_type, decision_action,
              {text(source)}, 'Active', received, current_timestamp(), current_timestamp(), CAST(NULL AS TIMESTAMP)
            FROM (SELECT *, CAST(number + last_deployment AS STRING) AS n FROM numbered_recommendations);
          INSERT INTO {s}.executions
            SELECT number + last_execution, {text(run_id)}, {text(source)}, station_name, friction_score, decision_action, decision_action, received, sent,
              seconds, scr_compliant, seconds < {fixed.LATENCY_GATE_SECONDS}, {text(source)}, sent
            FROM (SELECT *, (unix_micros(sent) - unix_micros(received)) / 1000000.0D AS seconds
              FROM (SELECT *, current_timestamp() AS sent FROM numbered_recommendations));
          SELECT count(*) AS logged FROM numbered_recommendations;
        END"""

    def transform_ridership_table(self, year: int) -> str:
        """Expand one year of the banded table into its partition of the hours. Gives the hours of the year."""
        return f"""
        BEGIN
          {self._transform(str(int(year)))}
          SELECT count(*) AS hours FROM {self.schema}.ridership_hourly WHERE year = {int(year)};
        END"""

    def _transform(self, year: str) -> str:
        columns = "* EXCEPT (year)"
        return f"INSERT OVERWRITE {self.schema}.ridership_hourly PARTITION (year = {year}) SELECT {columns} FROM expanded_years WHERE year = {year};"

    def scan_and_transform_new_ridership_tables(self) -> str:
        """Expand every year that was not processed yet, and record it. Gives the number of these years."""
        s = self.schema
        command = f"'INSERT OVERWRITE {s}.ridership_hourly PARTITION (year = ' || y.year || ') SELECT * EXCEPT (year) FROM expanded_years WHERE year = ' || y.year"
        return f"""
        BEGIN
          DECLARE found BIGINT;
          SET found = (SELECT count(*) FROM source_years LEFT ANTI JOIN {s}.processed_years USING (year));
          FOR y AS SELECT year FROM source_years LEFT ANTI JOIN {s}.processed_years USING (year) ORDER BY year DO
            EXECUTE IMMEDIATE {command};
            INSERT INTO {s}.processed_years SELECT y.year;
          END FOR;
          SELECT found AS transformed;
        END"""

    def train_and_validate_models(self) -> str:
        """Append the evaluation of the models to the ledger; ids go on from the last one. Gives the rows of the ledger."""
        s = self.schema
        return f"""
        BEGIN
          DECLARE last_id BIGINT;
          SET last_id = (SELECT coalesce(max(id), 0) FROM {s}.evaluations);
          INSERT INTO {s}.evaluations SELECT id + last_id, * EXCEPT (id) FROM next_evaluation;
          SELECT count(*) AS stored FROM {s}.evaluations;
        END"""


@dataclass(frozen=True)
class Inputs:
    """What the scripts work on: the year view, recommendations and protocols, the banded table with its year, evaluation rows."""

    year: DataFrame
    recommended: DataFrame
    protocols: DataFrame
    banded: DataFrame
    evaluation: DataFrame


def numbered(recommended: DataFrame, protocols: DataFrame) -> DataFrame:
    """Recommendations with consecutive numbers in the ledgers' order, their score and whether the protocol is known."""
    rows = number_rows(recommended.select(*prescribe.ORDER, "forecasted_threat_level"), prescribe.ORDER)
    known = prescribe.known_flag(rows, "decision_action", protocols, "scr_compliant", prescribe.RECOMMENDED)
    return known.withColumn("friction_score", indices.ledger_score(F.col("forecasted_threat_level")))


def make_table(spark: SparkSession, name: str, folder: str, schema: str, partition: str | None = None) -> None:
    by = f"PARTITIONED BY ({partition})" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet {by} LOCATION {text(folder)}")


def columns_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def publish(spark: SparkSession, schema: str, folder: str, inputs: Inputs) -> Scripts:
    """Make the tables, empty where they are new, and the views; returns the scripts."""
    hours = expand_bands(inputs.banded.drop("year")).withColumn("year", F.year("date"))
    views = {
        "vw_predictive_forecast_1y": inputs.year,
        "numbered_recommendations": stage(numbered(inputs.recommended, inputs.protocols), "numbered"),
        "expanded_years": hours,
        "source_years": inputs.banded.select("year").distinct(),
        "next_evaluation": inputs.evaluation,
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION {text(f'{folder}/{schema}')}")
    tables = {
        "predictive_passenger_volume_forecast_1y": (columns_of(inputs.year), None),
        "deployments": (prescribe.DEPLOYMENT, None),
        "executions": (prescribe.EXECUTION, None),
        "ridership_hourly": (columns_of(hours), "year"),
        "processed_years": ("year int", None),
        "evaluations": (columns_of(inputs.evaluation), None),
    }
    for name, (columns, partition) in tables.items():
        make_table(spark, f"{schema}.{name}", f"{folder}/{schema}/{name}", columns, partition)
    return Scripts(schema)


def withdraw(spark: SparkSession, schema: str) -> None:
    """Take the schema out of the catalog; its files stay where they are."""
    spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")
