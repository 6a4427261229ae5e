"""Dimension tables: ids, codes, and bullet text in first normal form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import labels
from flowgauge.functions.labels import padded
from flowgauge.operators.numbering import number_rows, sequential_ids


def incident_dim(raw: DataFrame) -> DataFrame:
    """``PSOR-01`` ... by load time and text."""
    return sequential_ids(raw, "PSOR-", 2, ["load_timestamp", "specific_incident_transgression"]).select(
        "id", "category", "specific_incident_transgression", "load_timestamp"
    )


def capacity_dim(raw: DataFrame) -> DataFrame:
    """Platform capacity rows under their station code."""
    return raw.select(labels.capacity_code(F.col("station_name")).alias("id"), *raw.columns)


def protocol_dim(raw: DataFrame) -> DataFrame:
    """``APTA-01`` ... by load time and standard code, without the multi-valued column."""
    numbered = sequential_ids(raw, "APTA-", 2, ["load_timestamp", "apta_standard_code"])
    kept = [c for c in raw.columns if c != "human_centric_ground_tactics"]
    return numbered.select("id", *kept)


def tactics(raw: DataFrame, protocols: DataFrame, bullet: str = "•\\s*") -> DataFrame:
    """One row per bullet, numbered by position, split into name and description."""
    lines = F.filter(F.split("human_centric_ground_tactics", bullet, -1), lambda t: F.trim(t) != "")
    pieces = raw.select("apta_standard_code", F.posexplode(lines).alias("_at", "_tactic"))
    ids = protocols.select("apta_standard_code", F.col("id").alias("protocol_id"))
    return pieces.join(ids, "apta_standard_code").select(
        F.concat(F.col("protocol_id"), F.lit("-T"), padded(F.col("_at") + 1, 2)).alias("id"),
        "protocol_id",
        F.trim(F.split_part("_tactic", F.lit(":"), F.lit(1))).alias("tactic_name"),
        F.trim(F.split_part("_tactic", F.lit(":"), F.lit(2))).alias("tactic_description"),
    )


def weight_dim(raw: DataFrame) -> DataFrame:
    """``FRI-AC01`` ... numbered inside each friction domain."""
    numbered = number_rows(raw, ["load_timestamp", "trigger_category"], ["friction_domain"], "_n")
    prefix = labels.lookup(
        F.lower("friction_domain"), fixed.DOMAIN_PREFIXES, F.lit(fixed.DOMAIN_PREFIX_DEFAULT)
    )
    return numbered.select(F.concat(F.lit("FRI-"), prefix, padded(F.col("_n"), 2)).alias("id"), *raw.columns)


def rename_category(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """Conditional update of one column."""
    return df.withColumn(column, F.when(F.col(column) == old, F.lit(new)).otherwise(F.col(column)))


def friction_weights(spark) -> DataFrame:
    """The built-in friction weights as rows (22)."""
    rows = [(d, t, fixed.dec(w)) for d, t, w in fixed.FRICTION_WEIGHTS]
    return spark.createDataFrame(rows, "friction_domain string, trigger_category string, friction_weight decimal(3,2)")
