from __future__ import annotations

import random

from conftest import rows

from flowgauge.operators import dims, numbering
from flowgauge.functions.labels import padded
from pyspark.sql import functions as F


def test_numbers_follow_the_global_order(spark):
    rng = random.Random(2)
    data = [(rng.randrange(500), rng.choice("abc"), i) for i in range(5000)]
    df = spark.createDataFrame(data, "k int, g string, i int").repartition(7)
    got = rows(numbering.number_rows(df, ["k", "i"]), "number")
    assert [(r["k"], r["i"]) for r in got] == sorted((k, i) for k, _, i in data)
    assert [r["number"] for r in got] == list(range(1, 5001))


def test_numbers_restart_per_group_even_with_a_hot_group_and_ties(spark):
    data = [("hot" if i % 3 else f"g{i % 5}", 1, i) for i in range(6000)] + [(None, 1, 0), (None, 1, 1)]
    df = spark.createDataFrame(data, "g string, k int, i int").repartition(6)
    got = rows(numbering.number_rows(df, ["k"], ["g"]))
    for group in {r["g"] for r in got}:
        numbers = sorted(r["number"] for r in got if r["g"] == group)
        assert numbers == list(range(1, len(numbers) + 1))
    assert len({r["i"] for r in got if r["g"] == "hot"}) == 4000


def test_identical_rows_still_get_distinct_numbers(spark):
    df = spark.createDataFrame([("x", 1)] * 1000, "a string, b int").repartition(5)
    assert sorted(r["number"] for r in rows(numbering.number_rows(df, ["b"]))) == list(range(1, 1001))


def test_padding_never_truncates(spark):
    r = spark.range(1).select(padded(F.lit(7), 4).alias("a"), padded(F.lit(12345), 4).alias("b")).first()
    assert (r.a, r.b) == ("0007", "12345")


def test_weight_ids_and_rename(spark):
    raw = spark.createDataFrame(
        [
            ("pagasa", "B", 2), ("pagasa", "A", 2), ("Operational", "C", 1), ("lgu", "D", 1), ("academic", "Mid-Day Class Suspension", 1),
        ],
        "friction_domain string, trigger_category string, load_timestamp int",
    )
    out = dims.rename_category(dims.weight_dim(raw), "trigger_category", "Mid-Day Class Suspension", "Class Suspension / Holiday")
    assert {r["id"]: r["trigger_category"] for r in rows(out)} == {
        "FRI-PA01": "A", "FRI-PA02": "B", "FRI-OP01": "C", "FRI-XX01": "D", "FRI-AC01": "Class Suspension / Holiday",
    }


def test_tactics_split(spark):
    raw = spark.createDataFrame(
        [("S1", "• Hold: wait: here •  • Meter"), ("S2", ""), ("S3", None)], "apta_standard_code string, human_centric_ground_tactics string"
    )
    ids = spark.createDataFrame([("APTA-01", "S1"), ("APTA-02", "S2"), ("APTA-03", "S3")], "id string, apta_standard_code string")
    out = rows(dims.tactics(raw, ids), "id")
    assert [(r["id"], r["tactic_name"], r["tactic_description"]) for r in out] == [
        ("APTA-01-T01", "Hold", "wait"), ("APTA-01-T02", "Meter", ""),
    ]


def test_capacity_codes(spark):
    df = spark.createDataFrame([(" recto ",), ("Araneta Center-Cubao",), ("New Town",)], "station_name string")
    assert [r["id"] for r in dims.capacity_dim(df).collect()] == ["CAP-REC", "CAP-CUB", "CAP-NEW"]
