from __future__ import annotations

import datetime as dt
import itertools
import re
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.operators import dims, enrich, feeds, quality

AT = dt.datetime(2026, 7, 1, 23, 16)  # 07:16 local on 2 July


def posts(spark, texts, at=AT):
    return spark.createDataFrame([(i, t, at) for i, t in enumerate(texts)], "id long, post_text string, posted_at timestamp")


CASES = [
    ("Coordination meeting about no classes", "administrative"),
    ("Planning of the fun run", "administrative"),
    ("Planning update: WALANG PASOK", "class_suspension"),
    ("#WalangPasok", "class_suspension"),
    ("Classes in all levels are hereby SUSPENDED", "class_suspension"),
    ("Work in offices will be suspended", "class_suspension"),
    ("suspension of office work", "class_suspension"),
    ("Special non-working holiday", "class_suspension"),
    ("Release of grades for the exam week", "administrative"),
    ("Student petition for leniency", "administrative"),
    ("Rainfall advisory no. 3", "weather_advisory"),
    ("Rainfall advisory: no classes", "class_suspension"),
    ("Christmas break begins", "school_break"),
    ("shift to asynchronous mode", "online_shift"),
    ("Tigil Pasada on Monday", "transport_strike"),
    ("PISTON to hold rally", "transport_strike"),
    ("UAAP finals", "major_event"),
    ("Midterm examination period", "exam_week"),
    ("Class starts late.\n\nTransport is\nsuspended", "class_suspension"),
    ("Midterm exams next week", "exam_week"),
    ("Enrolment opens", "regular_class_day"),
    ("Nothing here", "unclassified"),
    ("", "unclassified"),
]


def test_rules(spark):
    got = {r["post_text"]: r["event_category"] for r in rows(enrich.classify(posts(spark, [t for t, _ in CASES])))}
    assert got == dict(CASES)


def alternatives(pattern):
    """A few texts that match a rule's pattern, made from its wording."""
    body = re.sub(r"^\(\?is?\)", "", pattern)
    body = re.sub(r"\\s[+*]", " ", body).replace(".*", " ")
    texts = set()
    # expand (a|b) groups from the inside out
    todo = [body]
    while todo:
        text = todo.pop()
        hit = re.search(r"\(([^()]*)\)(\??)", text)
        if not hit:
            texts.add(re.sub(r"(\w)\?", r"\1", text))
            texts.add(re.sub(r"(\w)\?", "", text))
            continue
        options = hit.group(1).split("|") + ([""] if hit.group(2) else [])
        todo += [text[: hit.start()] + o + text[hit.end() :] for o in options]
    return [t for t in texts if re.search(pattern, t)]


@pytest.mark.parametrize("rule", enrich.RULES, ids=lambda r: f"{r.category}-{r.pattern[4:14]}")
def test_needs_cover_the_pattern(rule):
    texts = alternatives(rule.pattern)
    assert len(texts) >= 3
    for text in texts:
        assert any(n in text.lower() for n in rule.needs), text


words = st.sampled_from(
    "classes suspend walang pasok UAAP exam week meeting planning no class break sem strike Recto Manila the of 12 July break shift to online enrollment grade posting".split()
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(words, max_size=9).map(" ".join), min_size=50, max_size=120))
def test_prefilter_changes_nothing(spark, texts):
    bare = [enrich.Rule(r.category, r.trigger, r.affects, r.pattern, r.unless) for r in enrich.RULES]
    table = posts(spark, texts)
    a = [r.event_category for r in enrich.classify(table).orderBy("id").collect()]
    b = [r.event_category for r in enrich.classify(table, rules=bare).orderBy("id").collect()]
    assert a == b
    want = []
    for text in texts:
        hit = next((r for r in bare if re.search(r.pattern, text) and not (r.unless and re.search(r.unless, text))), None)
        want.append(hit.category if hit else "unclassified")
    assert a == want


def test_dates(spark):
    cases = [
        ("Classes off on July 5, 2026 and 9 August", dt.date(2026, 7, 5)),
        ("memo 9 August, see July 5, 2026", dt.date(2026, 8, 9)),
        ("on the 3rd of Sept. 2027", dt.date(2027, 9, 3)),
        ("mayor 12 said tomorrow", dt.date(2026, 7, 3)),
        ("bukas na", dt.date(2026, 7, 3)),
        ("February 31, 2026 tomorrow", dt.date(2026, 7, 3)),
        ("nothing", dt.date(2026, 7, 2)),  # local day, not the UTC day
        ("DEC 25", dt.date(2026, 12, 25)),
    ]
    out = {r["post_text"]: r["event_date"] for r in rows(enrich.with_event_date(posts(spark, [t for t, _ in cases])))}
    assert out == dict(cases)


def test_propagation(spark):
    out = enrich.propagate(posts(spark, ["suspension in Recto", "Quezon  City and PASIG", "everyone", "Rectory"]))
    got = {}
    for r in rows(out):
        got.setdefault(r["post_text"], set()).add(r["station"])
    assert got == {
        "suspension in Recto": {"Recto", "Legarda", "Pureza", "V. Mapa"},
        "Quezon  City and PASIG": {*fixed.CITY_STATIONS["Quezon City"], "Santolan"},
        "everyone": {"All Stations"},
        "Rectory": {"All Stations"},
    }
    assert sorted(itertools.chain(*fixed.CITY_STATIONS.values())) == sorted(fixed.STATIONS)


def test_consolidation_and_cancellation(spark):
    table = posts(spark, ["Walang pasok sa Recto", "Tigil pasada", "Planning session"]).selectExpr(
        "*", "'fb' AS source_name", "'u' AS source_url"
    )
    events = enrich.consolidate_posts(table, dims.friction_weights(spark))
    out = {r["id"]: r for r in rows(events)}
    assert set(out) == {"SCR-CS-0702-0-REC", "SCR-CS-0702-0-LEG", "SCR-CS-0702-0-PUR", "SCR-CS-0702-0-VMA", "SCR-TS-0702-1-ALL"}
    assert float(out["SCR-CS-0702-0-REC"]["normalized_score"]) == 1.0
    assert float(out["SCR-CS-0702-0-REC"]["friction_weight_ref"]) == 0.85
    assert float(out["SCR-TS-0702-1-ALL"]["normalized_score"]) == 0.9
    kept = enrich.drop_cancelled(events, spark.createDataFrame([("0",), ("0",)], "source_id string"), ["source_id"])
    assert [r["id"] for r in rows(kept)] == ["SCR-TS-0702-1-ALL"]
    # a later post that calls off the strike of that day, and names no suspension
    notice = posts(spark, ["Tigil pasada cancelled"]).selectExpr("*", "'fb' AS source_name", "'u' AS source_url")
    cancelled = enrich.consolidate_posts(notice.withColumn("id", F.lit(77)), dims.friction_weights(spark))
    kept = enrich.drop_cancelled(events, cancelled)
    assert "SCR-TS-0702-1-ALL" not in {r["id"] for r in rows(kept)} and kept.count() == 4
    report = quality.false_positives(events, table.withColumn("id", table.id.cast("string")))
    assert report.first().violations == 0


def density_events(spark):
    day = dt.date(2026, 1, 1)
    cells = [(i, day, "Recto", "major_event", 0.3) for i in range(3)] + [
        (3, day, "Gilmore", "major_event", 0.5),
        (4, day, "Gilmore", "holiday", 0.3),
        (5, day, None, "major_event", 0.5),
    ]
    return spark.createDataFrame([(*c[:4], Decimal(str(c[4]))) for c in cells], "id int, event_date date, station string, event_category string, normalized_score decimal(6,5)")


def test_density(spark):
    out = {r["id"]: (float(r["normalized_score"]), r["changed"]) for r in rows(enrich.rescore_density(density_events(spark)))}
    assert out == {0: (1.0, True), 1: (1.0, True), 2: (1.0, True), 3: (0.5, False), 4: (0.3, False), 5: (0.5, False)}
    groups = {r["station"]: (r["major_events"], float(r["surge_score"])) for r in rows(enrich.density_groups(density_events(spark)))}
    assert groups == {"Recto": (3, 1.0), "Gilmore": (1, 0.5), None: (1, 0.5)}
    report = {r["check_name"]: r["violations"] for r in rows(quality.event_checks(density_events(spark)))}
    assert report["surge_density"] == 1
    fixed_up = enrich.rescore_density(density_events(spark))
    assert {r["check_name"]: r["violations"] for r in rows(quality.event_checks(fixed_up))}["surge_density"] == 0


def test_weather_friction(spark):
    cells = [(0, 0.0, "None", 0.0), (0, 5.0, "None", 0.4), (1, 0.0, None, 0.4), (0, 0.0, "Yellow", 0.4), (2, 0.0, None, 0.8),
             (0, 41.0, None, 0.8), (0, 0.0, "Red", 0.8), (2, 41.0, None, 1.0), (None, None, None, 0.0), (0, 40.0, None, 0.4)]
    df = spark.createDataFrame([(i, "Recto", s, r, a, AT) for i, (s, r, a, _) in enumerate(cells)],
                               "id int, station string, wind_signal int, rainfall_mm double, advisory_level string, observed_at timestamp")
    out = rows(enrich.consolidate_weather(df, "forecast"), "id")
    assert {r["id"]: float(r["normalized_score"]) for r in out} == {f"WTH-FCT-{i}": c[3] for i, c in enumerate(cells)}
    assert enrich.consolidate_weather(df).first().id == "WTH-CUR-Recto"
    assert out[0]["weather_date"] == dt.date(2026, 7, 2)


def test_live_feed(spark):
    weather = spark.createDataFrame(
        [("w1", "Recto", 30.5, 31.0, "None", AT), ("w2", "Gilmore", 30.0, 0.0, "Heavy", AT), ("w3", "Anonas", None, 0.0, None, AT), ("w4", "Anonas", 1.0, 0.0, None, dt.datetime(2026, 7, 1, 10))],
        "id string, station string, temperature double, rainfall_mm double, computed_rainfall_level string, observed_at timestamp",
    )
    day = dt.date(2026, 7, 2)
    schema = "id string, station string, event_date date, source_name string, event_name string, event_category string, friction_domain string, normalized_score decimal(6,5), announcement_time timestamp, updated_at timestamp, source_url string, description string"
    events = spark.createDataFrame(
        [
            ("e2", "Recto", day, "B", "Walang Pasok", "class_suspension", "academic", Decimal("0.1"), None, AT, "u", "d"),
            ("e1", "Gilmore", day, "A", "Walang Pasok", "class_suspension", "academic", Decimal("0.2"), None, AT, None, None),
            ("e3", None, day, "A", "Fun run", "lgu", "academic", Decimal("0.5"), None, AT, None, None),
            ("e4", "Recto", day, "A", None, "misc", "lgu", Decimal("0.1"), None, AT, None, None),
            ("e5", "Recto", dt.date(2026, 7, 3), "A", "Later", "misc", "lgu", Decimal("0.1"), None, AT, None, None),
        ],
        schema,
    )
    feed = {r["trigger_id"]: r for r in rows(feeds.live_event_feed(feeds.weather_feed(weather, "2026-07-02", "S", "U", "D"), events, "2026-07-02"))}
    assert set(feed) == {"w1", "w2", "w3", "e1", "e3", "e4"}
    assert feed["w1"]["message"] == "Station: Recto - Temp: 30.5°C, Rain: 31.0mm (Normal)" and feed["w1"]["urgency"] == "critical"
    assert feed["w2"]["urgency"] == "warning" and feed["w3"]["message"] is None
    assert feed["e1"]["source"] == "A / B" and feed["e1"]["message"] == "Station: Gilmore, Recto - Walang Pasok"
    assert feed["e1"]["urgency"] == "critical"
    assert feed["e3"]["message"] is None and feed["e3"]["urgency"] == "warning" and feed["e3"]["source_type"] == "lgu"
    assert feed["e4"]["message"] == "Station: Recto - Event Notice" and feed["e4"]["urgency"] == "low"


def test_calendar_ids(spark):
    df = spark.createDataFrame([("UP", dt.date(2026, 7, 2), 7)], "s string, d date, i int")
    assert df.select(enrich.calendar_id(df.s, df.d, df.i).alias("x")).first().x == "CAL-UP-0702-7"


def test_domain_rules(spark):
    capacity = spark.createDataFrame([("Recto", 2500), ("Gilmore", 0)], "station_name string, max_safe_platform_capacity int")
    assert quality.rule_check(capacity, quality.capacity_rules()).first().violations == 1
    contacts = spark.createDataFrame([("09171234567",), ("123",), (None,)], "mobile string")
    assert quality.rule_check(contacts, quality.contact_rules()).first().violations == 1
    weights = spark.createDataFrame([(0.5,), (1.5,), (-0.1,)], "friction_weight double")
    assert quality.rule_check(weights, quality.weight_rules()).first().violations == 2
    incidents = spark.createDataFrame([("Other", "Critical", "pending"), ("Fire", "Info", "open")], "incident_type string, severity string, status string")
    assert [r.violations for r in quality.rule_check(incidents, quality.incident_rules()).collect()] == [1, 1, 1]
