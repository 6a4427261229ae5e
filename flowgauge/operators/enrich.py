"""Posts and notices: category, date, affected stations, score, cancellation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge import fixed
from flowgauge.functions import indices, labels


@dataclass(frozen=True)
class Rule:
    """First rule whose ``pattern`` occurs, and whose ``unless`` does not, decides.

    ``needs`` lists lower-case literals of which every match holds at least one. They
    are searched first, as plain substrings, so the pattern only runs on texts that
    can match; with no ``needs`` it runs on all. ``linear`` is the same pattern for an
    engine that goes back: one whose cost grows with the length of a text, not its square.
    """

    category: str
    trigger: str
    affects: bool
    pattern: str
    unless: str | None = None
    needs: tuple[str, ...] = ()
    linear: str | None = None


# The rule order, and the patterns of the suspension and online-shift rules, which are
# published ones with one correction ("suspension" must match where only verb forms were listed).
# Where only prose describes a rule, the wording is our own.
RULES = [
    Rule("administrative", "Administrative", False, fixed.PLANNING_STRICT, needs=("meeting", "visit", "session", "coordination")),
    Rule(
        "administrative",
        "Administrative",
        False,
        fixed.PLANNING_LOOSE,
        fixed.EXPLICIT_DISRUPTION,
        needs=("meeting", "ocular", "planning", "preparation", "discussion"),
    ),
    Rule(
        "administrative",
        "Administrative",
        False,
        r"(?i)(release\s+of\s+grades|grades?\s+(posting|release|encoding)|posting\s+of\s+grades"
        r"|dropping\s+of\s+subjects?|deliberation)",
        needs=("grade", "subject", "deliberation"),
    ),
    Rule(
        "administrative",
        "Administrative",
        False,
        r"(?i)(petition|academic\s+(leniency|ease)|medical\s+(checkup|mission)|dental|job\s+fair|id\s+processing)",
        needs=("petition", "academic", "medical", "dental", "fair", "processing"),
    ),
    Rule(
        "weather_advisory",
        "LGU Weather / Flooding Advisory",
        False,
        r"(?i)(rainfall\s+(advisory|warning)|weather\s+(monitoring|update)|river\s+maintenance|flood(ed)?\s+(update|advisory|road))",
        fixed.EXPLICIT_DISRUPTION,
        needs=("rainfall", "weather", "river", "flood"),
    ),
    Rule(
        "school_break",
        "School Break",
        True,
        r"(?i)(semestral\s+break|sem\s+break|christmas\s+(break|vacation)|summer\s+(break|vacation)|term\s+break)",
        needs=("break", "vacation"),
    ),
    Rule(
        "class_suspension",
        "Class Suspension / Holiday",
        True,
        r"(?is)(walang\s*pasok|no\s+class(es)?|(regular|special)\s+(non-working\s+)?holiday)",
        needs=("walang", "class", "holiday"),
    ),
    Rule(  # of its own, so that only texts that hold the word are searched for what may stand far apart
        "class_suspension",
        "Class Suspension / Holiday",
        True,
        r"(?is)(class(es)?\s+.*suspend|work\s+.*suspend|suspen(d(ed|ing)?|sion)\s+.*(class|office|work|transaction|operation))",
        needs=("suspen",),
        # of two words that may stand far apart, the first one's first place decides: no other is tried
        linear=r"(?is)\A(?>.*?(?:class(?:es)?|work)\s).*suspend|\A(?>.*?suspen(?:d(?:ed|ing)?|sion)\s).*(?:class|office|work|transaction|operation)",
    ),
    Rule(
        "online_shift",
        "Online / Asynchronous Class Shift",
        True,
        r"(?i)(shift\s+to\s+(online|asynchronous)|online\s+synchronous\s+classes|remote\s+learning)",
        needs=("shift", "online", "remote"),
    ),
    Rule(
        "transport_strike",
        "Transport Strike",
        True,
        r"(?i)(tigil\s*pasada|transport\s+strike|jeepney\s+strike|welga|piston|manibela)",
        needs=("tigil", "strike", "welga", "piston", "manibela"),
    ),
    Rule(
        "major_event",
        "Major Arena Event",
        True,
        r"(?i)(uaap|ncaa|arena|concert|pep\s+rally|sports?\s+(day|fest))",
        needs=("uaap", "ncaa", "arena", "concert", "rally", "sport"),
    ),
    Rule(
        "exam_week",
        "University Exam Week",
        True,
        r"(?i)((midterm|final)s?\s+exam|exam(ination)?\s+(week|period))",
        needs=("exam",),
    ),
    Rule(
        "regular_class_day",
        "Regular Class Day",
        False,
        r"(?i)(orientation|enrol?lment|start\s+of\s+classes|first\s+day\s+of\s+classes)",
        needs=("orientation", "enrol", "classes"),
    ),
]
# Short codes of the categories in event ids
CATEGORY_CODES = {
    "administrative": "AD",
    "weather_advisory": "WA",
    "school_break": "SB",
    "class_suspension": "CS",
    "online_shift": "OS",
    "transport_strike": "TS",
    "major_event": "ME",
    "exam_week": "EW",
    "regular_class_day": "RC",
}
FULL_SCORE_CATEGORIES = ["class_suspension", "school_break", "online_shift"]

_MONTH = (
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?"
    r"|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
DATE_PATTERN = (
    rf"(?i)\b(?:{_MONTH}\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?\b(?:,?\s+(\d{{4}})\b)?"
    rf"|(\d{{1,2}})(?:st|nd|rd|th)?\s+(?:of\s+)?{_MONTH}\b\.?(?:,?\s+(\d{{4}})\b)?)"
)
TOMORROW_PATTERN = r"(?i)\b(tomorrow|bukas)\b"
_MONTHS = {m: i for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}


def holds_any(lowered: Column, words: tuple[str, ...]) -> Column:
    """Whether a lower-cased text holds one of the literals."""
    return reduce(lambda x, y: x | y, [F.contains(lowered, F.lit(w)) for w in words])


def classify(posts: DataFrame, text: str = "post_text", rules: list[Rule] = RULES) -> DataFrame:
    """Adds event_category, trigger_category and affects_ridership by the first matching rule.

    The matching rule's position is found once; the three columns are looked up from it.
    It comes out of a generator, so a later filter on the category stays above the text
    search instead of repeating it below.
    """
    body, lowered = F.col(text), F.col("_lowered")
    position = None
    for i, rule in enumerate(rules):
        hit = body.rlike(rule.linear or rule.pattern)
        if rule.needs:
            hit = holds_any(lowered, rule.needs) & hit
        if rule.unless:
            hit = hit & ~body.rlike(rule.unless)
        position = F.when(hit, i) if position is None else position.when(hit, i)
    found = F.col("_rule")

    def column(values: list, default) -> Column:
        return labels.lookup(found, dict(enumerate(values)), F.lit(default))

    placed = posts.withColumn("_lowered", F.lower(text)).select(
        *posts.columns, F.explode_outer(F.array(position.otherwise(len(rules)))).alias("_rule")
    )
    return placed.withColumns(
        {
            "event_category": column([r.category for r in rules], "unclassified"),
            "trigger_category": column([r.trigger for r in rules], "Unclassified"),
            "affects_ridership": column([r.affects for r in rules], False),
        }
    ).drop("_rule")


def with_event_date(
    posts: DataFrame, text: str = "post_text", posted_at: str = "posted_at", zone: str = fixed.LOCAL_ZONE
) -> DataFrame:
    """Adds ``event_date``: the earliest explicit day in the text, else tomorrow when it says
    so, else the local post day.

    The text is searched once for the first date; its parts are read from the short match.
    """
    found = posts.withColumns(
        {
            "_day_text": F.regexp_extract(text, DATE_PATTERN, 0),
            "_post_day": F.to_date(F.from_utc_timestamp(posted_at, zone)),
        }
    )
    match, post_day = F.col("_day_text"), F.col("_post_day")

    def part(*groups: int) -> Column:
        return F.coalesce(*[F.nullif(F.regexp_extract(match, DATE_PATTERN, g), F.lit("")) for g in groups])

    month = labels.lookup(F.lower(F.substring(part(1, 5), 1, 3)), _MONTHS).cast("string")
    year = F.coalesce(part(3, 6), F.year(post_day).cast("string"))
    written = F.when(match != "", F.try_to_date(F.concat(year, F.lit("-"), month, F.lit("-"), part(2, 4)), "yyyy-M-d"))
    relative = F.when(F.col(text).rlike(TOMORROW_PATTERN), F.date_add(post_day, 1)).otherwise(post_day)
    return found.withColumn("event_date", F.coalesce(written, relative)).drop("_day_text", "_post_day")


def _city_pattern(city: str, stations: list[str]) -> str:
    names = dict.fromkeys([city, *stations])
    words = "|".join(n.replace(".", r"\.").replace(" ", r"\s+") for n in names)
    return rf"(?i)\b({words})\b"


def _city_needs(city: str, stations: list[str]) -> tuple[str, ...]:
    """The longest word of each name, lower case; any mention holds it."""
    return tuple(dict.fromkeys(max(n.lower().split(), key=len) for n in [city, *stations]))


def affected_stations(text: Column, lowered: Column, cities: dict[str, list[str]] | None = None) -> Column:
    """All stations of every city the text names, or names a station of; none means the network."""
    cities = cities or fixed.CITY_STATIONS
    none = F.array().cast("array<string>")

    def members(city: str, names: list[str]) -> Column:
        named = holds_any(lowered, _city_needs(city, names)) & text.rlike(_city_pattern(city, names))
        return F.when(named, F.array(*[F.lit(n) for n in names])).otherwise(none)

    return F.concat(*[members(city, names) for city, names in cities.items()])


def propagate(posts: DataFrame, text: str = "post_text", cities: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per affected station; a post that names no place affects the whole network."""
    found = posts.withColumn("_lowered", F.lower(text)).withColumn(
        "_stations", affected_stations(F.col(text), F.col("_lowered"), cities)
    )
    network = F.array(F.lit("All Stations"))
    places = F.when(F.size("_stations") > 0, F.col("_stations")).otherwise(network)
    # never empty, so the outer form keeps the same rows and adds no size test below
    return found.withColumn("station", F.explode_outer(places)).drop("_stations", "_lowered")


#: What a cancelling post says is off: it names these as the post it cancels does.
CANCELLED_BY = ["station", "event_date", "event_category"]


def drop_cancelled(events: DataFrame, cancellations: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Events without an explicit cancellation; silence keeps an event alive."""
    keys = keys or CANCELLED_BY
    return events.join(cancellations.select(*keys).distinct(), keys, "left_anti")


def normalise_scores(events: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """1.0 for suspensions, breaks and online shifts, else the trigger's weight, else 0.

    Without ``weights`` the built-in table is a literal map and nothing is joined.
    """
    if weights is None:
        table = {trigger: fixed.dec(w) for _, trigger, w in fixed.FRICTION_WEIGHTS}
        rows = events.withColumn("friction_weight_ref", labels.lookup(F.col("trigger_category"), table))
    else:
        per_trigger = weights.groupBy("trigger_category").agg(F.max("friction_weight").alias("friction_weight_ref"))
        rows = events.join(per_trigger, "trigger_category", "left")
    weight = F.coalesce(F.col("friction_weight_ref").cast(indices.SCORE), F.lit(0).cast(indices.SCORE))
    full = F.col("event_category").isin(FULL_SCORE_CATEGORIES)
    return rows.withColumn("friction_weight_ref", weight).withColumn(
        "normalized_score", F.when(full, F.lit(1).cast(indices.SCORE)).otherwise(F.col("friction_weight_ref"))
    )


def scraped_id(category: Column, day: Column, raw_id: Column) -> Column:
    """``SCR-CS-0702-17``."""
    code = labels.lookup(category, CATEGORY_CODES, F.lit("GN"))
    return F.concat_ws("-", F.lit("SCR"), code, F.date_format(day, "MMdd"), raw_id.cast("string"))


def calendar_id(school: Column, day: Column, row_id: Column) -> Column:
    return F.concat_ws("-", F.lit("CAL"), school, F.date_format(day, "MMdd"), row_id.cast("string"))


def consolidate_posts(
    posts: DataFrame, weights: DataFrame | None = None, rules: list[Rule] = RULES, keep: list[str] | None = None
) -> DataFrame:
    """Posts to event-calendar rows: classify, keep what affects ridership, date, fan out, score.

    ``posts``: id, post_text, posted_at, source_name, source_url, and further columns to ``keep``.
    """
    kept = classify(posts, rules=rules).filter("affects_ridership")
    spread = propagate(with_event_date(kept))
    scored = normalise_scores(spread, weights)
    return scored.select(
        F.concat_ws(
            "-",
            scraped_id(F.col("event_category"), F.col("event_date"), F.col("id")),
            F.regexp_replace(labels.capacity_code(F.col("station")), "^CAP-", ""),
        ).alias("id"),
        "station",
        "event_date",
        F.lit("academic_lgu_events").alias("source_table"),
        F.col("id").cast("string").alias("source_id"),
        "source_name",
        F.col("trigger_category").alias("event_name"),
        "event_category",
        F.lit("academic").alias("friction_domain"),
        "trigger_category",
        "normalized_score",
        "friction_weight_ref",
        F.col("posted_at").alias("announcement_time"),
        "source_url",
        F.col("post_text").alias("description"),
        *(keep or []),
    )


def rescore_density(events: DataFrame, day: str | Column = "event_date") -> DataFrame:
    """Major events rescored by how many share their date and station.

    Counts are pre-aggregated and joined back (a hot group is one row of counts); the
    ``changed`` flag marks the rows a merge has to rewrite.
    """
    key = F.col(day) if isinstance(day, str) else day
    keyed = events.withColumn("_day", key)
    major = F.col("event_category") == "major_event"
    counts = (
        keyed.filter(major)
        .groupBy("_day", F.coalesce("station", F.lit("")).alias("_station"))
        .agg(F.count("*").alias("major_events"))
    )
    # only major events look for their count; the rest stay where they are
    rows = keyed.filter(major).withColumn("_station", F.coalesce("station", F.lit("")))
    counted = rows.join(counts, ["_day", "_station"])
    joined = counted.unionByName(keyed.filter(~major | major.isNull()), allowMissingColumns=True)
    score = F.when(major, indices.surge_density(F.col("major_events"))).otherwise(F.col("normalized_score"))
    return (
        joined.withColumn("_score", score)
        .withColumn("changed", ~F.col("_score").eqNullSafe(F.col("normalized_score")))
        .withColumn("normalized_score", F.col("_score"))
        .withColumn("major_events", F.coalesce("major_events", F.lit(0)))
        .drop("_day", "_station", "_score")
    )


def density_groups(events: DataFrame, day: str | Column = "event_date") -> DataFrame:
    """Major-event count and density score per date and station."""
    key = F.col(day) if isinstance(day, str) else day
    counts = (
        events.filter(F.col("event_category") == "major_event")
        .groupBy(key.alias("event_day"), "station")
        .agg(F.count("*").alias("major_events"))
    )
    return counts.withColumn("surge_score", indices.surge_density(F.col("major_events")))


def consolidate_weather(readings: DataFrame, kind: str = "current") -> DataFrame:
    """Weather readings to scored calendar rows with ids ``WTH-CUR-station`` / ``WTH-FCT-id``."""
    if kind == "current":
        row_id = F.concat(F.lit("WTH-CUR-"), F.col("station"))
    else:
        row_id = F.concat(F.lit("WTH-FCT-"), F.col("id").cast("string"))
    return readings.select(
        row_id.alias("id"),
        "station",
        F.to_date(F.from_utc_timestamp("observed_at", fixed.LOCAL_ZONE)).alias("weather_date"),
        F.col("observed_at").alias("observed_or_forecasted_at"),
        indices.weather_friction(F.col("wind_signal"), F.col("rainfall_mm"), F.col("advisory_level")).alias(
            "normalized_score"
        ),
        F.lit("weather_advisory").alias("event_category"),
        F.col("id").alias("reading_id"),
    )
