"""Time labels, station codes and formatted ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge import fixed

HOUR_LABEL = r"^[0-2][0-9]:00$"
RANGE_LABEL = "__:__-__:__"


def lookup(key: Column, table: dict, default: Column | None = None) -> Column:
    """``key`` mapped through a literal table."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, default)


def hour_of(label: Column) -> Column:
    return F.substring(label, 1, 2).cast("int")


def hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def padded(number: Column, width: int) -> Column:
    """Zero-padded text that grows instead of losing digits beyond ``width``."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def band_of(label: Column) -> Column:
    """Hour label -> band; daily total to its banded spelling; anything else unchanged."""
    table = {
        f"{hour:02d}:00": band for band, shares in fixed.HOUR_SHARES.items() for hour in shares
    }
    table.update({stored: shown for shown, stored in fixed.TOTAL_LABELS.items()})
    return lookup(label, table, label)


def range_label(label: Column) -> Column:
    """``05:00`` -> ``05:00-06:00``; 23:00 wraps; totals take their banded spelling."""
    following = hour_label((F.substring(label, 1, 2).try_cast("int") + 1) % 24)
    totals = lookup(label, {v: k for k, v in fixed.TOTAL_LABELS.items()}, label)
    return F.when(label.rlike(HOUR_LABEL), F.concat(label, F.lit("-"), following)).otherwise(totals)


def stored_total(label: Column) -> Column:
    return lookup(label, fixed.TOTAL_LABELS, label)


def is_total(label: Column) -> Column:
    return label.isin([*fixed.TOTAL_LABELS, *fixed.TOTAL_LABELS.values()])


def counted_hourly(day: Column) -> Column:
    """Days whose source rows were hourly from the start: June and 1 November."""
    return (F.month(day) == 6) | ((F.month(day) == 11) & (F.dayofmonth(day) == 1))


def band_rank(label: Column) -> Column:
    order = {band: i + 1 for i, band in enumerate(fixed.BANDS)}
    order["Daily Total"] = len(order) + 1
    return lookup(label, order, F.lit(len(order) + 1))


def grain_of(label: Column) -> Column:
    return (
        F.when(label.isin("Daily Total", "DAILY_TOTAL"), "day")
        .when(label.isin("Monthly Total", "MONTHLY_TOTAL"), "month")
        .when(label.isin("Peak Total", "PEAK_TOTAL"), "peak")
        .when(label.rlike(r"^\d\d:\d\d"), "hour").otherwise("band")
    )


def hour_id(day: Column, label: Column) -> Column:
    """``YR97-0105-07``."""
    return F.concat(F.lit("YR"), F.date_format(day, "yy-MMdd-"), F.substring(label, 1, 2))


def hourly_id(day: Column, label: Column) -> Column:
    """``YR97-0105-07``; totals ``YR97-0105-DT``, ``YR97-01-MT``, ``YR97-01-PT``."""
    per_month = F.concat(F.lit("YR"), F.date_format(day, "yy-MM-"))
    return (
        F.when(label.isin("Daily Total", "DAILY_TOTAL"), F.concat(F.lit("YR"), F.date_format(day, "yy-MMdd-"), F.lit("DT")))
        .when(label.isin("Monthly Total", "MONTHLY_TOTAL"), F.concat(per_month, F.lit("MT")))
        .when(label.isin("Peak Total", "PEAK_TOTAL"), F.concat(per_month, F.lit("PT")))
        .otherwise(hour_id(day, label))
    )


def allocated_id(day: Column, label: Column) -> Column:
    """``ST97-0105-07`` and ``ST97-0105-DT``."""
    tail = F.when(label == "DAILY_TOTAL", "DT").otherwise(F.substring(label, 1, 2))
    return F.concat(F.lit("ST"), F.date_format(day, "yy-MMdd-"), tail)


def capacity_code(station: Column) -> Column:
    fallback = F.concat(F.lit("CAP-"), F.upper(F.substring(F.replace(station, F.lit(" "), F.lit("")), 1, 3)))
    return lookup(F.upper(F.trim(station)), fixed.CAPACITY_CODES, fallback)


def display_id(station: Column) -> Column:
    return lookup(station, fixed.DISPLAY_IDS, F.lower(station))


def station_alias(name: Column) -> Column:
    """Known spellings to the station's own name; unknown names only trimmed."""
    return lookup(F.lower(F.trim(name)), fixed.STATION_ALIASES, F.trim(name))


def scope_of(station: Column) -> Column:
    """Null for a network-wide row, else the station."""
    return F.when(station.isin(fixed.NETWORK_SCOPES), F.lit(None).cast("string")).otherwise(station)


def range_step(start: str, end: str) -> Column:
    """Array of days from ``start`` to ``end``, both included."""
    return F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
