"""Values the results depend on, stated once and overridable by argument."""

from __future__ import annotations

from decimal import Decimal

# --- Fixed values: stations, in line order of the wide tables --------------------
STATIONS = [
    "Anonas",
    "Antipolo",
    "Araneta Center Cubao",
    "Betty Go-Belmonte",
    "Gilmore",
    "J. Ruiz",
    "Katipunan",
    "Legarda",
    "Marikina-Pasig",
    "Pureza",
    "Recto",
    "Santolan",
    "V. Mapa",
]
FLOWS = ["entry", "exit"]
NETWORK_SCOPES = ["All", "All Stations"]
LOCAL_ZONE = "Asia/Manila"

# --- Fixed values: share of a band that falls in each of its hours ---------------
HOUR_SHARES = {
    "5-7am (OFF PEAK)": {5: "0.294976632537090", 6: "0.705023367462910"},
    "7-9am (AM PEAK)": {7: "0.544024908634851", 8: "0.455975091365149"},
    "9am-5pm (OFF PEAK)": {
        9: "0.115810405840533",
        10: "0.109552336053815",
        11: "0.112527198170051",
        12: "0.125297635652118",
        13: "0.122739214381356",
        14: "0.122510819491823",
        15: "0.133837412726751",
        16: "0.157724977683553",
    },
    "5-7pm (PM PEAK)": {17: "0.514927690590153", 18: "0.485072309409847"},
    "7-10pm (OFF PEAK)": {
        19: "0.511999956428162",
        20: "0.367992309570645",
        21: "0.120007734001193",
    },
}
BANDS = list(HOUR_SHARES)

# --- Fixed values: labels of total rows, banded table -> hourly table -------------
TOTAL_LABELS = {
    "Daily Total": "DAILY_TOTAL",
    "Monthly Total": "MONTHLY_TOTAL",
    "Peak Total": "PEAK_TOTAL",
}
TOTAL_SUFFIXES = {"DAILY_TOTAL": "DT", "MONTHLY_TOTAL": "MT", "PEAK_TOTAL": "PT"}
JUNK_COLUMNS = {
    "entry": {"total_entry", "entry_entry", "exit_entry"},
    "exit": {"total_exit", "entry_exit", "exit_exit"},
}

# --- Fixed values: index weights and shock coefficients ---------------------------
CFI_WEIGHTS = {"weather": "0.25", "academic": "0.15", "civic": "0.35", "operational": "0.25"}
SHOCKS = {"academic": "0.285", "civic": "-0.420", "weather": "-0.165", "operational": "-0.290"}
WHATIF_SHOCKS = {"academic": "0.30", "civic": "-0.45", "weather": "-0.175"}
EMERGENCY_CFI = "0.85"
WHATIF_DEFAULT_WARNING = 1000
WHATIF_DEFAULT_CRITICAL = 1200
MIDDAY_EXODUS = "-0.4444"
EARLY_NOTICE_HOUR = 8

# --- Fixed values: calendar modulation (all terms are added to 1) -----------------
_INBOUND = ["Antipolo", "Marikina-Pasig", "Santolan", "Anonas"]
_CAMPUS = ["Pureza", "Legarda", "Recto", "Katipunan"]
RUSH_FACTORS = [  # (hours, flow or None, stations, factor), first hit wins
    ([6, 7], "entry", _INBOUND, "0.184"),
    ([7, 8], "exit", _CAMPUS, "0.215"),
    ([17, 18], "entry", [*_CAMPUS, "Araneta Center Cubao"], "0.226"),
    ([18, 19], "exit", _INBOUND, "0.198"),
    ([12, 13], None, ["Pureza", "Legarda", "Katipunan", "Gilmore"], "0.125"),
]
RUSH_DEFAULT = "-0.035"
WEEKDAY_FACTORS = {1: "0.045", 5: "0.098", 6: "-0.321", 7: "-0.440"}
MONTH_FACTORS = {
    1: "0.025",
    4: "-0.125",
    6: "-0.186",
    7: "-0.186",
    8: "0.075",
    9: "0.075",
    11: "0.084",
    12: "0.148",
}
PAYDAYS = [14, 15, 16, 29, 30, 31]
PAYDAY_FACTOR = "0.152"

# --- Fixed values: platform capacity and station codes ----------------------------
PLATFORM_CAPACITY = {
    "Recto": 2500,
    "Legarda": 1800,
    "Pureza": 1800,
    "V. Mapa": 1800,
    "J. Ruiz": 1200,
    "Betty Go-Belmonte": 1200,
    "Araneta Center Cubao": 2500,
    "Anonas": 1500,
    "Katipunan": 2000,
    "Santolan": 1800,
    "Marikina-Pasig": 1800,
    "Antipolo": 2200,
    "Gilmore": 1500,
}
CAPACITY_CODES = {
    "RECTO": "CAP-REC",
    "LEGARDA": "CAP-LEG",
    "PUREZA": "CAP-PUR",
    "V. MAPA": "CAP-VMA",
    "J. RUIZ": "CAP-JRU",
    "GILMORE": "CAP-GIL",
    "BETTY GO-BELMONTE": "CAP-BET",
    "ARANETA CENTER-CUBAO": "CAP-CUB",
    "ANONAS": "CAP-ANO",
    "KATIPUNAN": "CAP-KAT",
    "SANTOLAN": "CAP-SAN",
    "MARIKINA-PASIG": "CAP-MAR",
    "ANTIPOLO": "CAP-ANT",
}
DISPLAY_IDS = {
    "Araneta Center Cubao": "cubao",
    "Betty Go-Belmonte": "bettygobelmonte",
    "J. Ruiz": "jruiz",
    "V. Mapa": "vmapa",
    "Marikina-Pasig": "marikinapasig",
}
# Spellings met in free text or app input, lower case -> station
STATION_ALIASES = {
    **{name.lower(): name for name in STATIONS},
    "cubao": "Araneta Center Cubao",
    "araneta": "Araneta Center Cubao",
    "araneta center-cubao": "Araneta Center Cubao",
    "araneta-cubao": "Araneta Center Cubao",
    "betty go": "Betty Go-Belmonte",
    "betty go belmonte": "Betty Go-Belmonte",
    "j ruiz": "J. Ruiz",
    "j.ruiz": "J. Ruiz",
    "marikina": "Marikina-Pasig",
    "marikina pasig": "Marikina-Pasig",
    "v mapa": "V. Mapa",
    "v.mapa": "V. Mapa",
}

# --- Fixed values: protocol tree and checklist lookups ----------------------------
PROTOCOL_NORMAL = ["APTA-03"]
PROTOCOL_WARNING = ["APTA-02"]
PROTOCOL_WARNING_FULL = ["APTA-02", "APTA-05"]
PROTOCOL_CRITICAL = ["APTA-04"]
PROTOCOL_CRITICAL_FULL = ["APTA-04", "APTA-02"]
PROTOCOL_EMERGENCY = ["APTA-01", "APTA-04"]
WARNING_FULL_AT = "0.80"
CRITICAL_FULL_AT = "0.90"
COMMAND_TACTICS = ["APTA-04-T02", "APTA-06-T02", "APTA-06-T03"]
CRITICAL_TACTICS = [
    "APTA-01-T01",
    "APTA-01-T02",
    "APTA-02-T03",
    "APTA-04-T03",
    "APTA-05-T01",
    "APTA-05-T02",
]
HIGH_TACTICS = ["APTA-02-T02", "APTA-03-T01", "APTA-04-T02", "APTA-06-T02", "APTA-06-T03"]
GUIDELINES = [  # (threat level, indicator, protocol id)
    ("Normal", "Volume < Warning (P80)", "APTA-03"),
    ("Warning", "Volume >= Warning (P80) and Volume < Critical (P90)", "APTA-02"),
    ("Critical", "Volume >= Critical (P90)", "APTA-04"),
    ("Emergency", "CFI > 0.85 and Storm Warning Active", "APTA-01"),
]
LEDGER_SCORES = {"Critical": "0.90", "Warning": "0.60"}
LEDGER_SCORE_DEFAULT = "0.10"

# --- Fixed values: model names and gates -------------------------------------------
VOLUME_MODEL = "volume_forecast"
THREAT_MODEL = "threat_classifier"
RMSE_GATE_PCT = 5.0
F1_GATE = 0.85
LATENCY_GATE_SECONDS = 3.0
TRAIN_SHARE = "0.8"
STATUS_CERTIFIED = "Certified Production-Ready"
STATUS_FAILED = "Failed One Or More Targets"
# Seed rows of the performance snapshot and of the weights, and the figures shown without a measurement
SEED_MAPE, SEED_RMSE = 8.5, 184.25
DEFAULT_MAPE, DEFAULT_RMSE = 1.19, 13.92
SCHOOL_BREAK_SEED = (
    "FRI-AC06",
    "academic",
    "School Break",
    "Semestral/Christmas/Summer Break",
    "0.85",
    "Assessment of Class Suspension and School Break Impacts on Metro Manila Traffic (NCTS)",
    "https://ncts.upd.edu.ph/tssp/wp-content/uploads/2018/08/Abad18.pdf",
)

# --- Fixed values: friction weights by trigger -------------------------------------
FRICTION_WEIGHTS = [
    ("academic", "Transport Strike", "0.90"),
    ("academic", "Class Suspension / Holiday", "0.85"),
    ("academic", "Class Suspension", "0.85"),
    ("academic", "Holiday", "0.85"),
    ("academic", "School Break", "0.85"),
    ("academic", "Online / Asynchronous Class Shift", "0.85"),
    ("academic", "Civic Rally & Public Mobilization", "0.75"),
    ("academic", "Major Arena Event", "0.65"),
    ("academic", "Graduation & Commencement Rites", "0.65"),
    ("academic", "University Exam Week", "0.20"),
    ("academic", "Regular Class Day", "0.00"),
    ("lgu", "LGU Municipal Clearing & Maintenance", "0.00"),
    ("operational", "Code Red / Standstill", "1.00"),
    ("operational", "Partial Line Suspension", "0.85"),
    ("operational", "Degraded Headway", "0.50"),
    ("operational", "Code Green", "0.00"),
    ("pagasa", "Typhoon (High)", "0.95"),
    ("pagasa", "Torrential Rain", "0.85"),
    ("pagasa", "Typhoon (Low)", "0.70"),
    ("pagasa", "Heavy Rain", "0.65"),
    ("pagasa", "Light/Moderate Rain", "0.35"),
    ("pagasa", "Clear / Fair", "0.00"),
]
SEVERITY_TRIGGERS = {"Critical": "Code Red / Standstill", "Warning": "Degraded Headway"}
SEVERITY_DEFAULT = "Code Green"
DOMAIN_PREFIXES = {"academic": "AC", "pagasa": "PA", "operational": "OP"}
DOMAIN_PREFIX_DEFAULT = "XX"

# --- Fixed values: allowed categories of incidents and roles -----------------------
INCIDENT_TYPES = [
    "Facility Order",
    "Platform Safety",
    "Property Crime",
    "Fare Collection",
    "Concourse Security",
    "Boarding Order",
    "Sanitation",
    "Contraband",
    "Public Order / Terrorism",
    "Gender-Based Offenses",
    "Physical Safety",
    "Other",
]
INCIDENT_SEVERITIES = ["Critical", "Warning"]
INCIDENT_STATUSES = ["pending", "acknowledged", "resolved"]
DEPLOYMENT_STATUSES = ["Active", "Completed", "Cancelled"]
MOBILE_PATTERN = r"^[0-9]{11}$"

# --- Fixed values: wording tests of the event feeds --------------------------------
FEED_CRITICAL_WORDS = r"(?i)(suspension|walang pasok|red alert|tigil pasada|strike|monsoon|typhoon)"
FEED_WARNING_WORDS = r"(?i)(arena|concert|heavy rain|flood|commencement|graduation|rally)"
NOTABLE_EXCLUDED_WORDS = [
    "%[Fallback]%",
    "%finalization%",
    "%posting%",
    "%grading%",
    "%encoding%",
    "%deliberation%",
]
NOTABLE_EXCLUDED_CATEGORIES = ["weather_advisory", "regular_class_day", "infrastructure"]
SUSPENSION_WORDS = ["%suspension%", "%suspend%", "%walang pasok%"]
TODAY_TRIGGERS = [
    "Class Suspension",
    "Holiday",
    "Transport Strike",
    "Major Arena Event",
    "Online / Asynchronous Class Shift",
    "Civic Rally & Public Mobilization",
]
WEEK_TRIGGERS = [*TODAY_TRIGGERS, "School Break"]
SEASON_TRIGGERS = ["Holiday", "Major Arena Event", "Graduation & Commencement Rites", "School Break"]
SEASON_CATEGORIES = ["holiday", "major_event", "school_break"]
TODAY_TIMES = {
    "Major Arena Event": "19:00",
    "Class Suspension": "07:00",
    "Holiday": "06:00",
    "University Exam Week": "08:00",
    "Transport Strike": "06:00",
}
TODAY_TIME_DEFAULT = "12:00"

# --- Fixed values: post classification words (own patterns where only prose exists) -
PLANNING_STRICT = (
    r"(?i)(coordination\s+meeting|ocular\s+visit|ocular\s+meeting|planning\s+meeting|planning\s+session"
    r"|preparatory\s+meeting|committee\s+meeting|coordination\s+visit|pre-event\s+coordination)"
)
PLANNING_LOOSE = r"(?i)(meeting|ocular|planning|preparation|discussion)"
EXPLICIT_DISRUPTION = r"(?i)(suspend|walang\s+pasok|no\s+class|strike|tigil\s+pasada|welga)"

# Cities and their stations; only the first city's members are published, the rest are ours
CITY_STATIONS = {
    "Manila": ["Recto", "Legarda", "Pureza", "V. Mapa"],
    "San Juan": ["J. Ruiz"],
    "Quezon City": [
        "Gilmore",
        "Betty Go-Belmonte",
        "Araneta Center Cubao",
        "Anonas",
        "Katipunan",
    ],
    "Pasig": ["Santolan"],
    "Marikina": ["Marikina-Pasig"],
    "Antipolo": ["Antipolo"],
}


def dec(text: str) -> Decimal:
    return Decimal(text)


def slug(station: str) -> str:
    """Column stem of a station in the wide tables: ``J. Ruiz`` -> ``j_ruiz``."""
    out = "".join(ch if ch.isalnum() else "_" for ch in station.lower())
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_")
