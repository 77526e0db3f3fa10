"""Fixed values shared by every module: column lists, schemas, lookup tables.

Everything in this file is data, not logic.
"""

from __future__ import annotations

# Raw CSV header.
RAW_COLUMNS = ("Violation_Id", "Timestamp", "Violation_Type", "Location")

# Columns of the cleaned table.
CLEAN_COLUMNS = ("violation_id", "timestamp_parsed", "violation_type", "location")

# Schemas in DDL form; CSV inputs are always read as text and cast in one place.
RAW_SCHEMA = "Violation_Id string, Timestamp string, Violation_Type string, Location string"
CLEAN_SCHEMA = (
    "violation_id string, timestamp_parsed timestamp_ntz, violation_type string, location string"
)
PER_HOUR_SCHEMA = "hour_of_day int, count bigint"
TIME_TYPE_SCHEMA = "DayOfWeek string, Hour int, Violation_Type string, count bigint"
LOCATION_COUNT_SCHEMA = "Location string, count bigint"
GRID_COUNT_SCHEMA = "grid_id string, count bigint"
CLUSTER_SCHEMA = (
    "violation_id string, lat double, lon double, prediction int, violation_type string"
)
CENTROID_SCHEMA = (
    "cluster_id int, center_lat double, center_lon double, violation_count bigint, "
    "dominant_violation string"
)
HOURLY_RISK_SCHEMA = (
    "Hour int, violation_count bigint, total_risk_score bigint, avg_risk_score double, "
    "primary_violation string, z_score double, anomaly_level string, is_anomaly boolean"
)
LOCATION_RISK_SCHEMA = (
    "location string, total_violations bigint, total_risk_score bigint, avg_risk_score double, "
    "high_severity_count bigint"
)
TIME_TYPE_MATRIX_SCHEMA = (
    "Hour int, violation_type string, violation_count bigint, total_risk_score bigint"
)

# Weekday names, Monday first.
DAY_ORDER = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Severity points per violation type, and the points of any other type.
SEVERITY_WEIGHTS = {
    "DUI": 10,
    "Reckless Driving": 8,
    "Red Light Violation": 7,
    "Speeding": 6,
    "Using Mobile Phone": 4,
    "Illegal Turn": 3,
    "Seatbelt Violation": 2,
}
DEFAULT_SEVERITY = 3
HIGH_SEVERITY = 7

# Z-score thresholds and the class names they select.
CRITICAL_Z = 2.0
ELEVATED_Z = 1.5
LOW_Z = -1.5
CRITICAL = "CRITICAL SPIKE"
ELEVATED = "ELEVATED SURGE"
LOW = "UNUSUALLY LOW"
NORMAL = "NORMAL"

# Recommended action per anomaly class, and the one for every other class.
PATROL_ACTIONS = {
    CRITICAL: "🚨 Immediate traffic squad tactical dispatch",
    ELEVATED: "⚠️ High patrol density allocation",
    LOW: "Reduced intensity patrol routine",
}
DEFAULT_ACTION = "Standard autonomous patrol"
DEFAULT_PRIMARY = "General Infraction"
DEFAULT_DOMINANT = "General"

# Coordinate text, and grid resolution (0.01 degree cells).
COORDINATE_PATTERN = r"^-?\d+\.\d+,-?\d+\.\d+$"
CELLS_PER_DEGREE = 100

# Hotspot centres (lat, lon).
HOTSPOTS = (
    (40.7580, -73.9855),
    (40.7295, -73.9965),
    (40.7484, -73.9857),
    (40.7061, -74.0088),
    (40.8075, -73.9626),
)

# Map colours of clusters 0..4 as RGBA and as hex, and the colour of any other.
CLUSTER_RGBA = {
    0: (239, 68, 68, 170),
    1: (59, 130, 246, 170),
    2: (16, 185, 129, 170),
    3: (245, 158, 11, 170),
    4: (139, 92, 246, 170),
}
CLUSTER_HEX = {0: "#EF4444", 1: "#3B82F6", 2: "#10B981", 3: "#F59E0B", 4: "#8B5CF6"}
DEFAULT_HEX = "#38BDF8"

# Generator settings (types, relative hour weights 0..23, days, jitter in degrees).
SYNTH_TYPES = (
    "Speeding",
    "Red Light Violation",
    "Reckless Driving",
    "Seatbelt Violation",
    "Using Mobile Phone",
    "Illegal Turn",
    "DUI",
)
HOUR_WEIGHTS = (
    5, 5, 5, 5, 5, 10, 20, 50, 80, 70, 40, 45, 50, 45, 50, 75, 90, 85, 60, 40, 25, 15, 10, 5,
)
SYNTH_DAYS = 61
SYNTH_JITTER = 0.005

# Texts that a CSV scan reads as null (the defaults of pandas.read_csv).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Header of the centroid table as shown to readers.
CENTROID_TITLES = {
    "cluster_id": "Cluster ID",
    "center_lat": "Center Lat",
    "center_lon": "Center Lon",
    "violation_count": "Total Violations",
    "dominant_violation": "Dominant Infraction",
}
