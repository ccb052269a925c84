"""Record contract, table schemas and the fixed values the results depend on."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the source system's for equal results)
# ---------------------------------------------------------------------------

# Raw request contract: 44 column names, order significant.
EXPECTED_COLUMNS = [
    "unique_key", "created_date", "closed_date", "agency", "agency_name",
    "complaint_type", "descriptor", "descriptor_2", "location_type",
    "incident_zip", "incident_address", "street_name", "address_type",
    "city", "status", "resolution_description",
    "resolution_action_updated_date", "community_board", "council_district",
    "police_precinct", "bbl", "borough", "x_coordinate_state_plane",
    "y_coordinate_state_plane", "open_data_channel_type",
    "park_facility_name", "park_borough", "latitude", "longitude",
    "location", "cross_street_1", "cross_street_2", "intersection_street_1",
    "intersection_street_2", "landmark", "facility_type",
    "bridge_highway_name", "bridge_highway_segment",
    "taxi_pick_up_location", "bridge_highway_direction", "road_ramp",
    "vehicle_type", "taxi_company_borough", "due_date",
]
# Columns parsed as timestamps during normalisation.
DATE_COLUMNS = ["created_date", "closed_date", "resolution_action_updated_date", "due_date"]
# Columns stored as exact numerics in the raw layer.
NUMERIC_COLUMNS = ["x_coordinate_state_plane", "y_coordinate_state_plane", "latitude", "longitude"]

# Resolution buckets: hours <= 24, hours <= 72, anything else (open requests included).
BUCKET_UNDER_24H = "under_24h"
BUCKET_1_3_DAYS = "1-3_days"
BUCKET_OVER_3_DAYS = "over_3_days"
BUCKET_LABELS = [BUCKET_UNDER_24H, BUCKET_1_3_DAYS, BUCKET_OVER_3_DAYS]
BUCKET_LIMITS_HOURS = (24, 72)

# Map grid: coordinates rounded to 2 decimals (about 1 km).
GRID_DECIMALS = 2

# Calendar dimension spine, both ends inclusive.
CALENDAR_START = _dt.date(2010, 1, 1)
CALENDAR_END = _dt.date(2035, 12, 31)

# Source freshness on the raw table: warn after 24 h, error after 48 h.
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48

# Ingestion status: no row -> Unknown, age <= 24 h Healthy, <= 72 h Stale, else Delayed.
STATUS_UNKNOWN = "Unknown"
STATUS_HEALTHY = "Healthy"
STATUS_STALE = "Stale"
STATUS_DELAYED = "Delayed"
STATUS_LIMITS_HOURS = (24, 72)

# Display of naive timestamps: local time of this zone, "YYYY-MM-DD hh:mm AM EST".
DISPLAY_ZONE = "America/New_York"
DISPLAY_ZONE_ABBREV = {-5: "EST", -4: "EDT"}
DISPLAY_MISSING = "Unavailable"

# Ingestion defaults.
DEFAULT_START = _dt.datetime(2026, 1, 1)
DEFAULT_BATCH_SIZE = 100_000
SAMPLE_SIZE = 1_000

# BI defaults: top types 10, heatmap cells 800, agencies 6, monthly heatmap 100, inspection 50.
TOP_TYPES_LIMIT = 10
HEATMAP_LIMIT = 800
AGENCY_LIMIT = 6
HEATMAP_MONTH_LIMIT = 100
INSPECTION_LIMIT = 50

# ---------------------------------------------------------------------------
# Names of our own (not fixed by the source system)
# ---------------------------------------------------------------------------

SOURCE_NAME = "service_requests"
KEY = "unique_key"
CREATED = "created_date"

_STRING = T.StringType()
_TS = T.TimestampNTZType()
_NUM = T.DecimalType(38, 18)  # the source column is unbounded; 18 decimals hold any double coordinate


def _raw_type(name: str) -> T.DataType:
    if name == KEY:
        return T.LongType()
    if name in DATE_COLUMNS:
        return _TS
    if name in NUMERIC_COLUMNS:
        return _NUM
    return _STRING


# Typed raw table (44 columns, contract order).
RAW_SCHEMA = T.StructType([T.StructField(c, _raw_type(c), c != KEY) for c in EXPECTED_COLUMNS])

# Landing schema: every field read as text, typed later with try_cast (lenient, per cell).
LANDING_SCHEMA = T.StructType([T.StructField(c, _STRING, True) for c in EXPECTED_COLUMNS])

# Watermark table: one row per source.
META_SCHEMA = T.StructType([
    T.StructField("source_name", _STRING, False),
    T.StructField("last_created_date", _TS, True),
    T.StructField("last_unique_key", T.LongType(), True),
    T.StructField("updated_at", _TS, True),
])
