"""Fixed values that results depend on, stated once.

Every module takes these from here; the DuckDB oracle SQL is generated
from the same values.
"""

# --- Fixed values: validation ranges --------------------------------------
# magnitude and coordinates inclusive; depth half-open [0, 1000).
MAGNITUDE_RANGE = (-2.0, 10.0)
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)
DEPTH_RANGE = (0.0, 1000.0)

# --- Fixed values: magnitude classes --------------------------------------
# (exclusive upper bound, label); at or above the last bound: "Great".
MAGNITUDE_CLASSES = [
    (3.0, "Micro"),
    (4.0, "Minor"),
    (5.0, "Light"),
    (6.0, "Moderate"),
    (7.0, "Strong"),
    (8.0, "Major"),
]
MAGNITUDE_TOP_CLASS = "Great"

# --- Fixed values: depth classes ------------------------------------------
# (inclusive upper bound in km, label); above the last bound: "Deep".
DEPTH_CLASSES = [(70, "Shallow"), (300, "Intermediate")]
DEPTH_TOP_CLASS = "Deep"

# --- Fixed values: hemisphere labels --------------------------------------
# (label at or above 0, label below 0)
HEMISPHERE_NS = ("Northern", "Southern")
HEMISPHERE_EW = ("Eastern", "Western")

# --- Fixed value: region detail = place text after the first comma --------
REGION_PATTERN = r",\s*(.*)$"

# --- Fixed values: the magnitude dimension --------------------------------
# (category, min, max, description) in published order; the bounds are
# descriptive, never join conditions.
MAGNITUDE_ROWS = [
    ("Micro", -2.0, 2.9, "Not felt or rarely felt."),
    ("Minor", 3.0, 3.9, "Often felt, rarely causes damage."),
    ("Light", 4.0, 4.9, "Felt by many, possible minor damage."),
    ("Moderate", 5.0, 5.9, "Damage to weak structures."),
    ("Strong", 6.0, 6.9, "Moderate damage to well-built structures."),
    ("Major", 7.0, 7.9, "Serious damage to most buildings."),
    ("Great", 8.0, 10.0, "Widespread destruction."),
    ("Unknown", None, None, "Category not determined."),
]

# --- Fixed value: calendar runs to the last event day plus this many days --
CALENDAR_BUFFER_DAYS = 30

# --- Fixed values: source requests ----------------------------------------
MAX_FEATURES_PER_DOCUMENT = 20000  # features per request page / document
MIN_MAGNITUDE = 2.5  # smallest magnitude requested
BACKFILL_DAYS = 365  # first load window
INCREMENTAL_HOURS = 48  # look-back of every later load

# --- Fixed values: retention per layer in days ----------------------------
RETENTION_DAYS = {"bronze": 365, "silver": 730, "gold": 1825}

# --- Fixed values: names --------------------------------------------------
GOLD_DATABASE = "gold_earthquakes"
FACT_TABLE = "fact_earthquake_events"

# The published fact mapping: Silver column -> fact column.
FACT_MEASURES = (
    ("magnitude", "Magnitude"),
    ("depth_km", "DepthKm"),
    ("tsunami_warning", "TsunamiWarning"),
    ("significance", "Significance"),
    ("felt_reports", "FeltReports"),
    ("nst_stations", "NumberOfStations"),
    ("rms_travel_time", "RmsTravelTime"),
    ("gap_azimuthal", "AzimuthalGap"),
    ("url", "SourceURL"),
)
