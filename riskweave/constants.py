"""Thresholds, lookup tables, texts and formats that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------

# City, latitude, longitude in decimal degrees.
CITIES = (
    ("New York", 40.7128, -74.0060),
    ("Chicago", 41.8781, -87.6298),
    ("Los Angeles", 34.0522, -118.2437),
    ("Miami", 25.7617, -80.1918),
    ("Seattle", 47.6062, -122.3321),
    ("Austin", 30.2672, -97.7431),
    ("Denver", 39.7392, -104.9903),
    ("Boston", 42.3601, -71.0589),
    ("London", 51.5074, -0.1278),
    ("Tokyo", 35.6762, 139.6503),
)
EARTH_RADIUS_KM = 6371.0

CURRENCY = "USD"
ATTACK_BANK = "attack-sim"
HIGH_RISK_CATEGORY = "7995"

STATUSES = ("pending", "approved", "denied")
DEFAULT_STATUS = "pending"

MAX_RETRIES = 3
RETRY_DELAY_SECONDS = 2

MIN_TRAINING_ROWS = 200
TRAIN_FRACTION = 0.8
MODEL_SEED = 42
# Library defaults of the classifier being matched.
MODEL_TREES = 100
MODEL_STEP = 0.1
MODEL_DEPTH = 3
# Most values of a feature that the trees tell apart.
MODEL_BINS = 256
DECISION_THRESHOLD = 0.5

FEATURE_COLUMNS = (
    "amount_cents",
    "hour_of_day",
    "weekday",
    "is_high_risk_mcc",
    "velocity_count",
    "category_seen_before",
    "geo_speed_kmh",
    "rule_flag_count",
)

# Speed given to two distant rows at the same instant: kilometres times this.
ZERO_GAP_SPEED_FACTOR = 1e6

HIGH_RISK_PERCENT = 70
MEDIUM_RISK_PERCENT = 30

MISSING_ID_ERROR = "schema: transaction missing bank or native_id"
ZERO_AMOUNT_ERROR = "schema: transaction %s has zero amount"
UNMARSHAL_PREFIX = "unmarshal error: "
GAVE_UP_TEXT = "gave up after %d retries: %s"
BAD_TIMESTAMP_ERROR = "bad timestamp"
BAD_AMOUNT_ERROR = "amount out of range"

REASON_SEPARATOR = "\n"
REASON_DISPLAY_SEPARATOR = " · "

# --- settings ---------------------------------------------------------------


@dataclass(frozen=True)
class RuleSettings:
    """Rule thresholds; the defaults are the fixed values of the three rules."""

    window_seconds: int = 120
    velocity_threshold: int = 5
    min_history: int = 5
    min_km: float = 1.0
    max_kmh: float = 1100.0


# An account with more rows than this is not given to a single window task but
# is cut into range-sorted chunks (operators/history.py).
HEAVY_ACCOUNT_ROWS = 100_000
# Rows aimed at per chunk when a heavy group is cut.
CHUNK_ROWS = 1_000_000
# Smaller chunks, no less than this, keep all cores busy on a smaller group.
SMALL_CHUNK_ROWS = 50_000
# So many chunks are made however small the caller wants them; more must have that many rows.
FEW_CHUNKS = 200
# Rows aimed at per task where groups are about as many as rows.
TASK_ROWS = 250_000
# Most chunks of one range shuffle; beyond it chunks get larger.
MAX_CHUNKS = 20_000
# Key lists are broadcast only when a count shows them to be no longer than this.
BROADCAST_KEYS = 100_000
