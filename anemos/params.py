"""Parameters of the jobs. The defaults are fixed values of the product rules."""

from __future__ import annotations

from dataclasses import dataclass, field

KMH_PER_KNOT = 1.852
LOCAL_ZONE = "Europe/Zurich"

RAW_COLUMNS = (
    "wind_speed_10m", "wind_speed_80m", "wind_speed_120m", "wind_direction_10m",
    "wind_direction_80m", "wind_gusts_10m", "temperature_2m", "precipitation",
    "relative_humidity_2m", "cloud_cover", "pressure_msl", "cape", "lifted_index",
)
ENGINEERED_COLUMNS = (
    "hour_of_day_sin", "hour_of_day_cos", "day_of_year_sin", "day_of_year_cos",
    "wind_direction_10m_sin", "wind_direction_10m_cos", "wind_steadiness",
    "gust_excess_10m", "gust_factor", "shore_alignment",
)
MODEL_FEATURES = (
    "wind_speed_10m", "wind_speed_80m", "wind_gusts_10m", "temperature_2m",
    "relative_humidity_2m", "hour_of_day_sin", "hour_of_day_cos", "day_of_year_sin",
    "day_of_year_cos", "wind_direction_10m_sin", "wind_direction_10m_cos",
    "wind_steadiness", "gust_excess_10m", "shore_alignment",
)
LABEL_INPUTS = (
    "wind_speed_10m", "wind_gusts_10m", "wind_steadiness", "gust_factor", "shore_alignment",
)

# Inclusive (low, high) bounds per column; None leaves that side open.
VALUE_RANGES: dict[str, tuple[float | None, float | None]] = {
    "wind_speed_10m": (0.0, 80.0),
    "wind_speed_80m": (0.0, 80.0),
    "wind_speed_120m": (0.0, 80.0),
    "wind_gusts_10m": (0.0, 120.0),
    "wind_direction_10m": (0.0, 360.0),
    "wind_direction_80m": (0.0, 360.0),
    "temperature_2m": (-40.0, 50.0),
    "relative_humidity_2m": (0.0, 100.0),
    "hour_of_day_sin": (-1.0, 1.0),
    "hour_of_day_cos": (-1.0, 1.0),
    "day_of_year_sin": (-1.0, 1.0),
    "day_of_year_cos": (-1.0, 1.0),
    "wind_direction_10m_sin": (-1.0, 1.0),
    "wind_direction_10m_cos": (-1.0, 1.0),
    "wind_steadiness": (0.0, None),
    "gust_excess_10m": (0.0, None),
    "gust_factor": (0.0, None),
    "shore_alignment": (-1.0, 1.0),
}
MAX_NULL_FRACTION = 0.1

QUALITY_NAMES = {
    0: "Unsafe", 1: "Too Light", 2: "Marginal", 3: "Good Enough", 4: "Fun Day",
    5: "Perfect Storm",
}
COMPASS_POINTS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
KNOWN_ROUTES = (
    "/health", "/spots", "/predict", "/rank", "/features/online",
    "/features/online/demo", "/metrics",
)
LATENCY_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
EXPECTED_UNITS = {
    "wind_speed_10m": "km/h", "wind_speed_80m": "km/h",
    "wind_speed_120m": "km/h", "wind_gusts_10m": "km/h",
}
RETRAIN_ALIASES = {
    "none": "off", "off": "off", "false": "off", "manual": "off", "": "off",
    "always": "always", "new-data": "always", "new_data": "always",
    "on-success": "always", "on_success": "always",
    "drift": "drift", "drift-only": "drift", "drift_only": "drift",
}
# Parts of a key that are limited on their own before the key is.
SALTS = 64
FEATURE_STAGES = ("fetch", "engineer", "validate", "store")
TRAINING_STAGES = ("train", "evaluate", "register")


@dataclass(frozen=True)
class LabelRules:
    """Wind limits in knots behind the 0-5 quality label."""

    unsafe_wind: float = 40.0
    unsafe_gust: float = 50.0
    light_rider_kg: float = 75.0
    light_rider_min: float = 12.0
    other_rider_min: float = 15.0
    marginal_below: float = 17.0
    good_below: float = 22.0
    fun_up_to: float = 30.0
    perfect_low: float = 15.0
    perfect_high: float = 25.0
    perfect_gust_factor: float = 1.25
    perfect_alignment: float = 0.7
    perfect_steadiness: float = 0.2


@dataclass(frozen=True)
class RankingRules:
    quality_weight: float = 0.6
    ratio_weight: float = 0.3
    hours_weight: float = 0.1
    rideable_from: float = 2.0
    min_drive_hours: float = 0.25
    horizon_rows: int = 14


@dataclass(frozen=True)
class RetentionRules:
    """Limits of the working event log; out-of-range values are lifted."""

    max_rows: int = 2048
    days: int = 60

    @classmethod
    def from_config(cls, max_rows: int = 2048, days: int = 60, evaluation_days: int = 30):
        return cls(max(max_rows, 2), max(days, 2 * max(evaluation_days, 1)))

    @classmethod
    def explicit(cls, max_rows: int, days: int):
        return cls(max(max_rows, 2), max(days, 1))


@dataclass(frozen=True)
class DriftRules:
    share_threshold: float = 0.15
    p_value: float = 0.05
    distance: float = 0.1
    window_days: int = 30


@dataclass(frozen=True)
class StoreLayout:
    """Physical layout of a stored table."""

    time_field: str
    cluster_fields: tuple[str, ...]
    retention_days: int


FEATURE_LAYOUT = StoreLayout("forecast_time", ("dataset_name", "spot_id"), 730)
EVENT_LAYOUT = StoreLayout("prediction_timestamp", ("model_version", "endpoint", "spot_id"), 180)


@dataclass(frozen=True)
class Thresholds:
    p95_latency_s: float = 2.0
    error_rate_per_s: float = 0.1
    feature_age_s: float = 28800.0
    snapshot_age_s: float = 25200.0
    online_ttl_days: int = 8
    hindcast_buffer_h: int = 120


@dataclass(frozen=True)
class Settings:
    labels: LabelRules = field(default_factory=LabelRules)
    ranking: RankingRules = field(default_factory=RankingRules)
    drift: DriftRules = field(default_factory=DriftRules)
    limits: Thresholds = field(default_factory=Thresholds)
