"""Fixed values and user-adjustable assumptions of the decision pipeline."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (results depend on each of them) --------------------------
SALES_COLUMNS = ["price", "mmr", "year", "mileage", "condition", "make", "model",
                 "body", "transmission", "state", "color"]
SALES_DEDUP_KEYS = ["price", "mmr", "year", "mileage", "make", "model", "state"]
COMMON_COLUMNS = ["price", "year", "mileage", "make", "model", "state", "condition",
                  "source_channel", "source"]
COMMON_DEDUP_KEYS = ["price", "year", "mileage", "make", "model", "state"]
VALID_TRANSMISSIONS = ["automatic", "manual"]

SALES_BOUNDS = {"price": (500.0, 250_000.0), "mmr": (500.0, 250_000.0),
                "mileage": (1.0, 400_000.0), "year": (1990, 2015)}
COMMON_BOUNDS = {"price": (500.0, 300_000.0), "mileage": (10.0, 400_000.0),
                 "year": (1990, 2025)}

NUMERIC_FEATURES = ["vehicle_age", "mileage", "mileage_per_year", "condition", "market_value"]
CATEGORICAL_FEATURES = ["make", "model", "body", "transmission", "state", "color"]
FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES
IMPUTED_FEATURES = ["vehicle_age", "mileage", "mileage_per_year", "market_value"]
LEAKAGE_COLUMNS = ["price"]
REFERENCE_YEAR = 2016
TRAINING_YEAR_MAX = 2015

BAND_EDGES = [60, 90, 120]
BAND_LABELS = ["Fast", "Moderate", "Slow", "Very slow"]
DEMAND_BY_BAND = {"Fast": "High demand", "Moderate": "Steady demand",
                  "Slow": "Soft demand", "Very slow": "Weak demand"}

MATCH_LEVEL_BASE = {"provided": 0.90, "live": 0.90, "make/model/year": 0.85,
                    "make/model": 0.60, "make": 0.35, "global": 0.15, "none": 0.10}
UNKNOWN_LEVEL_BASE = 0.30
LIVE_RESALE_SCORE, LIVE_BAND_SCORE, DEFAULT_BAND_SCORE = 0.88, 0.85, 0.5
DIVERGENCE_WARN, DIVERGENCE_BAD = 0.30, 0.50
TOO_GOOD_DELTA, IMPLAUSIBLE_ROI, HIGH_MILEAGE = -0.60, 1.0, 300_000

REQUIRED_LISTING_COLUMNS = ["make", "model", "year", "odometer", "condition"]
OPTIONAL_TEXT_COLUMNS = ["trim", "body", "transmission", "state", "color", "interior"]
OPTIONAL_NUMBER_COLUMNS = ["mmr", "listing_price"]
LISTING_YEAR_RANGE = (1980, 2025)
RISK_ORDER = {"Low": 0, "Medium": 1, "High": 2}

OPTION_SIZES = {"makes": 60, "models": 40, "bodies": 30, "colors": 25, "states": 60}
CONDITION_RANGE = (1.0, 49.0)
RETAIL_MIN_ROWS = 1000
MIN_STATE_ROWS = 30
WORST_STATES = 5
GATE_MIN_IMPROVEMENT = 0.05
CALIBRATION_ROWS = 60_000
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Assumptions:
    """Business assumptions of one evaluation; the defaults are fixed values."""

    target_profit_margin: float = 0.15
    min_dollar_profit: float = 1000.0
    risk_tolerance: float = 0.60
    holding_cost_per_day: float = 20.0
    holding_period_days: int = 45
    repair_estimate: float = 0.0
    acquisition_discount: float = 0.20

    def columns(self) -> "AssumptionColumns":
        return AssumptionColumns({f.name: F.lit(float(getattr(self, f.name)))
                                  for f in fields(self)})


class AssumptionColumns:
    """The seven assumptions as columns: literals, or fields of a scenario struct."""

    def __init__(self, by_name: dict[str, Column]):
        self._by_name = by_name

    def __getattr__(self, name: str) -> Column:
        try:
            return self._by_name[name]
        except KeyError:
            raise AttributeError(name) from None

    @classmethod
    def from_struct(cls, struct: str) -> "AssumptionColumns":
        return cls({f.name: F.col(f"{struct}.{f.name}") for f in fields(Assumptions)})
