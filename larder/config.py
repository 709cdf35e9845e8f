"""Thresholds, code lists and formats the decisions depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: codes of the goods-movement and material feeds -----------------
MATERIAL_TYPES = ("FERT", "HALB", "ROH")
MOVEMENT_TYPES = ("101", "102", "261", "262", "601", "602")
STOCK_IN = ("101", "262", "602")
STOCK_OUT = ("261", "601", "102")
SALE = "601"
SALE_RETURN = "602"
SALES_WINDOWS = (7, 14, 28, 90)
MOVEMENT_CORRECTION = "562"
GOODS_MOVEMENT_CODE = "01"
ORDER_DOC_TYPE = "NB"
ORDER_UNIT = "EA"
PARTNER_ROLE = "LF"
PARTNER_LANGUAGE = "EN"

# --- Fixed values: inputs of the phantom-stock model, in model order ---------------
PHANTOM_FEATURES = (
    "sales_7d",
    "sales_14d",
    "sales_28d",
    "sales_90d",
    "stock_qty",
    "days_of_cover",
    "velocity_collapse_ratio",
    "days_since_last_sale",
)

# --- Fixed values: inputs of the demand models, in model order ---------------------
DEMAND_FEATURES = (
    "trend",
    "weekly",
    "yearly",
    "day_of_week",
    "week_of_year",
    "is_public_holiday",
    "stock_qty",
    "days_of_cover",
)
HORIZONS = (7, 14, 28)
HISTORY_WEEKS = 104
TRAIN_MIN_DAYS = 364
SCORE_MIN_DAYS = 14
QUANTILES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
WEATHER_DAYS = 7
TEMPERATURE_NORM = 15.0
PRECIPITATION_NORM = 2.0
LIFT_RANGE = (0.5, 2.0)

KEYS = ("werks", "unified_sku_id")


@dataclass(frozen=True)
class PhantomLimits:
    review_score: float = 0.85
    auto_correct_score: float = 0.95
    label_min_sales_28d: int = 5
    replay_days: int = 90
    max_auto_corrections: int = 500
    precision_gate: float = 0.80


@dataclass(frozen=True)
class IdentityLimits:
    match_rate_gate: float = 0.95


@dataclass(frozen=True)
class LifeRule:
    """Share of shelf life that may pass in transit, and what happens beyond it."""

    limit: float
    hard: bool


@dataclass(frozen=True)
class OrderLimits:
    # Transit-to-life limits per category
    life_rules: dict[str, LifeRule] = field(
        default_factory=lambda: {
            "FRESH_PRODUCE": LifeRule(0.50, True),
            "BAKERY": LifeRule(0.50, False),
        }
    )
    default_life_rule: LifeRule = LifeRule(0.60, True)
    uncertainty_ratio: float = 0.30
    order_value: float = 500.0
    max_orders: int = 200


@dataclass(frozen=True)
class SweepLimits:
    transit_to_life: float = 0.50
    quantity_deviation: float = 0.25
    cutoff_minutes: int = 30
    deadline_hour: int = 8
    deadline_minute: int = 15
    zone: str = "Europe/Amsterdam"


@dataclass(frozen=True)
class ForecastLimits:
    mae_share_gate: float = 0.15


@dataclass(frozen=True)
class TreeSettings:
    """Size of a boosted-tree model.

    Operators, the daily run and the queries share one size per model. Boosting is sequential:
    every round is a pass over the data, so steps are large (SURVEY 2.13). ``trees`` is the most
    rounds; those after the least error on a held-back fold are left out.
    """

    trees: int
    depth: int
    rate: float
    seed: int = 7
    least_rows: int = 1  # rows of a leaf
    patience: int = 2  # rounds without gain on the held-back fold before growing ends


PHANTOM_TREES = TreeSettings(trees=20, depth=6, rate=0.2)
DEMAND_TREES = TreeSettings(trees=20, depth=6, rate=0.2)
WEATHER_TREES = TreeSettings(trees=20, depth=5, rate=0.2)
QUANTILE_TREES = TreeSettings(trees=4, depth=3, rate=0.6, least_rows=20, patience=1)


@dataclass(frozen=True)
class DecompositionSettings:
    """Split of a series: places where the trend may bend, order of the waves, and how much both are held small."""

    bends: int = 8
    bent_share: float = 0.8  # the last part of the series keeps its slope
    week_order: int = 3
    year_order: int = 4
    line_penalty: float = 1e-6
    bend_penalty: float = 0.1
    wave_penalty: float = 0.01


@dataclass(frozen=True)
class ResolutionSettings:
    """Identity of materials without a barcode."""

    gram: int = 3
    least_similarity: float = 0.5
    similarity_steps: tuple[float, ...] = (0.6, 0.75, 0.9)
    least_probability: float = 0.5
    most_probability: float = 0.999
