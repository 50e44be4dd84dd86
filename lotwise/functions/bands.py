"""Small label rules: days bands, demand, risk, condition scale, price delta."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def days_to_band(days: Column) -> Column:
    band = F.when(days.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(config.BAND_EDGES, config.BAND_LABELS):
        band = band.when(days <= edge, label)
    return band.otherwise(config.BAND_LABELS[-1])


def demand_text(band: Column) -> Column:
    text = F.when(band.isNull(), "Unknown")
    for label, demand in config.DEMAND_BY_BAND.items():
        text = text.when(band == label, demand)
    return text.otherwise("Unknown")


def risk_level(band: Column, confidence: Column, tolerance: Column) -> Column:
    return (
        F.when((band == "Very slow") | (confidence < 0.40), "High")
        .when(band.isin("Fast", "Moderate") & (confidence >= tolerance), "Low")
        .otherwise("Medium")
    )


def risk_ordinal(level: Column) -> Column:
    order = F.when(level.isNull(), config.RISK_ORDER["Medium"])
    for label, rank in config.RISK_ORDER.items():
        order = order.when(level == label, rank)
    return order.otherwise(config.RISK_ORDER["Medium"])


def condition_to_model_scale(display: Column) -> Column:
    """0-100 display grade to the 1-49 grade the models use."""
    low, high = config.CONDITION_RANGE
    grade = F.floor(F.lit(low) + display / 100.0 * (high - low) + 0.5)
    return F.when(display.isNotNull(), F.greatest(F.lit(int(low)), F.least(F.lit(int(high)), grade)))


def condition_to_display(condition: Column) -> Column:
    """1-49 model grade to whole 0-100 points (ties to even)."""
    points = F.bround((condition - 1) / 48 * 100, 0)
    return F.when(condition.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), points)))


def price_delta(price: Column, benchmark: Column) -> Column:
    return F.when(benchmark != 0, (price - benchmark) / benchmark)


def profit_label(price: Column, market_value: Column, discount: float, margin: float) -> Column:
    """1 where buying at ``discount`` under market would clear ``margin``, else 0."""
    buy = F.lit(1.0 - discount) * F.when(market_value != 0, market_value)
    return F.when((price - buy) / buy >= F.lit(float(margin)), 1).otherwise(0)
