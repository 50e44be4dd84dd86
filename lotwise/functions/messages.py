"""User-facing sentences and the number formats inside them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (texts shown to the user; {name} marks a filled-in value) --
REASON_ROI = "ROI {roi} below target {target}"
REASON_PROFIT = "Gross profit ${profit} below minimum ${minimum}"
REASON_CONFIDENCE = "Confidence {confidence} below risk tolerance {tolerance}"
REASON_BUY = "Meets ROI, profit, and confidence thresholds"

COVERAGE_YEAR = (
    "{year} is beyond the model's training data (through {last}). This estimate is "
    "unreliable — connect a live price feed for current-year vehicles."
)
COVERAGE_GLOBAL = (
    "No comparable vehicles for this make/model in the training data; estimate is "
    "low-confidence."
)
NOTE_LIVE = "Current market value from live listings."
NOTE_LIVE_COUNT = "Current market value from live listings ({n} comparable listings)."
NOTE_LEVEL = "Market value estimated at the '{level}' level."
NOTE_RECONCILED = (
    "Raw model resale ${raw} was {level} confidence; reconciled toward the market "
    "benchmark to ${resale}."
)
NOTE_DISCOUNT = (
    "No listing price supplied; evaluated at a {discount} wholesale discount below market "
    "value (MMR)."
)
NOTE_RESALE = "No listing price or market value; evaluated at predicted resale."

GUIDE_NO_LISTING = (
    "No listing price: ${ceiling} is the most you should bid at auction to still clear a "
    "{margin} margin."
)
GUIDE_ABOVE = (
    "The ${listing} listing is above your ${ceiling} ceiling for a {margin} margin. "
    "Negotiate to ${ceiling} or below, or pass."
)
GUIDE_HOLD = (
    "Even at the ${listing} listing this doesn't clear your criteria (see the reasons "
    "above), so hold off."
)
GUIDE_BUY = (
    "Buy at the ${listing} listing (or negotiate lower) — never above it. ${ceiling} is "
    "only your walk-away ceiling for a {margin} margin, not a target; the listing sits "
    "${head} under it."
)

LEVEL_BASIS = {
    "provided": "You supplied the market value.",
    "live": "Median of live market listings.",
    "make/model/year": "Median of matching make / model / year sales.",
    "make/model": "Median across all years for this make / model.",
    "make": "Only a make-level median was available (no model match).",
    "global": "No make match; using the overall dataset median.",
    "none": "No comparable sales found.",
}
LEVEL_BASIS_OTHER = "Matched at '{level}'."
BASIS_FEW = " Only {n} comparable sale(s)."
BASIS_SOME = " {n} comparable sales."
BASIS_RESALE_LIVE = "Anchored to current live market listings."
BASIS_RESALE = "Gradient-boosted resale model"
BASIS_RESALE_GOOD = " on a well-represented segment."
WHY_FEW = "few comparable vehicles in the training data"
WHY_COVERAGE = "vehicle is outside the model's training coverage"
WHY_DISAGREES = "predicted resale disagrees with market value by {gap}"
WHY_DIFFERS = "predicted resale differs from market value by {gap}"
BASIS_BAND_LIVE = "From live median days-on-market."
BASIS_BAND = "Classifier probability {p} (make-level benchmark)."
BASIS_BUY_PASS = (
    "Lower of profit-model {profit} and resale reliability {resale} (limited by the "
    "{limiter})."
)

FLAG_TOO_GOOD = (
    "Purchase price is {gap} below market value. That far below market almost always means "
    "a salvage/branded title, the wrong trim, or a data-entry error rather than a genuine "
    "bargain — verify before buying."
)
FLAG_DIVERGES = (
    "Predicted resale (${resale}) and market value (${mmr}) disagree by {gap}; treat the "
    "valuation as low-confidence."
)
FLAG_NO_MILEAGE = (
    "Mileage is 0 — enter the actual odometer reading. A used-vehicle valuation with no "
    "mileage is unreliable."
)
FLAG_HIGH_MILEAGE = "Mileage {odometer} is unusually high; confirm it is correct."
FLAG_YEAR = "Model year is missing or invalid."
FLAG_ROI = (
    "Projected ROI of {roi} is implausibly high and usually reflects a bad price or missing "
    "inputs rather than a real opportunity."
)

ERROR_MISSING = "missing required field '{field}'"
ERROR_NOT_NUMERIC = "non-numeric year/odometer/condition"
ERROR_YEAR = "year {year} out of range {first}-{last}"
ERROR_ODOMETER = "odometer is negative"
# --- end of fixed values ----------------------------------------------------


def fill(template: str, **values: Column) -> Column:
    """Concatenation of a template's literal pieces and the given text columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p)
                      for i, p in enumerate(parts) if p or i % 2])


def whole(c: Column) -> Column:
    """Thousands-grouped whole number, ties to even."""
    return F.format_number(c, 0)


def fixed(c: Column, digits: int) -> Column:
    return F.replace(F.format_number(c, digits), F.lit(","), F.lit(""))


def percent(c: Column, digits: int = 0) -> Column:
    return F.concat(fixed(c * 100, digits), F.lit("%"))


def signed_percent(c: Column) -> Column:
    text = percent(c)
    return F.when(text.startswith("-"), text).otherwise(F.concat(F.lit("+"), text))


def present(*texts: Column) -> Column:
    """Array of the non-NULL items, in order."""
    return F.filter(F.array(*texts), lambda t: t.isNotNull())
