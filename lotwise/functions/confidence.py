"""Reliability scores per prediction, and data-quality flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from . import messages as M
from .rounding import round_exact


def clip(score: Column) -> Column:
    return F.when(score.isNotNull(), F.greatest(F.lit(0.02), F.least(F.lit(0.98), score)))


def level_of(score: Column) -> Column:
    return (F.when(score >= 0.75, "High").when(score >= 0.50, "Medium")
            .when(score >= 0.30, "Low").otherwise("Very low"))


def rounded_score(raw: Column) -> Column:
    return round_exact(clip(raw), 3)


def scored(raw: Column, basis: Column) -> Column:
    """Struct (score, level, basis) from an unclipped score."""
    return settled(rounded_score(raw), basis)


def settled(score: Column, basis: Column) -> Column:
    """Struct (score, level, basis) from a rounded score."""
    return F.struct(score.alias("score"), level_of(score).alias("level"), basis.alias("basis"))


def _base(level: Column) -> Column:
    base = F.when(level.isNull(), config.UNKNOWN_LEVEL_BASE)
    for name, value in config.MATCH_LEVEL_BASE.items():
        base = base.when(level == name, value)
    return base.otherwise(config.UNKNOWN_LEVEL_BASE)


def _divergence(resale: Column, mmr: Column) -> Column:
    return F.when(mmr > 0, F.abs(resale - mmr) / mmr)


def market_value_confidence(level: Column, sample_size: Column) -> Column:
    text = F.when(level.isNull(), M.fill(M.LEVEL_BASIS_OTHER, level=F.lit("None")))
    for name, basis in M.LEVEL_BASIS.items():
        text = text.when(level == name, basis)
    text = text.otherwise(M.fill(M.LEVEL_BASIS_OTHER, level=level))
    factor = (F.when(sample_size < 5, 0.55).when(sample_size < 25, 0.80).otherwise(1.0))
    counted = (
        F.when(sample_size.isNull(), "")
        .when(sample_size < 5, M.fill(M.BASIS_FEW, n=sample_size.cast("string")))
        .otherwise(M.fill(M.BASIS_SOME, n=M.whole(sample_size)))
    )
    return scored(_base(level) * factor, F.concat(text, counted))


def resale_score(price_source: Column, level: Column, resale: Column, mmr: Column, warned: Column) -> Column:
    """Unclipped score of :func:`resale_confidence`."""
    gap = _divergence(resale, mmr)
    raw = (_base(level) * F.when(warned, 0.40).otherwise(1.0)
           * F.when(gap >= config.DIVERGENCE_BAD, 0.40).when(gap >= config.DIVERGENCE_WARN, 0.70).otherwise(1.0))
    return F.when(price_source == "live", config.LIVE_RESALE_SCORE).otherwise(raw)


def resale_confidence(price_source: Column, level: Column, resale: Column, mmr: Column,
                      warned: Column, score: Column | None = None) -> Column:
    """``warned`` is true where a coverage warning was raised; ``score`` is the rounded score, where a column holds it already."""
    gap = _divergence(resale, mmr)
    bad, warn = gap >= config.DIVERGENCE_BAD, gap >= config.DIVERGENCE_WARN
    live = price_source == "live"
    reasons = M.present(
        F.when(level.isin("make", "global", "none"), M.WHY_FEW),
        F.when(warned, M.WHY_COVERAGE),
        F.when(bad, M.fill(M.WHY_DISAGREES, gap=M.percent(gap)))
        .when(warn, M.fill(M.WHY_DIFFERS, gap=M.percent(gap))),
    )
    basis = F.when(
        F.size(reasons) > 0,
        F.concat(F.lit(M.BASIS_RESALE), F.lit(" — "), F.array_join(reasons, "; "), F.lit(".")),
    ).otherwise(M.BASIS_RESALE + M.BASIS_RESALE_GOOD)
    if score is None:
        score = rounded_score(resale_score(price_source, level, resale, mmr, warned))
    return settled(score, F.when(live, M.BASIS_RESALE_LIVE).otherwise(basis))


def days_band_confidence(band_proba: Column, from_live: Column) -> Column:
    p = F.coalesce(band_proba, F.lit(config.DEFAULT_BAND_SCORE))
    return scored(F.when(from_live, config.LIVE_BAND_SCORE).otherwise(p),
                  F.when(from_live, M.BASIS_BAND_LIVE)
                  .otherwise(M.fill(M.BASIS_BAND, p=M.percent(p))))


def weakest(profit_p: Column, resale_score: Column) -> Column:
    """Lower of two scores, NULL if either is missing (``least`` would skip NULLs)."""
    return F.when(profit_p.isNotNull() & resale_score.isNotNull(), F.least(profit_p, resale_score))


def buy_pass_confidence(profit_p: Column, resale_score: Column) -> Column:
    limiter = F.when(resale_score < profit_p, "resale estimate").otherwise("profit model")
    return scored(weakest(profit_p, resale_score),
                  M.fill(M.BASIS_BUY_PASS, profit=M.percent(profit_p),
                         resale=M.percent(resale_score), limiter=limiter))


def quality_flags(odometer: Column, year: Column, resale: Column, mmr: Column,
                  delta: Column, roi: Column) -> Column:
    """Array of (severity, message), most severe first."""
    gap = _divergence(resale, mmr)

    def flag(when: Column, severity: str, message: Column) -> Column:
        return F.when(when, F.struct(F.lit(severity).alias("severity"),
                                     message.alias("message")))

    return M.present(
        flag(delta <= config.TOO_GOOD_DELTA, "alert",
             M.fill(M.FLAG_TOO_GOOD, gap=M.percent(F.abs(delta)))),
        flag(gap >= config.DIVERGENCE_BAD, "warn",
             M.fill(M.FLAG_DIVERGES, resale=M.whole(resale), mmr=M.whole(mmr),
                    gap=M.percent(gap))),
        flag(odometer.isNull() | (odometer <= 0), "warn", F.lit(M.FLAG_NO_MILEAGE)),
        flag(odometer > config.HIGH_MILEAGE, "warn",
             M.fill(M.FLAG_HIGH_MILEAGE, odometer=M.whole(odometer))),
        flag(year.isNull() | (year <= 0), "warn", F.lit(M.FLAG_YEAR)),
        flag(roi > config.IMPLAUSIBLE_ROI, "warn",
             M.fill(M.FLAG_ROI, roi=M.percent(roi))),
    )
