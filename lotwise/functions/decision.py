"""Deal arithmetic: holding cost, ceiling price, profit, ROI and the verdict."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AssumptionColumns
from . import messages as M
from .rounding import round_exact


def holding_cost(a: AssumptionColumns, days: Column) -> Column:
    return a.holding_cost_per_day * F.coalesce(days, a.holding_period_days)


def required_profit(resale: Column, margin: Column) -> Column:
    return margin * resale


def max_purchase_price(resale: Column, a: AssumptionColumns, days: Column) -> Column:
    return (resale - a.repair_estimate - holding_cost(a, days)
            - required_profit(resale, a.target_profit_margin))


def financials(purchase: Column, resale: Column, a: AssumptionColumns, days: Column) -> Column:
    """Struct of the six rounded money figures; ROI is 0 where nothing is invested."""
    holding = holding_cost(a, days)
    invested = purchase + a.repair_estimate
    net = resale - purchase - a.repair_estimate - holding
    return F.struct(
        round_exact(purchase, 2).alias("purchase_price"),
        round_exact(a.repair_estimate, 2).alias("estimated_repairs"),
        round_exact(resale, 2).alias("predicted_resale_price"),
        round_exact(holding, 2).alias("total_holding_cost"),
        round_exact(net, 2).alias("net_profit"),
        round_exact(F.when(invested > 0, net / invested).otherwise(0.0), 4).alias("roi"),
    )


def buy_or_pass(roi: Column, net_profit: Column, confidence: Column,
                a: AssumptionColumns) -> tuple[Column, Column]:
    """(verdict, ordered reasons); ``roi`` and ``net_profit`` are the rounded figures."""
    roi_ok = roi >= a.target_profit_margin
    profit_ok = net_profit >= a.min_dollar_profit
    confidence_ok = confidence >= a.risk_tolerance
    buy = roi_ok & profit_ok & confidence_ok
    reasons = M.present(
        F.when(~roi_ok, M.fill(M.REASON_ROI, roi=M.percent(roi, 1),
                               target=M.percent(a.target_profit_margin, 1))),
        F.when(~profit_ok, M.fill(M.REASON_PROFIT, profit=M.whole(net_profit),
                                  minimum=M.whole(a.min_dollar_profit))),
        F.when(~confidence_ok, M.fill(M.REASON_CONFIDENCE, confidence=M.fixed(confidence, 2),
                                      tolerance=M.fixed(a.risk_tolerance, 2))),
        F.when(buy, F.lit(M.REASON_BUY)),
    )
    return F.when(buy, "Buy").otherwise("Pass"), reasons
