"""Scoring inputs, the decision layer and what-if scenarios over whole listing tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import AssumptionColumns, Assumptions
from ..functions import bands, confidence as conf, decision
from ..functions import messages as M
from ..functions.parse import key_text, or_unknown
from ..functions.rounding import round_exact
from ..operators.benchmarks import lookup_days, lookup_live, lookup_market, market_keys
from ..operators.lookup import keyed_lookup


def resolve_benchmarks(listings: DataFrame, bench: DataFrame, dts: DataFrame,
                       live: DataFrame | None = None) -> DataFrame:
    """Attach market value, days-to-turn and live prices, and settle which one counts.

    ``bench`` and ``dts`` are stored benchmark tables; ``live`` a comparables table. The
    listing's own ``mmr`` wins over the live value, and that over the lookup.
    """
    keys = market_keys(F.col("make"), F.col("model"), F.col("year"))
    if live is not None:
        keys["state"] = key_text(F.col("state"))

    def resolve(distinct: DataFrame) -> DataFrame:
        found = lookup_days(lookup_market(distinct, bench), dts)
        if live is not None:
            found = lookup_live(found, live)
        return found

    found = keyed_lookup(listings, keys, resolve)
    if live is None:
        found = found.withColumns({
            "live_value": F.lit(None).cast("double"), "live_days": F.lit(None).cast("double"),
            "live_n": F.lit(None).cast("long")})
    provided, has_live = F.col("mmr").isNotNull(), F.col("live_value").isNotNull()
    return found.withColumns({
        "mmr": F.coalesce("mmr", "live_value", "lookup_value"),
        "mmr_match_level": F.when(provided, "provided").when(has_live, "live")
        .otherwise(F.col("lookup_level")),
        "mmr_sample_size": F.when(provided, F.lit(None).cast("long"))
        .when(has_live, F.col("live_n")).otherwise(F.col("lookup_n")),
    })


def model_input(resolved: DataFrame) -> DataFrame:
    """Add the model-side columns of a listing (mileage, market_value, unknown texts)."""
    return resolved.withColumns({
        "mileage": F.col("odometer"),
        "market_value": F.coalesce("mmr", F.lit(0.0)),
        **{c: or_unknown(F.col(c)) for c in ("body", "transmission", "state", "color")},
    })


def settle_sources(scored: DataFrame) -> DataFrame:
    """Choose live or model values and raise the coverage warning.

    Input: resolved listings with model_resale, model_band, band_proba and profit_p.
    """
    has_live = F.col("live_value").isNotNull()
    live_days = has_live & F.col("live_days").isNotNull()
    warning = F.when(
        F.col("year") > config.TRAINING_YEAR_MAX,
        M.fill(M.COVERAGE_YEAR, year=F.col("year").cast("string"),
               last=F.lit(str(config.TRAINING_YEAR_MAX))),
    ).when(F.col("mmr_match_level") == "global", M.COVERAGE_GLOBAL)
    return scored.withColumns({
        "predicted_resale": F.when(has_live, F.col("live_value")).otherwise(F.col("model_resale")),
        "benchmark_days": F.when(live_days, F.col("live_days")).otherwise(F.col("make_days")),
        "days_band": F.when(live_days, bands.days_to_band(F.col("live_days")))
        .otherwise(F.col("model_band")),
        "band_from_live": live_days,
        "price_source": F.when(has_live, "live").otherwise("model"),
        "coverage_warning": F.when(~has_live, warning),
        "live_sample_size": F.col("live_n"),
    })


def scenario_free(scored: DataFrame) -> DataFrame:
    """Add what no assumption changes: trust, reconciled price, market figures and their sentences."""
    mmr, raw = F.col("mmr"), F.col("predicted_resale")
    facts = (F.col("price_source"), F.col("mmr_match_level"), raw, mmr, F.col("coverage_warning").isNotNull())
    # the score has a column of its own, so that its sentence is made only where it is asked for
    df = scored.withColumn("_score", conf.clip(conf.resale_score(*facts)))
    df = df.withColumn("_trust", round_exact(F.col("_score"), 3))
    df = df.withColumn("resale_confidence", conf.resale_confidence(*facts, score=F.col("_trust")))
    trust = F.col("_trust")
    shrunk = (F.col("price_source") == "model") & (mmr > 0)
    df = df.withColumn("_resale", F.when(shrunk, trust * raw + (1.0 - trust) * mmr).otherwise(raw))
    resale, days, band = F.col("_resale"), F.col("benchmark_days"), F.col("days_band")
    moved = F.abs(resale - raw) / F.greatest(F.abs(raw), F.lit(1.0)) >= 0.05
    level = F.col("mmr_match_level")
    live = F.col("price_source") == "live"
    sure = conf.weakest(F.col("profit_p"), trust)
    return df.withColumns({
        "_confidence": sure,
        "_market_notes": M.present(
            F.col("coverage_warning"),
            F.when(live & (F.col("live_sample_size") > 0),
                   M.fill(M.NOTE_LIVE_COUNT, n=F.col("live_sample_size").cast("string")))
            .when(live, M.NOTE_LIVE)
            .when(~level.isin("provided", "make/model/year", "live"), M.fill(M.NOTE_LEVEL, level=level)),
            F.when(shrunk & moved, M.fill(
                M.NOTE_RECONCILED, raw=M.whole(raw), resale=M.whole(resale),
                level=F.lower(conf.level_of(trust))))),
        "confidence": round_exact(sure, 3),
        "predicted_resale_price": round_exact(resale, 2),
        "days_to_sell_band": band,
        "market_value_mmr": round_exact(mmr, 2),
        "market_value_confidence": F.when(mmr.isNotNull(), conf.market_value_confidence(
            level, F.col("mmr_sample_size"))),
        "days_band_confidence": conf.days_band_confidence(F.col("band_proba"),
                                                          F.col("band_from_live")),
        "buy_pass_confidence": conf.buy_pass_confidence(F.col("profit_p"), trust),
        "market_demand": bands.demand_text(band),
        "days_to_sell_benchmark": round_exact(days, 1),
    })


def evaluate(scored: DataFrame,
             assumptions: Assumptions | Sequence[Assumptions] = Assumptions()) -> DataFrame:
    """Financials, verdict, confidence, flags and explanations for scored listings.

    With several assumptions every listing is evaluated once per scenario; the result
    then carries ``scenario`` (their position). What no assumption changes is computed before a listing
    is multiplied, so once for each listing.
    """
    carried = [c for c in scored.columns if c not in ("confidence", "scenario")]
    df = scenario_free(scored.select(*carried))
    if isinstance(assumptions, Assumptions):
        a = assumptions.columns()
    else:
        df = df.select("*", F.posexplode(F.array(*[
            F.struct(*[F.lit(float(getattr(s, f.name))).alias(f.name) for f in fields(s)])
            for s in assumptions])).alias("scenario", "assumptions"))
        a = AssumptionColumns.from_struct("assumptions")
        carried = [*carried, "scenario"]

    mmr, resale, days = F.col("mmr"), F.col("_resale"), F.col("benchmark_days")
    df = df.withColumn("_purchase", F.coalesce(
        "listing_price", mmr * (1.0 - a.acquisition_discount), resale))
    purchase, listing = F.col("_purchase"), F.col("listing_price")

    df = df.withColumns({
        "financial_summary": decision.financials(purchase, resale, a, days),
        "_ceiling": decision.max_purchase_price(resale, a, days),
        "_delta": bands.price_delta(purchase, mmr),
    })
    ceiling, delta, sure = F.col("_ceiling"), F.col("_delta"), F.col("_confidence")
    roi, net = F.col("financial_summary.roi"), F.col("financial_summary.net_profit")
    verdict, reasons = decision.buy_or_pass(roi, net, sure, a)
    df = df.withColumns({"recommendation": verdict, "reasons": reasons})

    margin = M.percent(a.target_profit_margin)
    guidance = (
        F.when(listing.isNull(), M.fill(M.GUIDE_NO_LISTING, ceiling=M.whole(ceiling), margin=margin))
        .when(listing > ceiling, M.fill(M.GUIDE_ABOVE, listing=M.whole(listing),
                                        ceiling=M.whole(ceiling), margin=margin))
        .when(F.col("recommendation") != "Buy", M.fill(M.GUIDE_HOLD, listing=M.whole(listing)))
        .otherwise(M.fill(M.GUIDE_BUY, listing=M.whole(listing), ceiling=M.whole(ceiling),
                          margin=margin, head=M.whole(ceiling - listing))))
    priced = M.present(
        F.when(listing.isNull() & mmr.isNotNull(),
               M.fill(M.NOTE_DISCOUNT, discount=M.percent(a.acquisition_discount)))
        .when(listing.isNull(), M.NOTE_RESALE))
    df = df.withColumns({
        "expected_gross_profit": net,
        "roi": roi,
        "max_purchase_price": round_exact(ceiling, 2),
        "price_vs_mmr_delta": round_exact(delta, 4),
        "data_quality_flags": conf.quality_flags(F.col("odometer"), F.col("year"), resale, mmr,
                                                 delta, roi),
        "price_guidance": guidance,
        "risk_level": bands.risk_level(F.col("days_band"), sure, a.risk_tolerance),
        "top_factors": top_factors(delta),
    })
    df = df.withColumn("notes", F.concat("_market_notes", priced, F.col("reasons"), F.array("price_guidance")))
    df = df.withColumn("risk_summary", F.struct(
        "days_to_sell_band", "days_to_sell_benchmark", "market_demand", "risk_level"))
    new = [
        "recommendation", "confidence", "predicted_resale_price", "days_to_sell_band",
        "expected_gross_profit", "roi", "max_purchase_price", "market_value_mmr",
        "price_vs_mmr_delta", "financial_summary", "risk_summary", "resale_confidence",
        "market_value_confidence", "days_band_confidence", "buy_pass_confidence",
        "data_quality_flags", "price_guidance", "top_factors", "notes", "risk_level",
    ]
    return df.select(*[c for c in carried if c not in new], *new)


def top_factors(delta: Column) -> Column:
    """Array of (factor, value) describing a scored listing."""
    age = F.greatest(F.lit(0), F.lit(config.REFERENCE_YEAR) - F.col("year"))

    def factor(name: str, value, when=F.lit(True)):
        return F.when(when, F.struct(F.lit(name).alias("factor"), value.alias("value")))

    return M.present(
        factor("Mileage", F.concat(M.whole(F.col("odometer")), F.lit(" mi"))),
        factor("Vehicle age", F.concat(age.cast("string"), F.lit(" yr"))),
        factor("Condition", F.concat(
            M.fixed(bands.condition_to_display(F.col("condition")), 0), F.lit("/100"))),
        factor("Days-to-sell band", F.col("days_band")),
        factor("Market value (MMR)", F.concat(F.lit("$"), M.whole(F.col("mmr"))),
               F.col("mmr").isNotNull()),
        factor("Price vs market", M.signed_percent(delta), delta.isNotNull()),
    )
