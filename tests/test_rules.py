"""Column rules against hand-computed expectations."""

import pytest
from pyspark.sql import functions as F

from lotwise import config
from lotwise.config import Assumptions
from lotwise.functions import bands, confidence as conf, decision, messages as M, parse


def test_default_assumptions():
    a = Assumptions()
    assert (a.target_profit_margin, a.min_dollar_profit, a.risk_tolerance) == (0.15, 1000, 0.60)
    assert a.acquisition_discount == 0.20


def test_band_edges(one):
    days = [45, 60, 61, 90, 91, 120, 121, 167]
    assert one(bands.days_to_band(F.col("d")), "d double", *[(float(d),) for d in days]) == [
        "Fast", "Fast", "Moderate", "Moderate", "Slow", "Slow", "Very slow", "Very slow"]


def test_numbers(one):
    texts = ["$12,345.50", "9,000 mi", "-500", "1.2.3", "", None, "1e5"]
    assert one(parse.dirty_number(F.col("t")), "t string", *[(t,) for t in texts]) == [
        12345.5, 9000.0, 500.0, None, None, None, 15.0]
    texts = [" 12 ", "1e1", "5d", "inf", "nan", "-3.5", "$5", "", None, "1e999"]
    assert one(parse.plain_number(F.col("t")), "t string", *[(t,) for t in texts]) == [
        12.0, 10.0, None, None, None, -3.5, None, None, None, None]


def test_text_and_suffix(one):
    assert one(parse.norm_text(F.col("t")), "t string", ("\t Kia  ",), (None,)) == ["kia", None]
    assert one(parse.strip_transmission(F.col("t")), "t string", ("Civic5-Speed Automatic",),
               ("ILX6-Speed",), ("Accord CVT",)) == ["Civic", "ILX6-Speed", "Accord"]


FIN = dict(schema="buy double, resale double, days double")


def _fin(one, field, row, a):
    cols = a.columns()
    struct = decision.financials(F.col("buy"), F.col("resale"), cols, F.col("days"))
    return one(struct[field], FIN["schema"], row)[0]


def test_financials(one):
    a = Assumptions(repair_estimate=800.0)
    assert _fin(one, "net_profit", (8000.0, 12000.0, None), a) == 2300.0
    assert _fin(one, "roi", (8000.0, 12000.0, None), a) == 0.2614
    assert _fin(one, "total_holding_cost", (8000.0, 12000.0, None), a) == 900.0
    assert _fin(one, "total_holding_cost", (8000.0, 12000.0, 60.0), a) == 1200.0
    assert _fin(one, "roi", (0.0, 12000.0, 1.0), Assumptions()) == 0.0
    ceiling = decision.max_purchase_price(F.col("resale"), a.columns(), F.col("days"))
    assert one(ceiling, FIN["schema"], (0.0, 12000.0, None)) == [8500.0]


@pytest.mark.parametrize("buy, confidence, verdict, reason", [
    (8000.0, 0.75, "Buy", "Meets ROI"), (8000.0, 0.40, "Pass", "Confidence 0.40"),
    (11500.0, 0.90, "Pass", "ROI")])
def test_verdict(one, buy, confidence, verdict, reason):
    a = Assumptions(repair_estimate=800.0).columns()
    fin = decision.financials(F.col("buy"), F.col("resale"), a, F.lit(None).cast("double"))
    v, reasons = decision.buy_or_pass(fin["roi"], fin["net_profit"], F.col("c"), a)
    schema = "buy double, resale double, c double"
    assert one(v, schema, (buy, 12000.0, confidence)) == [verdict]
    assert one(reasons, schema, (buy, 12000.0, confidence))[0][0].startswith(reason)


def test_profit_label(one):
    rows = [(p, 10000.0) for p in (9500.0, 9200.0, 9000.0)] + [(1.0, 0.0), (1.0, None)]
    schema = "p double, mv double"
    label = bands.profit_label(F.col("p"), F.col("mv"), 0.20, 0.15)
    assert one(label, schema, *rows) == [1, 1, 0, 0, 0]
    larger = bands.profit_label(F.col("p"), F.col("mv"), 0.30, 0.15)
    assert sum(one(larger, schema, *rows)) >= 2


def test_delta(one):
    assert one(bands.price_delta(F.col("p"), F.col("m")), "p double, m double",
               (21000.0, 20000.0), (None, 20000.0), (21000.0, 0.0)) == [0.05, None, None]


MARKET = {  # level -> score with n < 5, 5 <= n < 25, n >= 25
    "provided": (0.495, 0.72, 0.90), "live": (0.495, 0.72, 0.90),
    "make/model/year": (0.468, 0.68, 0.85), "make/model": (0.33, 0.48, 0.60),
    "make": (0.193, 0.28, 0.35), "global": (0.083, 0.12, 0.15), "none": (0.055, 0.08, 0.10)}


def test_market_confidence(one):
    score = conf.market_value_confidence(F.col("l"), F.col("n"))["score"]
    for level, expected in MARKET.items():
        got = one(score, "l string, n long", *[(level, n) for n in (3, 10, 40)], (level, None))
        assert got == pytest.approx([*expected, expected[-1]], abs=6e-4), level


RESALE = {  # level -> divergence < .30, .30-.50, >= .50, then the same with a warning
    "provided": (0.90, 0.63, 0.36, 0.36, 0.252, 0.144),
    "make/model/year": (0.85, 0.595, 0.34, 0.34, 0.238, 0.136),
    "make/model": (0.60, 0.42, 0.24, 0.24, 0.168, 0.096),
    "make": (0.35, 0.245, 0.14, 0.14, 0.098, 0.056)}


def test_resale_confidence(one):
    score = conf.resale_confidence(F.lit("model"), F.col("l"), F.col("r"), F.lit(100.0),
                                   F.col("w"))["score"]
    for level, expected in RESALE.items():
        rows = [(level, r, w) for w in (False, True) for r in (110.0, 140.0, 170.0)]
        assert one(score, "l string, r double, w boolean", *rows) == pytest.approx(
            list(expected), abs=6e-4), level
    live = conf.resale_confidence(F.lit("live"), F.lit("live"), F.lit(1.0), F.lit(9.0), F.lit(False))
    assert one(live["score"], "x int", (1,)) == [0.88]


def test_levels_and_nulls(one):
    assert one(conf.level_of(F.col("s")), "s double", (0.75,), (0.5,), (0.3,), (0.29,)) == [
        "High", "Medium", "Low", "Very low"]
    assert one(conf.clip(F.col("s")), "s double", (None,), (0.0,), (1.0,)) == [None, 0.02, 0.98]
    assert one(conf.days_band_confidence(F.col("p"), F.lit(False))["score"], "p double",
               (None,), (0.91,)) == [0.5, 0.91]
    assert one(bands.condition_to_model_scale(F.col("c")), "c double",
               (0.0,), (50.0,), (100.0,), (200.0,), (None,)) == [1, 25, 49, 49, None]


def test_flags_in_order(one):
    flags = conf.quality_flags(F.col("odo"), F.lit(0), F.lit(200.0), F.lit(100.0), F.lit(-0.7),
                               F.lit(1.5))
    got = one(F.transform(flags, lambda f: f["severity"]), "odo double", (0.0,), (400000.0,))
    assert got == [["alert", "warn", "warn", "warn", "warn"]] * 2


def test_formats(one):
    assert one(M.whole(F.col("x")), "x double", (1234567.5,), (-1200.0,)) == ["1,234,568", "-1,200"]
    assert one(M.percent(F.col("x"), 1), "x double", (0.15,), (-12.345,)) == ["15.0%", "-1234.5%"]
    assert one(M.signed_percent(F.col("x")), "x double", (0.05,), (-0.2,)) == ["+5%", "-20%"]


def test_fixed_lists():
    assert config.FEATURE_COLUMNS[:5] == config.NUMERIC_FEATURES
    assert not set(config.LEAKAGE_COLUMNS) & set(config.FEATURE_COLUMNS)
