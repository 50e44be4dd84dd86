"""Exact binary rounding against Python's own round."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lotwise.functions.rounding import round_exact


def numbers():
    rng = random.Random(5)
    out = [0.0, -0.0, 2.675, 0.125, 0.375, -0.125, 2.5, 3.5, -2.5, 1e22, -1e300, 4503599627370497.5, 1e15 + 0.3, 5e-324, 0.005, 1.005, 1234567.885]
    out += [rng.randrange(-10**9, 10**9) / 1000 for _ in range(4000)]  # many end in half a cent
    out += [rng.randrange(0, 10**7) / 8 for _ in range(500)]  # true ties
    out += [math.nextafter(rng.randrange(0, 10**7) / 8, d) for _ in range(500) for d in (-math.inf, math.inf)]
    out += [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-6, 17) for _ in range(3000)]
    return out


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 4, 7])
def test_round_exact_is_pythons(spark, digits):
    values = numbers()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [tuple(r) for r in df.select("x", round_exact(F.col("x"), digits)).collect()]
    bad = [(x, y, round(x, digits)) for x, y in got if str(y) != str(float(round(x, digits)))]
    assert not bad[:5]


def test_no_number_and_odd_numbers(spark):
    df = spark.createDataFrame([(None,), (math.inf,), (-math.inf,), (math.nan,)], "x double")
    got = [r[0] for r in df.select(round_exact(F.col("x"), 2)).collect()]
    assert got[:3] == [None] * 3 and math.isnan(got[3])


def test_numbers_away_from_ties_need_no_text(spark):
    """Only what is near a tie, or large, goes through a number format."""
    df = spark.createDataFrame([(1.0,)], "x double").select(round_exact(F.col("x"), 2).alias("y"))
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.index("rint") < plan.index("format_number")
