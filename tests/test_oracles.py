"""Registered queries against their SQL on the smallest tables.

A spread of queries runs here; tests/oracle_check.py runs all of them at any size.
"""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
SHORT = ["clean_sales", "harmonize_clean", "sample_cap", "mmr_rollup", "comparables",
         "features_imputed", "encode_features", "evaluate_live", "evaluate_text", "quality_flags",
         "scenario_grid", "batch_rank_risk", "metrics_binary", "psi", "options_models"]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 6000


@pytest.mark.parametrize("name", SHORT)
def test_query(spark, name):
    assert compare(queries()[name](spark, SF), connect(SF), oracle_sql()[name]) is None
