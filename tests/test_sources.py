"""Building the sales and parsing their texts: every text once, every join once, narrow rows through the joins."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lotwise.functions import parse
from lotwise.operators import clean
from lotwise.plans.queries import QUERIES
from lotwise.sources import proxy


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Three suppliers (one without a nation), four parts, five orders; keys that repeat, are missing or unknown."""
    d = str(tmp_path_factory.mktemp("tables"))
    frames = {
        "nation": ([(1, "FRANCE"), (2, "PERU")], "n_nationkey int, n_name string"),
        "supplier": ([(1, 1), (2, 2), (2, 1), (3, None)], "s_suppkey long, s_nationkey int"),
        "part": ([(i, f"Red bolt {i}", "Brand#7", "LARGE", i) for i in range(4)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "orders": ([(i, datetime(1999 + i, 5, 1)) for i in (37, 41, 43, 47, 2)] + [(None, None)],
                   "o_orderkey long, o_orderdate timestamp"),
        "lineitem": ([(o, p, s, n, 10.0, 1234.5, 0.25, "A") for o in (37, 41, 43, 47, 2, 99, None) for p in (0, 3, 9)
                      for s in (1, 2, 3) for n in (1, 7)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_returnflag string")}
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def plan(df, mode="optimized"):
    execution = df._jdf.queryExecution()
    return (execution.optimizedPlan() if mode == "optimized" else execution.sparkPlan()).toString()


def test_sales_rows(spark, tables):
    rows = proxy.sales(spark, tables).collect()
    # 5 known orders, 2 known parts, 2 lines; supplier 1 once, supplier 2 twice, supplier 3 has no nation
    assert len(rows) == 5 * 2 * 2 * 3
    one = [r for r in rows if (r.l_orderkey, r.l_partkey, r.l_suppkey) == (37, 3, 1)]
    assert [(r.make, r.model, r.year, r.mileage, r.body, r.transmission, r.state, r.color, r.mmr, r.price)
            for r in one] == [("brand#7", "red bolt 3", 2036, 80_000.0, "large", "automatic", "france", "Red", 1234.5, 925.875)] * 2
    assert sorted(((r.l_linenumber, r.condition) for r in one)) == [(1, 3.0), (7, None)]


def test_texts_of_parts_join_last(spark, tables):
    joins = [line for line in plan(proxy.sales(spark, tables)).splitlines() if "Join" in line]
    assert "l_partkey" in joins[0] and "l_orderkey" in joins[2]
    assert "broadcast" in joins[1]  # suppliers: measured, not estimated


@pytest.mark.parametrize("name", ["harmonize_union", "harmonize_clean"])
def test_sources_read_stored_sales(spark, tables, name):
    assert "Join" not in plan(QUERIES[name](spark, tables))


def test_texts_are_stripped_once(spark, tables):
    sold = proxy.sales(spark, tables)
    for df, texts in ((clean.from_auction(proxy.raw_sales(sold)), 2 * 5), (clean.parse_sales(proxy.raw_sales(sold)), 2 * 8),
                      (clean.from_recent(proxy.raw_recent(sold)), 3)):
        assert 3 <= plan(df).count("trim(") <= texts  # raw sales are a union of two


def test_lines_compile(spark, tables):
    """Methods above 8,000 bytes are interpreted by the JVM."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = proxy.sales_lines(proxy.raw_sales(proxy.sales(spark, tables).localCheckpoint()))
        text = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(lines._jdf.queryExecution().executedPlan())
        assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8_000
        got = {(r.l_orderkey, r.copy): r.line for r in lines.where("l_partkey = 0 and l_suppkey = 1 and l_linenumber = 1").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    long, short, plain = got[37, 0], got[41, 0], got[2, 0]
    assert long.endswith(',"Automatic","Red ",extra') and plain.endswith(',"Automatic","Red "')
    assert short.endswith('"$925.88"') and got[47, 2] == "###"
    assert plain.startswith('" 2001","  BRAND#7\t",,"lx","LARGE",,"FRANCE"')


ODD = ["", " ", "a", " a", "a ", "\ta b ", " x", "x　", "é", "é ", " é", "~!", "\x1f", "a\x1f", "\x7f", "日本 ", None]


def test_strip_column(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    rows = df.select("t", parse.strip_column(F.col("t")), parse.strip(F.col("t"))).collect()
    assert [r[1] for r in rows] == [r[2] for r in rows] == [None if t is None else t.strip(parse.WHITE_SPACE) for t in ODD]


def test_strip_transmission_as_by_the_plain_pattern(spark):
    texts = ["Civic5-Speed Automatic", "Civic CVT.", "auto", "A3 6 spd M/T", "Camry -  speed auto", "Autobahn", "x automatic\n",
             "manual manual", "9-speed", "Focus 4-spdmanual", "  8 cvt", "ſpeed auto", "speed  speed a/t", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = parse.strip(F.regexp_replace("t", parse.TRANSMISSION_SUFFIX, ""))
    assert df.select(parse.strip_transmission(F.col("t"))).collect() == df.select(plain).collect()
