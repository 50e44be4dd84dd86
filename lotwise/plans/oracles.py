"""DuckDB SQL with the expected result of each deterministic registered query.

Written from the rules of the operators over the same test tables; each string stands
alone and reads whole tables.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def rnd(x: str, digits: int) -> str:
    """Round half up on the decimal text of a double, as Spark does."""
    return (f"CAST(ROUND(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,15)), {digits})"
            f" AS DOUBLE)")


def near(x: str, digits: int) -> str:
    """Round by the binary value of a double, ties to even."""
    return f"CAST(format('{{:.{digits}f}}', CAST({x} AS DOUBLE)) AS DOUBLE)"


def whole(x: str) -> str:
    return f"format('{{:,.0f}}', CAST({x} AS DOUBLE))"


def pct(x: str, digits: int = 0) -> str:
    return f"(format('{{:.{digits}f}}', CAST({x} AS DOUBLE) * 100e0) || '%')"


def oracle(name: str, *ctes: str, select: str) -> None:
    ORACLES[name] = ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select


ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

# --- inputs ---------------------------------------------------------------------
SALES = """sales AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    lower(p_brand) AS make, lower(p_name) AS model, CAST(year(o_orderdate) AS INT) AS year,
    l_quantity * 8000 AS mileage,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS condition,
    lower(p_type) AS body,
    CASE l_returnflag WHEN 'A' THEN 'automatic' WHEN 'N' THEN 'manual' ELSE 'unknown' END
      AS transmission,
    lower(n_name) AS state, split_part(p_name, ' ', 1) AS color,
    l_extendedprice AS mmr, l_extendedprice * (1 - l_discount) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

DTS = """dts AS (
  SELECT lower(p_brand) AS make,
    40e0 + 3.5e0 * max(CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT)) AS days
  FROM part GROUP BY 1)"""

LISTINGS = """listings AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_orderkey % 49 = 0 THEN 'nomake' ELSE make END AS make,
    CASE WHEN l_orderkey % 7 = 0 THEN 'nomodel' ELSE model END AS model,
    CASE WHEN l_orderkey % 5 = 0 THEN 1985 WHEN l_orderkey % 11 = 0 THEN 2017 ELSE year END AS year,
    mileage AS odometer, condition, body, transmission, state, color,
    CASE WHEN l_linenumber = 3 THEN mmr END AS mmr,
    CASE WHEN l_linenumber > 2 THEN price * (0.7e0 + 0.05e0 * l_linenumber) END AS listing_price,
    price
  FROM sales)"""

BENCH = """bench AS (
  SELECT grouping_id(make, model, year) AS gid, make, model, year,
    median(mmr) AS value, count(*) AS n
  FROM sales WHERE mmr IS NOT NULL AND make IS NOT NULL AND model IS NOT NULL AND year IS NOT NULL
  GROUP BY GROUPING SETS ((make, model, year), (make, model), (make), ()))"""

NO_LIVE = """live AS (
  SELECT '' AS make, '' AS model, 0 AS year, '' AS state, 0e0 AS live_value, 0e0 AS live_days,
    CAST(0 AS BIGINT) AS live_n WHERE false)"""

FEED = """feed AS (
  SELECT make, model, year, state,
    CASE WHEN l_linenumber = 4 THEN 0e0 WHEN l_linenumber = 5 THEN NULL ELSE price * 1.12e0 END AS price,
    CASE WHEN l_linenumber = 2 THEN -1e0 ELSE mileage / 4000 END AS dom
  FROM sales),
feed_stats AS (
  SELECT make, model, year, state, grouping(state) AS any_state,
    median(price) FILTER (WHERE price > 0) AS live_value,
    median(dom) FILTER (WHERE dom >= 0) AS live_days, count(*) AS live_n
  FROM feed GROUP BY GROUPING SETS ((make, model, year, state), (make, model, year)))"""

LIVE = """live AS (
  SELECT make, model, year, state, live_value, live_days, live_n
  FROM feed_stats WHERE any_state = 0 AND live_value IS NOT NULL)"""

RESOLVED = """looked AS (
  SELECT l.*, b0.value AS v0, b0.n AS n0, b1.value AS v1, b1.n AS n1, b3.value AS v3, b3.n AS n3,
    g.value AS vg, g.n AS ng, lv.live_value, lv.live_days, lv.live_n,
    coalesce(d.days, (SELECT median(days) FROM dts)) AS make_days
  FROM listings l
    LEFT JOIN bench b0 ON b0.gid = 0 AND b0.make = l.make AND b0.model = l.model AND b0.year = l.year
    LEFT JOIN bench b1 ON b1.gid = 1 AND b1.make = l.make AND b1.model = l.model
    LEFT JOIN bench b3 ON b3.gid = 3 AND b3.make = l.make
    LEFT JOIN bench g ON g.gid = 7 AND g.value > 0
    LEFT JOIN dts d ON d.make = l.make
    LEFT JOIN live lv ON lv.make = l.make AND lv.model = l.model AND lv.year = l.year
      AND lv.state = l.state),
resolved AS (
  SELECT * EXCLUDE (mmr, v0, n0, v1, n1, v3, n3, vg, ng), mmr AS provided,
    CASE WHEN v0 IS NOT NULL THEN v0 WHEN v1 IS NOT NULL THEN v1 WHEN v3 IS NOT NULL THEN v3
      ELSE vg END AS lookup_value,
    CASE WHEN v0 IS NOT NULL THEN 'make/model/year' WHEN v1 IS NOT NULL THEN 'make/model'
      WHEN v3 IS NOT NULL THEN 'make' WHEN vg IS NOT NULL THEN 'global' ELSE 'none' END AS lookup_level,
    CASE WHEN v0 IS NOT NULL THEN n0 WHEN v1 IS NOT NULL THEN n1 WHEN v3 IS NOT NULL THEN n3
      ELSE ng END AS lookup_n
  FROM looked),
chosen AS (
  SELECT *, CASE WHEN provided IS NOT NULL THEN provided WHEN live_value IS NOT NULL THEN live_value
      ELSE lookup_value END AS mmr,
    CASE WHEN provided IS NOT NULL THEN 'provided' WHEN live_value IS NOT NULL THEN 'live'
      ELSE lookup_level END AS mmr_match_level,
    CASE WHEN provided IS NOT NULL THEN NULL WHEN live_value IS NOT NULL THEN live_n
      ELSE lookup_n END AS mmr_sample_size
  FROM resolved)"""


def band(x: str) -> str:
    return (f"CASE WHEN {x} <= 60 THEN 'Fast' WHEN {x} <= 90 THEN 'Moderate' "
            f"WHEN {x} <= 120 THEN 'Slow' ELSE 'Very slow' END")


def level(x: str) -> str:
    return (f"CASE WHEN {x} >= 0.75e0 THEN 'High' WHEN {x} >= 0.5e0 THEN 'Medium' "
            f"WHEN {x} >= 0.3e0 THEN 'Low' ELSE 'Very low' END")


def clip3(x: str) -> str:
    return near(f"greatest(0.02e0, least(0.98e0, {x}))", 3)


LEVEL_BASE = """CASE mmr_match_level WHEN 'provided' THEN 0.9e0 WHEN 'live' THEN 0.9e0
    WHEN 'make/model/year' THEN 0.85e0 WHEN 'make/model' THEN 0.6e0 WHEN 'make' THEN 0.35e0
    WHEN 'global' THEN 0.15e0 WHEN 'none' THEN 0.1e0 ELSE 0.3e0 END"""

SCORED = f"""scored AS (
  SELECT *,
    CASE WHEN live_value IS NOT NULL THEN live_value
      ELSE mmr * (0.85e0 + 0.005e0 * ((l_partkey * 37 + l_suppkey) % 100))
        * (CASE WHEN l_partkey % 50 = 0 THEN 1.5e0 ELSE 1e0 END) END AS predicted_resale,
    CASE WHEN live_value IS NOT NULL THEN 'live' ELSE 'model' END AS price_source,
    CASE WHEN live_days IS NOT NULL THEN live_days ELSE make_days END AS benchmark_days,
    {band("CASE WHEN live_days IS NOT NULL THEN live_days ELSE make_days END")} AS days_band,
    live_value IS NOT NULL AND live_days IS NOT NULL AS band_from_live,
    ((l_partkey + l_suppkey) % 101) / 100e0 AS band_proba,
    (50 + ((l_orderkey * 31 + l_linenumber) % 50)) / 100e0 AS profit_p,
    CASE WHEN live_value IS NOT NULL THEN NULL
      WHEN year > 2015 THEN year || ' is beyond the model''s training data (through 2015). This '
        || 'estimate is unreliable — connect a live price feed for current-year vehicles.'
      WHEN mmr_match_level = 'global' THEN 'No comparable vehicles for this make/model in the '
        || 'training data; estimate is low-confidence.' END AS coverage_warning
  FROM chosen),
trusted AS (
  SELECT *, abs(predicted_resale - mmr) / CASE WHEN mmr > 0 THEN mmr END AS gap FROM scored),
weighed AS (
  SELECT *, {clip3(f'''CASE WHEN price_source = 'live' THEN 0.88e0 ELSE {LEVEL_BASE}
      * (CASE WHEN coverage_warning IS NOT NULL THEN 0.4e0 ELSE 1e0 END)
      * (CASE WHEN gap >= 0.5e0 THEN 0.4e0 WHEN gap >= 0.3e0 THEN 0.7e0 ELSE 1e0 END) END''')} AS trust
  FROM trusted)"""


def evaluated(margin="0.15e0", min_profit="1000e0", tolerance="0.6e0", per_day="20e0",
              repairs="0e0", discount="0.2e0", source="weighed", name="evaluated") -> str:
    """CTE chain of the decision layer; arguments are SQL expressions over ``source``."""
    return f"""{name}_a AS (
  SELECT *, CASE WHEN price_source = 'model' AND mmr > 0
      THEN trust * predicted_resale + (1e0 - trust) * mmr ELSE predicted_resale END AS resale,
    least(profit_p, trust) AS sure
  FROM {source}),
{name}_b AS (
  SELECT *, CASE WHEN listing_price IS NOT NULL THEN listing_price
      WHEN mmr IS NOT NULL THEN mmr * (1e0 - {discount}) ELSE resale END AS purchase,
    resale - {repairs} - {per_day} * benchmark_days - {margin} * resale AS ceiling
  FROM {name}_a),
{name}_c AS (
  SELECT *, resale - purchase - {repairs} - {per_day} * benchmark_days AS net_raw,
    (purchase - mmr) / CASE WHEN mmr <> 0 THEN mmr END AS delta
  FROM {name}_b),
{name}_d AS (
  SELECT *, {near("net_raw", 2)} AS expected_gross_profit,
    {near(f"CASE WHEN purchase + {repairs} > 0 THEN net_raw / (purchase + {repairs}) ELSE 0e0 END", 4)} AS roi
  FROM {name}_c),
{name} AS (
  SELECT *, CASE WHEN roi >= {margin} AND expected_gross_profit >= {min_profit}
      AND sure >= {tolerance} THEN 'Buy' ELSE 'Pass' END AS recommendation,
    CASE WHEN days_band = 'Very slow' OR sure < 0.4e0 THEN 'High'
      WHEN days_band IN ('Fast', 'Moderate') AND sure >= {tolerance} THEN 'Low'
      ELSE 'Medium' END AS risk_level
  FROM {name}_d)"""


LOOKUP = (SALES, DTS, LISTINGS, BENCH, NO_LIVE, RESOLVED)
LOOKUP_LIVE = (SALES, DTS, LISTINGS, BENCH, FEED, LIVE, RESOLVED)
EVALUATED = evaluated()

# --- sources and parsing ------------------------------------------------------------
def money(x: str) -> str:
    return f"format('{{:,.2f}}', {rnd(x, 2)})"


RAW_SALES = f"""raw_once AS (
  SELECT {ID}, 0 AS copy,
    CASE WHEN l_orderkey % 101 = 0 THEN '$300,000.00' ELSE '$' || {money("price")} END AS sellingprice,
    CASE WHEN l_orderkey % 103 = 0 THEN '-' ELSE {money("mmr")} || ' USD' END AS mmr,
    CASE WHEN l_orderkey % 97 = 0 THEN 'unknown' WHEN l_orderkey % 89 = 0 THEN '1989'
      ELSE ' ' || year END AS year,
    format('{{:,}}', CAST(mileage AS BIGINT)) || ' mi' AS odometer,
    CASE WHEN l_linenumber = 6 THEN '1e1' ELSE CAST(CAST(condition AS INT) AS VARCHAR) END AS condition,
    '  ' || upper(make) || chr(9) AS make,
    CASE WHEN l_partkey % 200 <> 0 THEN model END AS model,
    CASE WHEN l_linenumber = 2 THEN '' ELSE upper(body) END AS body,
    CASE WHEN l_suppkey % 3 = 0 THEN 'sedan' ELSE transmission END AS transmission,
    CASE WHEN l_suppkey % 20 <> 0 THEN upper(state) END AS state,
    color || ' ' AS color
  FROM sales),
raw AS (
  SELECT * FROM raw_once UNION ALL
  SELECT * REPLACE (1 AS copy, 'other' AS body) FROM raw_once WHERE l_linenumber = 1)"""


def dirty(x: str) -> str:
    return f"try_cast(regexp_replace({x}, '[^0-9.]', '', 'g') AS DOUBLE)"


def text(x: str) -> str:
    return f"lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"


def plain(x: str) -> str:
    number = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
    return f"CASE WHEN regexp_matches({x}, '{number}') THEN try_cast(trim({x}) AS DOUBLE) END"


PARSED = f"""parsed AS (
  SELECT {dirty("sellingprice")} AS price, {dirty("mmr")} AS mmr, {plain("year")} AS year,
    {dirty("odometer")} AS mileage, {plain("condition")} AS condition, {text("make")} AS make,
    {text("model")} AS model, {text("body")} AS body, {text("transmission")} AS transmission,
    {text("state")} AS state, {text("color")} AS color, copy, {ID}
  FROM raw)"""

oracle("parse_numbers", SALES, RAW_SALES, select=f"""
SELECT copy, {ID}, {dirty("sellingprice")} AS sellingprice_num, {dirty("mmr")} AS mmr_num,
  {dirty("odometer")} AS odometer_num, {plain("year")} AS year_num,
  {plain("condition")} AS condition_num FROM raw""")

oracle("scan_sales", SALES, RAW_SALES, PARSED, select="SELECT * FROM parsed")

CLEAN = """kept AS (
  SELECT * REPLACE (CAST(trunc(year) AS INT) AS year,
      CASE WHEN transmission IN ('automatic', 'manual') THEN transmission ELSE 'unknown' END AS transmission,
      coalesce(nullif(body, ''), 'unknown') AS body, coalesce(nullif(state, ''), 'unknown') AS state,
      coalesce(nullif(color, ''), 'unknown') AS color)
  FROM parsed
  WHERE price BETWEEN 500 AND 250000 AND mmr BETWEEN 500 AND 250000
    AND mileage BETWEEN 1 AND 400000 AND year BETWEEN 1990 AND 2015
    AND make IS NOT NULL AND model IS NOT NULL)"""

oracle("clean_sales", SALES, RAW_SALES, PARSED, CLEAN, select=f"""
SELECT * FROM kept QUALIFY row_number() OVER (
  PARTITION BY price, mmr, year, mileage, make, model, state ORDER BY copy, {ID}) = 1""")

oracle("dedup_sales", SALES, select=f"""
SELECT * REPLACE ({rnd("price", -3)} AS price) FROM sales
QUALIFY row_number() OVER (PARTITION BY make, year, state, {rnd("price", -3)} ORDER BY {ID}) = 1""")

SUFFIX = r"\s*\d?-?\s*(speed|spd)?\s*(a/t|m/t|automatic|manual|cvt|auto)\.?$"
RAW_RETAIL = f"""raw_retail AS (
  SELECT {ID}, '$' || {money("price")} AS price, CAST(year AS VARCHAR) AS year,
    CASE WHEN l_linenumber = 5 THEN '9' ELSE format('{{:,}}', CAST(mileage AS BIGINT)) END AS mileage,
    make, model || CASE WHEN l_linenumber % 2 = 0 THEN '6-Speed Automatic' ELSE ' CVT' END AS model,
    upper(state) AS state
  FROM sales)"""

oracle("strip_suffix", SALES, RAW_RETAIL, select=f"""
SELECT model, lower(trim(regexp_replace(model, '{SUFFIX}', '', 'i'))) AS stripped, count(*) AS n
FROM raw_retail GROUP BY model""")

BLENDED = f"""blended AS (
  SELECT {dirty("price")} AS price, {plain("year")} AS year, {dirty("mileage")} AS mileage,
    {text("make")} AS make, lower(trim(regexp_replace(model, '{SUFFIX}', '', 'i'))) AS model,
    {text("state")} AS state, CAST(NULL AS DOUBLE) AS condition, 'retail' AS source_channel,
    'true_car_listings' AS source, 0 AS copy, {ID}, 0 AS source_order FROM raw_retail
  UNION ALL
  SELECT price, year, mileage, make, model, state, condition, 'wholesale', 'car_prices', copy, {ID}, 1
  FROM parsed
  UNION ALL
  SELECT {dirty(f"'$' || {money('price * 1.1e0')}")}, CAST(year + 22 AS DOUBLE), mileage, make, model,
    NULL, NULL, 'retail', 'used_cars', 0, {ID}, 2 FROM sales)"""

oracle("harmonize_union", SALES, RAW_SALES, PARSED, RAW_RETAIL, BLENDED, select=f"""
SELECT source, source_channel, make, count(*) AS n, count(price) AS prices, count(year) AS years,
  count(state) AS states, count(condition) AS conditions, {rnd("sum(mileage)", 4)} AS mileage_sum,
  min(model) AS first_model, max(model) AS last_model
FROM blended GROUP BY 1, 2, 3""")

oracle("harmonize_clean", SALES, RAW_SALES, PARSED, RAW_RETAIL, BLENDED, select=f"""
SELECT * REPLACE (CAST(trunc(year) AS INT) AS year, coalesce(state, 'unknown') AS state)
FROM blended
WHERE price BETWEEN 500 AND 300000 AND mileage BETWEEN 10 AND 400000
  AND year BETWEEN 1990 AND 2025 AND make IS NOT NULL AND model IS NOT NULL
QUALIFY row_number() OVER (
  PARTITION BY price, trunc(year), mileage, make, model, coalesce(state, 'unknown')
  ORDER BY source_order, copy, {ID}) = 1""")

oracle("dts_latest", """sheet AS (
  SELECT CASE WHEN p_partkey % 19 = 0 THEN 'industry' WHEN p_partkey % 23 = 0 THEN 'make'
      ELSE lower(p_brand) END AS make, p_partkey % 10 AS month, p_partkey AS position,
    CASE WHEN p_partkey % 13 = 0 OR p_partkey % 17 = 0 THEN NULL
      ELSE CAST(30 + p_partkey % 100 AS DOUBLE) END AS days
  FROM part)""", select="""
SELECT make, arg_max(days, position) AS days FROM sheet
WHERE month = (SELECT max(month) FROM sheet) AND days IS NOT NULL
  AND make NOT IN ('industry', 'make') GROUP BY make""")


# --- splits -----------------------------------------------------------------------
def hash32(salt: str) -> str:
    return (f"CAST('0x' || substr(md5('42|{salt}|' || l_orderkey || '|' || l_linenumber || '|' || "
            f"l_partkey || '|' || l_suppkey), 1, 8) AS BIGINT)")


oracle("split_counts", SALES, select=f"""
SELECT CASE WHEN {hash32("test")} % 10000 < 2000 THEN 'test'
    WHEN {hash32("val")} % 10000 < 1500 THEN 'val' ELSE 'train' END AS split,
  make, count(*) AS n FROM sales GROUP BY 1, 2""")

oracle("split_recent", SALES, select=f"""
SELECT CASE WHEN year >= 2000 AND {hash32("recent")} % 10000 < 4000 THEN 'recent'
    WHEN {hash32("test")} % 10000 < 2000 THEN 'test' ELSE 'train' END AS split,
  year, count(*) AS n FROM sales GROUP BY 1, 2""")

oracle("sample_cap", SALES, select=f"""
SELECT {ID}, make, mmr FROM sales ORDER BY {hash32("sample")}, {ID} LIMIT 20000""")

# --- files --------------------------------------------------------------------------
FILED = """filed AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 41 <> 0 THEN transmission END AS transmission,
    CASE WHEN l_orderkey % 41 <> 0 THEN color END AS color)
  FROM raw WHERE l_orderkey % 37 <> 0)"""
oracle("csv_roundtrip", SALES, RAW_SALES, FILED, PARSED.replace("FROM raw", "FROM filed"), CLEAN, select=f"""
SELECT * EXCLUDE (copy, {ID}) FROM kept QUALIFY row_number() OVER (
  PARTITION BY price, mmr, year, mileage, make, model, state ORDER BY {ID}, copy) = 1""")

oracle("csv_first_rows", SALES, RAW_SALES, f"""lines AS (
  SELECT {ID}, copy, make, model, sellingprice,
    CASE WHEN l_orderkey % 43 = 0 THEN 'big "north", inc' || chr(10) || 'second line' ELSE 'dealer, inc' END AS seller
  FROM raw WHERE l_orderkey % 37 <> 0
  UNION ALL SELECT {ID}, 2, NULL, NULL, NULL, NULL FROM raw_once WHERE l_orderkey % 47 = 0)""", select=f"""
SELECT make, model, sellingprice, seller FROM lines ORDER BY {ID}, copy LIMIT 7500""")

oracle("split_roundtrip", SALES, select=f"""
SELECT {ID}, make, mmr, 'test' AS split FROM sales WHERE {hash32("test")} % 10000 < 2000""")

# --- benchmarks ---------------------------------------------------------------------
LEVEL_NAME = ("CASE gid WHEN 0 THEN 'make/model/year' WHEN 1 THEN 'make/model' "
              "WHEN 3 THEN 'make' ELSE 'global' END")

oracle("mmr_rollup", SALES, BENCH, select=f"""
SELECT {LEVEL_NAME} AS level, make, model, year, {rnd("value", 4)} AS value, n FROM bench""")

oracle("mmr_approximate", SALES, BENCH, select=f"""
SELECT {LEVEL_NAME} AS level, make, model, year, n, true AS within FROM bench""")

oracle("registry_tables", SALES, DTS, BENCH, select="""
SELECT 'mmr_lookup' AS name, count(*) AS n, CAST(0 AS BIGINT) AS differing, count(*) AS stated FROM bench
UNION ALL SELECT 'dts_benchmark', count(*), CAST(0 AS BIGINT), count(*) FROM dts""")

oracle("registry_models", SALES, select="""
SELECT name, count(*) AS n, CAST(0 AS BIGINT) AS differing
FROM sales, (SELECT unnest(['resale', 'band', 'profit']) AS name) GROUP BY name""")

oracle("mmr_retail_proxy", SALES, """picked AS (
  SELECT * FROM sales WHERE l_linenumber <= 3
    OR (SELECT count(*) FROM sales WHERE l_linenumber <= 3) <= 1000)""", select=f"""
SELECT CASE grouping_id(make, model, year) WHEN 0 THEN 'make/model/year' WHEN 1 THEN 'make/model'
    WHEN 3 THEN 'make' ELSE 'global' END AS level,
  make, model, year, {rnd("median(price)", 4)} AS value, count(*) AS n
FROM picked GROUP BY GROUPING SETS ((make, model, year), (make, model), (make), ())""")

oracle("mmr_lookup", *LOOKUP, select=f"""
SELECT {ID}, {rnd("lookup_value", 4)} AS lookup_value, lookup_level, lookup_n FROM resolved""")

oracle("mmr_resolve", *LOOKUP, select=f"""
SELECT {ID}, {rnd("mmr", 4)} AS mmr, mmr_match_level, mmr_sample_size,
  {rnd("(listing_price - mmr) / CASE WHEN mmr <> 0 THEN mmr END", 4)} AS delta FROM chosen""")

oracle("dts_lookup", *LOOKUP, select=f"""
SELECT {ID}, {rnd("make_days", 4)} AS make_days, {band("make_days")} AS make_band FROM resolved""")

oracle("comparables", SALES, FEED, select=f"""
SELECT CAST(any_state AS INT) AS any_state, make, model, year, state,
  {rnd("live_value", 4)} AS live_value, {rnd("live_days", 4)} AS live_days, live_n
FROM feed_stats WHERE live_value IS NOT NULL""")

# --- learned models ---------------------------------------------------------------------
oracle("model_band_truth", SALES, DTS, select=f"""
SELECT {ID}, make, {band("days")} AS model_band, 1e0 AS proba_total FROM sales JOIN dts USING (make)""")

# --- features and labels --------------------------------------------------------------
FEATURES = f"""inputs AS (
  SELECT {ID}, CASE WHEN l_partkey % 31 <> 0 THEN year END AS year,
    CASE WHEN l_partkey % 37 <> 0 THEN mileage END AS mileage, condition,
    CASE WHEN l_suppkey % 11 <> 0 THEN mmr END AS market_value, make, model, body, transmission,
    CASE WHEN l_suppkey % 20 <> 0 THEN state ELSE 'unknown' END AS state, 'unknown' AS color
  FROM sales),
aged AS (
  SELECT *, CASE WHEN year IS NULL THEN NULL WHEN year > 2002 THEN 0e0 ELSE 2002e0 - year END
    AS vehicle_age FROM inputs),
feats AS (
  SELECT {ID}, vehicle_age, mileage,
    mileage / CASE WHEN vehicle_age = 0 THEN 1 ELSE vehicle_age END AS mileage_per_year,
    condition, market_value, make, model, body, transmission, state, color
  FROM aged)"""


def rounded(fmt: str) -> str:
    return ", ".join(f"{rnd(fmt.format(c=c), 4)} AS {c}" for c in
                     ("vehicle_age", "mileage", "mileage_per_year", "market_value"))


TEXTS = "make, model, body, transmission, state, color"
oracle("features_core", SALES, FEATURES, select=f"""
SELECT {ID}, {rounded("{c}")}, {rnd("condition", 4)} AS condition, {TEXTS} FROM feats""")

oracle("features_imputed", SALES, FEATURES, select=f"""
SELECT {ID}, {rounded("coalesce({c}, (SELECT median({c}) FROM feats))")},
  {rnd("condition", 4)} AS condition, {TEXTS} FROM feats""")


def code(c: str) -> str:
    return (f"coalesce((SELECT idx FROM codes WHERE feature = '{c}' AND codes.value = f.{c}), -1e0) AS {c}")


oracle("encode_features", SALES, FEATURES, """known AS (
  UNPIVOT (SELECT f.make, f.model, f.body, f.transmission, f.state, f.color
    FROM feats f WHERE """ + f"{hash32('test')} % 10000 >= 2000 AND {hash32('val')} % 10000 >= 1500" + """)
  ON make, model, body, transmission, state, color INTO NAME feature VALUE value),
codes AS (
  SELECT feature, value, CAST(rank() OVER (PARTITION BY feature ORDER BY value) - 1 AS DOUBLE) AS idx
  FROM (SELECT DISTINCT feature, value FROM known))""", select=f"""
SELECT {ID}, {", ".join(code(c) for c in TEXTS.split(", "))} FROM feats f""")

LABEL = f"""CASE WHEN ({rnd("price", 2)} - 0.8e0 * mmr) / (0.8e0 * CASE WHEN mmr <> 0 THEN mmr END)
    >= 0.15e0 THEN 1 ELSE 0 END"""
oracle("profit_label", SALES, select=f"SELECT {ID}, CAST({LABEL} AS INT) AS label FROM sales")

LABELLED = f"""labelled0 AS (
  SELECT *, {LABEL} AS label,
    ((l_orderkey * 31 + l_partkey * 7 + l_linenumber) % 997) / 997e0 AS noise FROM sales),
labelled AS (
  SELECT label, {rnd("0.35e0 * label + 0.65e0 * noise", 4)} AS score FROM labelled0)"""

oracle("class_weights", SALES, LABELLED, select=f"""
SELECT CAST(label AS INT) AS label, count(*) AS n,
  {rnd("(SELECT count(*) FROM labelled) / (2e0 * count(*))", 4)} AS weight
FROM labelled GROUP BY label""")

# --- decision layer ---------------------------------------------------------------------
CORE = f"""
SELECT {ID}, recommendation, {near("sure", 3)} AS confidence, {near("resale", 2)} AS predicted_resale_price,
  days_band AS days_to_sell_band, expected_gross_profit, roi, {near("ceiling", 2)} AS max_purchase_price,
  {near("mmr", 2)} AS market_value_mmr, {near("delta", 4)} AS price_vs_mmr_delta, price_source,
  mmr_match_level, mmr_sample_size, risk_level,
  CASE days_band WHEN 'Fast' THEN 'High demand' WHEN 'Moderate' THEN 'Steady demand'
    WHEN 'Slow' THEN 'Soft demand' ELSE 'Weak demand' END AS market_demand,
  {near("benchmark_days", 1)} AS days_to_sell_benchmark, {near("purchase", 2)} AS purchase_price,
  coverage_warning IS NOT NULL AS warned
FROM evaluated"""
oracle("evaluate_core", *LOOKUP, SCORED, EVALUATED, select=CORE)
oracle("log_content", *LOOKUP, SCORED, EVALUATED, select=CORE)
oracle("evaluate_live", *LOOKUP_LIVE, SCORED, EVALUATED, select=CORE)


def joined(*parts: str) -> str:
    return f"concat_ws(' | ', {', '.join(parts)})"


def when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def reasons(sure: str, verdict: str) -> tuple[str, ...]:
    return (
        when("roi < 0.15e0", f"'ROI ' || {pct('roi', 1)} || ' below target 15.0%'"),
        when("expected_gross_profit < 1000e0",
             f"'Gross profit $' || {whole('expected_gross_profit')} || ' below minimum $1,000'"),
        when(f"{sure} < 0.6e0",
             f"'Confidence ' || format('{{:.2f}}', {sure}) || ' below risk tolerance 0.60'"),
        when(f"{verdict} = 'Buy'", "'Meets ROI, profit, and confidence thresholds'"),
    )


GUIDE = f"""CASE WHEN listing_price IS NULL THEN 'No listing price: $' || {whole("ceiling")}
    || ' is the most you should bid at auction to still clear a 15% margin.'
  WHEN listing_price > ceiling THEN 'The $' || {whole("listing_price")} || ' listing is above your $'
    || {whole("ceiling")} || ' ceiling for a 15% margin. Negotiate to $' || {whole("ceiling")}
    || ' or below, or pass.'
  WHEN recommendation <> 'Buy' THEN 'Even at the $' || {whole("listing_price")}
    || ' listing this doesn''t clear your criteria (see the reasons above), so hold off.'
  ELSE 'Buy at the $' || {whole("listing_price")} || ' listing (or negotiate lower) — never above it. $'
    || {whole("ceiling")} || ' is only your walk-away ceiling for a 15% margin, not a target; the '
    || 'listing sits $' || {whole("ceiling - listing_price")} || ' under it.' END"""

NOTES = joined(
    "coverage_warning",
    when("mmr_match_level NOT IN ('provided', 'make/model/year', 'live')",
         "'Market value estimated at the ''' || mmr_match_level || ''' level.'"),
    when("mmr > 0 AND abs(resale - predicted_resale) / greatest(abs(predicted_resale), 1e0) >= 0.05e0",
         f"'Raw model resale $' || {whole('predicted_resale')} || ' was ' || lower({level('trust')}) "
         f"|| ' confidence; reconciled toward the market benchmark to $' || {whole('resale')} || '.'"),
    when("listing_price IS NULL", "CASE WHEN mmr IS NOT NULL THEN 'No listing price supplied; evaluated "
         "at a 20% wholesale discount below market value (MMR).' ELSE 'No listing price or market value; "
         "evaluated at predicted resale.' END"),
    *reasons("sure", "recommendation"), GUIDE)

FACTORS = joined(
    f"'Mileage=' || {whole('odometer')} || ' mi'",
    "'Vehicle age=' || greatest(0, 2016 - year) || ' yr'",
    "CASE WHEN condition IS NOT NULL THEN 'Condition=' || format('{:.0f}', greatest(0e0, least(100e0, round_even((condition - 1) / 48 * 100, 0)))) || '/100' END",
    "'Days-to-sell band=' || days_band",
    f"'Market value (MMR)=$' || {whole('mmr')}",
    f"'Price vs market=' || CASE WHEN starts_with({pct('delta')}, '-') THEN '' ELSE '+' END || {pct('delta')}")

oracle("evaluate_text", *LOOKUP, SCORED, EVALUATED, select=f"""
SELECT {ID}, {GUIDE} AS price_guidance, {NOTES} AS notes, {FACTORS} AS top_factors, coverage_warning
FROM evaluated""")

GAP = "abs(resale - mmr) / CASE WHEN mmr > 0 THEN mmr END"
FLAGS = (
    when("delta <= -0.6e0", f"'alert: Purchase price is ' || {pct('abs(delta)')} || ' below market value. "
         "That far below market almost always means a salvage/branded title, the wrong trim, or a "
         "data-entry error rather than a genuine bargain — verify before buying.'"),
    when(f"{GAP} >= 0.5e0", f"'warn: Predicted resale ($' || {whole('resale')} || ') and market value ($' || "
         f"{whole('mmr')} || ') disagree by ' || {pct(GAP)} || '; treat the valuation as low-confidence.'"),
    when("odometer IS NULL OR odometer <= 0", "'warn: Mileage is 0 — enter the actual odometer reading. A "
         "used-vehicle valuation with no mileage is unreliable.'"),
    when("odometer > 300000", f"'warn: Mileage ' || {whole('odometer')} || ' is unusually high; confirm it "
         "is correct.'"),
    when("year IS NULL OR year <= 0", "'warn: Model year is missing or invalid.'"),
    when("roi > 1e0", f"'warn: Projected ROI of ' || {pct('roi')} || ' is implausibly high and usually "
         "reflects a bad price or missing inputs rather than a real opportunity.'"),
)
oracle("quality_flags", *LOOKUP, SCORED, EVALUATED, select=f"""
SELECT {ID}, CAST({" + ".join(f"(({f}) IS NOT NULL)::INT" for f in FLAGS)} AS INT) AS n_flags,
  {joined(*FLAGS)} AS flags FROM evaluated""")

oracle("financials", *LOOKUP, SCORED, """deal AS (
  SELECT *, coalesce(listing_price, mmr) AS buy,
    20e0 * CASE WHEN l_linenumber <> 4 THEN benchmark_days ELSE 45e0 END AS holding FROM scored)""",
       select=f"""
SELECT {ID}, {near("buy", 2)} AS purchase_price, 0e0 AS estimated_repairs,
  {near("predicted_resale", 2)} AS predicted_resale_price, {near("holding", 2)} AS total_holding_cost,
  {near("predicted_resale - buy - 0e0 - holding", 2)} AS net_profit,
  {near("CASE WHEN buy > 0 THEN (predicted_resale - buy - 0e0 - holding) / buy ELSE 0e0 END", 4)} AS roi,
  {near("predicted_resale - 0e0 - 20e0 * benchmark_days - 0.15e0 * predicted_resale", 2)} AS max_price,
  {near("0.15e0 * predicted_resale", 2)} AS required_profit
FROM deal""")

VERDICT_P = ("CASE WHEN roi >= 0.15e0 AND expected_gross_profit >= 1000e0 AND profit_p >= 0.6e0 "
             "THEN 'Buy' ELSE 'Pass' END")
oracle("buy_or_pass", *LOOKUP, SCORED, EVALUATED, select=f"""
SELECT {ID}, {VERDICT_P} AS verdict, {joined(*reasons("profit_p", VERDICT_P))} AS reasons
FROM evaluated""")

oracle("reconcile", *LOOKUP, SCORED, EVALUATED, select=f"""
SELECT {ID}, {rnd("predicted_resale", 4)} AS raw, {near("resale", 2)} AS predicted_resale_price,
  trust AS weight FROM evaluated""")


def confidence(name: str, ctes: tuple[str, ...], score: str, basis: str) -> None:
    oracle(name, *ctes, SCORED, EVALUATED,
           f"s AS (SELECT *, {score} AS shown_score, {basis} AS shown_basis FROM evaluated)",
           select=f"SELECT {ID}, shown_score AS score, {level('shown_score')} AS level, "
                  f"shown_basis AS basis FROM s")


confidence(
    "conf_market", LOOKUP_LIVE,
    clip3(f"{LEVEL_BASE} * (CASE WHEN mmr_sample_size < 5 THEN 0.55e0 "
          f"WHEN mmr_sample_size < 25 THEN 0.8e0 ELSE 1e0 END)"),
    """(CASE mmr_match_level WHEN 'provided' THEN 'You supplied the market value.'
      WHEN 'live' THEN 'Median of live market listings.'
      WHEN 'make/model/year' THEN 'Median of matching make / model / year sales.'
      WHEN 'make/model' THEN 'Median across all years for this make / model.'
      WHEN 'make' THEN 'Only a make-level median was available (no model match).'
      WHEN 'global' THEN 'No make match; using the overall dataset median.' END)
    || (CASE WHEN mmr_sample_size IS NULL THEN ''
      WHEN mmr_sample_size < 5 THEN ' Only ' || mmr_sample_size || ' comparable sale(s).'
      ELSE ' ' || format('{:,}', mmr_sample_size) || ' comparable sales.' END)""")

WHY = (f"""concat_ws('; ',
      CASE WHEN mmr_match_level IN ('make', 'global', 'none')
        THEN 'few comparable vehicles in the training data' END,
      CASE WHEN coverage_warning IS NOT NULL
        THEN 'vehicle is outside the model''s training coverage' END,
      CASE WHEN gap >= 0.5e0 THEN 'predicted resale disagrees with market value by ' || {pct("gap")}
        WHEN gap >= 0.3e0 THEN 'predicted resale differs from market value by ' || {pct("gap")} END)""")
confidence(
    "conf_resale", LOOKUP_LIVE, "trust",
    f"""CASE WHEN price_source = 'live' THEN 'Anchored to current live market listings.'
      WHEN {WHY} = '' THEN 'Gradient-boosted resale model on a well-represented segment.'
      ELSE 'Gradient-boosted resale model — ' || {WHY} || '.' END""")

confidence(
    "conf_band", LOOKUP_LIVE, clip3("CASE WHEN band_from_live THEN 0.85e0 ELSE band_proba END"),
    f"""CASE WHEN band_from_live THEN 'From live median days-on-market.'
      ELSE 'Classifier probability ' || {pct("band_proba")} || ' (make-level benchmark).' END""")

confidence(
    "conf_buy_pass", LOOKUP, clip3("sure"),
    f"""'Lower of profit-model ' || {pct("profit_p")} || ' and resale reliability ' || {pct("trust")}
      || ' (limited by the ' || CASE WHEN trust < profit_p THEN 'resale estimate'
      ELSE 'profit model' END || ').'""")

oracle("condition_scale", select=f"""
SELECT {ID}, shown, CASE WHEN shown IS NOT NULL THEN greatest(CAST(1 AS BIGINT), least(CAST(49 AS BIGINT),
    CAST(floor(1e0 + shown / 100e0 * 48e0 + 0.5e0) AS BIGINT))) END AS grade
FROM (SELECT *, CASE WHEN l_linenumber <> 6 THEN l_quantity * 2.5e0 - 10 END AS shown FROM lineitem)""")

SCENARIOS = """scenarios(scenario, margin, min_profit, tolerance, per_day, repairs, discount) AS (
  VALUES (0, 0.15e0, 1000e0, 0.6e0, 20e0, 0e0, 0.2e0), (1, 0.05e0, 250e0, 0.3e0, 20e0, 0e0, 0.2e0),
    (2, 0.15e0, 1000e0, 0.6e0, 45e0, 1500e0, 0.2e0), (3, 0.25e0, 1000e0, 0.6e0, 20e0, 0e0, 0.35e0)),
cases AS (SELECT * FROM weighed, scenarios)"""
oracle("scenario_grid", *LOOKUP, SCORED, SCENARIOS,
       evaluated("margin", "min_profit", "tolerance", "per_day", "repairs", "discount", "cases"),
       select=f"""
SELECT scenario, recommendation, days_band AS days_to_sell_band, risk_level, count(*) AS n,
  {rnd("CAST(sum(CAST(CAST(expected_gross_profit AS VARCHAR) AS DECIMAL(38,4))) AS DOUBLE)", 1)} AS profit,
  max(roi) AS best_roi, min({near("ceiling", 2)}) AS lowest_ceiling
FROM evaluated GROUP BY 1, 2, 3, 4""")

# --- batch triage ---------------------------------------------------------------------------
RAW_LISTINGS = f"""raw_list AS (
  SELECT {ID}, CASE WHEN l_orderkey % 61 = 0 THEN ' ' ELSE make END AS make,
    CASE WHEN l_orderkey % 67 = 0 THEN NULL ELSE model END AS model,
    CASE WHEN l_orderkey % 71 = 0 THEN '1975' WHEN l_orderkey % 73 = 0 THEN '20x5'
      ELSE year || '.0' END AS year,
    CASE WHEN l_orderkey % 79 = 0 THEN '-5' WHEN l_orderkey % 83 = 0 THEN 'inf'
      ELSE CAST(CAST(odometer AS INT) AS VARCHAR) END AS odometer,
    CAST(CAST(condition AS INT) AS VARCHAR) AS condition, body, '' AS transmission,
    CASE WHEN l_linenumber = 2 THEN NULL ELSE state END AS state,
    CASE WHEN l_linenumber = 3 THEN CASE WHEN l_orderkey % 2 = 0 THEN '$15,000' ELSE '15000' END END AS mmr,
    CASE WHEN l_linenumber > 2 THEN {rnd("price", 2)} END AS listing_price,
    1 + row_number() OVER (ORDER BY {ID}, CAST(CAST(odometer AS INT) AS VARCHAR)) AS row
  FROM listings),
checked AS (
  SELECT *, try_cast(year AS DOUBLE) AS y, CASE WHEN odometer = 'inf' THEN NULL
      ELSE try_cast(odometer AS DOUBLE) END AS o, try_cast(condition AS DOUBLE) AS c
  FROM raw_list),
validated AS (
  SELECT *, CASE WHEN trim(coalesce(make, '')) = '' THEN 'missing required field ''make'''
    WHEN trim(coalesce(model, '')) = '' THEN 'missing required field ''model'''
    WHEN condition IS NULL THEN 'missing required field ''condition'''
    WHEN y IS NULL THEN 'non-numeric year/odometer/condition'
    WHEN trunc(y) NOT BETWEEN 1980 AND 2025
      THEN 'year ' || CAST(trunc(y) AS BIGINT) || ' out of range 1980-2025'
    WHEN o IS NULL OR c IS NULL THEN 'non-numeric year/odometer/condition'
    WHEN o < 0 THEN 'odometer is negative' END AS error
  FROM checked)"""

oracle("batch_validate", SALES, LISTINGS, RAW_LISTINGS,
       select=f"SELECT {ID}, row, error FROM validated")
oracle("batch_errors", SALES, LISTINGS, RAW_LISTINGS,
       select="SELECT row, error FROM validated WHERE error IS NOT NULL")
oracle("csv_listing_errors", SALES, LISTINGS, RAW_LISTINGS,
       select="SELECT row, error FROM validated WHERE error IS NOT NULL")
TYPED = f"""typed AS (
  SELECT {ID}, row, make, model, CAST(trunc(y) AS INT) AS year, o AS odometer, c AS condition, body,
    transmission, coalesce(state, '') AS state, try_cast(mmr AS DOUBLE) AS mmr, listing_price
  FROM validated WHERE error IS NULL)"""
oracle("batch_typed", SALES, LISTINGS, RAW_LISTINGS, TYPED, select=f"SELECT * EXCLUDE (row) FROM typed")

BATCH = (SALES, DTS, LISTINGS, BENCH, NO_LIVE, RAW_LISTINGS, TYPED,
         RESOLVED.replace("FROM listings l", "FROM typed l"), SCORED, EVALUATED)
RESULTS = f"""results AS (
  SELECT row, make, model, year, recommendation, {near("sure", 3)} AS confidence,
    {near("resale", 2)} AS predicted_resale, {near("ceiling", 2)} AS max_purchase_price,
    expected_gross_profit, roi, days_band AS days_to_sell_band, risk_level FROM evaluated)"""
oracle("batch_results", *BATCH, RESULTS, select="SELECT * FROM results")
oracle("batch_summary", *BATCH, RESULTS, select="""
SELECT (SELECT count(*) FROM results) AS evaluated,
  (SELECT count(*) FROM validated WHERE error IS NOT NULL) AS errors,
  (SELECT count(*) FROM results WHERE recommendation = 'Buy') AS buy""")
for objective, order in {
        "profit": "expected_gross_profit DESC", "roi": "roi DESC",
        "risk": "CASE risk_level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END"}.items():
    oracle(f"batch_rank_{objective}", *BATCH, RESULTS, select=f"""
SELECT row_number() OVER (ORDER BY {order}, row) AS rank, row, expected_gross_profit, roi, risk_level
FROM results""")

# --- metrics and monitoring -----------------------------------------------------------------
PREDICTED = """predicted AS (
  SELECT state, price, mmr, mmr * (0.85e0 + 0.005e0 * ((l_partkey * 37 + l_suppkey) % 40)) AS pred
  FROM sales)"""
oracle("metrics_regression", SALES, PREDICTED, select=f"""
SELECT {rnd("mae", 4)} AS mae, {rnd("mape", 4)} AS mape, {rnd("rmsle", 4)} AS rmsle,
  {rnd("r2", 4)} AS r2, {rnd("base", 4)} AS mmr_baseline_mae,
  (base - mae) / base >= 0.05e0 AS beats_mmr_baseline
FROM (SELECT avg(abs(price - pred)) AS mae, avg(abs(price - pred) / price) FILTER (WHERE price > 0) AS mape,
    sqrt(avg(pow(ln(1 + greatest(pred, 0)) - ln(1 + price), 2))) AS rmsle,
    1 - sum(pow(price - pred, 2)) / sum(pow(price - (SELECT avg(price) FROM predicted), 2)) AS r2,
    avg(abs(price - mmr)) AS base FROM predicted)""")

STATES = """states AS (
  SELECT state, avg(abs(price - pred)) AS mae, count(*) AS n FROM predicted
  GROUP BY state HAVING count(*) >= 30)"""
oracle("state_mae", SALES, PREDICTED, STATES, select=f"""
SELECT state, {rnd("mae", 4)} AS mae, n FROM (SELECT * FROM states ORDER BY mae DESC, state LIMIT 5)""")
oracle("state_mae_all", SALES, PREDICTED, STATES, select=f"""
SELECT state, {rnd("mae", 4)} AS mae, n FROM states""")
oracle("state_gap", SALES, PREDICTED, STATES, select=f"""
SELECT (SELECT state FROM states ORDER BY mae, state LIMIT 1) AS best_state,
  (SELECT state FROM states ORDER BY mae DESC, state DESC LIMIT 1) AS worst_state,
  {rnd("min(mae)", 4)} AS best_mae, {rnd("max(mae)", 4)} AS worst_mae,
  {rnd("max(mae) - min(mae)", 4)} AS gap, {rnd("max(mae) / min(mae)", 4)} AS gap_ratio FROM states""")

oracle("metrics_multiclass", SALES, DTS, f"""guessed AS (
  SELECT {band("days")} AS y, {band("days + (l_partkey % 7) * 5 - 15")} AS p
  FROM sales JOIN dts USING (make)),
labels_seen AS (SELECT y AS label FROM guessed UNION SELECT p FROM guessed),
f1s AS (
  SELECT label, (SELECT count(*) FROM guessed WHERE y = label AND p = label) AS tp,
    (SELECT count(*) FROM guessed WHERE y <> label AND p = label) AS fp,
    (SELECT count(*) FROM guessed WHERE y = label AND p <> label) AS fn FROM labels_seen)""",
       select=f"""
SELECT {rnd("(SELECT avg((y = p)::INT) FROM guessed)", 4)} AS accuracy,
  {rnd("avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0 END)", 4)} AS macro_f1
FROM f1s""")

CURVE = """g AS (SELECT score, sum(label) AS tp, sum(1 - label) AS fp FROM labelled GROUP BY score),
curve AS (
  SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp, sum(tp) OVER () AS np, sum(fp) OVER () AS nn
  FROM g WINDOW w AS (ORDER BY score DESC))"""


def f1_at(cut: str) -> str:
    hit = f"score >= {cut}"
    return (f"2e0 * count(*) FILTER (WHERE {hit} AND label = 1) / (2 * count(*) FILTER (WHERE {hit} AND "
            f"label = 1) + count(*) FILTER (WHERE {hit} AND label = 0) + count(*) FILTER (WHERE NOT ({hit}) "
            f"AND label = 1))")


oracle("metrics_binary", SALES, LABELLED, CURVE, select=f"""
SELECT 0.42e0 AS threshold, {rnd("avg(((score >= 0.42e0)::INT = label)::INT)", 4)} AS accuracy,
  {rnd(f1_at("0.42e0"), 4)} AS f1, {rnd(f1_at("0.5e0"), 4)} AS f1_at_0_5,
  {rnd("2 * avg(label) / (avg(label) + 1)", 4)} AS trivial_f1_baseline,
  {rnd("(SELECT sum(fp * (ctp - tp) + 0.5e0 * tp * fp) / max(np * nn) FROM curve)", 4)} AS roc_auc,
  {rnd("(SELECT sum(tp / np * (ctp / (ctp + cfp))) FROM curve)", 4)} AS auc_pr,
  {rnd("avg(pow(score - label, 2))", 4)} AS brier, {rnd("avg(label)", 4)} AS positive_rate
FROM labelled""")

oracle("threshold_search", SALES, LABELLED, CURVE, """f AS (
  SELECT score, 2 * (ctp / (ctp + cfp)) * (ctp / np) / (ctp / (ctp + cfp) + ctp / np + 1e-12) AS f1
  FROM curve)""", select=f"""
SELECT {rnd("score", 4)} AS threshold, {rnd("f1", 4)} AS best_f1 FROM f ORDER BY f1 DESC, score LIMIT 1""")

oracle("psi", SALES, """old AS (SELECT mmr AS x FROM sales WHERE year < 1999),
fresh AS (SELECT CASE WHEN l_linenumber <> 7 THEN mmr * 1.15e0 END AS x FROM sales WHERE year >= 1999),
cuts AS (
  SELECT DISTINCT unnest(quantile_cont(x, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS lo FROM old),
bins AS (
  SELECT lo, lead(lo) OVER (ORDER BY lo) AS hi, row_number() OVER (ORDER BY lo DESC) = 2 AS is_last
  FROM cuts),
shares AS (
  SELECT greatest((SELECT count(*) FROM old WHERE x >= lo AND (x < hi OR (is_last AND x = hi)))
      / (SELECT count(*)::DOUBLE FROM old), 1e-6) AS e,
    greatest((SELECT count(*) FROM fresh WHERE x >= lo AND (x < hi OR (is_last AND x = hi)))
      / (SELECT count(x)::DOUBLE FROM fresh), 1e-6) AS a
  FROM bins WHERE hi IS NOT NULL)""", select=f"""
SELECT {rnd("sum((a - e) * ln(a / e))", 6)} AS psi,
  CAST(0 AS BIGINT) AS expected_nulls,
  (SELECT count(*) FROM fresh WHERE x IS NULL) AS actual_nulls FROM shares""")


# --- options --------------------------------------------------------------------------------
def top(name: str, column: str, n: int, drop: bool) -> str:
    cut = f"SELECT {column} AS value, count(*) AS n FROM sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {n}"
    keep = " WHERE value NOT IN ('', 'unknown')" if drop else ""
    return f"SELECT '{name}' AS list, value, n FROM ({cut}){keep}"


TOPS = "\nUNION ALL\n".join([top("makes", "make", 60, False), top("bodies", "body", 30, True),
                            top("colors", "color", 25, True), top("states", "state", 60, True)])
oracle("options_topn", SALES, select=TOPS)
oracle("options_models", SALES, select="""
SELECT make, CAST(count(*) AS INT) AS n_models, string_agg(model, ',' ORDER BY model) AS models
FROM (SELECT make, model FROM sales GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY make ORDER BY count(*) DESC, model) <= 40)
GROUP BY make""")
oracle("options_scalar", SALES, select="""
SELECT min(year) AS year_min, max(year) AS year_max, 1e0 AS condition_min, 49e0 AS condition_max,
  count(*) AS n_rows FROM sales""")
oracle("options_row", SALES, f"tops AS ({TOPS})", select="""
SELECT min(year) AS year_min, max(year) AS year_max, 1e0 AS condition_min, 49e0 AS condition_max,
  (SELECT string_agg(value, ',' ORDER BY value) FROM tops WHERE list = 'makes') AS makes,
  (SELECT string_agg(value, ',' ORDER BY value) FROM tops WHERE list = 'bodies') AS bodies,
  (SELECT string_agg(value, ',' ORDER BY value) FROM tops WHERE list = 'colors') AS colors,
  (SELECT string_agg(value, ',' ORDER BY value) FROM tops WHERE list = 'states') AS states,
  'automatic,manual' AS transmissions
FROM sales""")
