"""Sales, listings and benchmark tables derived from the star-schema test tables.

The registered queries run over these frames. Each covers every row of its tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import days_to_band
from ..operators.lookup import BROADCAST_BYTES, table_bytes
from .writers import csv_line

ROW_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
REFERENCE_YEAR = 2002  # the test tables hold model years up to 2001


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Shuffle a scan that has fewer input splits than cores, such as one small file.

    A large table has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item of a known part, supplier and order.

    The wide texts of the parts are joined last, so that no shuffle of the line items carries them. What is made from
    a part, an order or a supplier alone is made there, once.
    """
    items, parts, orders, suppliers, nations = (
        read(spark, sf_dir, t) for t in ("lineitem", "part", "orders", "supplier", "nation"))
    items = spread(items.select(*ROW_ID, "l_quantity", "l_extendedprice", "l_discount",
                                "l_returnflag"), ROW_ID)
    orders = orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    suppliers = (suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
                 .select("s_suppkey", F.lower("n_name").alias("state")))
    if table_bytes(suppliers) <= BROADCAST_BYTES:  # Spark's own estimate of a join is the product of both sides
        suppliers = F.broadcast(suppliers)
    parts = parts.select(
        "p_partkey", F.lower("p_brand").alias("make"), F.lower("p_name").alias("model"),
        F.col("p_size").cast("double").alias("size"), F.lower("p_type").alias("body"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("color"))
    joined = (items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(parts, F.col("l_partkey") == F.col("p_partkey")))
    flag = F.col("l_returnflag")
    return joined.select(
        *ROW_ID, "make", "model", "year",
        (F.col("l_quantity") * 8000).alias("mileage"),
        F.when(F.col("l_linenumber") != 7, F.col("size")).alias("condition"),
        "body",
        F.when(flag == "A", "automatic").when(flag == "N", "manual").otherwise("unknown")
        .alias("transmission"),
        "state", "color",
        F.col("l_extendedprice").alias("mmr"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price"),
    )


def days_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Make, days: one row per make."""
    number = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    return (read(spark, sf_dir, "part").groupBy(F.lower("p_brand").alias("make"))
            .agg((40.0 + 3.5 * F.max(number)).alias("days")))


def listings(sold: DataFrame, *keep: str) -> DataFrame:
    """Candidate listings of every sale; some keys are changed to reach every fallback."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    return sold.select(
        *ROW_ID,
        F.when(key % 49 == 0, "nomake").otherwise(F.col("make")).alias("make"),
        F.when(key % 7 == 0, "nomodel").otherwise(F.col("model")).alias("model"),
        F.when(key % 5 == 0, 1985).when(key % 11 == 0, 2017).otherwise(F.col("year")).alias("year"),
        F.col("mileage").alias("odometer"), "condition", "body", "transmission", "state", "color",
        F.when(line == 3, F.col("mmr")).alias("mmr"),
        F.when(line > 2, F.col("price") * (0.7 + 0.05 * line)).alias("listing_price"),
        *keep,
    )


def with_surrogate_scores(resolved: DataFrame) -> DataFrame:
    """Fixed formulas in place of fitted models, so that results can be checked in SQL."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    wave = 0.85 + 0.005 * ((part * 37 + supp) % 100)
    return resolved.withColumns({
        "model_resale": F.col("mmr") * wave * F.when(part % 50 == 0, 1.5).otherwise(1.0),
        "model_band": days_to_band(F.col("make_days")),
        "band_proba": ((part + supp) % 101) / 100.0,
        "profit_p": (50 + ((F.col("l_orderkey") * 31 + F.col("l_linenumber")) % 50)) / 100.0,
    })


def live_listings(sold: DataFrame) -> DataFrame:
    """Comparable live listings: prices 12 % up, some missing or zero, days from quantity."""
    line = F.col("l_linenumber")
    return sold.select(
        "make", "model", "year", "state",
        F.when(line == 4, 0.0).when(line == 5, F.lit(None)).otherwise(F.col("price") * 1.12)
        .alias("price"),
        F.when(line == 2, -1.0).otherwise(F.col("mileage") / 4000).alias("dom"))


def _money(c: Column) -> Column:
    return F.format_number(F.round(c, 2), 2)


def raw_sales(sold: DataFrame) -> DataFrame:
    """Sales as dirty text, with contaminated and missing fields and repeated rows."""
    key, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    text = sold.select(
        *ROW_ID, F.lit(0).alias("copy"),
        F.when(key % 101 == 0, "$300,000.00").otherwise(F.concat(F.lit("$"), _money(F.col("price"))))
        .alias("sellingprice"),
        F.when(key % 103 == 0, "-").otherwise(F.concat(_money(F.col("mmr")), F.lit(" USD"))).alias("mmr"),
        F.when(key % 97 == 0, "unknown").when(key % 89 == 0, "1989")
        .otherwise(F.concat(F.lit(" "), F.col("year").cast("string"))).alias("year"),
        F.concat(F.format_number(F.col("mileage"), 0), F.lit(" mi")).alias("odometer"),
        F.when(line == 6, "1e1").otherwise(F.col("condition").cast("int").cast("string")).alias("condition"),
        F.concat(F.lit("  "), F.upper("make"), F.lit("\t")).alias("make"),
        F.when(part % 200 != 0, F.initcap("model")).alias("model"),
        F.when(line == 2, "").otherwise(F.upper("body")).alias("body"),
        F.when(F.col("l_suppkey") % 3 == 0, "sedan").otherwise(F.initcap("transmission"))
        .alias("transmission"),
        F.when(F.col("l_suppkey") % 20 != 0, F.upper("state")).alias("state"),
        F.concat(F.col("color"), F.lit(" ")).alias("color"),
    )
    again = text.where(F.col("l_linenumber") == 1).withColumns(
        {"copy": F.lit(1), "body": F.lit("other")})
    return text.unionByName(again)


RAW_ORDER = ["copy", *ROW_ID]


def raw_retail(sold: DataFrame) -> DataFrame:
    return sold.select(
        *ROW_ID, F.lit(0).alias("copy"),
        F.concat(F.lit("$"), _money(F.col("price"))).alias("price"),
        F.col("year").cast("string").alias("year"),
        F.when(F.col("l_linenumber") == 5, "9").otherwise(
            F.format_number(F.col("mileage"), 0)).alias("mileage"),
        "make",
        F.concat(F.col("model"), F.when(F.col("l_linenumber") % 2 == 0, "6-Speed Automatic")
                 .otherwise(" CVT")).alias("model"),
        F.upper("state").alias("state"))


def raw_recent(sold: DataFrame) -> DataFrame:
    return sold.select(
        *ROW_ID, F.lit(0).alias("copy"),
        F.concat(F.lit("$"), _money(F.col("price") * 1.1)).alias("price"),
        (F.col("year") + 22).cast("string").alias("model_year"),
        F.concat(F.format_number(F.col("mileage"), 0), F.lit(" mi.")).alias("milage"),
        F.upper("make").alias("brand"), "model")


def raw_listings(sold: DataFrame) -> DataFrame:
    """Listings as text with every kind of invalid row."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    return listings(sold, "price").select(
        *ROW_ID,
        F.when(key % 61 == 0, " ").otherwise(F.col("make")).alias("make"),
        F.when(key % 67 == 0, F.lit(None)).otherwise(F.col("model")).alias("model"),
        F.when(key % 71 == 0, "1975").when(key % 73 == 0, "20x5")
        .otherwise(F.concat(F.col("year").cast("string"), F.lit(".0"))).alias("year"),
        F.when(key % 79 == 0, "-5").when(key % 83 == 0, "inf")
        .otherwise(F.col("odometer").cast("int").cast("string")).alias("odometer"),
        F.coalesce(F.col("condition").cast("int").cast("string"), F.lit("N/A")).alias("condition"),
        "body",
        F.when(line == 2, F.lit(None)).otherwise(F.col("state")).alias("state"),
        F.when(line == 3, F.when(key % 2 == 0, "$15,000").otherwise("15000")).alias("mmr"),
        F.when(line > 2, F.replace(_money(F.col("price")), F.lit(","), F.lit("")))
        .alias("listing_price"),
    )


FILE_KEYS = 20_000  # order keys that share a file


def _file_part() -> Column:
    return F.lpad(F.floor(F.col("l_orderkey") / FILE_KEYS).cast("string"), 12, "0").alias("part")


SALES_HEADER = " Year,make,Model,trim,body,vin,state,condition,odometer,seller,mmr,sellingprice,transmission,color"


def sales_lines(raw: DataFrame) -> DataFrame:
    """Raw sales as CSV records: some too long, some short, some with a line break in a field, some without any field."""
    key = F.col("l_orderkey")
    seller = F.when(key % 43 == 0, 'big "north", inc\nsecond line').otherwise("dealer, inc")
    fields = [F.col("year"), F.col("make"), F.col("model"), F.lit("lx"), F.col("body"), F.lit(None).cast("string"),
              F.col("state"), F.col("condition"), F.col("odometer"), seller, F.col("mmr"), F.col("sellingprice")]
    # each part of a record is made once, as a column: with every case written out, the generated method would be too large to compile
    raw = raw.withColumns({"_line": csv_line(*fields), "_last": csv_line(F.col("transmission"), F.col("color"))})
    whole = F.concat_ws(",", "_line", "_last")
    line = (F.when(key % 37 == 0, F.concat(whole, F.lit(",extra")))
            .when(key % 41 == 0, F.col("_line")).otherwise(whole))
    rows = raw.select(_file_part(), *ROW_ID, "copy", line.alias("line"))
    junk = rows.where((key % 47 == 0) & (F.col("copy") == 0)).withColumns({"copy": F.lit(2), "line": F.lit("###")})
    return rows.unionByName(junk)


LISTING_COLUMNS = ["make", "model", "year", "odometer", "condition", "body", "state", "mmr", "listing_price"]


def listing_lines(raw: DataFrame) -> DataFrame:
    """Raw listings as CSV records."""
    return raw.select(_file_part(), *ROW_ID, "odometer", csv_line(*[F.col(c) for c in LISTING_COLUMNS]).alias("line"))


def days_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long days-to-turn rows per part and month, with headings, blanks and repeats."""
    parts = read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    month = F.make_date(F.lit(2016), (F.lit(1) + key % 10).cast("int"), F.lit(1))
    text = (F.when(key % 13 == 0, F.lit(None)).when(key % 17 == 0, "n.a.")
            .otherwise((30 + key % 100).cast("string")))
    return parts.select(
        F.when(key % 19 == 0, " Industry").when(key % 23 == 0, "Make")
        .otherwise(F.upper("p_brand")).alias("make"),
        month.alias("month"), text.alias("days"), key.alias("position"))
