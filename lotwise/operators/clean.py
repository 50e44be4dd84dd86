"""Cleaning, bounds, first-row deduplication and the union of sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.parse import (dirty_number, norm_column, or_unknown, strip_column, strip_transmission,
                               stripped_number)


def parsed_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed exactly once per row.

    Filters on a parsed column would otherwise be pushed below the projection and repeat
    its parsing for each comparison; they do not pass a generator.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def stripped(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns without white space around them: a column of its own is made once, however often it is read."""
    return raw.withColumns({c: strip_column(F.col(c).cast("string")) for c in columns})


def parse_sales(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed sales from raw text columns; ``keep`` carries extra columns through."""
    return parsed_once(stripped(raw, ["year", "condition"]).select(
        dirty_number(F.col("sellingprice")).alias("price"),
        dirty_number(F.col("mmr")).alias("mmr"),
        stripped_number(F.col("year")).alias("year"),
        dirty_number(F.col("odometer")).alias("mileage"),
        stripped_number(F.col("condition")).alias("condition"),
        *[norm_column(F.col(c)).alias(c)
          for c in ("make", "model", "body", "transmission", "state", "color")],
        *keep,
    ))


def within_bounds(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """Keep rows whose bounded columns are present and inside (inclusive)."""
    for name, (low, high) in bounds.items():
        df = df.where(F.col(name).between(low, high))
    return df


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the first by ``order``.

    Spark limits each key to its first row before the shuffle as well as after it, so a
    large group of copies never meets in one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn"))


def clean_sales(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Required fields, bounds, allowed transmissions, ``unknown`` fill, dedup.

    ``order`` names the columns that give the file order of the rows.
    """
    kept = within_bounds(
        df.where(F.col("make").isNotNull() & F.col("model").isNotNull()), config.SALES_BOUNDS)
    tidy = kept.withColumns({
        "year": F.col("year").cast("int"),
        "transmission": F.coalesce(
            F.when(F.col("transmission").isin(config.VALID_TRANSMISSIONS), F.col("transmission")),
            F.lit("unknown")),
        **{c: or_unknown(F.col(c)) for c in ("body", "state", "color")},
    })
    return dedup_first(tidy, config.SALES_DEDUP_KEYS, order)


def from_retail(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    raw = raw.withColumn("model", strip_transmission(F.col("model")))
    return _common(raw, "price", "year", "mileage", "make", "model", "state", None,
                   "retail", "true_car_listings", keep)


def from_auction(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _common(raw, "sellingprice", "year", "odometer", "make", "model",
                   "state", "condition", "wholesale", "car_prices", keep)


def from_recent(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _common(raw, "price", "model_year", "milage", "brand", "model",
                   None, None, "retail", "used_cars", keep)


def _common(raw, price, year, mileage, make, model, state, condition, channel, source, keep):
    raw = stripped(raw, [c for c in (year, condition) if c])
    none = F.lit(None).cast("string")
    return parsed_once(raw.select(
        dirty_number(F.col(price)).alias("price"),
        stripped_number(F.col(year)).alias("year"),
        dirty_number(F.col(mileage)).alias("mileage"),
        norm_column(F.col(make)).alias("make"),
        norm_column(F.col(model)).alias("model"),
        (norm_column(F.col(state)) if state else none).alias("state"),
        (stripped_number(F.col(condition)) if condition else none.cast("double")).alias("condition"),
        F.lit(channel).alias("source_channel"),
        F.lit(source).alias("source"),
        *keep,
    ))


def blend(retail: DataFrame, auction: DataFrame, recent: DataFrame) -> DataFrame:
    """Union of the three sources, with ``source_order`` in that order."""
    return (retail.withColumn("source_order", F.lit(0))
            .unionByName(auction.withColumn("source_order", F.lit(1)))
            .unionByName(recent.withColumn("source_order", F.lit(2))))


def clean_blended(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Clean a blended frame; earlier sources win when rows repeat."""
    kept = within_bounds(
        df.where(F.col("make").isNotNull() & F.col("model").isNotNull()), config.COMMON_BOUNDS)
    tidy = kept.withColumns({"year": F.col("year").cast("int"),
                             "state": F.coalesce("state", F.lit("unknown"))})
    return dedup_first(tidy, config.COMMON_DEDUP_KEYS, ["source_order", *order])
