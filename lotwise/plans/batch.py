"""Triage of a whole listings table: validate, evaluate, quarantine, rank, summarise."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import Assumptions
from ..functions import messages as M
from ..functions.parse import null_if_token, plain_number, strip, stripped_number
from ..session import materialize
from .evaluate import evaluate

RESULT_COLUMNS = ["row", "make", "model", "year", "recommendation", "confidence",
                  "predicted_resale", "max_purchase_price", "expected_gross_profit", "roi",
                  "days_to_sell_band", "risk_level"]


def with_columns_present(raw: DataFrame) -> DataFrame:
    """Header names normalised; absent listing columns added as NULL text."""
    df = raw.toDF(*[c.strip().lower() for c in raw.columns])
    wanted = (config.REQUIRED_LISTING_COLUMNS + config.OPTIONAL_TEXT_COLUMNS
              + config.OPTIONAL_NUMBER_COLUMNS)
    absent = {c: F.lit(None).cast("string") for c in wanted if c not in df.columns}
    return df.withColumns(absent) if absent else df


def validate(listings: DataFrame) -> DataFrame:
    """Add ``error``: the first problem of each row, NULL where the row is valid."""
    df = with_columns_present(listings)
    # Parsed once per row: a filter on the error would repeat the parsing for each comparison, but does not pass a generator.
    text = {c: strip(null_if_token(F.col(c).cast("string"))) for c in config.REQUIRED_LISTING_COLUMNS}
    stripped = df.withColumns({f"_text_{c}": t for c, t in text.items()})
    facts = F.inline(F.array(F.struct(
        *[F.coalesce(F.col(f"_text_{c}") == "", F.lit(True)).alias(f"_blank_{c}") for c in text],
        stripped_number(F.col("_text_year")).try_cast("long").alias("_year"),
        stripped_number(F.col("_text_odometer")).alias("_odometer"),
        stripped_number(F.col("_text_condition")).alias("_condition"))))
    error = F.when(F.lit(False), "")
    for c in config.REQUIRED_LISTING_COLUMNS:
        error = error.when(F.col(f"_blank_{c}"), M.fill(M.ERROR_MISSING, field=F.lit(c)))
    first, last = config.LISTING_YEAR_RANGE
    year, odometer, condition = F.col("_year"), F.col("_odometer"), F.col("_condition")
    error = (
        error.when(year.isNull(), M.ERROR_NOT_NUMERIC)
        .when(~year.between(first, last), M.fill(
            M.ERROR_YEAR, year=year.cast("string"), first=F.lit(str(first)), last=F.lit(str(last))))
        .when(odometer.isNull(), M.ERROR_NOT_NUMERIC)
        .when(odometer < 0, M.ERROR_ODOMETER)
        .when(condition.isNull(), M.ERROR_NOT_NUMERIC))
    own = [F.col(f"`{c}`") for c in df.columns if c != "error"]
    return stripped.select(*own, facts).select(*own, error.alias("error"))


def typed(valid: DataFrame) -> DataFrame:
    """Valid rows with numbers parsed, optional texts defaulted to '' and bad numbers NULL."""
    def text(c: str):
        return null_if_token(F.col(c).cast("string"))

    return valid.withColumns({
        "year": plain_number(F.col("year")).try_cast("int"),
        "odometer": plain_number(F.col("odometer")),
        "condition": plain_number(F.col("condition")),
        **{c: F.coalesce(text(c), F.lit("")) for c in config.OPTIONAL_TEXT_COLUMNS},
        **{c: plain_number(text(c)) for c in config.OPTIONAL_NUMBER_COLUMNS},
    }).drop("error")


def triage(listings: DataFrame, score: Callable[[DataFrame], DataFrame],
           assumptions: Assumptions = Assumptions()) -> tuple[DataFrame, DataFrame]:
    """(results, errors) of listings that carry a ``row`` number.

    ``score`` turns typed listings into scored ones. Listings are numbered, validated and typed in one pass and stored, as the
    errors, the lookup keys and the results all read them.
    """
    checked = materialize(typed(validate(listings).withColumn("_error", F.col("error"))))
    errors = checked.where(F.col("_error").isNotNull()).select("row", F.col("_error").alias("error"))
    evaluated = evaluate(score(checked.where(F.col("_error").isNull()).drop("_error")), assumptions)
    results = evaluated.withColumn("predicted_resale", F.col("predicted_resale_price"))
    return results.select(*RESULT_COLUMNS), errors


def summary(results: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: evaluated, errors, buy."""
    tagged = (results.select(F.lit(False).alias("bad"), (F.col("recommendation") == "Buy").alias("buy"))
              .unionByName(errors.select(F.lit(True).alias("bad"), F.lit(False).alias("buy"))))
    return tagged.agg(F.count_if(~F.col("bad")).alias("evaluated"),
                      F.count_if("bad").alias("errors"), F.count_if("buy").alias("buy"))
