"""Market-value hierarchy, days-to-turn benchmark and comparable live listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.bands import days_to_band
from ..functions.parse import finite, key_text, norm_text, plain_number
from ..session import materialize
from .quantiles import exact_quantiles, quantiles_of_cells

# match level -> keys that must agree, finest first
LEVELS = {"make/model/year": ["make", "model", "year"], "make/model": ["make", "model"],
          "make": ["make"], "global": []}
KEYS = ["make", "model", "year"]
NO_YEAR = -1
SKETCH_K = 400  # entries that a sketch keeps of each level; decides its rank error


def _valued(df: DataFrame, value_col: str | None) -> DataFrame:
    """make, model, year, value of the rows a benchmark is made from.

    ``value_col`` defaults to ``mmr`` where present, else ``price``; for prices, retail
    rows are preferred when there are more than a thousand of them.
    """
    value_col = value_col or ("mmr" if "mmr" in df.columns else "price")
    base = df
    if value_col == "price" and "source_channel" in df.columns:
        retail = F.col("source_channel") == "retail"
        retail_rows = df.where(retail).agg(F.count(F.lit(1)).alias("n")).scalar()
        base = df.where((retail_rows <= config.RETAIL_MIN_ROWS) | retail)
    return base.select(*KEYS, F.col(value_col).cast("double").alias("value")).dropna()


def _at_grains(rows: DataFrame, *more: str) -> DataFrame:
    """Each row at four grains; blanks stand for the keys a coarser grain drops."""
    blank = {"make": F.lit(""), "model": F.lit(""), "year": F.lit(NO_YEAR)}
    grains = F.explode(F.array(*[
        F.struct(F.lit(i).alias("grain"), *[
            (F.col(k) if k in kept else blank[k]).alias(k) for k in KEYS])
        for i, kept in enumerate(LEVELS.values())]))
    return rows.select(grains.alias("g"), "value", *more).select("g.*", "value", *more)


def named_levels(df: DataFrame, *more: str | Column) -> DataFrame:
    """level, make, model, year in place of the grain number; dropped keys are NULL."""
    at_grain = [F.when(F.col("grain").isin([i for i, kept in enumerate(LEVELS.values())
                                            if k in kept]), F.col(k)).alias(k) for k in KEYS]
    names = F.array(*[F.lit(name) for name in LEVELS])
    return df.select(F.get(names, F.col("grain")).alias("level"), *at_grain, *more)


def market_benchmark(df: DataFrame, value_col: str | None = None) -> DataFrame:
    """Medians and counts at four grains: level, make, model, year, value, n.

    For the rows and ``value_col`` see :func:`_valued`.
    """
    cells = _valued(df, value_col).groupBy(*KEYS, "value").agg(F.count(F.lit(1)).alias("cell_n"))
    medians = quantiles_of_cells(_at_grains(cells, "cell_n"), ["grain", *KEYS],
                                 "value", "cell_n", [0.5])
    return named_levels(medians, F.col("q0").alias("value"), "n")


def market_sketches(df: DataFrame, value_col: str | None = None, k: int = SKETCH_K) -> DataFrame:
    """Quantile sketches at four grains: grain, make, model, year, sketch.

    Rows are looked at once, for the finest grain; each coarser one merges the sketches of the one
    before. Sketches of other days or batches merge in the same way (:func:`merged_sketches`).
    """
    finest = _valued(df, value_col).groupBy(*KEYS).agg(F.kll_sketch_agg_double("value", k).alias("sketch"))
    level = materialize(finest.select(F.lit(0).alias("grain"), *KEYS, "sketch"))
    levels = [level]
    for i, kept in enumerate(LEVELS.values()):
        if not i:
            continue
        blank = {"make": F.lit(""), "model": F.lit(""), "year": F.lit(NO_YEAR)}
        coarser = level.select(F.lit(i).alias("grain"), *[
            (F.col(c) if c in kept else blank[c]).alias(c) for c in KEYS], "sketch")
        level = materialize(merged_sketches(coarser, k))
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)


def merged_sketches(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One sketch for each grain and key."""
    return sketches.groupBy("grain", *KEYS).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_rank_error(k: int = SKETCH_K) -> float:
    """Share of a group's rows by which a quantile's rank is off at most, in 99 of 100 sketches."""
    return 2.296 / k**0.9723


def approximate_benchmark(sketches: DataFrame, prob: float = 0.5) -> DataFrame:
    """As :func:`market_benchmark`, from sketches: value has a rank error of about :func:`sketch_rank_error`."""
    return named_levels(sketches, F.kll_sketch_get_quantile_double("sketch", F.lit(prob)).alias("value"),
                         F.kll_sketch_get_n_double("sketch").alias("n"))


def measured_rank_error(df: DataFrame, sketches: DataFrame, prob: float = 0.5,
                        value_col: str | None = None) -> DataFrame:
    """grain, make, model, year, n, error: how far the rank of a sketch's quantile is from ``prob``, by counting rows.

    The quantile covers the ranks from the share of smaller values to that of values no greater.
    """
    cells = _valued(df, value_col).groupBy(*KEYS, "value").agg(F.count(F.lit(1)).alias("cell_n"))
    asked = sketches.select("grain", *KEYS, F.kll_sketch_get_quantile_double("sketch", F.lit(prob)).alias("quantile"))
    rows = _at_grains(cells, "cell_n").join(asked, ["grain", *KEYS])
    below = F.sum(F.when(F.col("value") < F.col("quantile"), F.col("cell_n")).otherwise(0))
    upto = F.sum(F.when(F.col("value") <= F.col("quantile"), F.col("cell_n")).otherwise(0))
    n = F.sum("cell_n")
    return rows.groupBy("grain", *KEYS).agg(
        n.alias("n"), F.greatest(below / n - prob, prob - upto / n, F.lit(0.0)).alias("error"))


def global_value(bench: DataFrame) -> Column:
    """Overall median as a scalar subquery; 0 for an empty benchmark."""
    return F.coalesce(
        bench.where(F.col("level") == "global").agg(F.max("value").alias("v")).scalar(),
        F.lit(0.0))


def market_keys(make: Column, model: Column, year: Column) -> dict[str, Column]:
    """Non-NULL lookup keys of a vehicle."""
    return {"make": key_text(make), "model": key_text(model),
            "year": F.coalesce(year.cast("int"), F.lit(NO_YEAR))}


def lookup_market(keys: DataFrame, bench: DataFrame) -> DataFrame:
    """Progressive fallback for distinct keys: adds lookup_value, lookup_level, lookup_n.

    ``bench`` is read once per level, so pass a stored table.
    """
    found, values, counts = keys, [], []
    for i, (name, on) in enumerate(LEVELS.items()):
        rows = bench.where(F.col("level") == name)
        if on:
            found = found.join(rows.select(*on, F.col("value").alias(f"_v{i}"),
                                           F.col("n").alias(f"_n{i}")), on, "left")
            values.append(F.col(f"_v{i}"))
            counts.append(F.col(f"_n{i}"))
        else:
            overall = rows.where(F.col("value") > 0)
            values.append(overall.agg(F.max("value").alias("v")).scalar())
            counts.append(overall.agg(F.max("n").alias("n")).scalar())
    level, n = F.when(F.lit(False), ""), F.when(F.lit(False), F.lit(0).cast("long"))
    for value, count, name in zip(values, counts, LEVELS):
        level, n = level.when(value.isNotNull(), name), n.when(value.isNotNull(), count)
    return found.select(*keys.columns, F.coalesce(*values).alias("lookup_value"),
                        level.otherwise("none").alias("lookup_level"), n.alias("lookup_n"))


def latest_days(table: DataFrame) -> DataFrame:
    """Days-to-turn per make in its latest month, from rows (make, month, days, position).

    Rows that are blank, non-numeric or headings are skipped; of repeated makes in the
    latest month of the table the last one by ``position`` wins.
    """
    rows = table.select(norm_text(F.col("make")).alias("make"), "month", "position",
                        finite(plain_number(F.col("days"))).alias("days"))
    newest = table.agg(F.max("month").alias("m")).scalar()
    rows = rows.where((F.col("month") == newest) & F.col("days").isNotNull()
                      & ~F.col("make").isin("make", "industry", ""))
    return rows.groupBy("make").agg(F.max_by("days", "position").alias("days"))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def overall_days(dts: DataFrame) -> DataFrame:
    """One row: the median over the makes."""
    return exact_quantiles(dts, [], "days", [0.5], small=True).select(F.col("q0").alias("overall_days"))


def lookup_days(keys: DataFrame, dts: DataFrame) -> DataFrame:
    """Add ``make_days``: the make's days, else the median over all makes."""
    days = dts.select("make", F.col("days").alias("_days"))
    return (keys.join(days, "make", "left")
            .withColumn("make_days", F.coalesce("_days", overall_days(dts).scalar()))
            .drop("_days"))


def with_band(df: DataFrame, days: str = "make_days") -> DataFrame:
    return df.withColumn("make_band", days_to_band(F.col(days)))


def comparables(listings: DataFrame) -> DataFrame:
    """Live market table per (make, model, year) and per (make, model, year, state).

    From rows (make, model, year, state, price, dom): live_value is the median positive
    price, live_days the median non-negative days on market, live_n the number of
    listings; groups without a price are left out. Rows over all states carry NULL state.
    """
    keys = ["make", "model", "year", "state"]
    measures = {"n": F.lit(0.0),
                "price": F.when(F.col("price") > 0, F.col("price").cast("double")),
                "dom": F.when(F.col("dom") >= 0, F.col("dom").cast("double"))}
    measured = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), value.alias("value"))
        for name, value in measures.items()]))
    rows = listings.select(
        key_text(F.col("make")).alias("make"), key_text(F.col("model")).alias("model"),
        F.coalesce(F.col("year").cast("int"), F.lit(NO_YEAR)).alias("year"),
        key_text(F.col("state")).alias("state"),
        measured.alias("m"))
    rows = rows.select(*keys, "m.measure", "m.value").where(
        F.col("value").isNotNull() & ~F.isnan("value"))
    cells = rows.groupBy(*keys, "measure", "value").agg(F.count(F.lit(1)).alias("cell_n"))
    scopes = F.explode(F.array(
        F.struct(F.lit(0).alias("any_state"), F.col("state").alias("in_state")),
        F.struct(F.lit(1).alias("any_state"), F.lit("").alias("in_state"))))
    grains = cells.select("*", scopes.alias("scope")).select(
        "make", "model", "year", "scope.any_state", F.col("scope.in_state").alias("state"),
        "measure", "value", "cell_n")
    medians = quantiles_of_cells(grains, ["any_state", *keys, "measure"], "value",
                                 "cell_n", [0.5])

    def of(measure: str, column: str) -> Column:
        return F.max(F.when(F.col("measure") == measure, F.col(column)))

    return (medians.groupBy("any_state", *keys)
            .agg(of("price", "q0").alias("live_value"), of("dom", "q0").alias("live_days"),
                 of("n", "n").alias("live_n"))
            .where(F.col("live_value").isNotNull())
            .withColumn("state", F.when(F.col("any_state") == 0, F.col("state"))))


def lookup_live(keys: DataFrame, live: DataFrame) -> DataFrame:
    """Add live_value, live_days, live_n for distinct keys (make, model, year, state).

    The state-level row where a state is given (empty = not given), else all states.
    """
    table = live.select(
        "make", "model", "year",
        F.when(F.col("any_state") == 1, "").otherwise(F.col("state")).alias("state"),
        "live_value", "live_days", "live_n", F.col("any_state"),
    ).where((F.col("any_state") == 1) | (F.col("state") != "")).drop("any_state")
    return keys.join(table, ["make", "model", "year", "state"], "left")
