"""Exact grouped quantiles that never gather a large group in one task.

Groups of few distinct values go through Spark's own ``percentile``, which is combined before the exchange. It keeps every
distinct value of a group in one buffer, so large groups, such as the overall median or a hot make, are selected by radix instead:
a histogram over the leading bits of an order-preserving integer, also combined before its exchange, shows which branch holds the
wanted rank, and only the values of that branch are looked at for the bits that follow. Where few are left they are ranked;
four levels of 16 bits end at a single value in any case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

PLAIN_CELLS = 100_000  # distinct values of a group that one aggregation buffer may hold
DIGIT_BITS = 16
#: Large groups are sent to all tasks up to this many; there are at most (distinct values) / PLAIN_CELLS.
BROADCAST_GROUPS = 1_000_000

# fixed values of the binary double
MANTISSA_BITS, EXPONENT_BIAS = 52, 1023
LEAST_NORMAL, LEAST_DOUBLE = 2.0**-1022, 2.0**-1074


def order_key(value: Column) -> Column:
    """The bits of a double as a long that sorts like it: sign and magnitude. Both zeros are 0, NaN comes last."""
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    power = F.pow(F.lit(2.0), guess)
    # the logarithm may round to the next whole number
    exponent = F.when(size < power, guess - 1).when(size / 2 >= power, guess + 1).otherwise(guess)
    fraction = (size / F.pow(F.lit(2.0), exponent) - 1) * 2.0**MANTISSA_BITS
    top = F.lit((2 * EXPONENT_BIAS + 1) << MANTISSA_BITS)
    magnitude = (F.when(F.isnan(value), top + 1)
                 .when(size == float("inf"), top)
                 .when(size < LEAST_NORMAL, (size / LEAST_DOUBLE).cast("long"))
                 .otherwise(F.shiftleft(exponent + EXPONENT_BIAS, MANTISSA_BITS) + fraction.cast("long")))
    return F.when(~F.isnan(value) & (value < 0), -magnitude).otherwise(magnitude)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float], *, small: bool = False) -> DataFrame:
    """Linear-interpolation quantiles of ``value`` per ``keys``: keys, n, q0, q1, ...

    Keys must not be NULL; NULL values are ignored. With no keys the result is one row
    (all NULL if empty). ``small`` says that no group can be large, which saves the look at their sizes.
    """
    cells = (df.where(F.col(value).isNotNull())
             .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    return quantiles_of_cells(cells, keys, value, "_n", probs, small=small)


def quantiles_of_cells(cells: DataFrame, keys: Sequence[str], value: str, count: str,
                       probs: Sequence[float], *, small: bool = False) -> DataFrame:
    """As :func:`exact_quantiles`, from rows that carry a ``count`` of their value."""
    cells = cells.select(*keys, F.col(value).cast("double").alias("_v"), F.col(count).alias("_n"))
    if small:
        return plain_quantiles(cells, keys, probs)
    cells = materialize(cells)
    by = list(keys) or ["_all"]
    if not keys:
        cells = cells.withColumn("_all", F.lit(0))
    large = materialize(cells.groupBy(*by).agg(F.count(F.lit(1)).alias("_cells"), F.sum("_n").alias("_total"))
                        .where(F.col("_cells") > PLAIN_CELLS).drop("_cells"))
    groups = large.count()
    if not groups:
        return plain_quantiles(cells, keys, probs)
    sent = F.broadcast if groups <= BROADCAST_GROUPS else lambda df: df
    selected = radix_quantiles(cells.join(sent(large), by), by, probs, sent).select(*keys, "n", *_names(probs))
    if not keys:
        return selected
    rest = cells.join(sent(large.select(*by)), by, "left_anti")
    return plain_quantiles(rest, keys, probs).unionByName(selected)


def _names(probs: Sequence[float]) -> list[str]:
    return [f"q{i}" for i in range(len(probs))]


def plain_quantiles(cells: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles of cells (keys, _v, _n) whose groups are small."""
    every = F.percentile("_v", [float(p) for p in probs], F.col("_n"))
    found = cells.groupBy(*keys).agg(F.sum("_n").alias("n"), every.alias("_q"))
    return found.select(*keys, "n", *[F.col("_q")[i].alias(name) for i, name in enumerate(_names(probs))])


def radix_quantiles(cells: DataFrame, keys: Sequence[str], probs: Sequence[float], sent=F.broadcast) -> DataFrame:
    """Quantiles of cells (keys, _v, _n, _total); ``sent`` marks what is sent to all tasks, one row per group and rank."""
    cells = materialize(cells.withColumn("_k", order_key(F.col("_v"))))
    spots = [(F.floor(p * (F.col("_total") - 1)), F.ceil(p * (F.col("_total") - 1))) for p in probs]
    ranks = F.array_distinct(F.array(*[r for spot in spots for r in spot]))
    branch = (cells.groupBy(*keys).agg(F.max("_total").alias("_total"))
              .select(*keys, "_total", F.explode(ranks).alias("_rank"))
              .withColumns({"_below": F.lit(0).cast("long"), "_up": F.lit(0).cast("long")}))
    own = [*keys, "_total", "_rank"]
    held = cells.drop("_total")
    reached = (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_c"))

    def upto(order: str) -> Column:
        window = Window.partitionBy(*own).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return F.col("_below") + F.sum("_c").over(window)

    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        up = F.shiftright("_k", shift + DIGIT_BITS) if shift + DIGIT_BITS < 64 else F.lit(0).cast("long")
        rows = held.withColumn("_up", up).join(sent(branch), [*keys, "_up"]).select(
            *own, "_below", F.shiftright("_k", shift).alias("_digits"), "_n", "_v")
        counted = rows.groupBy(*own, "_below", "_digits").agg(
            F.sum("_n").alias("_c"), F.count(F.lit(1)).alias("_cells"), F.max("_v").alias("_v"))
        # a group has at most 2 ** DIGIT_BITS rows here; one row per group and rank is left
        branch = materialize(
            counted.withColumn("_upto", upto("_digits")).where(reached)
            .select(*own, (F.col("_upto") - F.col("_c")).alias("_below"), F.col("_digits").alias("_up"), "_cells",
                    F.col("_v").alias("_found")))
        if shift and (branch.agg(F.max("_cells")).first()[0] or 0) <= PLAIN_CELLS:
            # few values are left in each branch: ranked as they are
            rows = held.withColumn("_up", F.shiftright("_k", shift)).join(sent(branch), [*keys, "_up"])
            branch = rows.select(*own, "_below", "_v", F.col("_n").alias("_c")).withColumn("_upto", upto("_v")).where(
                reached).withColumn("_found", F.col("_v"))
            break
        branch = branch.drop("_cells") if not shift else branch.drop("_cells", "_found")
    at = [[F.max(F.when(F.col("_rank") == r, F.col("_found"))) for r in spot] for spot in spots]
    found = branch.groupBy(*keys, "_total").agg(*[v.alias(f"_{side}{i}") for i, both in enumerate(at)
                                                  for side, v in zip(("lo", "hi"), both)])
    quantiles = []
    for i, p in enumerate(probs):
        position = p * (F.col("_total") - 1)
        low, high = F.floor(position), F.ceil(position)
        between = (high - position) * F.col(f"_lo{i}") + (position - low) * F.col(f"_hi{i}")
        quantiles.append(F.when(low == high, F.col(f"_lo{i}")).otherwise(between).alias(f"q{i}"))
    return found.select(*keys, F.col("_total").alias("n"), *quantiles)
