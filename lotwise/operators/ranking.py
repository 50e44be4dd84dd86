"""Sorting by objective and exact row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import risk_ordinal
from ..session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in these
_LEAST_KEY = -(1 << 62)
#: Position of a row in the files of a scan: file, byte offset of the split, number that grows along the split.
FILE_ORDER = ["src_file", "src_block", "src_pos"]
BROADCAST_BLOCKS = 500_000


def with_global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank",
                     start: int = 1) -> DataFrame:
    """Number all rows from ``start`` in the given total order.

    A range-partitioned sort is stored with each row's partition and position in it;
    adding up the partition sizes (one row per partition) gives the global number.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    placed = materialize(df.orderBy(*order).withColumns(
        {"_pid": F.spark_partition_id(), "_pos": position}))
    before = Window.partitionBy(F.lit(0)).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_pid").agg((F.max("_pos") + 1).alias("_size"))
               .select("_pid", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off")))
    # One row per sort partition, so bounded by spark.sql.shuffle.partitions.
    return (placed.join(F.broadcast(offsets), "_pid")
            .select(*df.columns, (F.col("_off") + F.col("_pos") + start).alias(name)))


def with_line_numbers(rows: DataFrame, name: str = "row", start: int = 1) -> DataFrame:
    """Number the rows of scanned files in the order of files and lines, without a sort or a copy.

    ``rows`` has the ``FILE_ORDER`` columns, the last from one id per row of a scan that leaves out no row.
    One scan counts the rows of each block of each file; added up, the counts give the number of a block's first row. A block
    that is cut in another way when it is scanned again raises an error.
    """
    file, block, position = FILE_ORDER
    counted = materialize(rows.groupBy(file, block).agg(
        F.min(position).alias("_first"), F.count(F.lit(1)).alias("_size")))
    # One row per block of a file.
    before = Window.partitionBy(F.lit(0)).orderBy(file, block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(counted.withColumn("_off", F.coalesce(F.sum("_size").over(before), F.lit(0))))
    blocks = offsets.count()
    sent = F.broadcast(offsets) if blocks <= BROADCAST_BLOCKS else offsets
    inside = F.col(position) - F.col("_first")
    number = F.when(inside.between(0, F.col("_size") - 1), F.col("_off") + inside + start).otherwise(
        F.raise_error(F.lit("the files were split in another way while their rows were numbered")).cast("long"))
    return rows.join(sent, [file, block], "left").select(
        *[F.col(c) for c in rows.columns], number.alias(name))


def with_key_rank(df: DataFrame, key: str, order: Sequence[Column | str], name: str = "rank",
                  start: int = 1, width: int = 1_024) -> DataFrame:
    """Number all rows from ``start`` by ``order``, which begins with the whole number ``key``.

    Rows are counted by blocks of ``width`` keys; the counts of smaller blocks are added to a row's place in its own block,
    so only one block at a time is ordered. A table is read twice, so pass a stored one. NULL keys come first.
    """
    span = 1 << 12  # blocks that are added up in one task
    block = F.floor(F.coalesce(F.col(key), F.lit(_LEAST_KEY)) / width).cast("long")
    sizes = df.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_size")).withColumn(
        "_part", F.floor(F.col("_block") / span))
    upto = Window.unboundedPreceding, -1
    parts = sizes.groupBy("_part").agg(F.sum("_size").alias("_size")).select(
        "_part", F.coalesce(F.sum("_size").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(*upto)),
                            F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_block").rowsBetween(*upto)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(parts, "_part").select(
        "_block", (F.col("_off") + F.col("_before")).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    return (df.withColumn("_block", block).withColumn("_place", place).join(offsets, "_block")
            .select(*df.columns, (F.col("_off") + F.col("_place") + (start - 1)).alias(name)))


def objective_order(objective: str) -> list[Column]:
    """Sort columns of an objective: profit (also the default), roi or risk; ties by row."""
    first = {
        "roi": F.desc("roi"),
        "risk": risk_ordinal(F.col("risk_level")).asc(),
    }.get(objective, F.desc("expected_gross_profit"))
    return [first, F.asc("row")]


def rank_results(results: DataFrame, objective: str = "profit") -> DataFrame:
    return results.orderBy(*objective_order(objective))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values, ties by value: value, n."""
    return (df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("value").isNotNull())
            .orderBy(F.desc("n"), "value").limit(n))
