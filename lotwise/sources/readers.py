"""CSV readers of raw sales, listings and benchmark tables; every column arrives as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import null_if_token
from ..operators.clean import (blend, clean_blended, clean_sales, from_auction, from_recent,
                               from_retail, parse_sales)
from ..operators.ranking import FILE_ORDER as ORDER
from ..operators.ranking import with_line_numbers

CORRUPT = "_corrupt_record"
_QUOTED = r'"(?:[^"]|"")*"'


def read_text_csv(spark: SparkSession, path: str, *, nrows: int | None = None,
                  skip_long_rows: bool = True, multi_line: bool = False) -> DataFrame:
    """All-text CSV with normalised header names, plus the ``ORDER`` columns.

    Rows with more fields than the header are dropped, short rows are padded with NULL,
    and the usual missing-value tokens become NULL. ``nrows`` keeps the first rows in the order of
    files and lines. ``multi_line`` reads fields that hold line breaks; a file is one split then.
    """
    reader = spark.read.option("header", True).option("escape", '"') \
        .option("multiLine", multi_line)
    names = [c.strip().lower() for c in reader.option("inferSchema", False).csv(path).columns]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    rows = (reader.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False).csv(path)
            .select("*", F.col("_metadata.file_path").alias("src_file"),
                    F.col("_metadata.file_block_start").alias("src_block"),
                    F.monotonically_increasing_id().alias("src_pos")))
    if skip_long_rows:
        commas = F.size(F.split(F.regexp_replace(CORRUPT, _QUOTED, ""), ","))
        # The length test is always true: it reads a data column too, since Spark refuses
        # to prune a CSV scan (for a count, say) to the corrupt record alone.
        rows = rows.where((F.col(CORRUPT).isNull() | (commas <= len(names)))
                          & (F.length(F.coalesce(names[0], F.lit(""))) >= 0))
    rows = rows.select(*[null_if_token(F.col(n)).alias(n) for n in names], *ORDER)
    # ordered, then limited: each task keeps its first nrows rows and one merges them
    return rows.orderBy(*ORDER).limit(nrows) if nrows is not None else rows


def load_sales(spark: SparkSession, path: str, nrows: int | None = None, *,
               multi_line: bool = False) -> DataFrame:
    """Cleaned auction sales in the eleven-column model schema."""
    raw = read_text_csv(spark, path, nrows=nrows, multi_line=multi_line)
    return clean_sales(parse_sales(raw, ORDER), ORDER).drop(*ORDER)


def load_blended(spark: SparkSession, retail: str, auction: str, recent: str,
                 nrows: int | None = None, *, multi_line: bool = False) -> DataFrame:
    """Cleaned union of retail, auction and recent listings in the common schema."""
    def read(path: str, skip: bool) -> DataFrame:
        return read_text_csv(spark, path, nrows=nrows, skip_long_rows=skip, multi_line=multi_line)

    blended = blend(from_retail(read(retail, False), ORDER),
                    from_auction(read(auction, True), ORDER),
                    from_recent(read(recent, False), ORDER))
    return clean_blended(blended, ORDER).drop(*ORDER, "source_order")


def load_listings(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Candidate listings as text with ``row``, the line number in the file (header = 1).

    Rows that hold line breaks count as one line. Of several files the numbers go on from one to the next.
    """
    rows = read_text_csv(spark, path, skip_long_rows=False, multi_line=multi_line)
    return with_line_numbers(rows, "row", start=2).drop(*ORDER)


def load_days_table(spark: SparkSession, path: str) -> DataFrame:
    """Days-to-turn table (make, month, days) with each row's ``position``."""
    rows = read_text_csv(spark, path)
    return rows.select("make", F.col("month").try_cast("date").alias("month"), "days",
                       F.struct(*ORDER).alias("position"))
