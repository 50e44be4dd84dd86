"""Helpers shared by the operators: inputs, row keys, stored tables, held-out rows, spans."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the folder that the whole cluster shares and read it back.

    Cuts lineage: a lost executor costs a re-read of finished files, and every branch that
    starts here knows the true size of the table.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_batches(spark: SparkSession, rows: int = 256) -> None:
    """Rows per Arrow batch: texts can be long, so a batch stays a few MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def texts(docs: DataFrame) -> DataFrame:
    """doc_id (long), text (string) and ``row_key``, a 64-bit hash of both.

    Other columns are left behind, so their names cannot clash. Rows that agree in id and text
    share a key, and a null id still has one, so joins by it lose no row.
    """
    doc_id, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"),
                       F.xxhash64(doc_id, text).alias("row_key"))


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids whose labels are never learned from; null ids: false."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def bounded(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of ``key``; all of them where they are fewer.

    For the labelled rows that a classifier is fitted on, and nothing else.
    """
    share = most / max(rows.count(), 1)
    if share >= 1:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000))


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """row_key, doc_id, text, label (0 or 1) of labelled documents that are not held out.

    Repeated labels of one document: the largest counts. Null labels: none.
    """
    marks = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
             .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    # most * 16 bytes, so a broadcast of known size
    return texts(docs).join(F.broadcast(bounded(marks, "doc_id", most)), "doc_id")


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, stop, value>>, code points, end exclusive.

    ``split`` gives the text between the matches and ``regexp_extract_all`` the matches themselves;
    lengths added up give the places, first inside blocks of about the square root of the number of matches, then over
    the blocks, so that no array of all matches is copied once per match. Null text: no match.
    """
    kind = "array<struct<start:int,stop:int,value:string>>"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # the last gap has no match after it; its struct is left out
    pieces = F.slice(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value")),
                     F.lit(1), F.size(whole))

    def step(acc: Column, piece: Column) -> Column:
        begin = acc["at"] + F.length(piece["gap"])
        end = begin + F.length(piece["whole"])
        return F.struct(
            end.alias("at"),
            F.array_append(acc["found"], F.struct(begin.alias("start"), end.alias("stop"),
                                                  piece["value"].alias("value"))).alias("found"))

    def block(part: Column) -> Column:
        return F.aggregate(part, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found")), step)

    def placed(all_pieces: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(all_pieces))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_pieces) - 1) / size).cast("int")),
                             lambda k: block(F.slice(all_pieces, k * size + 1, size)))

        def shift(acc: Column, b: Column) -> Column:
            moved = F.transform(b["found"], lambda m: F.struct((m["start"] + acc["at"]).alias("start"), (m["stop"] + acc["at"]).alias("stop"), m["value"].alias("value")))
            return F.struct((acc["at"] + b["at"]).alias("at"), F.array_append(acc["found"], moved).alias("found"))

        begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("found"))
        return F.aggregate(blocks, begin, shift, lambda acc: F.flatten(acc["found"]))

    # through a transform of one element, so that the pieces are made once
    return F.when(text.rlike(pattern), F.element_at(F.transform(F.array(pieces), placed), 1)).otherwise(F.array().cast(kind))
