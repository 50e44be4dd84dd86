"""A training corpus in five stages, each an operator of the library applied to what the last one kept."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.contamination import contamination
from lotwise.llm.jaccard import classes
from lotwise.llm.mixing import mix
from lotwise.llm.secrets import redacted
from lotwise.llm.toxicity import fit, score
from lotwise.session import checkpoint_root

TOXIC = 0.3
KEY = f"_key_{uuid.uuid4().hex}"  # no column of an input has this name


def row_key(docs: DataFrame, *more: Column) -> Column:
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"), *more)


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """docs without the rows whose key is in ``rejected`` (row_key); all columns stay."""
    keys = rejected.select(F.col("row_key").alias(KEY)).distinct()
    return docs.join(keys, row_key(docs) == keys[KEY], "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring below TOXIC. Null and empty texts stay; rows that agree in id and text go or stay together."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, score(docs, model).where(F.col("score") >= TOXIC))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays; repeated rows stay once."""
    kept = without(docs, classes(docs).where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))
    return kept.withColumn(KEY, row_key(kept)).dropDuplicates([KEY]).drop(KEY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated. Null and empty texts stay; an empty benchmark drops nothing."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(docs, contamination(docs, items).where("contaminated"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked and ``n_chars``, where there is one, counted anew; null texts stay null."""
    masked = redacted(docs)
    if "n_chars" not in docs.columns:
        return masked
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), size).otherwise(F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies; repeated rows of one source are one document.

    Null and empty texts have no words to take and go. The number is in ``copies``, or, where the input has a column of
    that name, in the first of ``copies_``, ``copies__``, ... that is free.
    """
    taken = {c.lower() for c in docs.columns}
    name = next(n for n in ("copies" + "_" * k for k in range(len(taken) + 1)) if n not in taken)
    copies = mix(docs).groupBy("row_key").agg(F.sum("copies").alias(name)).where(F.col(name) > 0).withColumnRenamed("row_key", KEY)
    once = docs.withColumn(KEY, row_key(docs, docs["source"].cast("string"))).dropDuplicates([KEY])
    return once.join(copies, KEY).drop(KEY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: the first stage is a fitted classifier, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    def apply(kept: DataFrame, stage: tuple) -> DataFrame:
        result = stage[1](spark, kept, sf_dir)
        path = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
        result.write.parquet(path)
        return spark.read.schema(result.schema).parquet(path)

    return functools.reduce(apply, STAGES, spark.read.parquet(f"{sf_dir}/documents.parquet"))
