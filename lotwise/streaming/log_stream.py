"""Evaluate arriving listings and append them to the prediction log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Assumptions
from ..plans.batch import typed, validate
from ..plans.evaluate import evaluate
from ..sources.writers import prediction_log


def start_log(listings: DataFrame, score: Callable[[DataFrame], DataFrame], path: str,
              checkpoint: str, versions: dict[str, str], vehicle_columns: list[str],
              assumptions: Assumptions = Assumptions(), **trigger) -> StreamingQuery:
    """Score each micro-batch of a text-schema listings stream with the batch operators.

    Every micro-batch is written to its own folder, replaced when Spark replays the
    batch after a failure, so no record is logged twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        valid = typed(validate(batch).where(F.col("error").isNull()))
        records = prediction_log(evaluate(score(valid), assumptions), vehicle_columns, versions)
        records.write.mode("overwrite").json(f"{path}/batch={batch_id}")

    writer = listings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
