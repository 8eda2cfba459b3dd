"""Scoring a stream with a pipeline and a model fitted on a table.

Fitted steps and models are plain column expressions without state, so they apply to a streaming
DataFrame as they are; this module only adds the sink.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import quoted
from ..plans.preparation import FittedPipeline
from ..session import work_folder


def score_stream(stream: DataFrame, pipeline: FittedPipeline, model: Any, id_col: str) -> DataFrame:
    """``(Id, Prediction)`` of every arriving row."""
    scored = model.transform(pipeline.transform(stream))
    return scored.select(
        quoted(id_col).cast("long").alias("Id"), F.col("prediction").cast("int").alias("Prediction")
    )


def write_stream(scored: DataFrame, path: str) -> StreamingQuery:
    """Append predictions to a CSV folder until the available input is used up."""
    return (
        scored.writeStream.format("csv")
        .option("header", True)
        .option("checkpointLocation", work_folder(scored.sparkSession))
        .trigger(availableNow=True)
        .start(path)
    )
