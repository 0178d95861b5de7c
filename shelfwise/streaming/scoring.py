"""Score reviews as they arrive; every row on its own, no state."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.sentiment import score_sentiment


def score_stream(
    stream: DataFrame, model: PipelineModel, sink: str, checkpoint: str, column: str = "Review_Text"
) -> StreamingQuery:
    return (
        score_sentiment(stream, model, column)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
