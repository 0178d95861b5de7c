"""Incremental ingestion: store each key once, across batches and restarts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from shelfwise.session import settings
from shelfwise.sources.readers import path_exists

DIGEST = "__digest"
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class FirstOfKey(StatefulProcessor):
    """Lets the first row of a key pass that no earlier batch had; the state is a flag a key."""

    def __init__(self, order: str) -> None:
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        self.seen.update((True,))
        # A row without the order column's value comes first, as in a sort.
        first = min(rows, key=lambda r: (r[self.order] is not None, r[self.order] if r[self.order] is not None else 0))
        fields = first.asDict(recursive=False)
        fields.pop(DIGEST)
        yield Row(**fields)

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        self.seen.update((True,))

    def close(self) -> None:
        pass


def key_digest(key: str) -> Column:
    """32 bytes for a key of any type and length; keys that are null are one key."""
    return F.unhex(F.sha2(F.to_json(F.struct(F.col(key).alias("k"))), 256))


def ingest_new(
    stream: DataFrame, sink: str, key: str, order: str, checkpoint: str, name: str | None = None
) -> StreamingQuery:
    """Append the first row of every key the sink does not hold yet.

    Keys that were stored are remembered as digests in keyed state on disk, so
    a batch looks up its own keys and reads nothing of the sink, however large
    that is.  Only the first batch of a new checkpoint reads the keys of the
    folders that other checkpoints wrote; what these add later isn't seen.

    A batch writes its own folder and overwrites it when run again, so a
    restart neither repeats nor loses rows; the folder carries ``name``, by
    default a digest of the checkpoint's place.  A lost checkpoint is replaced
    by one at another place or of another name.
    """
    query = name or hashlib.md5(checkpoint.encode()).hexdigest()
    spark = stream.sparkSession
    held = None
    if path_exists(spark, sink):
        stored = spark.read.schema(f"{stream.select(key).schema.toDDL()}, query string, batch long").parquet(sink)
        held = stored.where(F.col("query") != query).select(key_digest(key).alias(DIGEST)).distinct().groupBy(DIGEST)
    rows = stream.withColumn(DIGEST, key_digest(key))
    fresh = rows.groupBy(DIGEST).transformWithState(FirstOfKey(order), stream.schema, "Append", "None", held)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/query={query}/batch={batch_id}")

    with settings(spark, STATE):
        return (
            fresh.writeStream.foreachBatch(write)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def ingest_within(
    stream: DataFrame, sink: str, key: str, time: str, delay: str, checkpoint: str
) -> StreamingQuery:
    """The same with bounded state: a key is remembered for the delay only."""
    return (
        stream.withWatermark(time, delay)
        .dropDuplicatesWithinWatermark([key])
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_rows(spark, sink: str) -> DataFrame:
    return spark.read.parquet(sink).drop("query", "batch")
