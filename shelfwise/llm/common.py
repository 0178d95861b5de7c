"""Staged tables, exact word and id helpers shared by the operators of this folder."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.session import scratch_path

#: A null id sorts behind every id, so a row without one is never anyone's earlier copy.
NO_ID = np.iinfo(np.int64).max


@contextmanager
def short_lived_shuffles(spark: SparkSession):
    """Shuffle files of the queries run inside go when each query ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` texts for this session, as whole texts are long.

    Queries and stages ask for it; a session that set a smaller number keeps it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; its shuffle files are dropped.

    Later steps read the table, so a lost executor costs no more than its own tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with short_lived_shuffles(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str, carry: list[str] | tuple = ()) -> DataFrame:
    """``id``, ``text`` (null: empty) and, if asked for, a struct ``carried`` of further columns.

    Other columns, whatever their names, stay outside.
    """
    columns = [docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")]
    if carry:
        columns.append(F.struct(*[docs[c] for c in carry]).alias("carried"))
    return docs.select(*columns)


def in_blocks(texts: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Rows of :func:`id_and_text` with a ``block``: about ``block_bytes`` of text, dealt by a hash; and their number.

    The number of blocks follows the table, the size of one does not.
    """
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    count = max(1, -(-total // block_bytes))
    rest = [c for c in texts.columns if c not in ("id", "text")]
    return texts.select(F.pmod(F.xxhash64("id", F.octet_length("text")), F.lit(count)).alias("block"), "id", "text", *rest), count


def ids_of(table: pa.Table) -> np.ndarray:
    return table.column("id").combine_chunks().fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)


def bytes_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a string or binary column as one byte array, and where each begins and ends."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    data = array.buffers()[2] if len(array) else None
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_column(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The reverse of :func:`bytes_of`."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def hex_digest(col: Column | str) -> Column:
    return F.sha2(col, 256)
