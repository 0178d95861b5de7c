"""Exact ranks, medians and tops that no single task has to compute.

A window without partition keys, or one whose keys may hold a large part of
the table, is split here into slices with an offset per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.selection import ACCURACY, middle, order_statistics
from shelfwise.session import stage


#: Rows that a task ranks; the number of slices follows the table.
SLICE_ROWS = 1_000_000


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Position of each row in the order, from 1.

    ``order`` must end in a unique key.  Rows are range partitioned, so a value
    shared by many rows is spread over slices by the columns after it.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(least, -(-df.count() // SLICE_ROWS))
    ranged = df.repartitionByRange(slices, *order).withColumn(
        "_slice", F.spark_partition_id()
    )
    staged = stage(ranged, "ranked")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice.
    offsets = (
        staged.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return (
        staged.join(F.broadcast(offsets), "_slice")
        .withColumn(name, (F.col("_before") + inside).cast("long"))
        .drop("_slice", "_before")
    )


def hashed_rank(
    df: DataFrame,
    key: Column,
    within: Sequence[str] = (),
    name: str = "rank",
) -> DataFrame:
    """Position by ``md5(key)`` from 1, per ``within``; a seeded shuffle.

    The digest of a unique key is uniform, so its first hex digits, as many as
    the number of rows asks for, cut every group, hot ones too, into even slices.
    """
    prefix = 3
    rows = df.count()
    while rows > SLICE_ROWS * 16**prefix:
        prefix += 1
    within = list(within)
    same = [*within, "_slice"]
    keyed = df.withColumn("_md5", F.md5(key.cast("string").cast("binary"))).withColumn(
        "_slice", F.substring("_md5", 1, prefix)
    )
    earlier = (
        Window.partitionBy(*within)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        keyed.groupBy(*within, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_size", F.sum("_rows").over(Window.partitionBy(*within)))
        .select("_before", "_size", *[F.col(c).alias(f"_{i}_of_slice") for i, c in enumerate(same)])
    )
    # Rows without a group or key form groups of their own and stay.
    matched = [F.col(c).eqNullSafe(F.col(f"_{i}_of_slice")) for i, c in enumerate(same)]
    inside = F.row_number().over(
        Window.partitionBy(*within, "_slice").orderBy("_md5")
    )
    return (
        keyed.withColumn("_inside", inside)
        .join(offsets, matched)
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("long"))
        .withColumn(f"{name}_of", F.col("_size").cast("long"))
        .drop("_md5", "_slice", "_inside", "_before", "_size", *[f"_{i}_of_slice" for i in range(len(same))])
    )


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, salts: int = 64
) -> DataFrame:
    """First ``n`` rows of each group by the ascending order columns.

    Each group is cut to ``n`` rows per salt first, so a hot group reaches its
    final task with at most ``salts * n`` rows.
    """
    keys, order = list(keys), list(order)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    early = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))
    final = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        salted.withColumn("_rn", early)
        .where(F.col("_rn") <= n)
        .drop("_rn", "_salt")
        .withColumn("position", final)
        .where(F.col("position") <= n)
    )


def first_per_key(df: DataFrame, keys: Sequence[str], ordinal: Column) -> DataFrame:
    """First row per key by ordinal; partial aggregates keep one row per task."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*rest)
    return (
        df.groupBy(*keys)
        .agg(F.min_by(packed, ordinal).alias("_first"))
        .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def medians(df: DataFrame, columns: Sequence[str], accuracy: int = ACCURACY) -> dict[str, float | None]:
    """The exact median of each column, NULLs left out."""
    found, _ = order_statistics(df, {c: middle for c in columns}, accuracy)
    return {c: (found[c][0].low + found[c][1].low) / 2 if found[c] else None for c in columns}


def exact_medians(df: DataFrame, columns: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """One row per column: ``column``, ``n``, ``median`` (NULLs left out)."""
    found, counts = order_statistics(df, {c: middle for c in columns}, accuracy)
    rows = [(c, counts[c], (found[c][0].low + found[c][1].low) / 2 if found[c] else None) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, n long, median double")


def scalar_struct(row: DataFrame) -> Column:
    """A one-row table as a scalar subquery, in place of a cross join."""
    return row.select(F.struct(*row.columns)).scalar()
