"""Session settings, and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for what runs inside; what was set before is set again."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session that names none gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/shelfwise/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str = "stage", even: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages re-read columns from the table instead of recomputing the
    plan, also when an executor is lost.  ``even`` writes files of the advised
    partition size, for tables that an iterative fit reads many times.
    """
    path = scratch_path(df.sparkSession, name)
    if even:
        df = df.hint("rebalance")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
