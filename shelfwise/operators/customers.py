"""Recency, frequency and monetary segments with a churn score."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.selection import even_tiles
from shelfwise.session import stage


def rfm_segments(customers: DataFrame, orders: DataFrame, tiles: int = 5) -> DataFrame:
    """One row per customer with orders.

    ``customers``: ``User_ID, email``; ``orders``: ``User_ID, order_date,
    amount``.  Scores run 1..``tiles``, the best customers highest, and the
    segment reads recency, frequency, monetary as three digits.  Churn is the
    customer's recency relative to the longest one.
    """
    per_customer = orders.groupBy("User_ID").agg(
        F.max(F.to_date("order_date")).alias("last_order"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("amount").alias("monetary"),
    )
    base = stage(customers.select("User_ID", "email").join(per_customer, "User_ID"), "rfm")
    latest, longest = base.agg(F.max("last_order"), F.date_diff(F.max("last_order"), F.min("last_order"))).first()
    aged = base.withColumn("recency", F.date_diff(F.lit(latest), F.col("last_order")))
    measures = {
        "_recency": F.coalesce(-F.col("recency"), F.lit(float("inf"))),
        "_frequency": F.col("frequency"),
        "_monetary": F.col("monetary"),
    }
    return even_tiles(aged, measures, "User_ID", tiles).select(
        "User_ID",
        "email",
        "recency",
        "frequency",
        "monetary",
        (F.col("_recency") * 100 + F.col("_frequency") * 10 + F.col("_monetary")).alias("rfm_segment"),
        F.coalesce(F.try_divide(F.col("recency"), F.lit(longest)), F.lit(0.0)).alias("churn_probability"),
    )
