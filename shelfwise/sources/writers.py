"""Sinks: overwritten and appended tables, nested documents, run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def aspect_documents(summary: DataFrame) -> DataFrame:
    """One document per product; its aspects are a map, at most one per aspect."""
    entry = F.struct(
        F.col("Aspect").alias("key"), F.struct("Score", "Pros", "Cons").alias("value")
    )
    return summary.groupBy("Product_ID", "Product_Name").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("Aspects")
    )


def elasticity_documents(elasticity: DataFrame) -> DataFrame:
    def uplift(points: int):
        return F.struct(
            F.col(f"Uplift_{points}pct").alias("Sales_Volume_Increase"),
            F.col(f"Uplift_{points}pct_Percent").alias("Percentage_Increase"),
        ).alias(f"Estimated_Uplift_{points}pct_Discount")

    return elasticity.select(
        "Brand",
        F.struct(
            "Product_Count", "Average_Original_Price", "Average_Discount_Rate",
            "Average_Sales_Volume", "Model_R2", "Price_Elasticity",
            uplift(5), uplift(10),
        ).alias("Elasticity"),
    )


def write_json(documents: DataFrame, path: str) -> None:
    """One JSON document per line, Unicode as is."""
    documents.write.mode("overwrite").json(path)


def append_forecast_runs(forecast: DataFrame, path: str, created_at: str) -> None:
    """Log of forecast runs, partitioned by the predicted date.

    Rows are gathered by date into files of the advised size; a date with many
    rows is split over several tasks.
    """
    (
        forecast.select(
            F.col("product_id").alias("productId"),
            F.col("date").alias("predictedDate"),
            F.col("predicted_volume").alias("predictedVolume"),
            "trend",
            F.lit(created_at).cast("timestamp").alias("createdAt"),
        )
        .hint("rebalance", F.col("predictedDate"))
        .write.mode("append")
        .partitionBy("predictedDate")
        .parquet(path)
    )
