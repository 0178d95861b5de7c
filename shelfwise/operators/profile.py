"""Counts, profiles and report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import lexicon
from shelfwise.functions import text
from shelfwise.functions.numeric import coerce_double
from shelfwise.functions.ranking import exact_medians, global_rank


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    if not keep_null:
        df = df.where(F.col(column).isNotNull())
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most common values; ties in value order."""
    return value_counts(df, column).orderBy(F.desc("n"), "value").limit(k)


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum, mean, median and missing count, one row per column."""
    coerced = df.select(*[coerce_double(F.col(c)).alias(c) for c in columns])
    one_pass = coerced.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
                F.avg(c).alias("mean"),
                F.sum(F.col(c).isNull().cast("long")).alias("missing"),
            ).alias(c)
            for c in columns
        ]
    )
    stats = one_pass.select(F.explode(F.array(*columns)).alias("s")).select("s.*")
    return stats.join(exact_medians(coerced, columns).select("column", "median"), "column")


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n"))


def review_counts(reviews: DataFrame) -> DataFrame:
    """Helpfulness, support contact and blank text over all reviews, one row."""
    helpful = F.coalesce(coerce_double(F.col("Helpfulness_Count")), F.lit(0.0))
    support = F.coalesce(coerce_double(F.col("Support_Contacted")), F.lit(0.0))
    return reviews.agg(
        F.max(helpful).alias("max_helpful"),
        F.avg(helpful).alias("mean_helpful"),
        F.count_if(helpful > 0).alias("nonzero_helpful"),
        F.count_if(support == 1).alias("support_contacted"),
        F.count_if(text.is_blank(F.col("Review_Text"))).alias("blank_text"),
    )


def class_counts(
    df: DataFrame, label: str = "label", names: Mapping[int, str] = lexicon.LABEL_NAMES
) -> DataFrame:
    """Count and percent of every class, also of one without rows."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col(label) == value).alias(name) for value, name in names.items()],
    )
    rows = [
        F.struct(F.lit(value).alias("label"), F.lit(name).alias("label_name"), F.col(name).alias("n"))
        for value, name in names.items()
    ]
    return counted.select("_all", F.explode(F.array(*rows)).alias("c")).select(
        "c.label", "c.label_name", "c.n", F.try_divide(F.col("c.n") * 100.0, F.col("_all")).alias("percent")
    )


def kpi_cards(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Products, brands, reviews and mean rating, one row."""
    review_count = reviews.agg(F.count(F.lit(1))).scalar()
    return products.agg(
        F.count(F.lit(1)).alias("products"),
        F.count_distinct("Brand").alias("brands"),
        F.avg("Avg_Star_Rating").alias("mean_rating"),
    ).withColumn("reviews", review_count)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def first_type_per_product(baskets: DataFrame) -> DataFrame:
    """Type on the first row of each product."""
    return baskets.groupBy("Product_ID").agg(
        F.min_by("Product_Type", "ordinal").alias("Product_Type")
    )


def metric_summary(metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of each metric over the folds."""
    one = metrics.agg(
        *[
            F.struct(
                F.lit(c).alias("metric"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")
            ).alias(c)
            for c in columns
        ]
    )
    return one.select(F.explode(F.array(*columns)).alias("m")).select("m.*")


def brands_by_count(products: DataFrame) -> DataFrame:
    """Brands ranked by product count, then name."""
    counted = value_counts(products, "Brand").withColumnRenamed("value", "Brand")
    return global_rank(counted, F.desc("n"), F.asc("Brand"))


COMPARE_KEYS = ["name", "brand", "price", "ramrom", "rating", "reviews"]


def compare_key(by: str) -> Column:
    def number(column: str) -> Column:
        return F.coalesce(F.col(column).cast("double"), F.lit(0.0))

    def vietnamese(column: Column) -> Column:
        return F.collate(F.coalesce(column, F.lit("")), "vi_CI_AI")

    return {
        "name": lambda: vietnamese(F.coalesce(F.nullif("Name", F.lit("")), "Product_ID")),
        "brand": lambda: vietnamese(F.col("Brand")),
        "price": lambda: number("Discounted_Price"),
        "ramrom": lambda: number("RAM") * 10_000 + number("ROM"),
        "rating": lambda: number("Avg_Star_Rating"),
        "reviews": lambda: number("Total_Reviews"),
    }[by]()


def compare_sort(products: DataFrame, by: str, descending: bool = False) -> DataFrame:
    """Products with their place in the chosen order; ties by id."""
    keyed = products.withColumn("sort_key", compare_key(by))
    first = F.desc("sort_key") if descending else F.asc("sort_key")
    return global_rank(keyed, first, F.asc("Product_ID"))


def report_rows(section: str, df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """A statistics table in the long form ``(section, metric, key, value)``."""
    entries = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ]
    return df.select(
        F.lit(section).alias("section"),
        F.col(key).cast("string").alias("key"),
        F.explode(F.array(*entries)).alias("e"),
    ).select("section", "e.metric", "key", "e.value")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
