"""Price elasticity of demand per brand, and promotion simulation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.numeric import coerce_double
from shelfwise.operators.cleaning import filter_valid_pricing, with_discount_rate
from shelfwise.session import stage


def valid_pricing(products: DataFrame) -> DataFrame:
    """Coerced prices and sales, discount rate, only rows fit for a regression."""
    columns = ["Original_Price", "Discounted_Price", "Sales_Volume"]
    coerced = products.withColumns(
        {c: F.coalesce(coerce_double(F.col(c)), F.lit(0.0)) for c in columns}
    )
    return filter_valid_pricing(with_discount_rate(coerced))


def price_elasticity(
    products: DataFrame, least_rows: int = 5, least_per_brand: int = 2
) -> DataFrame:
    """Sales on discount rate, one least-squares line per brand.

    All statistics are sums that combine on the map side, so a brand holding a
    large part of the rows costs one partial row per task.
    """
    rate, sales = F.col("Discount_Rate"), F.col("Sales_Volume")
    fitted = stage(
        valid_pricing(products)
        .where(F.col("Brand").isNotNull())
        .groupBy("Brand")
        .agg(
            F.count(F.lit(1)).alias("Product_Count"),
            F.avg("Original_Price").alias("price"),
            F.avg(rate).alias("rate"),
            F.avg(sales).alias("sales"),
            F.coalesce(F.regr_slope(sales, rate), F.lit(0.0)).alias("beta"),
            F.when(F.var_pop(sales) == 0, 1.0)
            .otherwise(F.coalesce(F.regr_r2(sales, rate), F.lit(0.0)))
            .alias("r2"),
        ),
        "fitted",
    )
    total = fitted.agg(F.sum("Product_Count")).scalar()
    per_sale = F.col("beta") / F.col("sales")
    elasticity = F.when(F.col("rate") > 0, per_sale * F.col("rate")).otherwise(per_sale)

    def increase(points: int) -> Column:
        return F.greatest(F.lit(0.0), F.col("beta") * (points / 100))

    return (
        fitted.where((F.col("Product_Count") >= least_per_brand) & (total >= least_rows))
        .select(
            "Brand",
            "Product_Count",
            F.bround("price", 2).alias("Average_Original_Price"),
            F.bround("rate", 4).alias("Average_Discount_Rate"),
            F.bround("sales", 2).alias("Average_Sales_Volume"),
            F.bround("r2", 4).alias("Model_R2"),
            F.bround(elasticity, 4).alias("Price_Elasticity"),
            F.bround(increase(5), 2).alias("Uplift_5pct"),
            F.bround(increase(5) / F.col("sales") * 100, 2).alias("Uplift_5pct_Percent"),
            F.bround(increase(10), 2).alias("Uplift_10pct"),
            F.bround(increase(10) / F.col("sales") * 100, 2).alias("Uplift_10pct_Percent"),
        )
    )


def most_elastic_brand(elasticity: DataFrame, none: str = "N/A") -> DataFrame:
    """The brand of highest positive elasticity; the first name wins a tie."""
    positive = elasticity.where(F.col("Price_Elasticity") > 0)
    # Least struct of (negated value, name) is the highest value, first name.
    best = F.min(F.struct((-F.col("Price_Elasticity")).alias("v"), F.col("Brand").alias("b")))
    return positive.agg(best.alias("best")).select(
        F.coalesce("best.b", F.lit(none)).alias("brand"),
        (-F.col("best.v")).alias("elasticity"),
    )


def promo_simulation(elasticity: DataFrame, most: int = 30) -> DataFrame:
    """Growth in percent and units for each extra discount of 1..``most`` points."""
    growth = F.col("Price_Elasticity") * F.col("increment")
    steps = F.explode(F.sequence(F.lit(1), F.lit(most)))
    return (
        elasticity.select("Brand", "Price_Elasticity", "Average_Sales_Volume", steps.alias("increment"))
        .withColumn("growth_percent", growth)
        .withColumn("added_sales", growth / 100 * F.col("Average_Sales_Volume"))
        .withColumn(
            "direction",
            F.when(growth > 0, "up").when(growth < 0, "down").otherwise("none"),
        )
        .withColumn("sign", F.when(growth >= 0, "+").otherwise("-"))
    )


def elasticity_of_products(products: DataFrame, elasticity: DataFrame) -> DataFrame:
    """Products with their brand's elasticity; the brand table is an aggregate."""
    return products.join(
        elasticity.select("Brand", "Price_Elasticity", "Average_Sales_Volume"), "Brand"
    )
