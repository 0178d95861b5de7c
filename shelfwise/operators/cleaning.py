"""Row-level operators: coercion, imputation, derived columns and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import lexicon
from shelfwise.functions import catalog, numeric, text
from shelfwise.functions.ranking import medians
from shelfwise.sources.readers import select_existing


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in columns if c.lower() in have]


def with_parsed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns as numbers, in steps, so that each pattern runs once a row."""
    columns = present(df, columns)
    texts, bodies = [[f"_{c}_{part}" for c in columns] for part in ("text", "body")]
    return (
        df.withColumns({t: numeric.number_text(F.col(c)) for t, c in zip(texts, columns)})
        .withColumns({b: numeric.number_body(F.col(t)) for b, t in zip(bodies, texts)})
        .withColumns(
            {c: numeric.read_number(F.col(t), F.col(b)) for c, t, b in zip(columns, texts, bodies)}
        )
        .drop(*texts, *bodies)
    )


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL → the column's exact median."""
    columns = present(df, columns)
    if not columns:
        return df
    found = medians(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(found[c])) for c in columns if found[c] is not None})


def impute_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill({c: v for c, v in values.items() if present(df, [c])})


def fill_unknown(df: DataFrame, word: str = "unknown") -> DataFrame:
    """NULL → a word in every text column."""
    return df.na.fill(word, [c for c, t in df.dtypes if t == "string"])


def normalize_units(df: DataFrame, unit_tokens: Sequence[str] = lexicon.UNIT_TOKENS) -> DataFrame:
    """Parse every column whose name holds a unit; numeric ones are numbers already."""
    named = [(c, t) for c, t in df.dtypes if any(u in c.lower() for u in unit_tokens)]
    parsed = with_parsed(df, [c for c, t in named if t == "string"])
    return parsed.withColumns({c: F.col(c).cast("double") for c, t in named if t != "string"})


def with_discount_rate(df: DataFrame) -> DataFrame:
    if len(present(df, ["Original_Price", "Discounted_Price"])) < 2:
        return df
    return df.withColumn(
        "Discount_Rate",
        numeric.discount_rate(F.col("Original_Price"), F.col("Discounted_Price")),
    )


def with_specs(df: DataFrame) -> DataFrame:
    price = F.col("Discounted_Price") if present(df, ["Discounted_Price"]) else F.lit(0.0)
    named = df.withColumn("_name", catalog.spec_text(F.col("Name")))
    with_rom = named.withColumn("_rom", catalog.single_rom(F.col("_name")))
    specs = catalog.extract_specs(F.col("_name"), F.col("_rom"), price)
    return with_rom.withColumns(specs).drop("_name", "_rom")


def with_calendar(df: DataFrame, column: str = "Inward_Date") -> DataFrame:
    if not present(df, [column]):
        return df
    return df.withColumns(catalog.calendar(catalog.read_date(F.col(column))))


def with_segment(df: DataFrame) -> DataFrame:
    ram = F.col("RAM") if present(df, ["RAM"]) else F.lit(4.0)
    return df.withColumn("cluster_name", catalog.segment(F.col("Discounted_Price"), ram))


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=present(df, columns))


def filter_nonblank(df: DataFrame, column: str) -> DataFrame:
    return df.where(~text.is_blank(F.col(column)))


def filter_valid_pricing(df: DataFrame) -> DataFrame:
    return df.where((F.col("Original_Price") > 0) & (F.col("Sales_Volume") > 0))


def churn_alert(customers: DataFrame, threshold: float = 0.7) -> DataFrame:
    risk = F.coalesce(F.col("churn_probability").try_cast("double"), F.lit(0.0))
    return select_existing(
        customers.where(risk > threshold),
        ["User_ID", "email", "churn_probability", "rfm_segment"],
    )


CLUSTER_COLUMNS = [
    "Product_ID", "Name", "Brand", "cluster_id", "cluster_name", "RAM", "ROM",
    "Battery", "Camera_MP", "Discounted_Price", "Avg_Star_Rating",
    "Total_Reviews", "PC1", "PC2",
]


def cluster_listing(products: DataFrame) -> DataFrame:
    return select_existing(products, CLUSTER_COLUMNS)


def filter_brand_segment(
    products: DataFrame,
    brand: str | None = None,
    segment: str | None = None,
    undefined: str = lexicon.UNDEFINED_SEGMENT,
) -> DataFrame:
    if brand is not None:
        products = products.where(F.col("Brand") == brand)
    if segment is not None:
        stated = F.nullif(F.col("cluster_name"), F.lit(""))
        products = products.where(F.coalesce(stated, F.lit(undefined)) == segment)
    return products


def plot_points(products: DataFrame, undefined: str = lexicon.UNDEFINED_SEGMENT) -> DataFrame:
    def finite(name: str) -> Column:
        value = F.col(name).try_cast("double")
        infinite = F.abs(value) == float("inf")
        return F.when(value.isNull() | F.isnan(value) | infinite, 0.0).otherwise(value)

    def stated(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    return products.select(
        finite("PC1").alias("x"),
        finite("PC2").alias("y"),
        F.coalesce(stated("Name"), F.col("Product_ID")).alias("name"),
        F.coalesce(stated("cluster_name"), F.lit(undefined)).alias("cluster"),
        F.col("Discounted_Price").alias("price"),
        F.col("RAM").alias("ram"),
        F.col("ROM").alias("rom"),
    )


def feature_defaults(
    requests: DataFrame, features: Sequence[str] = lexicon.FORECAST_FEATURES
) -> DataFrame:
    """The model's features in trained order; absent or NULL ones are 0."""
    have = set(present(requests, features))
    return requests.select(
        "product_id",
        *[
            (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in have else F.lit(0.0)).alias(f)
            for f in features
        ],
    )


def with_url_fields(links: DataFrame, base_url: str) -> DataFrame:
    """Absolute URL, id from its last part (else from the name), brand."""
    url = catalog.absolute_url(F.col("href"), base_url)
    return links.withColumns(
        {
            "Product_URL": url,
            "Product_ID": F.coalesce(
                F.nullif(catalog.url_slug(url), F.lit("")), catalog.id_from_name(F.col("name"))
            ),
            "Brand": catalog.brand_or_first_word(F.col("brand"), F.col("name")),
        }
    )
