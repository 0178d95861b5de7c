"""Readers for raw catalogue, review, basket and document files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

PRODUCT_FIELDS = [
    "Product_ID", "Name", "Brand", "Category", "Original_Price",
    "Discounted_Price", "Delivery_Options", "Sales_Volume", "Avg_Star_Rating",
    "Total_Reviews", "Product_URL",
]
REVIEW_FIELDS = [
    "Review_ID", "Product_ID", "Product_Name", "Review_Date", "Star_Rating",
    "Review_Text", "Helpfulness_Count", "Support_Contacted", "Language_Code",
]


def text_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


PRODUCT_SCHEMA = text_schema(PRODUCT_FIELDS)
REVIEW_SCHEMA = text_schema(REVIEW_FIELDS)
SCORED_SCHEMA = T.StructType(
    [T.StructField("Product_ID", T.StringType()), T.StructField("Sentiment_Score", T.DoubleType())]
)
ASPECT = T.StructType(
    [
        T.StructField("Score", T.DoubleType()),
        T.StructField("Pros", T.ArrayType(T.StringType())),
        T.StructField("Cons", T.ArrayType(T.StringType())),
    ]
)
ASPECT_DOCUMENT = T.StructType(
    [
        T.StructField("Product_ID", T.StringType()),
        T.StructField("Product_Name", T.StringType()),
        T.StructField("Aspects", T.MapType(T.StringType(), ASPECT)),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header; quoted fields may hold quotes and line breaks.

    A file with quoted line breaks cannot be split, so large exports should be
    many files, or parquet.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).exists(target)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    for path in paths:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exists: {list(paths)}")


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table, or an empty one of the same schema."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def dictionary_rows(df: DataFrame, column: str) -> DataFrame:
    """JSON objects as rows ``(token, replacement)``."""
    parsed = F.from_json(column, "map<string,string>")
    return df.select(F.explode(parsed).alias("token", "replacement"))


def read_dictionary(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """JSON objects, one per file or one per line, as a lookup table."""
    return dictionary_rows(spark.read.text(path, wholetext=not per_line), "value")


def read_aspect_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per product, flattened to a row per product and aspect."""
    return (
        spark.read.schema(ASPECT_DOCUMENT)
        .json(path)
        .select("Product_ID", "Product_Name", F.explode("Aspects").alias("Aspect", "a"))
        .select("Product_ID", "Product_Name", "Aspect", "a.Score", "a.Pros", "a.Cons")
    )


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = {c.lower() for c in df.columns}
    return df.select(*[c for c in columns if c.lower() in present])


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    present = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in present]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df


def require_rows(df: DataFrame, least: int) -> DataFrame:
    found = df.limit(least).count()
    if found < least:
        raise ValueError(f"only {found} usable rows, at least {least} needed")
    return df


def validation_report(df: DataFrame, required: Sequence[str], least: int) -> DataFrame:
    """One row: what is missing, and whether the row gate is met."""
    missing = ",".join(sorted(missing_columns(df, required)))
    return df.limit(least).agg(
        F.lit(missing).alias("missing"),
        (F.count(F.lit(1)) >= least).alias("enough_rows"),
        ((F.count(F.lit(1)) >= least) & F.lit(not missing)).alias("valid"),
    )
