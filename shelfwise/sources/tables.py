"""Retail views over the given tables, for Spark and, as text, for SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.operators.aspects import AspectLexicon
from shelfwise.session import stage

NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]

# Words frequent in the given texts, in the roles the defaults have.
DICTIONARY = {"it": "the", "un": "une"}
ASPECTS = AspectLexicon(
    keywords={
        "Battery/Charging": ["the", "of"],
        "Performance/OS": ["de", "la"],
        "Camera": ["der", "die"],
        "Design/Build": ["that", "was"],
        "Service/Staff": ["with", "this"],
    },
    vetoes={"Performance/OS": ["que"], "Design/Build": ["her"]},
    positive=("and", "les"),
    negative=("is", "und"),
    marks=",.",
    words=("to",),
)


class Tables:
    """The given parquet tables and the views derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in NAMES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        raise AttributeError(name)

    def stream(self, name: str) -> DataFrame:
        """A table as a stream, be it one file or a folder of files.

        Spark streams a single file only by a pattern, which the braces make of its name.
        """
        return self.spark.readStream.schema(getattr(self, name).schema).parquet(f"{self.folder}/{{{name}}}.parquet")

    @cached_property
    def products(self) -> DataFrame:
        sold = self.lineitem.groupBy("l_partkey").agg(
            F.avg("l_discount").alias("d"),
            F.sum("l_quantity").alias("q"),
            F.count(F.lit(1)).alias("n"),
            F.min("l_shipdate").alias("first"),
        )
        price = F.col("p_retailprice") * F.col("p_size") * 1000
        return self.part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").select(
            F.col("p_partkey").cast("string").alias("Product_ID"),
            F.col("p_name").alias("Name"),
            F.col("p_brand").alias("Brand"),
            F.col("p_type").alias("Category"),
            price.alias("Original_Price"),
            (price * (1 - F.col("d"))).alias("Discounted_Price"),
            F.col("q").alias("Sales_Volume"),
            (1 + F.col("p_size") % 5).cast("double").alias("Avg_Star_Rating"),
            F.col("n").alias("Total_Reviews"),
            F.col("first").alias("Inward_Date"),
        )

    @cached_property
    def stored_products(self) -> DataFrame:
        """The products written once, for queries that read them several times."""
        return stage(self.products, "products")

    @cached_property
    def gappy_products(self) -> DataFrame:
        gap = F.col("Product_ID").cast("long") % 11 == 0
        columns = ["Original_Price", "Sales_Volume", "Total_Reviews"]
        return self.stored_products.withColumns(
            {c: F.when(~gap, F.col(c).cast("double")) for c in columns}
        )

    @cached_property
    def spec_products(self) -> DataFrame:
        return self.products.withColumn("Name", spec_name(F.col("Product_ID").cast("long"), F.col("Name")))

    @cached_property
    def raw_products(self) -> DataFrame:
        """All text, with gaps and units, as a crawl would leave them."""
        k = F.col("Product_ID").cast("long")
        whole = F.round("Original_Price").cast("long").cast("string")
        sold = F.round("Sales_Volume").cast("long").cast("string")
        return self.spec_products.select(
            F.col("Product_ID"),
            F.col("Name"),
            F.when(k % 13 != 0, F.col("Brand")).alias("Brand"),
            F.when(k % 11 == 0, None).when(k % 7 == 3, "12,5 triệu").otherwise(whole).alias("Original_Price"),
            F.round("Discounted_Price").cast("long").cast("string").alias("Discounted_Price"),
            F.when(k % 11 == 0, "unknown").when(k % 5 == 0, F.concat(sold, F.lit(",5k"))).otherwise(sold).alias("Sales_Volume"),
            F.round("Avg_Star_Rating").cast("long").cast("string").alias("Avg_Star_Rating"),
            F.when(k % 11 != 1, F.col("Total_Reviews").cast("string")).alias("Total_Reviews"),
            F.when(k % 17 == 0, "no date").otherwise(F.date_format("Inward_Date", "yyyy-MM-dd")).alias("Inward_Date"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        stars = F.when(F.col("toxic") == 1, "1").when(F.col("quality") == 0, "3").when(F.col("quality") == 1, "5")
        key = F.col("doc_id")
        return self.documents.join(self.labels, "doc_id", "left").select(
            key.cast("string").alias("Review_ID"),
            (key % 50).cast("string").alias("Product_ID"),
            F.concat(F.lit("Product "), (key % 50).cast("string")).alias("Product_Name"),
            stars.alias("Star_Rating"),
            F.col("text").alias("Review_Text"),
            (F.col("n_chars") % 7).cast("string").alias("Helpfulness_Count"),
            (key % 3 == 0).cast("int").cast("string").alias("Support_Contacted"),
            key.alias("ordinal"),
        )

    @cached_property
    def raw_reviews(self) -> DataFrame:
        """The reviews with markup, a link and a support note on some."""
        key = F.col("ordinal")
        return self.reviews.withColumn(
            "Review_Text",
            F.concat(
                F.col("Review_Text"),
                F.when(key % 7 == 0, "<b>x</b>").otherwise(""),
                F.when(key % 5 == 0, " http://a.b/c ").otherwise(""),
                F.when(key % 3 == 0, " || note ").otherwise(""),
            ),
        )

    @cached_property
    def baskets(self) -> DataFrame:
        number = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
        return self.lineitem.join(self.part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").cast("string").alias("Transaction_ID"),
            F.col("p_brand").alias("Product_ID"),
            F.when(number % 2 == 1, "smartphone").otherwise("accessory").alias("Product_Type"),
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("ordinal"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").cast("string").alias("User_ID"),
            F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        )

    @cached_property
    def customer_orders(self) -> DataFrame:
        return self.orders.select(
            F.col("o_custkey").cast("string").alias("User_ID"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("amount"),
        )

    @cached_property
    def scored(self) -> DataFrame:
        """A sentiment score per order line; some products have none."""
        score = F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity") / 50)
        return self.lineitem.select(
            F.col("l_partkey").cast("string").alias("Product_ID"), score.alias("Sentiment_Score")
        )

    @cached_property
    def messy(self) -> DataFrame:
        return self.part.select("p_partkey", messy_number().alias("raw"))

    @cached_property
    def predictions(self) -> DataFrame:
        """Line status against return flag, as true and predicted classes."""
        return self.lineitem.select(
            F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("label"),
            ((F.col("l_suppkey") + F.col("l_linenumber")) % 3).cast("int").alias("prediction"),
        )

    @cached_property
    def requests(self) -> DataFrame:
        return self.products.select(
            F.col("Product_ID").alias("product_id"),
            F.col("Discounted_Price").alias("current_price"),
            (1 - F.col("Discounted_Price") / F.col("Original_Price")).alias("discount_rate"),
            ((F.col("Avg_Star_Rating") - 1) / 4).alias("sentiment_score_yesterday"),
        )

    @cached_property
    def daily_sales(self) -> DataFrame:
        return self.lineitem.groupBy(
            F.col("l_partkey").alias("request_id"), F.to_date("l_shipdate").alias("date")
        ).agg(F.sum("l_quantity").alias("predicted_volume"))


def spec_name(k: Column, name: Column) -> Column:
    third = k % 3
    ram = F.when(third == 0, "4").when(third == 1, "6").otherwise("8")
    rom = F.when(third == 0, "64").when(third == 1, "128").otherwise("256")
    return (
        F.when(k % 8 == 0, F.concat(F.lit("iPhone 15 "), name, F.lit(" 512GB")))
        .when(k % 8 == 1, F.concat(F.lit("Samsung Ultra "), name, F.lit(" 12GB/1TB")))
        .when(k % 8 == 2, F.concat(F.lit("Nokia 105 4G "), name))
        .when(k % 8 == 3, F.concat(name, F.lit(" Power 5G")))
        .when(k % 8 == 4, F.concat(F.lit("Neo 13T "), name))
        .otherwise(F.concat(name, F.lit(" "), ram, F.lit("GB/"), rom, F.lit("GB")))
    )


def messy_number() -> Column:
    size, k = F.col("p_size").cast("string"), F.col("p_partkey") % 10
    return (
        F.when(k == 0, F.concat(size, F.lit("k")))
        .when(k == 1, F.concat(size, F.lit(".500")))
        .when(k == 2, F.concat(F.lit("1.23"), size, F.lit(",5")))
        .when(k == 3, F.concat(F.lit("-"), size))
        .when(k == 4, "unknown")
        .when(k == 5, "")
        .when(k == 6, F.concat(F.lit("10-"), size))
        .when(k == 7, F.concat(size, F.lit(",5 triệu")))
        .when(k == 8, F.concat(size, F.lit("mp")))
        .otherwise(F.concat(F.lit("Đã bán "), size, F.lit(",4k")))
    )


# The same views in SQL; each may use the ones it names.
SQL_VIEWS = {
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS Product_ID, p_name AS Name, p_brand AS Brand,
               p_type AS Category, p_retailprice * p_size * 1000 AS Original_Price,
               p_retailprice * p_size * 1000 * (1 - d) AS Discounted_Price, q AS Sales_Volume,
               CAST(1 + p_size % 5 AS DOUBLE) AS Avg_Star_Rating, n AS Total_Reviews,
               inward AS Inward_Date
        FROM part LEFT JOIN (
            SELECT l_partkey, avg(l_discount) AS d, sum(l_quantity) AS q, count(*) AS n,
                   min(l_shipdate) AS inward FROM lineitem GROUP BY l_partkey
        ) ON p_partkey = l_partkey""",
    "gappy_products": """
        SELECT * REPLACE (
            CASE WHEN CAST(Product_ID AS BIGINT) % 11 <> 0 THEN Original_Price END AS Original_Price,
            CASE WHEN CAST(Product_ID AS BIGINT) % 11 <> 0 THEN Sales_Volume END AS Sales_Volume,
            CASE WHEN CAST(Product_ID AS BIGINT) % 11 <> 0 THEN CAST(Total_Reviews AS DOUBLE) END AS Total_Reviews)
        FROM products""",
    "spec_products": """
        SELECT * REPLACE (CASE CAST(Product_ID AS BIGINT) % 8
            WHEN 0 THEN 'iPhone 15 ' || Name || ' 512GB'
            WHEN 1 THEN 'Samsung Ultra ' || Name || ' 12GB/1TB'
            WHEN 2 THEN 'Nokia 105 4G ' || Name
            WHEN 3 THEN Name || ' Power 5G'
            WHEN 4 THEN 'Neo 13T ' || Name
            ELSE Name || CASE CAST(Product_ID AS BIGINT) % 3 WHEN 0 THEN ' 4GB/64GB'
                WHEN 1 THEN ' 6GB/128GB' ELSE ' 8GB/256GB' END END AS Name)
        FROM products""",
    "raw_products": """
        SELECT Product_ID, Name,
               CASE WHEN k % 13 <> 0 THEN Brand END AS Brand,
               CASE WHEN k % 11 = 0 THEN NULL WHEN k % 7 = 3 THEN '12,5 triệu'
                    ELSE CAST(CAST(round(Original_Price) AS BIGINT) AS VARCHAR) END AS Original_Price,
               CAST(CAST(round(Discounted_Price) AS BIGINT) AS VARCHAR) AS Discounted_Price,
               CASE WHEN k % 11 = 0 THEN 'unknown'
                    WHEN k % 5 = 0 THEN CAST(CAST(round(Sales_Volume) AS BIGINT) AS VARCHAR) || ',5k'
                    ELSE CAST(CAST(round(Sales_Volume) AS BIGINT) AS VARCHAR) END AS Sales_Volume,
               CAST(CAST(Avg_Star_Rating AS BIGINT) AS VARCHAR) AS Avg_Star_Rating,
               CASE WHEN k % 11 <> 1 THEN CAST(Total_Reviews AS VARCHAR) END AS Total_Reviews,
               CASE WHEN k % 17 = 0 THEN 'no date' ELSE strftime(Inward_Date, '%Y-%m-%d') END AS Inward_Date
        FROM (SELECT *, CAST(Product_ID AS BIGINT) AS k FROM spec_products)""",
    "reviews": """
        SELECT CAST(d.doc_id AS VARCHAR) AS Review_ID, CAST(d.doc_id % 50 AS VARCHAR) AS Product_ID,
               'Product ' || CAST(d.doc_id % 50 AS VARCHAR) AS Product_Name,
               CASE WHEN toxic = 1 THEN '1' WHEN quality = 0 THEN '3' WHEN quality = 1 THEN '5' END AS Star_Rating,
               d.text AS Review_Text, CAST(n_chars % 7 AS VARCHAR) AS Helpfulness_Count,
               CASE WHEN d.doc_id % 3 = 0 THEN '1' ELSE '0' END AS Support_Contacted,
               d.doc_id AS ordinal
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "raw_reviews": """
        SELECT * REPLACE (Review_Text
            || CASE WHEN ordinal % 7 = 0 THEN '<b>x</b>' ELSE '' END
            || CASE WHEN ordinal % 5 = 0 THEN ' http://a.b/c ' ELSE '' END
            || CASE WHEN ordinal % 3 = 0 THEN ' || note ' ELSE '' END AS Review_Text)
        FROM reviews""",
    "baskets": """
        SELECT CAST(l_orderkey AS VARCHAR) AS Transaction_ID, p_brand AS Product_ID,
               CASE WHEN CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) % 2 = 1
                    THEN 'smartphone' ELSE 'accessory' END AS Product_Type,
               l_orderkey * 100 + l_linenumber AS ordinal
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS User_ID,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email FROM customer""",
    "customer_orders": """
        SELECT CAST(o_custkey AS VARCHAR) AS User_ID, o_orderdate AS order_date,
               o_totalprice AS amount FROM orders""",
    "scored": """
        SELECT CAST(l_partkey AS VARCHAR) AS Product_ID,
               CASE WHEN l_partkey % 9 <> 0 THEN l_quantity / 50 END AS Sentiment_Score FROM lineitem""",
    "messy": """
        SELECT p_partkey, CASE p_partkey % 10
            WHEN 0 THEN p_size || 'k' WHEN 1 THEN p_size || '.500'
            WHEN 2 THEN '1.23' || p_size || ',5' WHEN 3 THEN '-' || p_size
            WHEN 4 THEN 'unknown' WHEN 5 THEN '' WHEN 6 THEN '10-' || p_size
            WHEN 7 THEN p_size || ',5 triệu' WHEN 8 THEN p_size || 'mp'
            ELSE 'Đã bán ' || p_size || ',4k' END AS raw
        FROM part""",
    "predictions": """
        SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label,
               CAST((l_suppkey + l_linenumber) % 3 AS INT) AS prediction FROM lineitem""",
    "requests": """
        SELECT Product_ID AS product_id, Discounted_Price AS current_price,
               1 - Discounted_Price / Original_Price AS discount_rate,
               (Avg_Star_Rating - 1) / 4 AS sentiment_score_yesterday FROM products""",
    "daily_sales": """
        SELECT l_partkey AS request_id, CAST(l_shipdate AS DATE) AS date,
               sum(l_quantity) AS predicted_volume FROM lineitem GROUP BY 1, 2""",
}
USES = {
    "gappy_products": ["products"],
    "spec_products": ["products"],
    "raw_products": ["products", "spec_products"],
    "raw_reviews": ["reviews"],
    "requests": ["products"],
}


def with_views(*names: str) -> str:
    """``WITH`` clause that defines the views and what they use."""
    wanted = {u for n in names for u in [*USES.get(n, []), n]}
    return "WITH " + ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in SQL_VIEWS if n in wanted)
