"""Joins between catalogue, reviews, dictionaries and rules.

No side is forced to broadcast unless its size is fixed; adaptive execution
broadcasts what turns out small and splits skewed partitions of the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions import text
from shelfwise.functions.ranking import first_per_key, first_rows


def mean_sentiment(scored: DataFrame) -> DataFrame:
    return (
        scored.where(F.col("Product_ID").isNotNull())
        .groupBy("Product_ID")
        .agg(F.avg("Sentiment_Score").alias("Sentiment_Score"))
    )


def left_join_sentiment(products: DataFrame, scored: DataFrame | None, neutral: float = 0.5) -> DataFrame:
    """Products with their mean sentiment; neutral where there is none."""
    if scored is None or "Sentiment_Score" not in scored.columns:
        return products.withColumn("Sentiment_Score", F.lit(neutral))
    joined = products.join(mean_sentiment(scored), "Product_ID", "left")
    return joined.withColumn(
        "Sentiment_Score", F.coalesce("Sentiment_Score", F.lit(neutral))
    )


#: Characters of text whose words a task counts.
PART_CHARS = 1 << 23


def dealt_by_key(docs: DataFrame, key: str, column: str) -> DataFrame:
    """The texts dealt out by key, so that counting their words by key moves no word."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chars = docs.agg(F.coalesce(F.sum(F.length(column)), F.lit(0))).first()[0]
    return docs.select(key, column).repartition(max(least, -(-chars // PART_CHARS)), key)


def dictionary_join(
    docs: DataFrame, dictionary: DataFrame, key: str, column: str, salts: int = 32
) -> DataFrame:
    """One row per word with its replacement, itself where the dictionary has none.

    For dictionaries of any size; ``functions.text.translate`` gives whole
    texts.  The few most frequent words make up much of any text, so every
    entry stands once per salt and places of a word take the salts in turn.
    """
    words = docs.select(
        key, F.posexplode(text.tokens(F.lower(F.col(column)))).alias("position", "token")
    ).withColumn("_salt", F.pmod(F.xxhash64(key, "position"), F.lit(salts)).cast("int"))
    entries = dictionary.select(
        "token", "replacement", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    )
    return words.join(entries, ["token", "_salt"], "left").select(
        key, "position", "token", F.coalesce("replacement", "token").alias("replacement")
    )


def keyword_matches(
    clauses: DataFrame,
    keywords: Mapping[str, Sequence[str]],
    vetoes: Mapping[str, Sequence[str]],
    column: str = "clause",
) -> DataFrame:
    """One row per clause and aspect it names, unless a veto term occurs in it.

    The keyword table becomes one pattern per aspect, so clauses are scanned
    where they are instead of being joined with every keyword.
    """
    clause = F.col(column)
    hits = []
    for aspect, words in keywords.items():
        hit = clause.rlike(text.any_word(words))
        for term in vetoes.get(aspect, ()):
            hit = hit & ~clause.contains(term)
        hits.append(F.when(hit, F.lit(aspect)))
    named = F.filter(F.array(*hits), lambda a: a.isNotNull())
    return clauses.withColumn("aspect", F.explode(named))


def new_products(found: DataFrame, seen: DataFrame, per_category: int | None = None) -> DataFrame:
    """First card of each URL not stored yet, in page order.

    Repeats are reduced before the join, so a URL listed on many pages meets
    the stored ones once.
    """
    place = F.struct("page_id", "position")
    fresh = first_per_key(found, ["Product_URL"], place).join(
        seen.select("Product_URL"), "Product_URL", "left_anti"
    )
    if per_category is None:
        return fresh
    return limit_per_category(fresh, per_category)


def limit_per_category(found: DataFrame, n: int) -> DataFrame:
    """At most ``n`` products per category, in page order."""
    ordered = found.withColumnRenamed("position", "card")
    return (
        first_rows(ordered, ["Category"], ["page_id", "card"], n)
        .drop("position")
        .withColumnRenamed("card", "position")
    )


def cap_reviews(reviews: DataFrame, n: int, order: Sequence[str] = ("ordinal",)) -> DataFrame:
    """At most ``n`` reviews per product, in order."""
    return first_rows(reviews, ["Product_ID"], order, n).drop("position")


def merge_reviews(sources: Sequence[DataFrame], order: str = "ordinal") -> DataFrame:
    """Ordered union of review sources; the first row of each review id stays."""
    tagged = [s.withColumn("source", F.lit(i)) for i, s in enumerate(sources)]
    merged = tagged[0]
    for other in tagged[1:]:
        merged = merged.unionByName(other)
    return first_per_key(merged, ["Review_ID"], F.struct("source", order))


def reviews_of_catalog(pages: DataFrame, products: DataFrame) -> DataFrame:
    """Review pages with the id and name of their product."""
    named = products.select(
        "Product_URL", F.col("Product_ID").alias("product_id"), F.col("Name").alias("product_name")
    )
    return pages.join(named, "Product_URL")


def horizon(requests: DataFrame, start: str, days: int = 7) -> DataFrame:
    """Each request once per following day."""
    first = F.date_add(F.to_date(F.lit(start)), 1)
    last = F.date_add(F.to_date(F.lit(start)), days)
    return requests.withColumn("date", F.explode(F.sequence(first, last)))


def cross_sell_lookup(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules whose left side holds the requested product."""
    stripped = F.transform(F.split("antecedent", ","), text.strip)
    items = rules.withColumn("Product_ID", F.explode(F.array_distinct(stripped)))
    return (
        requests.select("Product_ID")
        .distinct()
        .join(items, "Product_ID")
        .select(
            "Product_ID",
            F.col("consequent").alias("accessory_id"),
            F.col("consequent").alias("accessory_name"),
            "confidence",
            "lift",
        )
    )
