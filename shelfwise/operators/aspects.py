"""Aspect-based sentiment of reviews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from shelfwise import lexicon
from shelfwise.functions import catalog, numeric, text
from shelfwise.functions.ranking import first_rows
from shelfwise.operators.joins import keyword_matches
from shelfwise.session import stage


@dataclass(frozen=True)
class AspectLexicon:
    keywords: Mapping[str, Sequence[str]] = field(default_factory=lambda: lexicon.ASPECT_KEYWORDS)
    vetoes: Mapping[str, Sequence[str]] = field(default_factory=lambda: lexicon.ASPECT_VETOES)
    positive: Sequence[str] = tuple(lexicon.POSITIVE_CUES)
    negative: Sequence[str] = tuple(lexicon.NEGATIVE_CUES)
    marks: str = lexicon.CLAUSE_MARKS
    words: Sequence[str] = tuple(lexicon.CLAUSE_WORDS)


def review_clauses(
    reviews: DataFrame,
    words: AspectLexicon = AspectLexicon(),
    dictionary: Mapping[str, str] | None = lexicon.SHORTHAND,
) -> DataFrame:
    """Clauses of each review with their place, the stars and the weight.

    ``dictionary=None`` splits the text as it is, so punctuation ends clauses.
    """
    body = F.col("Review_Text")
    if dictionary is not None:
        body = text.clean_text(body, dictionary)
    stars = F.coalesce(numeric.coerce_double(F.col("Star_Rating")), F.lit(5.0))
    helpful = F.col("Helpfulness_Count") if "Helpfulness_Count" in reviews.columns else F.lit("0")
    return reviews.where(F.col("Product_ID").isNotNull()).select(
        "Product_ID",
        "ordinal",
        stars.alias("stars"),
        catalog.review_weight(helpful).alias("weight"),
        F.posexplode(text.split_clauses(body, words.marks, words.words)).alias("place", "clause"),
    )


def extract_aspects(
    reviews: DataFrame,
    words: AspectLexicon = AspectLexicon(),
    dictionary: Mapping[str, str] | None = lexicon.SHORTHAND,
) -> DataFrame:
    """One row per review clause and aspect, with its sentiment."""
    matched = keyword_matches(
        review_clauses(reviews, words, dictionary), words.keywords, words.vetoes
    )
    return matched.withColumn(
        "sentiment",
        text.cue_sentiment(F.col("clause"), F.col("stars"), words.positive, words.negative),
    )


def aspect_scores(aspects: DataFrame) -> DataFrame:
    """Weighted share of positive sentiment per product and aspect."""
    positive = F.sum(F.col("sentiment") * F.col("weight"))
    return aspects.groupBy("Product_ID", F.col("aspect").alias("Aspect")).agg(
        F.bround(positive / F.sum("weight"), 2).alias("Score"),
        F.count(F.lit(1)).alias("clauses"),
    )


def aspect_samples(aspects: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` different positive and negative clauses, in reading order."""
    place = F.min(F.struct("ordinal", "place")).alias("first")
    unique = (
        aspects.where(F.col("sentiment") != 0.5)
        .groupBy("Product_ID", "aspect", "sentiment", "clause")
        .agg(place)
        .select("Product_ID", "aspect", "sentiment", "clause", "first.ordinal", "first.place")
    )
    return first_rows(unique, ["Product_ID", "aspect", "sentiment"], ["ordinal", "place"], n)


def aspect_pros_cons(aspects: DataFrame, n: int = 5) -> DataFrame:
    """The samples as two ordered lists of at most ``n`` clauses."""

    def listed(sentiment: float):
        picked = F.collect_list(
            F.when(F.col("sentiment") == sentiment, F.struct("position", "clause"))
        )
        return F.transform(F.array_sort(picked), lambda x: x.clause)

    return (
        aspect_samples(aspects, n)
        .groupBy("Product_ID", F.col("aspect").alias("Aspect"))
        .agg(listed(1.0).alias("Pros"), listed(0.0).alias("Cons"))
    )


def product_names(reviews: DataFrame) -> DataFrame:
    """Name on the first review of each product, the id where there is no name."""
    name = F.col("Product_Name") if "Product_Name" in reviews.columns else F.col("Product_ID")
    return (
        reviews.where(F.col("Product_ID").isNotNull())
        .groupBy("Product_ID")
        .agg(F.min_by(name, "ordinal").alias("Product_Name"))
    )


def aspect_summary(
    reviews: DataFrame,
    words: AspectLexicon = AspectLexicon(),
    dictionary: Mapping[str, str] | None = lexicon.SHORTHAND,
) -> DataFrame:
    """Score, pros and cons per product and aspect, with the product's name."""
    aspects = stage(extract_aspects(reviews, words, dictionary), "aspects")
    none = F.array().cast("array<string>")
    return (
        aspect_scores(aspects)
        .join(aspect_pros_cons(aspects), ["Product_ID", "Aspect"], "left")
        .join(product_names(reviews), "Product_ID")
        .select(
            "Product_ID",
            "Product_Name",
            "Aspect",
            "Score",
            F.coalesce("Pros", none).alias("Pros"),
            F.coalesce("Cons", none).alias("Cons"),
        )
    )


# What stands in for a missing quote.
DEFAULT_PRAISE = "Khách hàng rất hài lòng về mặt này."
DEFAULT_COMPLAINT = "Ghi nhận một số phàn nàn nhẹ."


def aspect_verdict(summary: DataFrame) -> DataFrame:
    """Strength or weakness, three-step label, chart band and headline quote."""
    score = F.coalesce("Score", F.lit(0.5))
    praise = F.nullif(F.try_element_at("Pros", F.lit(1)), F.lit(""))
    complaint = F.nullif(F.try_element_at("Cons", F.lit(1)), F.lit(""))
    strong, weak = score >= 0.6, score < 0.45
    return summary.select(
        "Product_ID",
        "Aspect",
        "Score",
        F.when(strong, "strength").when(weak, "weakness").alias("verdict"),
        F.when(strong, "good").when(score >= 0.4, "neutral").otherwise("poor").alias("level"),
        F.when(score * 100 >= 60, "green")
        .when(score * 100 >= 45, "yellow")
        .otherwise("red")
        .alias("band"),
        F.when(strong, F.coalesce(praise, F.lit(DEFAULT_PRAISE)))
        .when(weak, F.coalesce(complaint, F.lit(DEFAULT_COMPLAINT)))
        .alias("quote"),
    )


def aspect_coverage(scores: DataFrame) -> DataFrame:
    """Per aspect: how many products mention it, and their mean score."""
    return scores.groupBy("Aspect").agg(
        F.count(F.lit(1)).alias("products"), F.avg("Score").alias("mean_score")
    )
