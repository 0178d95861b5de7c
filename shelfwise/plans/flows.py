"""End-to-end jobs from raw tables to the tables the reports read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from shelfwise import lexicon
from shelfwise.functions import catalog, text
from shelfwise.functions.ranking import first_per_key
from shelfwise.operators import cleaning, profile
from shelfwise.operators.aspects import AspectLexicon, aspect_coverage, aspect_summary
from shelfwise.operators.phrases import with_segments
from shelfwise.operators.pricing import price_elasticity
from shelfwise.session import stage
from shelfwise.sources.writers import aspect_documents, elasticity_documents

Segmenter = Callable[[DataFrame, str], DataFrame]


def clean_products(raw: DataFrame) -> DataFrame:
    """Parsed and gap-free commercial columns, specs, discount, calendar."""
    parsed = stage(cleaning.with_parsed(raw, lexicon.COMMERCIAL_COLUMNS), "parsed")
    df = cleaning.impute_median(parsed, lexicon.COMMERCIAL_COLUMNS)
    df = cleaning.normalize_units(cleaning.with_specs(df))
    df = cleaning.with_calendar(cleaning.with_discount_rate(df))
    return cleaning.fill_unknown(cleaning.drop_null_keys(df, ["Product_ID"]))


def _segmented(df: DataFrame, segmenter: Segmenter | None) -> DataFrame:
    """The segmenter's column; without one, phrases are mined from the texts themselves."""
    return (segmenter or with_segments)(df, "Review_Text_Clean")


def clean_reviews(
    reviews: DataFrame,
    dictionary: Mapping[str, str] = lexicon.SHORTHAND,
    segmenter: Segmenter | None = None,
) -> DataFrame:
    """Cleaned and segmented text, and the two-class label."""
    df = reviews.withColumn("Review_Text_Clean", text.clean_text(F.col("Review_Text"), dictionary))
    df = _segmented(df, segmenter)
    if "Star_Rating" in df.columns and "label" not in df.columns:
        df = df.withColumn("label", catalog.label_binary(F.col("Star_Rating")).cast("double"))
    return cleaning.drop_null_keys(df, ["Review_Text_Segmented"])


def label_reviews(
    reviews: DataFrame,
    dictionary: Mapping[str, str] = lexicon.SHORTHAND,
    segmenter: Segmenter | None = None,
    order: str = "ordinal",
) -> DataFrame:
    """Three-class training table without blank, unlabelled or repeated texts.

    Repeats leave before the texts are segmented.  Whether a text is blank
    travels with the row, so that the test does not clean every text again.
    """
    labeled = reviews.withColumn("label", catalog.label_three(F.col("Star_Rating"))).where(
        F.col("label").isNotNull()
    )
    cleaned = labeled.withColumn(
        "Review_Text_Clean",
        text.clean_text(text.strip_support_note(F.col("Review_Text")), dictionary),
    ).withColumn("_worded", ~text.is_blank(F.col("Review_Text_Clean")))
    firsts = first_per_key(cleaned, ["Review_Text_Clean", "label"], F.col(order))
    return _segmented(firsts.where("_worded").drop("_worded"), segmenter).withColumns(
        {
            "Review_Text_Raw": F.col("Review_Text"),
            "Review_Text_NoNoise": text.strip_support_note(F.col("Review_Text")),
            "label_name": catalog.label_name(F.col("label")),
        }
    )


def aspect_report(
    reviews: DataFrame,
    words: AspectLexicon = AspectLexicon(),
    dictionary: Mapping[str, str] | None = lexicon.SHORTHAND,
) -> DataFrame:
    """One nested document per product."""
    return aspect_documents(aspect_summary(reviews, words, dictionary))


def elasticity_report(products: DataFrame) -> DataFrame:
    """One nested document per brand."""
    return elasticity_documents(price_elasticity(products))


def statistics_report(
    products: DataFrame, reviews: DataFrame, aspect_scores: DataFrame, columns: Sequence[str] = lexicon.COMMERCIAL_COLUMNS
) -> DataFrame:
    """All dataset statistics in the long form."""
    review_counts = profile.review_counts(reviews).withColumn("scope", F.lit("all"))
    return profile.union_all(
        [
            profile.report_rows("brands", profile.value_counts(products, "Brand"), "value", ["n"]),
            profile.report_rows(
                "products", profile.column_profile(products, columns), "column",
                ["min", "max", "mean", "median", "missing"],
            ),
            profile.report_rows("stars", profile.value_counts(reviews, "Star_Rating", True), "value", ["n"]),
            profile.report_rows(
                "reviews", review_counts, "scope",
                ["max_helpful", "mean_helpful", "nonzero_helpful", "support_contacted", "blank_text"],
            ),
            profile.report_rows("aspects", aspect_coverage(aspect_scores), "Aspect", ["products", "mean_score"]),
            profile.report_rows(
                "elasticity", price_elasticity(products), "Brand",
                ["Product_Count", "Price_Elasticity", "Model_R2", "Average_Sales_Volume"],
            ),
        ]
    )
