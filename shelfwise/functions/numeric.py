"""Column expressions that turn scraped text into numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings of "no value" and of the two magnitudes.
MISSING_WORDS = ["", "nan", "none", "unknown"]
MILLION_WORDS = r"triệu|trieu|\p{Nd}\s*m($|[^\p{L}\p{N}_])"
THOUSAND_WORDS = r"nghìn|ngan|\p{Nd}\s*k($|[^\p{L}\p{N}_])"


def coerce_double(col: Column) -> Column:
    """Number or NULL; NaN and literals such as ``1d`` count as missing."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value) & ~col.cast("string").rlike(r"[0-9.][dDfF]$"), value)


def number_text(col: Column) -> Column:
    return F.lower(F.trim(col.cast("string")))


def number_body(text: Column) -> Column:
    """Digits and marks only, with at most one minus in front."""
    return F.regexp_replace(F.regexp_replace(text, r"[^0-9.,-]", ""), r"^-+", "-")


def read_number(text: Column, body: Column) -> Column:
    scale = (
        F.when(text.rlike(MILLION_WORDS), 1_000_000.0)
        .when(text.rlike(THOUSAND_WORDS), 1_000.0)
        .otherwise(1.0)
    )
    has_dot, has_comma = body.contains("."), body.contains(",")
    comma_is_decimal = body.rlike(r",[^.]*$")
    grouped = body.rlike(r"[.,].*[.,]|^-?[^-].+[.,].{3}$")
    plain = (
        F.when(
            has_dot & has_comma & comma_is_decimal,
            F.translate(F.translate(body, ".", ""), ",", "."),
        )
        .when(has_dot & has_comma, F.translate(body, ",", ""))
        .when(grouped, F.translate(body, ".,", ""))
        .otherwise(F.translate(body, ",", "."))
    )
    return F.when(~text.isin(MISSING_WORDS), plain.try_cast("double") * scale)


def parse_number(col: Column) -> Column:
    """A number as shops write it: either decimal mark, words, k and m."""
    text = number_text(col)
    return read_number(text, number_body(text))


def digits(col: Column) -> Column:
    return F.regexp_replace(F.coalesce(col, F.lit("")), r"[^\p{Nd}]", "")


def parse_compact_count(col: Column) -> Column:
    """Counter text such as ``243,4k`` as a string of digits."""
    text = F.lower(F.trim(F.coalesce(col, F.lit(""))))
    pattern = r"([0-9]+(?:[.,][0-9]+)?)\s*([km])?"
    number = F.translate(F.regexp_extract(text, pattern, 1), ",", ".")
    suffix = F.regexp_extract(text, pattern, 2)
    factor = F.when(suffix == "k", 1_000.0).when(suffix == "m", 1_000_000.0)
    scaled = (number.try_cast("double") * factor).try_cast("bigint").cast("string")
    return F.when(factor.isNull(), digits(number)).otherwise(scaled)


def discount_rate(original: Column, discounted: Column) -> Column:
    rate = F.try_divide(original - discounted, original)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(rate, F.lit(0.0))))
