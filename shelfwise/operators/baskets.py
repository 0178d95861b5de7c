"""Frequent itemsets and cross-sell rules."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.operators.profile import first_type_per_product, union_all
from shelfwise.session import stage
from shelfwise.sources.readers import require_columns


#: Items that a whole number marks, a bit each.
BITS = 63
#: Different items up to which transactions are gathered as bits.
MOST_LISTED = 4 * BITS


def basket_bits(baskets: DataFrame, items: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A row a transaction with a bit for each of the listed items it has, and the columns that hold them, ``BITS`` each."""
    place = F.array_position(F.array(*[F.lit(item) for item in items]), F.col("Product_ID")) - 1
    firsts = range(0, len(items), BITS)
    sold = baskets.select("Transaction_ID", place.alias("_place")).select(
        "Transaction_ID",
        *[
            F.when(F.col("_place").between(first, first + BITS - 1), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_place") - first).cast("int"))).alias(f"_{first}")
            for first in firsts
        ],
    )
    marks = [f"_{first}" for first in firsts]
    return sold.groupBy("Transaction_ID").agg(*[F.coalesce(F.bit_or(m), F.lit(0).cast("long")).alias(m) for m in marks]), marks


def bit_of(marks: Sequence[str], i: int) -> Column:
    return F.shiftright(marks[i // BITS], i % BITS).bitwiseAND(1)


def basket_onehot(baskets: DataFrame, items: Sequence[str]) -> DataFrame:
    """Transactions by a listed set of items, 0 or 1; ``basket_arrays`` is the long form.

    A transaction is held as a bit an item until its columns are made, so a task holds few bytes for each.
    """
    bits, marks = basket_bits(baskets, items)
    return bits.select("Transaction_ID", *[bit_of(marks, i).cast("int").alias(item) for i, item in enumerate(items)])


def transaction_count(baskets: DataFrame) -> int:
    return baskets.agg(F.count_distinct("Transaction_ID")).first()[0]


def frequent_items(sold: DataFrame, least: int) -> DataFrame:
    """Items in at least ``least`` of the distinct (transaction, item) pairs."""
    return (
        sold.groupBy("Product_ID")
        .agg(F.count(F.lit(1)).alias("freq"))
        .where(F.col("freq") >= least)
    )


def basket_arrays(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy("Transaction_ID").agg(
        F.array_sort(F.collect_set("Product_ID")).alias("items")
    )


def few_items(baskets: DataFrame, most: int = MOST_LISTED) -> list[str] | None:
    """The different items, sorted, unless there are more than ``most``."""
    found = baskets.select("Product_ID").where(F.col("Product_ID").isNotNull()).distinct().limit(most + 1).collect()
    return sorted(r[0] for r in found) if len(found) <= most else None


def gathered_baskets(baskets: DataFrame, min_support: float) -> tuple[DataFrame, int, int]:
    """``items`` of the transactions that have frequent ones, the number of all transactions, and the least count."""
    items = few_items(baskets)
    if items:  # one shuffle, of a few bytes a transaction, however many rows it has
        bits, marks = basket_bits(baskets, items)
        whole = stage(bits, "baskets", even=True)
        n = whole.where(F.col("Transaction_ID").isNotNull()).count()
        least = max(1, math.ceil(min_support * n))
        sums = whole.agg(*[F.sum(bit_of(marks, i)).alias(f"n{i}") for i in range(len(items))]).first()
        held = [F.when(bit_of(marks, i) == 1, F.lit(item)) for i, item in enumerate(items) if sums and (sums[i] or 0) >= least]
        arrays = whole.select(F.array_compact(F.array(*held)).alias("items")) if held else whole.select(F.array().cast("array<string>").alias("items"))
        return arrays.where(F.size("items") > 0), n, least
    sold = stage(baskets.select("Transaction_ID", "Product_ID").distinct(), "sold")
    n = transaction_count(sold)
    least = max(1, math.ceil(min_support * n))
    frequent = frequent_items(sold, least).select("Product_ID")
    kept = sold.join(frequent, "Product_ID", "left_semi")
    return stage(basket_arrays(kept), "baskets", even=True), n, least


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.02) -> DataFrame:
    """Every itemset of at least the support: sorted items, count and support.

    Rare items leave before transactions are gathered, so a transaction holds
    at most as many items as are frequent, however many rows it has.  Where
    there are at most ``MOST_LISTED`` different items, it is a bit for each.
    """
    require_columns(baskets, ["Transaction_ID", "Product_ID"])
    schema = "items array<string>, freq bigint, support double"
    # The support is relative to all transactions, also those without frequent items.
    arrays, n, least = gathered_baskets(baskets, min_support)
    found = mined(arrays, least)
    if found is None:
        return baskets.sparkSession.createDataFrame([], schema)
    # Stored, as rules look up every part of an itemset in this table again.
    return stage(found.withColumn("support", F.col("freq") / F.lit(float(n))), "itemsets")


def mined(arrays: DataFrame, least: int) -> DataFrame | None:
    """Itemsets with at least ``least`` of the baskets ``items``, and this number as ``freq``; none at all is None.

    Prefixes of frequent items grow by an item a level.  A row is a prefix with what some baskets have behind it and
    the number of these, so baskets that are alike there cost one row.
    """
    rest = F.array_sort("items").alias("rest")
    behind = arrays.select(F.array().cast("array<string>").alias("items"), rest).groupBy("items", "rest").agg(F.count(F.lit(1)).alias("n"))
    levels: list[DataFrame] = []
    while True:
        each = behind.select("items", "rest", "n", F.posexplode("rest").alias("place", "item"))
        after = F.expr("slice(rest, place + 2, size(rest))")
        grown = each.select(F.concat("items", F.array("item")).alias("items"), after.alias("rest"), "n")
        grown = stage(grown.groupBy("items", "rest").agg(F.sum("n").alias("n")), f"grown_{len(levels) + 1}")
        level = stage(grown.groupBy("items").agg(F.sum("n").alias("freq")).where(F.col("freq") >= least), f"level_{len(levels) + 1}")
        if level.isEmpty():
            break
        levels.append(level)
        behind = grown.where(F.size("rest") > 0).join(level.select("items"), "items", "left_semi")
    return union_all(levels) if levels else None


def rule_arrays(
    itemsets: DataFrame, min_confidence: float = 0.3, min_lift: float = 1.2
) -> DataFrame:
    """Rules between any two parts of an itemset, both sides sorted arrays of any length.

    Right sides grow by an item a level.  A larger one never has a higher
    confidence, so only those that pass grow, by items that pass alone.  Parts
    are looked up in the itemsets; every part of a frequent itemset is frequent.
    """
    left = itemsets.select(F.col("items").alias("a"), F.col("support").alias("support_a"))

    def passing(candidates: DataFrame, level: int) -> DataFrame:
        split = candidates.withColumn("a", F.array_except("items", "c"))
        found = split.join(left, "a").withColumn("confidence", F.col("support") / F.col("support_a"))
        kept = found.where(F.col("confidence") >= min_confidence)
        return stage(kept.select("items", "support", "a", "c", "confidence"), f"rules_{level}")

    whole = itemsets.where(F.size("items") > 1).select("items", "support")
    levels = [passing(whole.withColumn("c", F.explode(F.transform("items", lambda x: F.array(x)))), 1)]
    alone = levels[0].groupBy("items").agg(F.collect_list(F.col("c")[0]).alias("more"))
    while not levels[-1].isEmpty():
        larger = levels[-1].join(alone, "items").where(F.size("c") < F.size("items") - 1)
        grown = larger.withColumn("x", F.explode("more")).where(F.col("x") > F.element_at("c", -1))
        levels.append(
            passing(grown.select("items", "support", F.concat("c", F.array("x")).alias("c")), len(levels) + 1)
        )
    rules = levels[0]
    for level in levels[1:-1]:
        rules = rules.unionByName(level)
    right = itemsets.select(F.col("items").alias("c"), F.col("support").alias("support_c"))
    lift = F.col("confidence") / F.col("support_c")
    return (
        rules.join(right, "c")
        .withColumn("lift", lift)
        .where(F.col("lift") >= min_lift)
        .select("a", "c", "support", "confidence", "lift")
    )


def joined_rules(rules: DataFrame) -> DataFrame:
    """The sides as comma-joined text, as rules are stored."""
    sides = [F.array_join("a", ",").alias("antecedent"), F.array_join("c", ",").alias("consequent")]
    return rules.select(*sides, "support", "confidence", "lift")


def association_rules(
    itemsets: DataFrame, min_confidence: float = 0.3, min_lift: float = 1.2
) -> DataFrame:
    return joined_rules(rule_arrays(itemsets, min_confidence, min_lift))


def filter_rule_types(
    rules: DataFrame, types: DataFrame, left: str = "smartphone", right: str = "accessory"
) -> DataFrame:
    """Rules (of ``rule_arrays``) with some antecedent of one type and some consequent of the other."""

    def holding(side: str, kind: str) -> DataFrame:
        items = rules.select("a", "c", F.explode(side).alias("Product_ID"))
        return items.join(types.where(F.col("Product_Type") == kind), "Product_ID", "left_semi")

    key = ["a", "c"]
    return rules.join(holding("a", left), key, "left_semi").join(holding("c", right), key, "left_semi")


def cross_sell_rules(
    baskets: DataFrame,
    min_support: float = 0.02,
    min_confidence: float = 0.3,
    min_lift: float = 1.2,
) -> DataFrame:
    rules = rule_arrays(frequent_itemsets(baskets, min_support), min_confidence, min_lift)
    if "Product_Type" in baskets.columns:
        rules = filter_rule_types(rules, first_type_per_product(baskets))
    return joined_rules(rules)
