"""Order statistics of any number of columns at once, exact at any size.

Sketches bound every wanted place from both sides.  Between the bounds values are counted in equal
steps, the step that holds the place becomes the next pair of bounds, and so on until they meet: a
search by the leading digits of the value, a dozen bits at a time.  No values are ranked or gathered; a
pass returns one row a step, however large the table.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Steps between a pair of bounds, and what sketches are accurate to.
STEPS, ACCURACY = 4096, 100_000
INFINITE = float("inf")
#: The largest finite number.
LARGEST = sys.float_info.max


@dataclass
class Place:
    """A place (from 1) of a column in ascending order, NULLs left out: its value lies in ``low`` to ``high``.

    ``below`` counts the values under ``low``; in the end it is what comes before the value, and ``ties``
    how often the value occurs.
    """

    column: str
    place: int
    low: float
    high: float
    below: int = 0
    ties: int = 0

    @property
    def found(self) -> bool:
        return self.low == self.high or math.isnan(self.low)

    def step_of(self, value: Column) -> Column:
        """Step between the bounds; infinities and NaN have steps of their own at the ends."""
        ends = [max(-LARGEST, min(LARGEST, x)) if not math.isnan(x) else LARGEST for x in (self.low, self.high)]
        part = 1.0 if ends[1] - ends[0] < INFINITE else 0.5  # halves, where the difference overflows
        low, width = ends[0] * part, ends[1] * part - ends[0] * part
        inside = F.floor((value * part - F.lit(low)) / F.lit(width) * STEPS) if width else F.lit(0)
        return F.when(F.isnan(value), STEPS + 2).when(value == INFINITE, STEPS + 1).when(value == -INFINITE, -1).otherwise(inside).cast("int")


def _bounded(df: DataFrame, ranks: Mapping[str, Callable[[int], Sequence[int]]], accuracy: int) -> tuple[list[Place], dict[str, int]]:
    """Places with bounds from sketches and what lies below, and the number of values of each column."""
    whole = df.agg(*[F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in ranks]).first()
    places = [Place(c, place, whole[c].low, whole[c].high) for c, of in ranks.items() if whole[c].n for place in of(whole[c].n)]
    shares = [[min(1.0, max(0.0, p.place / whole[p.column].n + side * 2 / accuracy)) for side in (-1, 1)] for p in places]
    if places:
        near = df.agg(*[F.percentile_approx(p.column, s, F.lit(accuracy)).alias(str(i)) for i, (p, s) in enumerate(zip(places, shares))]).first()
        counted = [(F.count_if(F.col(p.column) < low), F.count_if(F.col(p.column) <= high)) for p, (low, high) in zip(places, near)]
        counts = df.agg(*[c.alias(f"{i} {j}") for i, pair in enumerate(counted) for j, c in enumerate(pair)]).first()
        for i, (p, (low, high)) in enumerate(zip(places, near)):
            below, upto = counts[2 * i], counts[2 * i + 1]
            if below < p.place <= upto:  # else the sketch was wrong, and the whole range is searched
                p.low, p.high, p.below, p.ties = low, high, below, upto - below
    return places, {c: whole[c].n for c in ranks}


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Callable[[int], Sequence[int]]], accuracy: int = ACCURACY
) -> tuple[dict[str, list[Place]], dict[str, int]]:
    """The wanted places of each column, and the number of its values that aren't NULL.

    ``ranks`` gives the places wanted among ``n`` values.  NaN comes last, as in sorting.
    """
    df = df.select(*[F.col(c).cast("double").alias(c) for c in ranks])
    places, counts = _bounded(df, ranks, accuracy)
    while True:
        searched = [(i, p) for i, p in enumerate(places) if not p.found or not p.ties]
        if not searched:
            break
        inside = [
            F.when(
                F.col(p.column).between(p.low, p.high),
                F.struct(F.lit(i).alias("i"), p.step_of(F.col(p.column)).alias("step"), F.col(p.column).alias("value")),
            )
            for i, p in searched
        ]
        steps = (
            df.select(F.explode(F.array_compact(F.array(*inside))).alias("x")).select("x.*")
            .groupBy("i", "step").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
        )
        for i, p in searched:
            for row in sorted((r for r in steps if r.i == i), key=lambda r: r.step):
                if p.below + row.n >= p.place:
                    p.low, p.high, p.ties = row.low, row.high, row.n
                    break
                p.below += row.n
    found: dict[str, list[Place]] = {c: [] for c in ranks}
    for p in places:
        found[p.column].append(p)
    return found, counts


def middle(n: int) -> list[int]:
    """The one or two places of the median."""
    return [(n + 1) // 2, n // 2 + 1]


def even_cuts(parts: int) -> Callable[[int], list[int]]:
    """The last place of each of ``parts`` even parts but the last; the first parts take the surplus."""

    def of(n: int) -> list[int]:
        base, surplus = divmod(n, parts)
        return [t * base + min(t, surplus) for t in range(1, parts) if t * base + min(t, surplus)]

    return of


def sortable_text(df: DataFrame, key: str) -> Column:
    """A key as text of the same order: itself, or the hex digits of a whole number from the least one on."""
    if dict(df.dtypes)[key] == "string":
        return F.col(key)
    return F.lpad(F.hex(F.col(key).cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def keys_at(df: DataFrame, key: str, wanted: Sequence[tuple[Column, int]], characters: int = 2) -> list[str]:
    """The key at a place (from 1) among the rows that meet a condition, for all ``wanted`` at once.

    Rows are counted by the next characters of the key; those that hold the place are looked at closer.
    """
    text, heads, left, found = F.col(key), [""] * len(wanted), [place for _, place in wanted], [None] * len(wanted)
    while None in found:
        inside = [
            F.when(of & text.startswith(head), F.struct(F.lit(i).alias("i"), F.substring(text, 1, len(head) + characters).alias("head"), text.alias("key")))
            for i, ((of, _), head) in enumerate(zip(wanted, heads)) if found[i] is None
        ]
        rows = (
            df.select(F.explode(F.array_compact(F.array(*inside))).alias("x")).select("x.*")
            .groupBy("i", "head").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        )
        for i in [i for i, k in enumerate(found) if k is None]:
            for row in sorted((r for r in rows if r.i == i), key=lambda r: r.low):
                if left[i] <= row.n:
                    heads[i], found[i] = row.head, row.low if row.low == row.high else None
                    break
                left[i] -= row.n
    return found


def even_tiles(df: DataFrame, measures: Mapping[str, Column], key: str, parts: int) -> DataFrame:
    """``df`` with a column for each measure: which of ``parts`` even tiles the row is in by ascending measure, then key.

    The cuts of all measures are selected together; keys count only for the rows that tie at a cut.  Then one
    projection places every row.  NULL measures come first.  The key must be unique.
    """
    names = {m: f"_{m}_value" for m in measures}
    valued = df.withColumns({names[m]: F.coalesce(of.cast("double"), F.lit(-INFINITE)) for m, of in measures.items()}).withColumn("_key", sortable_text(df, key))
    cuts, _ = order_statistics(valued, {c: even_cuts(parts) for c in names.values()})
    split = [(c, p) for c, places in cuts.items() for p in places if p.place - p.below < p.ties]
    keys = dict(zip([(c, p.place) for c, p in split], keys_at(valued, "_key", [(F.col(c) == p.low, p.place - p.below) for c, p in split]))) if split else {}

    def beyond(c: str, p: Place) -> Column:
        value = F.col(c) > F.lit(p.low)
        last = keys.get((c, p.place))
        return (value if last is None else value | ((F.col(c) == F.lit(p.low)) & (F.col("_key") > last))).cast("int")

    tiles = {m: sum([beyond(c, p) for p in cuts[c]], F.lit(1)) for m, c in names.items()}
    return valued.withColumns(tiles).drop("_key", *names.values())
