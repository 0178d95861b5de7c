"""Exact ranks, medians and tops, with one value holding a third of the rows."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from shelfwise.functions import ranking, selection
from shelfwise.operators import folds


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    rows = [(i, 7.0 if i % 3 == 0 else float(rng.randint(0, 400)), "hot" if i % 3 == 0 else f"g{i % 40}") for i in range(6000)]
    return rows, spark.createDataFrame(rows, "id long, v double, g string").repartition(6).cache()


def test_exact_medians(spark, skewed):
    rows, df = skewed
    gaps = df.withColumn("w", F.when(F.col("id") % 2 == 0, F.col("v") * 3 + F.col("id") / 7))
    found = {r["column"]: r for r in ranking.exact_medians(gaps, ["v", "w"], accuracy=50).collect()}
    assert found["v"]["median"] == statistics.median(v for _, v, _ in rows)
    w = [v * 3 + i / 7 for i, v, _ in rows if i % 2 == 0]
    assert found["w"]["median"] == pytest.approx(statistics.median(w)) and found["w"]["n"] == len(w)


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert ranking.exact_medians(df, ["v"]).first()["median"] is None


def test_global_rank(skewed):
    rows, df = skewed
    ranked = ranking.global_rank(df, F.desc("v"), F.asc("id")).collect()
    order = [i for i, _, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert [r["id"] for r in sorted(ranked, key=lambda r: r["rank"])] == order
    assert sorted(r["rank"] for r in ranked) == list(range(1, len(rows) + 1))


def test_first_rows(skewed):
    rows, df = skewed
    found = {(r["g"], r["position"]): r["id"] for r in ranking.first_rows(df, ["g"], ["v", "id"], 5).collect()}
    groups = {}
    for i, v, g in sorted(rows, key=lambda r: (r[1], r[0])):
        groups.setdefault(g, []).append(i)
    assert found == {(g, n + 1): i for g, ids in groups.items() for n, i in enumerate(ids[:5])}


def test_first_per_key(skewed):
    rows, df = skewed
    found = {r["g"]: r["id"] for r in ranking.first_per_key(df, ["g"], F.col("id")).collect()}
    first = {}
    for i, _, g in rows:
        first.setdefault(g, i)
    assert found == first


def test_folds_partition_the_rows(skewed):
    rows, df = skewed
    sizes = [r["count"] for r in folds.kfold(df, "id", 7).groupBy("fold").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    strata = folds.stratified_kfold(df, "id", "g", 5).groupBy("g", "fold").count()
    spread = strata.groupBy("g").agg((F.max("count") - F.min("count")).alias("d")).agg(F.max("d")).first()[0]
    assert spread <= 1


def test_stratified_split(skewed):
    rows, df = skewed
    split = folds.stratified_split(df, "id", "g")
    per = {r["g"]: (r["t"], r["n"]) for r in split.groupBy("g").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n")).collect()}
    assert all(abs(t - 0.15 * n) <= 0.5 for t, n in per.values())


@pytest.mark.parametrize("n", [1, 3, 5, 23, 400])
def test_even_tiles(spark, n):
    """As ntile over all rows, with long ties at the cuts, for keys of text and of whole numbers."""
    rows = [(f"k{i * 7919 % 1000}", i * 7919 % 1000 - 500, float(i % 4), i * 31 % 17 if i % 5 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "key string, number long, v double, w int")
    for key in ["key", "number"]:
        found = selection.even_tiles(df, {"a": F.col("v"), "b": -F.col("v"), "c": F.col("w")}, key, 5)
        df.createOrReplaceTempView("tiled")
        sql = f"ntile(5) OVER (ORDER BY v, {key}) AS a, ntile(5) OVER (ORDER BY -v, {key}) AS b, ntile(5) OVER (ORDER BY w NULLS FIRST, {key}) AS c"
        expected = spark.sql(f"SELECT *, {sql} FROM tiled")
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_order_statistics(spark):
    rng = random.Random(9)
    odd = [float("-inf")] * 3 + [float("inf")] * 5 + [float("nan")] * 2 + [1e308, -1e308, 5e-324, -5e-324, 0.0, -0.0]
    values = odd + [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1) * 10.0 ** rng.randint(-300, 300), 7.0, float(rng.randint(0, 9))]) for _ in range(3000)]
    rng.shuffle(values)
    df = spark.createDataFrame([(v, None if i % 3 else v) for i, v in enumerate(values)], "v double, w double").repartition(5)
    for accuracy in [20, 100_000]:
        found, counts = selection.order_statistics(df, {"v": lambda n: list(range(1, n + 1, 97)) + [n], "w": lambda n: [1, n]}, accuracy)
        ordered = sorted(values, key=lambda v: (math.isnan(v), v))
        for p in found["v"]:
            assert str(p.low + 0.0) == str(ordered[p.place - 1] + 0.0) and p.below < p.place <= p.below + p.ties
            assert p.below == sum(v < p.low for v in values) or math.isnan(p.low)
        assert counts == {"v": len(values), "w": len(values[::3])} and [p.place for p in found["w"]] == [1, counts["w"]]
    assert selection.order_statistics(df.limit(0), {"v": selection.middle})[0] == {"v": []}


def test_median_of_many_different_values(spark, monkeypatch):
    """The driver gets a bounded number of rows a pass, and nothing is sorted."""
    n, passes = 10_000_000, []
    collect = DataFrame.collect

    def counted(df):
        assert "Window" not in df._jdf.queryExecution().toString()
        passes.append(len(rows := collect(df)))
        return rows

    monkeypatch.setattr(DataFrame, "collect", counted)
    df = spark.range(n).select(((F.col("id") * 7919) % 10_000_019 / 7).alias("v"))
    assert ranking.medians(df, ["v"]) == {"v": float(np.median(np.arange(n) * 7919 % 10_000_019 / 7))}
    assert max(passes) <= 2 * (selection.STEPS + 4)


def test_rows_without_group_or_key_stay(spark):
    rows = [(i if i % 5 else None, "a" if i % 3 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, g string")
    dealt = folds.stratified_kfold(df, "id", "g", 4)
    assert dealt.count() == 40 and folds.stratified_split(df, "id", "g").count() == 40
    sizes = {r["g"]: r["n"] for r in dealt.groupBy("g", "fold").count().groupBy("g").agg((F.max("count") - F.min("count")).alias("n")).collect()}
    assert set(sizes) == {"a", None} and max(sizes.values()) <= 1
    assert sorted(r["r"] for r in ranking.hashed_rank(df, F.col("id"), name="r").collect()) == list(range(1, 41))
