"""Sales forecast: features, boosted trees, validation, seven-day series."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import astuple, replace

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise import lexicon
from shelfwise.functions import catalog
from shelfwise.functions.numeric import coerce_double
from shelfwise.operators.boosting import BoostedModel, Booster, BoostParams, Fit, fit_boosted, search_boosted
from shelfwise.operators.cleaning import present
from shelfwise.operators.evaluate import regression_metrics
from shelfwise.operators.folds import fold_count, kfold
from shelfwise.operators.joins import horizon, left_join_sentiment
from shelfwise.operators.profile import union_all
from shelfwise.session import stage
from shelfwise.sources.readers import require_columns, require_rows


def with_loo_mean(
    df: DataFrame,
    value: str = "Sales_Volume",
    group: str = "Brand",
    name: str = "Sales_Volume_7d_mean",
) -> DataFrame:
    """Mean of the other rows of the group; the overall mean where there are none.

    Group totals are aggregated first and joined back, so a group with a large
    part of the rows is not gathered in one task.
    """
    df = df.withColumn("_value", coerce_double(F.col(value)))
    if not present(df, [group]):
        return df.withColumn(name, df.agg(F.avg("_value")).scalar()).drop("_value")
    sums = df.groupBy(group).agg(F.sum("_value").alias("_sum"), F.count("_value").alias("_n"))
    totals = stage(sums, "group_totals")
    overall = totals.agg(F.sum("_sum") / F.sum("_n")).scalar()
    others = F.try_divide(F.col("_sum") - F.col("_value"), F.col("_n") - 1)
    return (
        df.join(totals, group, "left")
        .withColumn(name, F.coalesce(others, overall))
        .drop("_value", "_sum", "_n")
    )


def forecast_dataset(products: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """Eight features and the sales target, one row per product with sales."""
    require_columns(products, ["Sales_Volume"])
    df = with_loo_mean(left_join_sentiment(products, scored))
    df = df.withColumn("target", coerce_double(F.col("Sales_Volume")))
    if present(df, ["Inward_Date"]):
        days = catalog.calendar(catalog.read_date(F.col("Inward_Date")))
    else:
        days = {c: F.lit(0) for c in ["Day_of_Week", "Is_Weekend", "Is_Holiday"]}
    df = df.withColumns(days)
    features = present(df, lexicon.FORECAST_FEATURES)
    return df.withColumns({c: coerce_double(F.col(c)) for c in features}).where(
        F.col("target").isNotNull()
    )


# The search ranges.
SEARCH = {
    "n_estimators": (50, 300),
    "max_depth": (2, 6),
    "learning_rate": (0.01, 0.2),
    "subsample": (0.7, 1.0),
    "colsample": (0.7, 1.0),
    "reg_lambda": (0.1, 10.0),
}


def random_params(trials: int, seed: int = 42, search: dict | None = None) -> list[BoostParams]:
    """Seeded draws from the ranges; the learning rate and the penalty on a log scale."""
    ranges, draw = {**SEARCH, **(search or {})}, random.Random(seed)
    return [
        BoostParams(
            n_estimators=draw.randint(*ranges["n_estimators"]),
            max_depth=draw.randint(*ranges["max_depth"]),
            learning_rate=math.exp(draw.uniform(*map(math.log, ranges["learning_rate"]))),
            subsample=draw.uniform(*ranges["subsample"]),
            colsample=draw.uniform(*ranges["colsample"]),
            reg_lambda=math.exp(draw.uniform(*map(math.log, ranges["reg_lambda"]))),
        )
        for _ in range(trials)
    ]


def on_features(estimator: Estimator, features: Sequence[str] = lexicon.FORECAST_FEATURES) -> Pipeline:
    """The features as one vector in their order, then the estimator."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), estimator])


def training_rows(dataset: DataFrame, key: str = "Product_ID", folds: int | None = None) -> DataFrame:
    """Gap-free features, target and fold, staged once for all fits."""
    features = present(dataset, lexicon.FORECAST_FEATURES)
    filled = stage(dataset.select(key, "target", *features).na.fill(0.0, features), "dataset")
    require_rows(filled, 5)
    k = folds or fold_count(filled.limit(5).count())
    return stage(kfold(filled, key, k), "training", even=True)


def row_key(rows: DataFrame) -> str:
    """The column that names a row: what is no feature, target or fold."""
    return next(c for c in rows.columns if c not in {*lexicon.FORECAST_FEATURES, "target", "fold"})


def used(rows: DataFrame, features: Sequence[str] = lexicon.FORECAST_FEATURES) -> list[str]:
    return present(rows, features)


def train_forecast(rows: DataFrame, params: BoostParams = BoostParams()) -> BoostedModel:
    return fit_boosted(rows, used(rows), [params], row_key(rows))[0]


def tune_forecast(
    rows: DataFrame, trials: int = 40, seed: int = 42, search: dict | None = None
) -> tuple[DataFrame, BoostParams]:
    """Fold error of every drawn parameter set, and the best set with the number of trees where it was least.

    ``trees`` is where a set was judged (see ``boosting.search_boosted``), ``grown`` how far it came; ``rmse`` is its mean
    over the folds there.
    """
    drawn = random_params(trials, seed, search)
    found, best = search_boosted(rows, used(rows), drawn, row_key(rows))
    scored = [(t.number, *astuple(t.params), t.best()[1], len(t.fits[0].trees), t.best()[0], t is best) for t in found]
    schema = (
        "trial int, n_estimators int, max_depth int, learning_rate double, subsample double, colsample double, "
        "reg_lambda double, trees int, grown int, rmse double, chosen boolean"
    )
    return rows.sparkSession.createDataFrame(scored, schema), replace(best.params, n_estimators=best.best()[1])


def fold_predictions(rows: DataFrame, pipeline: Pipeline) -> DataFrame:
    """Each row predicted by a model that has not seen its fold."""
    folds = rows.agg(F.max("fold")).first()[0] + 1
    return union_all(
        [
            pipeline.fit(rows.where(F.col("fold") != f))
            .transform(rows.where(F.col("fold") == f))
            .select("fold", "target", "prediction")
            for f in range(folds)
        ]
    )


def boosted_predictions(rows: DataFrame, sets: Sequence[tuple[str, BoostParams, Sequence[str]]]) -> DataFrame:
    """``method, fold, target, prediction``: each row by models that have not seen its fold.

    The models of all sets (name, parameters, features) and folds grow in the same passes.
    """
    features = used(rows)
    booster = Booster(rows, features, row_key(rows))
    at = {c: i for i, c in enumerate(features)}
    fits = [
        (name, Fit(params, fold, columns=tuple(at[c] for c in chosen if c in at)))
        for name, params, chosen in sets
        for fold in sorted(booster.folds)
    ]
    booster.start([f for _, f in fits])
    booster.grow([f for _, f in fits], max(f.params.n_estimators for _, f in fits))
    booster.close()
    return union_all(
        [
            booster.model(fit).transform(rows.where(F.col("fold") == fit.fold)).select(F.lit(name).alias("method"), "fold", "target", "prediction")
            for name, fit in fits
        ]
    )


def cv_metrics(rows: DataFrame, params: BoostParams = BoostParams()) -> DataFrame:
    return regression_metrics(boosted_predictions(rows, [("boosted", params, lexicon.FORECAST_FEATURES)]))


def baseline_predictions(rows: DataFrame) -> DataFrame:
    """The mean target of the other folds, from sums per fold."""
    per_fold = rows.groupBy("fold").agg(F.sum("target").alias("s"), F.count("target").alias("n"))
    every = Window.partitionBy()  # over one row per fold
    means = per_fold.select(
        "fold",
        ((F.sum("s").over(every) - F.col("s")) / (F.sum("n").over(every) - F.col("n"))).alias("prediction"),
    )
    return rows.select("fold", "target").join(F.broadcast(means), "fold")


def compare_forecasts(
    rows: DataFrame, tuned: BoostParams, trees: int = 300, default: BoostParams = BoostParams()
) -> DataFrame:
    """Mean fold metrics of six methods on the same folds."""
    without = [f for f in lexicon.FORECAST_FEATURES if f != "Sentiment_Score"]
    fitted: dict[str, Callable[[], DataFrame]] = {
        "baseline": lambda: baseline_predictions(rows),
        "linear": lambda: fold_predictions(rows, on_features(LinearRegression(labelCol="target"))),
        "forest": lambda: fold_predictions(
            rows, on_features(RandomForestRegressor(labelCol="target", numTrees=trees, seed=42))
        ),
    }
    boosted = [
        ("boosted", default, lexicon.FORECAST_FEATURES),
        ("boosted_tuned", tuned, lexicon.FORECAST_FEATURES),
        ("boosted_tuned_no_sentiment", tuned, without),
    ]
    scored = union_all(
        [predict().select(F.lit(name).alias("method"), "fold", "target", "prediction") for name, predict in fitted.items()]
        + [boosted_predictions(rows, boosted)]
    )
    return (
        regression_metrics(scored, ["method", "fold"])
        .groupBy("method")
        .agg(*[F.avg(m).alias(m) for m in ["rmse", "mae", "r2"]])
    )


def trend(current, previous):
    return (
        F.when(previous.isNull(), "flat").when(current > previous, "up").otherwise("down")
    )


def trend_flags(predictions: DataFrame, keys: Sequence[str] = ("request_id",)) -> DataFrame:
    """Up or down against the previous date of the request; the first is flat."""
    before = F.lag("predicted_volume").over(Window.partitionBy(*keys).orderBy("date"))
    return predictions.withColumn("trend", trend(F.col("predicted_volume"), before))


# Fixed value: the rating a forecast request is scored with.
REQUEST_RATING = 4.0


def request_features(requests: DataFrame) -> DataFrame:
    return requests.select(
        "product_id",
        F.col("current_price").alias("Discounted_Price"),
        F.col("discount_rate").alias("Discount_Rate"),
        F.lit(REQUEST_RATING).alias("Avg_Star_Rating"),
        F.col("sentiment_score_yesterday").alias("Sentiment_Score"),
    )


def valid_requests(requests: DataFrame) -> DataFrame:
    return requests.where(
        (F.col("current_price") > 0)
        & F.col("discount_rate").between(0, 1)
        & F.col("sentiment_score_yesterday").between(0, 1)
    )


def forecast_horizon(requests: DataFrame, start: str, days: int = 7) -> DataFrame:
    """Request rows for every following day, with the calendar features."""
    return horizon(request_features(requests), start, days).withColumns(
        catalog.calendar(F.col("date"))
    )


def forecast_days(
    requests: DataFrame, model: BoostedModel | PipelineModel, start: str, days: int = 7
) -> DataFrame:
    """Day by day, all requests at once; each prediction is the next day's lag."""
    state = request_features(valid_requests(requests)).withColumn("Sales_Volume_7d_mean", F.lit(0.0))
    shown = []
    for day in range(1, days + 1):
        date = F.date_add(F.to_date(F.lit(start)), day)
        scored = model.transform(state.withColumns(catalog.calendar(date)))
        volume = F.greatest(F.lit(0.0), F.col("prediction"))
        state = scored.withColumns({f"day_{day}": volume, "Sales_Volume_7d_mean": volume}).drop(
            "features", "prediction"
        )
        previous = F.col(f"day_{day - 1}") if day > 1 else F.lit(None).cast("double")
        shown.append(
            F.struct(
                date.alias("date"),
                F.bround(F.col(f"day_{day}"), 2).alias("predicted_volume"),
                trend(F.col(f"day_{day}"), previous).alias("trend"),
            )
        )
    return state.select("product_id", F.explode(F.array(*shown)).alias("f")).select(
        "product_id", "f.date", "f.predicted_volume", "f.trend"
    )
