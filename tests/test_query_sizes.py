"""Model queries ask the operators for their full sizes."""

import inspect

import pytest

import __spark_entry__
from shelfwise.operators import forecast, segments, sentiment
from shelfwise.plans import queries_models, queries_text

QUERIES = __spark_entry__.queries()
SIZES = {"ks", "restarts", "trials", "search", "params", "default", "trees", "folds", "max_iter"}


class Called(Exception):
    pass


def sizes(monkeypatch, spark, module, operator, query):
    """Arguments about size with which the query calls the operator."""
    signature = inspect.signature(getattr(module, operator))

    def record(*args, **more):
        bound = signature.bind(*args, **more)
        raise Called({k: v for k, v in bound.arguments.items() if k in SIZES})

    monkeypatch.setattr(module, operator, record)
    with pytest.raises(Called) as found:
        QUERIES[query](spark, "/root/testdata/sf0.001")
    return found.value.args[0]


@pytest.mark.parametrize("query, module, operator, asked", [
    ("best_k", segments, "k_scores", {"ks": range(2, 10)}), ("kmeans_k_scores", segments, "k_scores", {"ks": range(2, 10)}),
    ("kmeans_segments", segments, "best_kmeans", {}), ("flow_segments", segments, "segment_products", {}),
    ("forecast_train", forecast, "train_forecast", {}), ("forecast_score_7d", forecast, "train_forecast", {}),
    ("forecast_tune", forecast, "tune_forecast", {}), ("forecast_cv_metrics", forecast, "cv_metrics", {}),
    ("sentiment_compare", sentiment, "compare_classifiers", {}), ("sentiment_train", sentiment, "train_sentiment", {}),
    ("sentiment_score", sentiment, "fit_sentiment", {}), ("sentiment_score_by_product", sentiment, "fit_sentiment", {}),
    ("stream_sentiment", sentiment, "fit_sentiment", {}),
])
def test_full_sizes(monkeypatch, spark, query, module, operator, asked):
    for name in ("labeled", "sentences"):
        for place in (queries_models, queries_text):
            monkeypatch.setattr(place, name, lambda t: t.spark.createDataFrame([("k", "a", 0)], "key string, clean string, label int"))
    monkeypatch.setattr(queries_models, "training", lambda t, folds=5: folds)
    assert sizes(monkeypatch, spark, module, operator, query) == asked


def test_compare_takes_the_tuned_parameters(monkeypatch, spark):
    best = forecast.BoostParams(n_estimators=77)
    monkeypatch.setattr(queries_models, "training", lambda t, folds=5: folds)
    monkeypatch.setattr(forecast, "tune_forecast", lambda rows: (None, best) if rows == 5 else None)
    monkeypatch.setattr(forecast, "compare_forecasts", lambda rows, tuned, **more: (_ for _ in ()).throw(Called(rows, tuned, more)))
    with pytest.raises(Called) as found:
        QUERIES["forecast_compare"](spark, "/root/testdata/sf0.001")
    assert found.value.args == (5, best, {})
