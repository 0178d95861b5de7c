"""Models: determinism, exact statistics, and better than the baseline."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.operators import forecast, segments, sentiment
from shelfwise.operators.folds import kfold


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.3, (30, 2)) for c in (0, 4, 9)])
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(x)], "id int, x array<double>")
    return x, df.select("id", array_to_vector("x").alias("scaled")).cache()


def brute_silhouette(x, labels):
    gap = ((x[:, None] - x[None]) ** 2).sum(2)
    out = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = gap[i][same].sum() / (same.sum() - 1)
        b = min(gap[i][labels == k].mean() for k in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_clusters_and_silhouette(points):
    x, df = points
    scores, models = segments.k_scores(df, [2, 3, 4], restarts=3)
    assert segments.best_k(scores).first()["k"] == 3
    labels = np.array([r.cluster_id for r in models[3].transform(df).orderBy("id").collect()])
    assert segments.silhouette(models[3].transform(df)) == pytest.approx(brute_silhouette(x, labels))


def test_standardize_and_coordinates(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 3)) * [1, 5, 20]
    df = spark.createDataFrame([(i, *map(float, r), 2.0) for i, r in enumerate(x)], "id int, a double, b double, c double, k double")
    scaled = segments.standardize(df, ["a", "k"]).orderBy("id").collect()
    assert np.allclose([r.a_z for r in scaled], (x[:, 0] - x[:, 0].mean()) / x[:, 0].std())
    assert {r.k_z for r in scaled} == {0.0}
    placed = segments.with_coordinates(segments.with_vector(df, ["a", "b", "c"])).orderBy("id").collect()
    z = (x - x.mean(0)) / x.std(0)
    _, axes = np.linalg.eigh(z.T @ z)
    axis = axes[:, -1] * np.sign(axes[np.abs(axes[:, -1]).argmax(), -1])
    assert np.allclose([r.PC1 for r in placed], z @ axis)


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(120):
        rate = float(rng.uniform(0, 0.5))
        rows.append((str(i), f"b{i % 4}", 100.0, 100 * (1 - rate), 50 + 200 * rate + float(rng.normal(0, 3)), 4.0, rate))
    df = spark.createDataFrame(rows, "Product_ID string, Brand string, Original_Price double, Discounted_Price double, Sales_Volume double, Avg_Star_Rating double, Discount_Rate double")
    return forecast.training_rows(forecast.forecast_dataset(df))


SMALL = forecast.BoostParams(n_estimators=8, max_depth=3, learning_rate=0.3)


def test_forecast_beats_the_mean(training):
    found = {r.method: r for r in forecast.compare_forecasts(training, SMALL, trees=10, default=SMALL).collect()}
    assert len(found) == 6
    assert found["linear"].rmse < found["baseline"].rmse and found["boosted"].rmse < found["baseline"].rmse


def test_baseline_predictions(training):
    rows = [(r.fold, r.target) for r in training.collect()]
    for r in forecast.baseline_predictions(training).collect():
        others = [t for f, t in rows if f != r.fold]
        assert r.prediction == pytest.approx(sum(others) / len(others))


def test_tuning_is_repeatable(training):
    ranges = {"n_estimators": (2, 4), "max_depth": (2, 3)}
    assert forecast.random_params(3, search=ranges) == forecast.random_params(3, search=ranges)
    scores, best = forecast.tune_forecast(training, 2, search=ranges)
    rows = scores.collect()
    first = min(rows, key=lambda r: r.rmse)
    assert first.chosen and first.trees == best.n_estimators <= first.n_estimators and first.reg_lambda == best.reg_lambda
    assert set(forecast.SEARCH) == {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample", "reg_lambda"}


def test_seven_days(spark, training):
    model = forecast.train_forecast(training, SMALL)
    asked = spark.createDataFrame([("p", 80.0, 0.2, 0.5), ("bad", -1.0, 0.2, 0.5)], "product_id string, current_price double, discount_rate double, sentiment_score_yesterday double")
    rows = forecast.forecast_days(asked, model, "2024-04-28").orderBy("date").collect()
    assert [str(r.date) for r in rows] == [f"2024-{d}" for d in ("04-29", "04-30", "05-01", "05-02", "05-03", "05-04", "05-05")]
    lag, expected = 0.0, []
    for r in rows:
        day = r.date
        one = {
            "Discounted_Price": 80.0, "Discount_Rate": 0.2, "Avg_Star_Rating": 4.0, "Sentiment_Score": 0.5,
            "Day_of_Week": float(day.weekday()), "Is_Weekend": float(day.weekday() >= 5),
            "Is_Holiday": float(day.strftime("%m-%d") in lexicon.HOLIDAYS), "Sales_Volume_7d_mean": lag,
        }
        lag = max(0.0, model.transform(spark.createDataFrame([one])).first().prediction)
        expected.append(lag)
    assert [r.predicted_volume for r in rows] == pytest.approx(expected, abs=0.006)
    assert rows[0].trend == "flat"


@pytest.fixture(scope="module")
def texts(spark):
    rows = []
    for i in range(90):
        word = ["tệ kém", "bình thường", "tốt đẹp"][i % 3]
        rows.append((str(i), f"máy {word} số {i % 7}", i % 3, float(1 + i % 2)))
    return spark.createDataFrame(rows, "key string, clean string, label int, review_weight double")


def test_tfidf_matches_its_formula(texts):
    docs = sentiment.with_terms(texts)
    model = sentiment.fit_tfidf(docs)
    idf = {r.term: r.idf for r in sentiment.smooth_idf(docs, F.col("terms"), 2).collect()}
    place = {t: model.stages[0].indexOf(t) for t in idf}
    assert len(set(place.values())) == len(idf)
    row = model.transform(docs).first()
    raw = {t: row.terms.count(t) * idf[t] for t in set(row.terms) if t in idf}
    norm = sum(v * v for v in raw.values()) ** 0.5
    found = {int(i): v for i, v in zip(row.tfidf.indices, row.tfidf.values) if v}
    assert found == pytest.approx({place[t]: v / norm for t, v in raw.items()})


def test_sentiment_training_and_scoring(spark, texts):
    synthetic = spark.createDataFrame([("không tốt", 0), ("  ", 2)], "text string, label int")
    model, metrics = sentiment.train_sentiment(texts, synthetic, max_iter=20)
    assert {(m.metric, m.key): m.value for m in metrics.collect()}["accuracy", "all"] > 0.9
    asked = spark.createDataFrame([("p", "Máy TỐT đẹp || note"), ("p", " \t")], "Product_ID string, Review_Text string")
    rows = sentiment.score_sentiment(asked, model).collect()
    assert len(rows) == 1 and rows[0].label_name == "positive" and rows[0].cleaned_text == "máy tốt đẹp"
    assert sum(rows[0].probabilities.values()) == pytest.approx(1.0)
    assert rows[0].confidence == max(rows[0].probabilities.values())


def test_penalty_is_selected_by_macro_f1(spark, texts):
    synthetic = spark.createDataFrame([("không tốt", 0)], "text string, label int")
    _, metrics = sentiment.train_sentiment(texts, synthetic, max_iter=10, penalties=(50.0, 0.01))
    found = {(m.metric, m.key): m.value for m in metrics.collect()}
    scores = {p: found["selection_f1", f"{p:g}"] for p in (50.0, 0.01)}
    assert found["penalty", "chosen"] == max(scores, key=lambda p: (scores[p], p)) and scores[0.01] > 0.9


def test_segments_reach_the_model(spark, texts, tmp_path):
    """The phrases that training finds are joined in scoring as well; a saved model reads the same."""
    rows = texts.unionByName(texts).unionByName(texts)
    model = sentiment.fit_sentiment(rows.select("clean", "label"), 10)
    phrases = model.stages[0].getOrDefault("phrases")
    assert {"tệ kém", "tốt đẹp"} <= set(phrases)
    words, joined = "máy tốt đẹp số".split(), []
    while words:
        n = 2 if " ".join(words[:2]) in phrases else 1
        joined.append("_".join(words[:n]))
        words = words[n:]
    shown = model.transform(spark.createDataFrame([("máy tốt đẹp số",)], "clean string")).first()
    assert shown.segmented == " ".join(joined) and "_" in shown.segmented and set(joined) <= set(shown.terms)
    model.write().overwrite().save(str(tmp_path / "model"))
    asked = spark.createDataFrame([(f"máy {w} số 1",) for w in ["tốt đẹp", "tệ kém", "bình thường", "đẹp tốt"]], "Review_Text string")
    before, after = (sentiment.score_sentiment(asked, m).collect() for m in (model, PipelineModel.load(str(tmp_path / "model"))))
    assert before == after and [r.label for r in before][:3] == [2, 0, 1]


def test_no_row_calibrates_a_model_that_saw_it(spark):
    """With a model that knows its own rows by heart, calibration on them would be sure of everything."""
    rows = spark.createDataFrame([(i, i % 2, 1.0, i % 3) for i in range(60)], "id int, label int, weight double, part int")

    class Memory:
        def fit(self, df):
            known = {r.id for r in df.collect()}
            self.transform = lambda rows: rows.withColumn("raw_svm", array_to_vector(F.array(F.when(F.col("id").isin(known), F.col("label") * 2.0 - 1).otherwise(0.0))))
            return self

    margins = sentiment.out_of_fold_margins(rows, "id", 5, svm=lambda max_iter, features: Memory()).collect()
    assert len(margins) == 60 and {m.margin[0] for m in margins} == {0.0}


def test_compare_classifiers(texts):
    two = texts.where("label <> 1").withColumn("label", (F.col("label") / 2).cast("int"))
    found = {r.method: r for r in sentiment.compare_classifiers(two, folds=2, max_iter=5, trees=5).collect()}
    assert len(found) == 8 and found["logistic"].accuracy > found["majority"].accuracy


def test_texts_are_taken_apart_once_for_all_folds(spark, texts, monkeypatch):
    """However many folds there are, characters are taken twice: for the terms to list and for the counts."""
    calls, plain = [], sentiment.text.char_ngrams
    monkeypatch.setattr(sentiment.text, "char_ngrams", lambda *a, **more: calls.append(1) or plain(*a, **more))
    monkeypatch.setattr(sentiment, "fold_predictions", lambda *a, **more: [])
    two = texts.where("label <> 1").withColumn("label", (F.col("label") / 2).cast("int"))
    sentiment.compare_classifiers(two, folds=4, max_iter=2, trees=2).collect()
    assert len(calls) == 2


def test_totals_list_the_terms_that_a_vocabulary_has(spark, texts):
    docs = texts.select((F.col("key").cast("int") % 3).alias("fold"), F.split("clean", " ").alias("terms"))
    docs = docs.unionByName(spark.createDataFrame([(0, ["rare", "rare", "rare"]), (1, [])], docs.schema))
    totals = sentiment.term_totals(docs, F.col("terms"), "fold").where("fold <> 2")
    one = docs.where("fold <> 2").select("terms")
    found = {r.term: (r.n, r.df) for r in totals.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")).collect()}
    lists = [r.terms for r in one.collect()]
    assert found == {t: (sum(x.count(t) for x in lists), sum(t in x for x in lists)) for x in lists for t in x}
    vocabulary = CountVectorizer(inputCol="terms", outputCol="tf", minDF=3.0, vocabSize=4).fit(one).vocabulary
    listed = sentiment.frequent_terms(totals, 3, 4)
    assert [found[t][0] for t in listed] == [found[t][0] for t in vocabulary] and "rare" not in listed


def test_model_is_fitted_on_stored_counts(spark, texts, monkeypatch):
    """Terms, several times longer than their texts, are never stored."""
    stored, plain = [], sentiment.stage
    monkeypatch.setattr(sentiment, "stage", lambda df, *a, **more: stored.extend(df.columns) or plain(df, *a, **more))
    sentiment.fit_sentiment(texts.select("clean", "label"), 5)
    assert "terms" not in stored and "tfidf_tf" in stored


def test_folds_do_not_depend_on_order(texts):
    one = kfold(texts, "key").select("key", "fold")
    two = kfold(texts.orderBy(F.desc("key")).repartition(3), "key").select("key", "fold")
    assert one.exceptAll(two).count() == 0


def test_starts_settle_in_shared_passes_as_mllib_settles_each(spark):
    rng = np.random.default_rng(5)
    rows = [((rng.normal(0, 0.8, 2) + c).tolist(),) for c in ([0, 0], [3, 1], [1, 4]) for _ in range(60)]
    df = spark.createDataFrame(rows, "x array<double>").select(array_to_vector("x").alias("scaled")).repartition(3).persist()
    asked = [(k, seed) for k in (2, 4) for seed in (42, 43)]
    starts = [segments.Start(k, seed, np.array(segments._kmeans(k, seed, 0).fit(df).clusterCenters())) for k, seed in asked]
    segments.settle(df, starts)
    for start, (k, seed) in zip(starts, asked):
        own = segments._kmeans(k, seed).fit(df)
        assert np.isclose(start.cost, own.summary.trainingCost, rtol=1e-9)
        assert np.allclose(start.centres, own.clusterCenters(), atol=1e-9)
