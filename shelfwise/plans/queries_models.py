"""Queries that fit or apply models; most have no SQL form."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions import text
from shelfwise.operators import baskets, evaluate, forecast, segments, sentiment
from shelfwise.operators.boosting import fit_boosted
from shelfwise.operators.cleaning import with_discount_rate, with_specs
from shelfwise.plans import flows, sql
from shelfwise.plans.queries_relational import BASKETS_SQL, RULE_COLUMNS, TYPES_SQL
from shelfwise.plans.queries_text import labeled, sentences
from shelfwise.plans.registry import query, rounded
from shelfwise.session import stage
from shelfwise.sources.tables import ASPECTS, DICTIONARY, with_views

V = with_views


# Segments -------------------------------------------------------------------


def catalogue(t):
    return with_specs(t.spec_products)


def vectors(t):
    filled = segments.with_features(catalogue(t))
    return stage(segments.with_vector(filled, segments.feature_columns(filled)), "vectors", even=True).persist()


SCALED = ["Discounted_Price", "Avg_Star_Rating", "Total_Reviews"]


@query(
    "standardize",
    V("products") + "SELECT Product_ID, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}_z" for c in SCALED
    ) + " FROM products",
)
def _(t):
    scaled = segments.standardize(t.stored_products, SCALED)
    return rounded(scaled.select("Product_ID", *[f"{c}_z" for c in SCALED]))


@query("kmeans_segments")
def _(t):
    rows = vectors(t)
    model = segments.best_kmeans(rows, 8)
    return model.transform(rows).select("Product_ID", "cluster_id")


@query("kmeans_far_rows", "SELECT count(*) AS n, 0 AS far FROM part")
def _(t):
    """Rows that aren't in the cluster of the nearest centre: none."""
    rows = vectors(t)
    model = segments.best_kmeans(rows, 8)
    away = [sum([(F.get(vector_to_array("scaled"), i) - F.lit(float(x))) ** 2 for i, x in enumerate(c)], F.lit(0.0)) for c in model.clusterCenters()]
    placed = model.transform(rows).withColumn("away", F.array(*away))
    far = F.get("away", F.col("cluster_id")) > F.array_min("away") + 1e-9
    return placed.agg(F.count(F.lit(1)).alias("n"), F.count_if(far).alias("far"))


@query("kmeans_k_scores")
def _(t):
    scores, _models = segments.k_scores(vectors(t), range(2, 10))
    return rounded(scores)


@query("pca_2d")
def _(t):
    return rounded(segments.with_coordinates(vectors(t)).select("Product_ID", "PC1", "PC2"))


@query("explore_pca")
def _(t):
    return rounded(segments.explore_coordinates(catalogue(t), "Brand#7").select("Product_ID", "PC1", "PC2"))


@query("flow_segments")
def _(t):
    clustered, _scores, _model = segments.segment_products(catalogue(t))
    return rounded(clustered.select("Product_ID", "cluster_id", "cluster_name", "PC1", "PC2"))


@query("flow_cross_sell", BASKETS_SQL + ", " + sql.rules_sql(0.004, 0.12, 1.0) + TYPES_SQL + f" SELECT {RULE_COLUMNS} FROM typed")
def _(t):
    return rounded(baskets.cross_sell_rules(t.baskets, 0.004, 0.12, 1.0))


# Forecast -------------------------------------------------------------------


def dataset(t):
    return forecast.forecast_dataset(with_discount_rate(t.stored_products), t.scored)


DATASET = f"""dataset AS (
    SELECT p.Product_ID, Discounted_Price, greatest(0, least(1, (Original_Price - Discounted_Price) / Original_Price)) AS Discount_Rate,
           Avg_Star_Rating, coalesce(s, 0.5) AS Sentiment_Score, {sql.calendar_sql('Inward_Date')},
           coalesce((sum(Sales_Volume) OVER b - Sales_Volume) / nullif(count(Sales_Volume) OVER b - 1, 0), avg(Sales_Volume) OVER ()) AS Sales_Volume_7d_mean,
           Sales_Volume AS target
    FROM products p LEFT JOIN (SELECT Product_ID, avg(Sentiment_Score) AS s FROM scored GROUP BY 1) m ON p.Product_ID = m.Product_ID
    WINDOW b AS (PARTITION BY Brand))"""


@query(
    "forecast_dataset",
    V("products", "scored") + f", {DATASET} SELECT Product_ID, " + ", ".join(
        f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in [*lexicon.FORECAST_FEATURES, "target"]
    ) + " FROM dataset",
)
def _(t):
    return rounded(dataset(t).select("Product_ID", *lexicon.FORECAST_FEATURES, "target"))


def training(t, folds=5):
    return forecast.training_rows(dataset(t), folds=folds)


@query("forecast_train")
def _(t):
    rows = training(t)
    return rounded(forecast.train_forecast(rows).transform(rows).select("Product_ID", "target", "prediction"), 4)


#: Features of few values, whose bins are the values themselves.
FEW_VALUES = ["Day_of_Week", "Is_Weekend", "Is_Holiday", "Avg_Star_Rating"]


@query(
    "forecast_stump",
    V("products", "scored") + f""", {DATASET},
    base AS (SELECT avg(target) AS b FROM dataset),
    long AS (SELECT Product_ID, unnest(range({len(FEW_VALUES)})) AS f, coalesce(unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in FEW_VALUES)}]), 0) AS x,
                    (SELECT b FROM base) - target AS g FROM dataset WHERE target IS NOT NULL),
    cuts AS (SELECT f, x, sum(sum(g)) OVER up AS gl, sum(count(*)) OVER up AS hl, sum(sum(g)) OVER al AS gt, sum(count(*)) OVER al AS ht
             FROM long GROUP BY f, x WINDOW up AS (PARTITION BY f ORDER BY x), al AS (PARTITION BY f)),
    best AS (SELECT *, gl * gl / (hl + 2) + (gt - gl) * (gt - gl) / (ht - hl + 2) AS gain FROM cuts WHERE ht > hl ORDER BY gain DESC, f, x LIMIT 1)
    SELECT Product_ID, round((SELECT b FROM base) - 0.3 * CASE WHEN l.x <= c.x THEN gl / (hl + 2) ELSE (gt - gl) / (ht - hl + 2) END, 4) AS prediction
    FROM long l JOIN best c ON l.f = c.f""",
)
def _(t):
    """One tree of one split: the gain, the penalty and the leaf values as plain SQL has them."""
    rows = training(t)
    model = fit_boosted(rows, FEW_VALUES, [forecast.BoostParams(1, 1, 0.3, reg_lambda=2.0)])[0]
    return rounded(model.transform(rows).select("Product_ID", "prediction"), 4)


@query("forecast_tune")
def _(t):
    scores, _best = forecast.tune_forecast(training(t))
    return rounded(scores)


@query("forecast_cv_metrics")
def _(t):
    return rounded(forecast.cv_metrics(training(t)), 4)


@query("forecast_compare")
def _(t):
    rows = training(t)
    _scores, best = forecast.tune_forecast(rows)
    return rounded(forecast.compare_forecasts(rows, best), 4)


@query(
    "forecast_baseline",
    V("products") + """, folded AS (
        SELECT Sales_Volume AS y, (row_number() OVER (ORDER BY md5(Product_ID)) - 1) % 5 AS fold FROM products WHERE Sales_Volume IS NOT NULL),
    guess AS (SELECT fold, ((SELECT sum(y) FROM folded) - sum(y)) / ((SELECT count(*) FROM folded) - count(*)) AS p FROM folded GROUP BY fold)
    SELECT CAST(fold AS INT) AS fold, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
           round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) AS r2
    FROM folded JOIN guess USING (fold) GROUP BY fold""",
)
def _(t):
    return rounded(evaluate.regression_metrics(forecast.baseline_predictions(training(t))), 4)


@query("forecast_score_7d")
def _(t):
    model = forecast.train_forecast(training(t))
    days = forecast.forecast_days(t.requests, model, "2024-04-26")
    return days.withColumn("date", F.col("date").cast("string"))


# Sentiment ------------------------------------------------------------------


@query(
    "majority_baseline",
    "SELECT label, count(*) AS n, CAST((SELECT quality FROM labels GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1) AS DOUBLE) AS prediction "
    "FROM (SELECT quality AS label FROM labels) GROUP BY label",
)
def _(t):
    rows = t.labels.select(F.col("quality").alias("label"))
    return sentiment.majority(rows, rows).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("sentiment_compare")
def _(t):
    docs = t.documents.join(t.labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("key"),
        text.clean_text(F.col("text"), DICTIONARY).alias("clean"),
        F.col("quality").alias("label"),
        (F.col("n_chars") % 7 + 1).cast("double").alias("review_weight"),
    )
    return rounded(sentiment.compare_classifiers(docs))


@query("sentiment_train")
def _(t):
    _model, metrics = sentiment.train_sentiment(labeled(t), sentences(t))
    return rounded(metrics)


def scored_reviews(t):
    model = sentiment.fit_sentiment(labeled(t).select("clean", "label"))
    return sentiment.score_sentiment(t.raw_reviews.select("Review_ID", "Product_ID", "Review_Text"), model)


@query("sentiment_score")
def _(t):
    scored = scored_reviews(t)
    return rounded(
        scored.select(
            "Review_ID", "label", "label_name", "confidence",
            *[F.col("probabilities")[n].alias(f"p_{n}") for n in lexicon.LABEL_NAMES.values()],
            "cleaned_text",
        )
    )


@query(
    "sentiment_score_sums",
    V("raw_reviews") + """ SELECT Review_ID, 1.0 AS total, true AS surest, true AS named
    FROM raw_reviews WHERE regexp_replace(Review_Text, '\\s', '', 'g') <> ''""",
)
def _(t):
    """Of every scored review the sum of its chances, and whether label and name are the surest."""
    scored = scored_reviews(t)
    chance = F.col("probabilities")
    names = F.array(*[F.lit(n) for n in lexicon.LABEL_NAMES.values()])
    return scored.select(
        "Review_ID", F.round(F.aggregate(F.map_values(chance), F.lit(0.0), lambda a, p: a + p), 6).alias("total"),
        (chance[F.col("label_name")] == F.col("confidence")).alias("surest"),
        (F.get(names, F.col("label")) == F.col("label_name")).alias("named"),
    )


@query("sentiment_score_by_product")
def _(t):
    return rounded(sentiment.sentiment_by_product(scored_reviews(t)))
