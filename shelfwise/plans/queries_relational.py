"""Queries over joins, aggregates, windows, sorts, sets and baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions import catalog, numeric, text
from shelfwise.operators import baskets, customers, evaluate, folds, forecast, joins, profile
from shelfwise.operators.cleaning import with_segment, with_specs
from shelfwise.plans import sql
from shelfwise.plans.registry import query, rounded
from shelfwise.session import stage
from shelfwise.sources.tables import ASPECTS, DICTIONARY, with_views

V = with_views


def dictionary(t):
    """The dictionary as a stored table."""
    rows = list(DICTIONARY.items())
    return stage(t.spark.createDataFrame(rows, "token string, replacement string"), "dictionary")


# Joins ----------------------------------------------------------------------


@query(
    "left_join_sentiment",
    V("products", "scored") + """
    SELECT p.Product_ID, Brand, round(coalesce(s, 0.5), 6) AS Sentiment_Score FROM products p
    LEFT JOIN (SELECT Product_ID, avg(Sentiment_Score) AS s FROM scored GROUP BY Product_ID) m ON p.Product_ID = m.Product_ID""",
)
def _(t):
    return rounded(joins.left_join_sentiment(t.products.select("Product_ID", "Brand"), t.scored))


@query(
    "dictionary_join",
    f"""SELECT doc_id, token, {'CASE token ' + ' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in DICTIONARY.items()) + ' ELSE token END'} AS replacement,
               count(*) AS n
        FROM (SELECT doc_id, unnest({sql.words_sql('lower(text)')}) AS token FROM documents) GROUP BY ALL""",
)
def _(t):
    docs = joins.dealt_by_key(t.documents, "doc_id", "text")
    words = joins.dictionary_join(docs, dictionary(t), "doc_id", "text")
    return words.groupBy("doc_id", "token", "replacement").agg(F.count(F.lit(1)).alias("n"))


@query(
    "keyword_match_join",
    "WITH " + "clauses AS (SELECT conv_id, turn, lower(text) AS clause FROM conversations) " + " UNION ALL ".join(
        f"SELECT conv_id, turn, '{a}' AS aspect FROM clauses WHERE {sql.has_word('clause', words)}"
        + "".join(f" AND NOT contains(clause, '{v}')" for v in ASPECTS.vetoes.get(a, ()))
        for a, words in ASPECTS.keywords.items()
    ),
)
def _(t):
    clauses = t.conversations.select("conv_id", "turn", F.lower("text").alias("clause"))
    return joins.keyword_matches(clauses, ASPECTS.keywords, ASPECTS.vetoes).select("conv_id", "turn", "aspect")


LINKS_SQL = """links AS (
    SELECT page_id, unnest(hrefs) AS Product_URL, generate_subscripts(hrefs, 1) - 1 AS position, lang AS Category FROM (
        SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS hrefs,
               regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages))"""


def links(t):
    hrefs = F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)">'), 1)
    return t.pages.select(
        "page_id",
        F.posexplode(hrefs).alias("position", "Product_URL"),
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("Category"),
    )


def stored_links(t):
    """URLs made of the words of the benchmark texts."""
    words = t.benchmark.select(F.explode(text.tokens(F.lower("text"))).alias("word"))
    return words.select(F.concat(F.lit("/"), "word").alias("Product_URL")).distinct()


STORED_SQL = f"stored AS (SELECT DISTINCT '/' || unnest({sql.words_sql('lower(text)')}) AS Product_URL FROM benchmark)"


@query(
    "anti_join_seen",
    f"""WITH {LINKS_SQL}, {STORED_SQL}
    SELECT Product_URL, min(page_id * 1000 + position) // 1000 AS page_id, CAST(min(page_id * 1000 + position) % 1000 AS INT) AS position
    FROM links WHERE Product_URL NOT IN (SELECT Product_URL FROM stored) GROUP BY Product_URL""",
)
def _(t):
    return joins.new_products(links(t), stored_links(t)).select("Product_URL", "page_id", "position")


BASKET = {"min_support": 0.02, "min_confidence": 0.15, "min_lift": 1.0}
BASKETS_SQL = V("baskets").replace("WITH", "WITH RECURSIVE", 1)
RULES_SQL = BASKETS_SQL + ", " + sql.rules_sql(0.02, 0.15, 1.0)
TYPES_SQL = """, types AS (SELECT Product_ID, arg_min(Product_Type, ordinal) AS Product_Type FROM baskets GROUP BY 1),
    typed AS (SELECT * FROM rules r
        WHERE EXISTS (SELECT 1 FROM types WHERE Product_Type = 'smartphone' AND list_contains(string_split(r.antecedent, ','), Product_ID))
          AND EXISTS (SELECT 1 FROM types WHERE Product_Type = 'accessory' AND list_contains(string_split(r.consequent, ','), Product_ID)))"""
RULE_COLUMNS = "antecedent, consequent, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift"


def all_rules(t):
    return baskets.rule_arrays(
        baskets.frequent_itemsets(t.baskets, BASKET["min_support"]), BASKET["min_confidence"], BASKET["min_lift"]
    )


@query("rule_type_filter", RULES_SQL + TYPES_SQL + f" SELECT {RULE_COLUMNS} FROM typed")
def _(t):
    return rounded(baskets.joined_rules(baskets.filter_rule_types(all_rules(t), baskets.first_type_per_product(t.baskets))))


@query(
    "cross_sell_lookup",
    RULES_SQL + """ SELECT a AS Product_ID, consequent AS accessory_id, consequent AS accessory_name,
        round(confidence, 6) AS confidence, round(lift, 6) AS lift
    FROM one JOIN rules ON list_contains(string_split(antecedent, ','), a)""",
)
def _(t):
    requests = t.baskets.select("Product_ID")
    return rounded(joins.cross_sell_lookup(requests, baskets.joined_rules(all_rules(t))))


@query("itemset_subset_join", RULES_SQL + f" SELECT {RULE_COLUMNS} FROM rules")
def _(t):
    return rounded(baskets.joined_rules(all_rules(t)))


@query(
    "horizon_cross_join",
    V("requests") + f""", days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-04-27', TIMESTAMP '2024-05-03', INTERVAL 1 DAY)) AS DATE) AS date)
    SELECT product_id, CAST(date AS VARCHAR) AS date, round(current_price, 2) AS Discounted_Price, round(discount_rate, 2) AS Discount_Rate,
           CAST(4 AS DOUBLE) AS Avg_Star_Rating, round(sentiment_score_yesterday, 2) AS Sentiment_Score, {sql.calendar_sql('date')}
    FROM requests, days""",
)
def _(t):
    days = forecast.forecast_horizon(t.requests, "2024-04-26")
    return rounded(days.withColumn("date", F.col("date").cast("string")), 2)


@query(
    "template_cross_join",
    "SELECT DISTINCT regexp_replace(b || n || ' ' || w || s, '^\\s+|\\s+$', '', 'g') AS text FROM (SELECT DISTINCT p_brand || ' ' AS b FROM part),"
    + f" (SELECT unnest({lexicon.NEGATORS}) AS n), (SELECT unnest({lexicon.NEGATIVE_WORDS}) AS w), (SELECT unnest({lexicon.SUFFIXES}) AS s)",
)
def _(t):
    from shelfwise.operators.sentiment import negation_sentences

    subjects = t.part.select(F.concat("p_brand", F.lit(" ")).alias("subject")).distinct()
    return negation_sentences(subjects, lexicon.NEGATIVE_WORDS).select(text.strip(F.col("text")).alias("text")).distinct()


@query(
    "catalog_reviews_join",
    V("products") + """SELECT l_orderkey, l_linenumber, Product_ID AS product_id, Name AS product_name
    FROM lineitem JOIN products ON Product_ID = CAST(l_partkey AS VARCHAR)""",
)
def _(t):
    url = F.concat(F.lit("/p/"), F.col("l_partkey").cast("string"))
    pages = t.lineitem.select("l_orderkey", "l_linenumber", url.alias("Product_URL"))
    named = t.part.select(
        F.concat(F.lit("/p/"), F.col("p_partkey").cast("string")).alias("Product_URL"),
        F.col("p_partkey").cast("string").alias("Product_ID"),
        F.col("p_name").alias("Name"),
    )
    return joins.reviews_of_catalog(pages, named).select("l_orderkey", "l_linenumber", "product_id", "product_name")


# Aggregations ---------------------------------------------------------------


@query(
    "mean_sentiment_by_product",
    V("scored") + "SELECT Product_ID, round(avg(Sentiment_Score), 6) AS Sentiment_Score FROM scored GROUP BY 1",
)
def _(t):
    return rounded(joins.mean_sentiment(t.scored))


@query("value_counts", V("reviews") + "SELECT Star_Rating AS value, count(*) AS n FROM reviews GROUP BY 1")
def _(t):
    return profile.value_counts(t.reviews, "Star_Rating", keep_null=True)


PROFILED = ["Original_Price", "Sales_Volume", "Total_Reviews"]


@query(
    "column_profile",
    V("gappy_products") + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(min({c}), 2) AS min, round(max({c}), 2) AS max, round(avg({c}), 2) AS mean,
            round(median({c}), 2) AS median, count(*) - count({c}) AS missing FROM gappy_products""" for c in PROFILED
    ),
)
def _(t):
    return rounded(profile.column_profile(t.gappy_products, PROFILED), 2)


@query("distinct_count", "SELECT count(DISTINCT l_partkey) AS n FROM lineitem")
def _(t):
    return profile.distinct_count(t.lineitem, "l_partkey")


@query(
    "conditional_counts",
    V("reviews") + f"""SELECT max(CAST(Helpfulness_Count AS DOUBLE)) AS max_helpful, round(avg(CAST(Helpfulness_Count AS DOUBLE)), 6) AS mean_helpful,
        count(*) FILTER (CAST(Helpfulness_Count AS DOUBLE) > 0) AS nonzero_helpful,
        count(*) FILTER (Support_Contacted = '1') AS support_contacted,
        count(*) FILTER (length(regexp_replace(Review_Text, '{sql.BLANK}', '', 'g')) = 0) AS blank_text FROM reviews""",
)
def _(t):
    return rounded(profile.review_counts(t.reviews))


@query(
    "label_distribution",
    V("reviews") + f"""SELECT label, {sql.LABEL_NAME} AS label_name, n, round(100.0 * n / (SELECT count(*) FROM reviews), 6) AS percent
    FROM (SELECT unnest([0, 1, 2]) AS label) LEFT JOIN (
        SELECT {sql.label_three_sql('Star_Rating')} AS l, count(*) AS n FROM reviews GROUP BY 1) ON l = label""",
)
def _(t):
    labeled = t.reviews.select(catalog.label_three(F.col("Star_Rating")).alias("label"))
    return rounded(profile.class_counts(labeled))


@query(
    "dedupe_text_label",
    "SELECT text, lang, min(doc_id) AS doc_id FROM documents GROUP BY text, lang",
)
def _(t):
    from shelfwise.functions.ranking import first_per_key

    rows = t.documents.select("text", "lang", "doc_id")
    return first_per_key(rows, ["text", "lang"], F.col("doc_id"))


@query(
    "basket_onehot",
    V("baskets") + "SELECT Transaction_ID, " + ", ".join(
        f"""max(CASE WHEN Product_ID = 'Brand#{b}' THEN 1 ELSE 0 END) AS "Brand#{b}" """ for b in range(1, 26)
    ) + " FROM baskets GROUP BY 1",
)
def _(t):
    return baskets.basket_onehot(t.baskets, [f"Brand#{b}" for b in range(1, 26)])


@query(
    "frequent_itemsets",
    BASKETS_SQL + ", " + sql.rules_sql(0.004, 0.15, 1.0) + " SELECT items, freq, round(support, 6) AS support FROM sets",
)
def _(t):
    found = baskets.frequent_itemsets(t.baskets, 0.004)
    return rounded(found.withColumn("items", F.array_join("items", ",")))


@query("association_rules", BASKETS_SQL + ", " + sql.rules_sql(0.004, 0.12, 1.0) + f" SELECT {RULE_COLUMNS} FROM rules")
def _(t):
    return rounded(baskets.association_rules(baskets.frequent_itemsets(t.baskets, 0.004), 0.12, 1.0))


@query(
    "kpi_cards",
    V("products") + """SELECT count(*) AS products, count(DISTINCT Brand) AS brands, round(avg(Avg_Star_Rating), 6) AS mean_rating,
        (SELECT count(*) FROM documents) AS reviews FROM products""",
)
def _(t):
    return rounded(profile.kpi_cards(t.products, t.documents))


@query("best_k")
def _(t):
    from shelfwise.operators import segments
    products = with_specs(t.spec_products)
    filled = segments.with_features(products)
    vectors = stage(segments.with_vector(filled, segments.feature_columns(filled)), "vectors", even=True).persist()
    scores, _models = segments.k_scores(vectors, range(2, 10))
    return segments.best_k(scores)


@query(
    "confusion_matrix",
    V("predictions") + "SELECT label, " + ", ".join(
        f"count(*) FILTER (prediction = {c}) AS predicted_{c}" for c in range(3)
    ) + " FROM predictions GROUP BY label",
)
def _(t):
    return evaluate.confusion_matrix(t.predictions, [0, 1, 2])


CLASS_SQL = """, per AS (
    SELECT class, support, hits, coalesce(hits / nullif(predicted, 0), 0) AS precision, hits / support AS recall
    FROM (SELECT label AS class, count(*) AS support, count(*) FILTER (label = prediction) AS hits FROM predictions GROUP BY 1)
    JOIN (SELECT prediction, count(*) AS predicted FROM predictions GROUP BY 1) ON prediction = class),
    f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM per)"""


@query(
    "classification_metrics",
    V("predictions") + CLASS_SQL + " SELECT metric, key, round(value, 6) AS value FROM (" + " UNION ALL ".join(
        [f"SELECT '{m}' AS metric, CAST(class AS VARCHAR) AS key, CAST({m} AS DOUBLE) AS value FROM f" for m in ["precision", "recall", "f1", "support"]]
        + [f"SELECT '{m}', 'macro', avg({m}) FROM f" for m in ["precision", "recall", "f1"]]
        + [f"SELECT '{m}', 'weighted', sum({m} * support) / sum(support) FROM f" for m in ["precision", "recall", "f1"]]
        + ["SELECT 'accuracy', 'all', sum(hits) / sum(support) FROM f"]
    ) + ")",
)
def _(t):
    return rounded(evaluate.classification_metrics(t.predictions))


@query(
    "regression_metrics",
    """SELECT fold, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
              round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
       FROM (SELECT l_linenumber AS fold, l_extendedprice AS y, l_quantity * 2500 AS p FROM lineitem) GROUP BY fold""",
)
def _(t):
    scored = t.lineitem.select(
        F.col("l_linenumber").alias("fold"), F.col("l_extendedprice").alias("target"), (F.col("l_quantity") * 2500).alias("prediction")
    )
    found = evaluate.regression_metrics(scored)
    return found.select("fold", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@query(
    "segment_list",
    V("products") + f"SELECT DISTINCT {sql.segment_sql('Discounted_Price', 'CAST(4 AS INT)')} AS cluster_name FROM products",
)
def _(t):
    return profile.distinct_values(with_segment(t.products), "cluster_name")


@query(
    "first_type_per_product",
    "SELECT l_partkey AS Product_ID, arg_min(l_returnflag || l_linestatus, l_orderkey * 100 + l_linenumber) AS Product_Type FROM lineitem GROUP BY 1",
)
def _(t):
    rows = t.lineitem.select(
        F.col("l_partkey").alias("Product_ID"),
        F.concat("l_returnflag", "l_linestatus").alias("Product_Type"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("ordinal"),
    )
    return baskets.first_type_per_product(rows)


@query(
    "metric_summary",
    "SELECT metric, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std FROM ("
    "SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS metric, unnest([l_quantity, l_discount, l_tax]) AS v FROM lineitem) GROUP BY metric",
)
def _(t):
    return rounded(profile.metric_summary(t.lineitem, ["l_quantity", "l_discount", "l_tax"]))


RFM_SQL = """, base AS (
    SELECT User_ID, email, max(CAST(order_date AS DATE)) AS last, count(*) AS frequency, sum(amount) AS monetary
    FROM customers JOIN customer_orders USING (User_ID) GROUP BY 1, 2),
    aged AS (SELECT *, (SELECT max(last) FROM base) - last AS recency FROM base)
    SELECT User_ID, email, CAST(recency AS INT) AS recency, frequency, round(monetary, 2) AS monetary,
           CAST(ntile(5) OVER (ORDER BY recency DESC, User_ID) * 100 + ntile(5) OVER (ORDER BY frequency, User_ID) * 10
             + ntile(5) OVER (ORDER BY round(monetary, 2), User_ID) AS INT) AS rfm_segment,
           round(recency / (SELECT max(recency) FROM aged), 6) AS churn_probability FROM aged"""


@query("rfm_segments", V("customers", "customer_orders") + RFM_SQL)
def _(t):
    found = rounded(customers.rfm_segments(t.customers, t.customer_orders))
    return found.withColumn("monetary", F.round("monetary", 2))


# Windows --------------------------------------------------------------------


@query(
    "loo_brand_mean",
    V("gappy_products") + """SELECT Product_ID, Brand, round(coalesce(
        (sum(Sales_Volume) OVER b - Sales_Volume) / nullif(count(Sales_Volume) OVER b - 1, 0), avg(Sales_Volume) OVER ()), 6) AS Sales_Volume_7d_mean
    FROM gappy_products WINDOW b AS (PARTITION BY Brand)""",
)
def _(t):
    return rounded(forecast.with_loo_mean(t.gappy_products).select("Product_ID", "Brand", "Sales_Volume_7d_mean"))


@query(
    "trend_flag",
    V("daily_sales") + """SELECT request_id, CAST(date AS VARCHAR) AS date, predicted_volume, CASE WHEN before IS NULL THEN 'flat'
        WHEN predicted_volume > before THEN 'up' ELSE 'down' END AS trend
    FROM (SELECT *, lag(predicted_volume) OVER (PARTITION BY request_id ORDER BY date) AS before FROM daily_sales)""",
)
def _(t):
    return forecast.trend_flags(t.daily_sales).withColumn("date", F.col("date").cast("string"))


@query(
    "limit_per_category",
    f"""WITH {LINKS_SQL} SELECT Category, page_id, CAST(position AS INT) AS position, Product_URL FROM (
        SELECT *, row_number() OVER (PARTITION BY Category ORDER BY page_id, position) AS rn FROM links) WHERE rn <= 40""",
)
def _(t):
    return joins.limit_per_category(links(t), 40).select("Category", "page_id", "position", "Product_URL")


@query(
    "cap_reviews_per_product",
    V("reviews") + """SELECT Product_ID, Review_ID FROM (
        SELECT *, row_number() OVER (PARTITION BY Product_ID ORDER BY ordinal) AS rn FROM reviews) WHERE rn <= 8""",
)
def _(t):
    return joins.cap_reviews(t.reviews, 8).select("Product_ID", "Review_ID")


@query(
    "kfold_assign",
    "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) - 1) % 5 AS INT) AS fold FROM orders",
)
def _(t):
    return folds.kfold(t.orders.select("o_orderkey"), "o_orderkey")


@query(
    "stratified_folds",
    """SELECT o_orderkey, o_orderstatus AS label, CAST((row_number() OVER (PARTITION BY o_orderstatus
       ORDER BY md5(CAST(o_orderkey AS VARCHAR))) - 1) % 5 AS INT) AS fold FROM orders""",
)
def _(t):
    return folds.stratified_kfold(t.orders.select("o_orderkey", F.col("o_orderstatus").alias("label")), "o_orderkey")


@query(
    "stratified_split",
    """SELECT o_orderkey, o_orderstatus AS label, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)))
       <= round(0.15 * count(*) OVER (PARTITION BY o_orderstatus)) AS is_test FROM orders""",
)
def _(t):
    return folds.stratified_split(t.orders.select("o_orderkey", F.col("o_orderstatus").alias("label")), "o_orderkey")


MERGE_SQL = """, merged AS (
    SELECT Review_ID, Product_ID, ordinal, 0 AS source FROM reviews
    UNION ALL SELECT CAST(conv_id AS VARCHAR), 'talk', conv_id * 1000 + turn, 1 FROM conversations)"""


def review_sources(t):
    talk = t.conversations.select(
        F.col("conv_id").cast("string").alias("Review_ID"),
        F.lit("talk").alias("Product_ID"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ordinal"),
    )
    return [t.reviews.select("Review_ID", "Product_ID", "ordinal"), talk]


@query(
    "merge_dedupe_reviews",
    V("reviews") + MERGE_SQL + """ SELECT Review_ID, Product_ID, ordinal, source FROM (
        SELECT *, row_number() OVER (PARTITION BY Review_ID ORDER BY source, ordinal) AS rn FROM merged) WHERE rn = 1""",
)
def _(t):
    return joins.merge_reviews(review_sources(t))


# Sorts and sets -------------------------------------------------------------


@query(
    "compare_sort",
    V("spec_products") + f""", keyed AS (SELECT Product_ID, {sql.spec_columns()} FROM spec_products)
    SELECT Product_ID, RAM * 10000 + ROM AS sort_key, row_number() OVER (ORDER BY RAM * 10000 + ROM DESC, Product_ID) AS rank FROM keyed""",
)
def _(t):
    products = with_specs(t.spec_products).select("Product_ID", "RAM", "ROM")
    return profile.compare_sort(products, "ramrom", descending=True).select("Product_ID", "sort_key", "rank")


@query("locale_sort")
def _(t):
    products = t.pages.select(
        F.col("page_id").cast("string").alias("Product_ID"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("Name")
    )
    return profile.compare_sort(products, "name").select("Product_ID", "Name", "rank")


@query(
    "sort_brand_by_count",
    V("products") + """SELECT Brand, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, Brand) AS rank FROM products GROUP BY Brand""",
)
def _(t):
    return profile.brands_by_count(t.products)


@query(
    "topk_common",
    f"""SELECT token AS value, count(*) AS n FROM (SELECT unnest({sql.words_sql('lower(text)')}) AS token FROM documents)
        GROUP BY 1 ORDER BY n DESC, value LIMIT 20""",
)
def _(t):
    words = t.documents.select(F.explode(text.tokens(F.lower("text"))).alias("token"))
    return profile.top_values(words, "token", 20)


@query("union_sources", V("reviews") + MERGE_SQL + " SELECT source, count(*) AS n, CAST(sum(ordinal) AS BIGINT) AS total FROM merged GROUP BY source")
def _(t):
    tagged = [s.withColumn("source", F.lit(i)) for i, s in enumerate(review_sources(t))]
    return profile.union_all(tagged).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("ordinal").alias("total"))


@query(
    "set_difference",
    f"WITH {LINKS_SQL}, {STORED_SQL} SELECT Product_URL FROM links EXCEPT SELECT Product_URL FROM stored",
)
def _(t):
    return links(t).select("Product_URL").subtract(stored_links(t))
