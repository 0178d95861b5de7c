"""Queries over review texts, aspects and phrases, and the end-to-end jobs on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions import text
from shelfwise.operators import aspects, folds, joins, phrases, profile, sentiment
from shelfwise.operators.cleaning import with_discount_rate
from shelfwise.plans import flows, sql
from shelfwise.plans.registry import joined, query, rounded
from shelfwise.session import scratch_path, stage
from shelfwise.sources import readers, writers
from shelfwise.sources.tables import ASPECTS, DICTIONARY, with_views
from shelfwise.streaming import ingest, scoring

V = with_views


# Text columns ---------------------------------------------------------------


@query("clean_text", V("raw_reviews") + f"SELECT Review_ID, {sql.clean_sql('Review_Text')} AS clean FROM raw_reviews")
def _(t):
    return t.raw_reviews.select("Review_ID", text.clean_text(F.col("Review_Text"), DICTIONARY).alias("clean"))


@query(
    "clean_text_aspect",
    f"SELECT conv_id, turn, {sql.clean_sql('text')} AS clean FROM conversations",
)
def _(t):
    return t.conversations.select("conv_id", "turn", text.clean_text(F.col("text"), DICTIONARY).alias("clean"))


MARKS = r"""[.,!?"''()\[\]{}]"""


@query(
    "teencode_translate",
    f"""SELECT conv_id, turn, array_to_string(list_transform({sql.words_sql('lower(text)')}, lambda w:
        CASE regexp_replace(w, '^{MARKS}+|{MARKS}+$', '', 'g') """
    + " ".join(f"WHEN '{k}' THEN regexp_extract(w, '^{MARKS}*') || '{v}' || regexp_extract(w, '{MARKS}*$')" for k, v in DICTIONARY.items())
    + " ELSE w END), ' ') AS translated FROM conversations",
)
def _(t):
    return t.conversations.select("conv_id", "turn", text.translate_shorthand(F.col("text"), DICTIONARY).alias("translated"))


@query(
    "strip_system_noise",
    V("raw_reviews") + f"SELECT Review_ID, {sql.note_free_sql('Review_Text')} AS words FROM raw_reviews",
)
def _(t):
    return t.raw_reviews.select("Review_ID", text.strip_support_note(F.col("Review_Text")).alias("words"))


@query(
    "split_clauses",
    V("reviews") + f", {sql.clauses_sql('reviews', 'Review_Text')} SELECT ordinal, place, clause FROM clauses",
)
def _(t):
    clauses = aspects.review_clauses(t.reviews, ASPECTS, None)
    return clauses.select("ordinal", F.col("place").cast("long").alias("place"), "clause")


@query(
    "clause_sentiment",
    V("reviews") + f""", {sql.clauses_sql('reviews', 'Review_Text')}
    SELECT ordinal, place, CAST(CASE WHEN {sql.has_word('clause', ASPECTS.negative)} AND NOT {sql.has_word('clause', ASPECTS.positive)} THEN 0
        WHEN {sql.has_word('clause', ASPECTS.positive)} AND NOT {sql.has_word('clause', ASPECTS.negative)} THEN 1
        WHEN stars >= 4 THEN 1 WHEN stars <= 2 THEN 0 ELSE 0.5 END AS DOUBLE) AS sentiment FROM clauses""",
)
def _(t):
    clauses = aspects.review_clauses(t.reviews, ASPECTS, None)
    mood = text.cue_sentiment(F.col("clause"), F.col("stars"), ASPECTS.positive, ASPECTS.negative)
    return clauses.select("ordinal", F.col("place").cast("long").alias("place"), mood.alias("sentiment"))


RAW_ASPECTS = V("reviews") + f", {sql.aspects_sql('reviews', 'Review_Text')}"
CLEAN_ASPECTS = V("reviews", "raw_reviews") + f", {sql.aspects_sql('raw_reviews', sql.clean_sql('Review_Text'))}"


@query("extract_aspects", RAW_ASPECTS + " SELECT Product_ID, ordinal, place, clause, aspect, sentiment, weight FROM aspects")
def _(t):
    found = aspects.extract_aspects(t.reviews, ASPECTS, None)
    return found.select("Product_ID", "ordinal", F.col("place").cast("long").alias("place"), "clause", "aspect", "sentiment", "weight")


@query(
    "phrase_mining",
    f"""WITH {sql.phrases_sql('documents', 'text')}
    SELECT first, second, n, round(npmi, 6) AS npmi FROM phrases""",
)
def _(t):
    return rounded(phrases.mine_phrases(t.documents, "doc_id", "text"))


@query(
    "phrase_segment",
    f"""WITH {sql.segmented_sql('documents', 'doc_id', 'text')}
    SELECT doc_id, coalesce(segmented, '') AS segmented FROM documents LEFT JOIN segmented ON id = doc_id""",
)
def _(t):
    found = phrases.mine_phrases(t.documents, "doc_id", "text")
    return phrases.segment_phrases(t.documents, found, "doc_id", "text")


@query(
    "extract_date",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date FROM lineitem""",
)
def _(t):
    note = F.concat(F.lit("called on "), F.date_format("l_shipdate", "d/M/yyyy"), F.lit(", then 1/2/2003"))
    return t.lineitem.select("l_orderkey", "l_linenumber", text.first_date(note).cast("string").alias("date"))


@query(
    "extract_helpful",
    V("reviews") + """SELECT Review_ID, 'review-' || Review_ID AS uid,
        CASE ordinal % 3 WHEN 0 THEN Helpfulness_Count WHEN 1 THEN Helpfulness_Count ELSE '0' END AS helpful FROM reviews""",
)
def _(t):
    third = F.col("ordinal") % 3
    link = F.concat(F.lit("javascript:likeRating("), "Review_ID", F.lit(") x"))
    label = (
        F.when(third == 0, F.concat(F.lit("Hữu ích 9 ("), "Helpfulness_Count", F.lit(")")))
        .when(third == 1, F.concat("Helpfulness_Count", F.lit(" Hữu ích")))
        .otherwise("Hữu ích")
    )
    return t.reviews.select(
        "Review_ID", text.helpful_id(link, "review-").alias("uid"), text.helpful_count(label).alias("helpful")
    )


WORDS = sql.words_sql(sql.clean_sql("Review_Text"))


@query(
    "word_ngrams",
    V("reviews") + f""", w AS (SELECT Review_ID, list_filter({WORDS}, lambda x: length(x) > 1) AS w FROM reviews),
    terms AS (SELECT Review_ID, unnest(w) AS term FROM w
        UNION ALL SELECT Review_ID, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w)
    SELECT term, count(DISTINCT Review_ID) AS df FROM terms GROUP BY term HAVING count(DISTINCT Review_ID) >= 2""",
)
def _(t):
    clean = t.reviews.select(text.clean_text(F.col("Review_Text"), DICTIONARY).alias("clean"))
    return sentiment.document_frequency(sentiment.with_terms(clean), F.col("terms"), 2)


@query(
    "char_ngrams",
    V("reviews") + f""", w AS (SELECT DISTINCT Review_ID, ' ' || unnest({WORDS}) || ' ' AS p FROM reviews),
    grams AS (SELECT Review_ID, unnest(flatten(list_transform([3, 4, 5], lambda n:
        list_transform(range(1, length(p) - n + 2), lambda i: substring(p, i, n))))) AS term FROM w)
    SELECT term, count(DISTINCT Review_ID) AS df FROM grams GROUP BY term HAVING count(DISTINCT Review_ID) >= 3""",
)
def _(t):
    clean = t.reviews.select(text.clean_text(F.col("Review_Text"), DICTIONARY).alias("clean"))
    # No run spans two words, so a text has the runs of its different words.
    return sentiment.document_frequency(clean, text.char_ngrams(text.each_once(F.col("clean"))), 3)


@query(
    "lexicon_polarity",
    V("reviews") + f""", hits AS (SELECT Review_ID, {sql.words_sql("regexp_replace(lower(Review_Text), '" + sql.EDGE + "', ' ', 'g')")} AS w FROM reviews),
    counted AS (SELECT Review_ID, len(list_filter(w, lambda x: x IN ('and', 'les'))) AS good, len(list_filter(w, lambda x: x IN ('is', 'und'))) AS bad FROM hits)
    SELECT Review_ID, CAST(CASE WHEN good > bad THEN 1 WHEN good < bad THEN 0 ELSE 0.5 END AS DOUBLE) AS polarity FROM counted""",
)
def _(t):
    return t.reviews.select(
        "Review_ID", text.cue_polarity(F.col("Review_Text"), ASPECTS.positive, ASPECTS.negative).alias("polarity")
    )


# Aspects --------------------------------------------------------------------


def raw_aspects(t):
    return aspects.extract_aspects(t.reviews, ASPECTS, None)


@query("aspect_score", RAW_ASPECTS + f", {sql.SCORES} SELECT * FROM scores")
def _(t):
    return aspects.aspect_scores(raw_aspects(t))


@query("aspect_pros_cons", RAW_ASPECTS + f", {sql.SAMPLES} SELECT Product_ID, Aspect, Pros, Cons FROM lists")
def _(t):
    found = aspects.aspect_pros_cons(raw_aspects(t))
    return found.select("Product_ID", "Aspect", joined("Pros").alias("Pros"), joined("Cons").alias("Cons"))


@query("aspect_first_name", V("reviews") + f", {sql.NAMES} SELECT * FROM names")
def _(t):
    return aspects.product_names(t.reviews)


@query(
    "aspect_coverage",
    RAW_ASPECTS + f", {sql.SCORES} SELECT Aspect, count(*) AS products, round(avg(Score), 6) AS mean_score FROM scores GROUP BY 1",
)
def _(t):
    return rounded(profile_coverage(t))


def profile_coverage(t):
    return aspects.aspect_coverage(aspects.aspect_scores(raw_aspects(t)))


@query(
    "aspect_verdict",
    RAW_ASPECTS + f", {sql.SCORES}, {sql.SAMPLES}" + f"""
    SELECT Product_ID, Aspect, Score, CASE WHEN Score >= 0.6 THEN 'strength' WHEN Score < 0.45 THEN 'weakness' END AS verdict,
        CASE WHEN Score >= 0.6 THEN 'good' WHEN Score >= 0.4 THEN 'neutral' ELSE 'poor' END AS level,
        CASE WHEN Score * 100 >= 60 THEN 'green' WHEN Score * 100 >= 45 THEN 'yellow' ELSE 'red' END AS band,
        CASE WHEN Score >= 0.6 THEN coalesce(pro, '{aspects.DEFAULT_PRAISE}')
             WHEN Score < 0.45 THEN coalesce(con, '{aspects.DEFAULT_COMPLAINT}') END AS quote
    FROM scores LEFT JOIN lists USING (Product_ID, Aspect)""",
)
def _(t):
    return aspects.aspect_verdict(aspects.aspect_summary(t.reviews, ASPECTS, None))


SUMMARY = f", {sql.SCORES}, {sql.SAMPLES}, {sql.NAMES} " + """
    SELECT Product_ID, Product_Name, Aspect, Score, coalesce(Pros, '') AS Pros, coalesce(Cons, '') AS Cons
    FROM scores LEFT JOIN lists USING (Product_ID, Aspect) JOIN names USING (Product_ID)"""


@query("scan_nested_json", RAW_ASPECTS + SUMMARY)
def _(t):
    path = scratch_path(t.spark, "aspects.json")
    writers.write_json(flows.aspect_report(t.reviews, ASPECTS, None), path)
    return flat_summary(readers.read_aspect_documents(t.spark, path))


def flat_summary(summary):
    return summary.select(
        "Product_ID", "Product_Name", "Aspect", "Score", joined("Pros").alias("Pros"), joined("Cons").alias("Cons")
    )


# Sentiment tables -----------------------------------------------------------


def labeled(t):
    """``key, clean, label`` of the reviews that state stars."""
    unsegmented = lambda df, column: df.withColumn("Review_Text_Segmented", F.col(column))
    return flows.label_reviews(t.raw_reviews, DICTIONARY, unsegmented).select(
        F.col("Review_ID").alias("key"), F.col("Review_Text_Clean").alias("clean"), "label"
    )


LABELED = f"""labeled AS (
    SELECT * FROM (
        SELECT *, {sql.LABEL_NAME} AS label_name, row_number() OVER (PARTITION BY clean, label ORDER BY ordinal) AS rn FROM (
            SELECT Review_ID, Review_Text, ordinal, {sql.note_free_sql('Review_Text')} AS words,
                   {sql.clean_sql(sql.note_free_sql('Review_Text'))} AS clean,
                   CAST({sql.label_three_sql('Star_Rating')} AS INT) AS label FROM raw_reviews)
        WHERE label IS NOT NULL AND clean <> '') WHERE rn = 1)"""


@query(
    "class_weights",
    V("raw_reviews") + f", {LABELED}" + """
    SELECT label, n, round((SELECT count(*) FROM labeled) / ((SELECT count(DISTINCT label) FROM labeled) * n), 6) AS class_weight
    FROM (SELECT label, count(*) AS n FROM labeled GROUP BY 1)""",
)
def _(t):
    return rounded(sentiment.class_weights(labeled(t)))


@query(
    "tfidf_features",
    V("reviews") + f""", w AS (SELECT Review_ID, list_filter({WORDS}, lambda x: length(x) > 1) AS w FROM reviews),
    terms AS (SELECT Review_ID, unnest(w) AS term FROM w
        UNION ALL SELECT Review_ID, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w)
    SELECT term, count(DISTINCT Review_ID) AS df,
           round(ln((1.0 + (SELECT count(*) FROM reviews)) / (1 + count(DISTINCT Review_ID))) + 1, 6) AS idf
    FROM terms GROUP BY term HAVING count(DISTINCT Review_ID) >= 2""",
)
def _(t):
    clean = t.reviews.select(text.clean_text(F.col("Review_Text"), DICTIONARY).alias("clean"))
    return rounded(sentiment.smooth_idf(sentiment.with_terms(clean), F.col("terms"), 2))


def sentences(t):
    """Synthetic sentences about the brands and types of the catalogue."""
    brand = t.part.select(F.concat("p_brand", F.lit(" ")).alias("subject")).distinct()
    kind = t.part.select(F.concat(F.lower("p_type"), F.lit(" ")).alias("subject")).distinct()
    praise = t.part.select(F.concat("p_name", F.lit(" đẹp")).alias("praise")).distinct()
    return sentiment.augmentation(brand, kind, praise)


def sample_sql(source: str, lists: list[list[str]], sentence: str, label: int, n: int, key: str) -> str:
    """The same sample: every place of the permutation, decoded; ``s0`` is the subject, then come the slots."""
    per = 1
    for values in lists:
        per *= len(values)
    mask, picks, below = "((1 << h) - 1)", [], 1
    for k, values in reversed(list(enumerate(lists, 1))):
        picks.append(f"({values})[1 + (p // {below}) % {len(values)}] AS s{k}")
        below *= len(values)
    left, right, turns = "l", "r", "SELECT i, h, i >> h AS l, i & ((1 << h) - 1) AS r, total FROM ids"
    for turn in range(4):
        digest = f"('0x' || substr(md5('{key}:{turn}:' || r), 1, 8))::BIGINT"
        turns = f"SELECT i, h, r AS l, xor(l, {digest} & {mask}) AS r, total FROM ({turns})"
    return f"""SELECT text, {label} AS label FROM (
        WITH subjects AS (SELECT list(v ORDER BY v) AS all_v, len(list(v)) * {per} AS total FROM (SELECT DISTINCT {source} AS v FROM part)),
        halves AS (SELECT *, (SELECT min(b) FROM range(1, 31) x(b) WHERE (1::BIGINT << (2 * b)) >= total) AS h FROM subjects),
        ids AS (SELECT unnest(range(1::BIGINT << (2 * h))) AS i, h, total FROM halves),
        places AS (SELECT i, (l << h) | r AS p, total FROM ({turns})),
        filled AS (SELECT i, all_v[1 + p // {per}] AS s0, {", ".join(picks)} FROM places, (SELECT all_v FROM subjects) WHERE p < total)
        SELECT regexp_replace({sentence}, '^\\s+|\\s+$', '', 'g') AS text, min(i) AS i FROM filled GROUP BY 1 ORDER BY 2 LIMIT {n})"""


NEGATED = "s0 || s1 || ' ' || s2 || s3"
AUGMENTED = "augmented AS (" + " UNION ALL ".join(
    f"({part})"
    for part in [
        sample_sql("p_brand || ' '", [lexicon.NEGATORS, lexicon.POSITIVE_WORDS, lexicon.SUFFIXES], NEGATED, 0, 300, "not good"),
        sample_sql("p_brand || ' '", [lexicon.NEGATORS, lexicon.NEGATIVE_WORDS, lexicon.SUFFIXES], NEGATED, 2, 100, "not bad"),
        sample_sql("p_name || ' đẹp'", [[*lexicon.CONTRASTS, ""], lexicon.NEGATIVE_CLAUSES], "concat_ws(' ', s0, nullif(s1, ''), s2)", 1, 250, "mixed"),
        sample_sql("lower(p_type) || ' '", [lexicon.NEUTRAL_PHRASES], "s0 || s1", 1, 150, "neutral"),
    ]
) + ")"


@query("augment_templates", "WITH " + AUGMENTED + " SELECT text, label FROM augmented")
def _(t):
    return sentences(t)


@query(
    "union_train_augmented",
    V("raw_reviews") + f""", {LABELED}, {AUGMENTED},
    split AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(Review_ID))
        > round(0.15 * count(*) OVER (PARTITION BY label)) AS train FROM labeled)
    SELECT clean AS text, label, false AS is_synthetic FROM split WHERE train UNION ALL SELECT text, label, true FROM augmented""",
)
def _(t):
    split = folds.stratified_split(stage(labeled(t), "labeled"), "key")
    train = split.where(~F.col("is_test")).select(F.col("clean").alias("text"), "label")
    return sentiment.with_synthetic(train, sentences(t))


# End-to-end jobs ------------------------------------------------------------


@query(
    "flow_products",
    V("raw_products") + f""", parsed AS (
        SELECT * REPLACE ({', '.join(f"{sql.number_sql(c)} AS {c}" for c in lexicon.COMMERCIAL_COLUMNS)}) FROM raw_products),
    filled AS (
        SELECT * REPLACE ({', '.join(f"coalesce({c}, (SELECT median({c}) FROM parsed)) AS {c}" for c in lexicon.COMMERCIAL_COLUMNS)}) FROM parsed)
    SELECT Product_ID, Name, coalesce(Brand, 'unknown') AS Brand, {', '.join(f'round({c}, 2) AS {c}' for c in lexicon.COMMERCIAL_COLUMNS)},
           coalesce(Inward_Date, 'unknown') AS Inward_Date, {sql.spec_columns()},
           round(greatest(0, least(1, coalesce((Original_Price - Discounted_Price) / nullif(Original_Price, 0), 0))), 6) AS Discount_Rate,
           {sql.calendar_sql('TRY_CAST(Inward_Date AS DATE)')}
    FROM filled WHERE Product_ID IS NOT NULL""",
)
def _(t):
    found = flows.clean_products(t.raw_products)
    return found.withColumns(
        {**{c: F.round(c, 2) for c in lexicon.COMMERCIAL_COLUMNS}, "Discount_Rate": F.round("Discount_Rate", 6)}
    )


@query(
    "flow_reviews",
    V("raw_reviews") + f""", cleaned AS (SELECT Review_ID, Star_Rating, {sql.clean_sql('Review_Text')} AS clean FROM raw_reviews),
    {sql.segmented_sql('cleaned', 'Review_ID', 'clean')}
    SELECT Review_ID, clean AS Review_Text_Clean, coalesce(segmented, '') AS Review_Text_Segmented,
        CAST(CASE WHEN TRY_CAST(Star_Rating AS DOUBLE) >= 4 THEN 1 WHEN TRY_CAST(Star_Rating AS DOUBLE) <= 2 THEN 0 END AS DOUBLE) AS label
    FROM cleaned LEFT JOIN segmented ON id = Review_ID""",
)
def _(t):
    return flows.clean_reviews(t.raw_reviews, DICTIONARY).select(
        "Review_ID", "Review_Text_Clean", "Review_Text_Segmented", "label"
    )


@query(
    "flow_labels",
    V("raw_reviews") + f""", {LABELED}, {sql.segmented_sql('labeled', 'Review_ID', 'clean')}
    SELECT Review_ID, Review_Text AS Review_Text_Raw, words AS Review_Text_NoNoise, clean AS Review_Text_Clean,
        coalesce(segmented, '') AS Review_Text_Segmented, label, label_name FROM labeled LEFT JOIN segmented ON id = Review_ID""",
)
def _(t):
    return flows.label_reviews(t.raw_reviews, DICTIONARY).select(
        "Review_ID", "Review_Text_Raw", "Review_Text_NoNoise", "Review_Text_Clean", "Review_Text_Segmented", "label", "label_name"
    )


@query("flow_aspects", CLEAN_ASPECTS + SUMMARY)
def _(t):
    documents = flows.aspect_report(t.raw_reviews, ASPECTS, DICTIONARY)
    rows = documents.select("Product_ID", "Product_Name", F.explode("Aspects").alias("Aspect", "a"))
    return flat_summary(rows.select("Product_ID", "Product_Name", "Aspect", "a.*"))


@query("flow_elasticity", V("products") + f", {sql.ELASTICITY} SELECT * FROM elasticity")
def _(t):
    report = flows.elasticity_report(with_discount_rate(t.products)).select("Brand", "Elasticity.*")

    def uplift(points: int):
        whole = f"Estimated_Uplift_{points}pct_Discount"
        return [
            F.col(f"{whole}.Sales_Volume_Increase").alias(f"Uplift_{points}pct"),
            F.col(f"{whole}.Percentage_Increase").alias(f"Uplift_{points}pct_Percent"),
        ]

    plain = [c for c in report.columns if not c.startswith("Estimated")]
    return report.select(*plain, *uplift(5), *uplift(10))


def _report_sql() -> str:
    parts = ["SELECT 'brands' AS section, 'n' AS metric, Brand AS key, CAST(count(*) AS DOUBLE) AS value FROM products GROUP BY Brand"]
    for c in lexicon.COMMERCIAL_COLUMNS:
        for metric, what in {
            "min": f"min({c})", "max": f"max({c})", "mean": f"avg({c})", "median": f"median({c})", "missing": f"count(*) - count({c})",
        }.items():
            parts.append(f"SELECT 'products', '{metric}', '{c}', CAST({what} AS DOUBLE) FROM products")
    parts.append("SELECT 'stars', 'n', Star_Rating, CAST(count(*) AS DOUBLE) FROM reviews GROUP BY Star_Rating")
    for metric, what in {
        "max_helpful": "max(CAST(Helpfulness_Count AS DOUBLE))",
        "mean_helpful": "avg(CAST(Helpfulness_Count AS DOUBLE))",
        "nonzero_helpful": "count(*) FILTER (Helpfulness_Count <> '0')",
        "support_contacted": "count(*) FILTER (Support_Contacted = '1')",
        "blank_text": f"count(*) FILTER (length(regexp_replace(Review_Text, '{sql.BLANK}', '', 'g')) = 0)",
    }.items():
        parts.append(f"SELECT 'reviews', '{metric}', 'all', CAST({what} AS DOUBLE) FROM reviews")
    parts.append("SELECT 'aspects', 'products', Aspect, CAST(count(*) AS DOUBLE) FROM scores GROUP BY Aspect")
    parts.append("SELECT 'aspects', 'mean_score', Aspect, avg(Score) FROM scores GROUP BY Aspect")
    for c in ["Product_Count", "Price_Elasticity", "Model_R2", "Average_Sales_Volume"]:
        parts.append(f"SELECT 'elasticity', '{c}', Brand, CAST({c} AS DOUBLE) FROM elasticity")
    return " UNION ALL ".join(parts)


@query(
    "flow_report",
    V("products", "reviews") + f", {sql.aspects_sql('reviews', 'Review_Text')}, {sql.SCORES}, {sql.ELASTICITY} "
    + f"SELECT section, metric, key, round(value, 2) AS value FROM ({_report_sql()})",
)
def _(t):
    scores = aspects.aspect_scores(raw_aspects(t))
    return rounded(flows.statistics_report(t.stored_products, t.reviews, scores), 2)


# Streams --------------------------------------------------------------------


@query(
    "stream_ingest_dedupe",
    "SELECT text, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY text",
)
def _(t):
    stream = t.stream("documents")
    sink, checkpoint = scratch_path(t.spark, "ingested"), scratch_path(t.spark, "checkpoint")
    ingest.ingest_new(stream.select("text", "doc_id", "lang"), sink, "text", "doc_id", checkpoint).awaitTermination()
    return ingest.stored_rows(t.spark, sink)


@query("stream_sentiment")
def _(t):
    model = sentiment.fit_sentiment(labeled(t).select("clean", "label"))
    stream = t.stream("conversations").select("conv_id", "turn", F.col("text").alias("Review_Text"))
    sink, checkpoint = scratch_path(t.spark, "scored"), scratch_path(t.spark, "checkpoint")
    scoring.score_stream(stream, model, sink, checkpoint).awaitTermination()
    scored = t.spark.read.parquet(sink)
    return rounded(scored.select("conv_id", "turn", "label", "label_name", "confidence"), 4)
