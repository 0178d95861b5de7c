"""Queries over sources, sinks, catalogue columns and prices."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions import catalog, numeric, text
from shelfwise.operators import cleaning, joins, pricing, profile
from shelfwise.operators.forecast import trend_flags
from shelfwise.plans import sql
from shelfwise.plans.registry import joined, query, rounded
from shelfwise.session import scratch_path
from shelfwise.sources import html, readers, writers
from shelfwise.sources.tables import with_views

V = with_views

# Sources and sinks ----------------------------------------------------------


@query(
    "scan_csv_products",
    V("products") + """
    SELECT Product_ID, Name || chr(10) || '"' || Category || '", new' AS Name, Brand,
           CAST(Total_Reviews AS VARCHAR) AS Total_Reviews FROM products""",
)
def _(t):
    path = scratch_path(t.spark, "products.csv")
    name = F.concat("Name", F.lit('\n"'), "Category", F.lit('", new'))
    raw = t.products.select("Product_ID", name.alias("Name"), "Brand", F.col("Total_Reviews").cast("string"))
    writers.write_table(raw, path, "csv")
    return readers.read_csv(t.spark, path, readers.text_schema(raw.columns))


@query("scan_first_existing", "SELECT p_partkey, p_name, p_brand FROM part")
def _(t):
    found = readers.first_existing(t.spark, [f"{t.folder}/absent.parquet", f"{t.folder}/part.parquet"])
    return t.spark.read.parquet(found).select("p_partkey", "p_name", "p_brand")


@query(
    "scan_json_dictionary",
    """SELECT 'k' AS token, json_extract_string(props, '$.k') AS replacement, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def _(t):
    path = scratch_path(t.spark, "dictionary")
    t.events.select(F.col("props").alias("value")).write.text(path)
    return readers.read_dictionary(t.spark, path, per_line=True).groupBy("token", "replacement").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "sink_csv_overwrite",
    V("products") + "SELECT Product_ID, Name, Brand, CAST(round(Sales_Volume, 2) AS DOUBLE) AS Sales_Volume FROM products",
)
def _(t):
    path = scratch_path(t.spark, "out")
    table = rounded(t.products.select("Product_ID", "Name", "Brand", "Sales_Volume"), 2)
    for _again in range(2):
        writers.write_table(table, path, "csv")
    return t.spark.read.schema(table.schema).option("header", True).csv(path)


@query(
    "sink_append",
    "SELECT p_brand, 2 * count(*) AS n, CAST(2 * sum(p_size) AS BIGINT) AS size FROM part GROUP BY p_brand",
)
def _(t):
    path = scratch_path(t.spark, "appended")
    for _again in range(2):
        writers.append_table(t.part.select("p_brand", "p_size"), path)
    return t.spark.read.parquet(path).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size")
    )


@query(
    "sink_nested_json",
    V("products") + f", {sql.ELASTICITY}" + """
    SELECT Brand, Product_Count, Price_Elasticity, Uplift_5pct AS increase_5, Uplift_10pct_Percent AS percent_10
    FROM elasticity""",
)
def _(t):
    path = scratch_path(t.spark, "elasticity.json")
    writers.write_json(writers.elasticity_documents(pricing.price_elasticity(t.products)), path)

    def field(place: str, kind: str):
        return F.get_json_object("value", place).cast(kind)

    return t.spark.read.text(path).select(
        field("$.Brand", "string").alias("Brand"),
        field("$.Elasticity.Product_Count", "long").alias("Product_Count"),
        field("$.Elasticity.Price_Elasticity", "double").alias("Price_Elasticity"),
        field("$.Elasticity.Estimated_Uplift_5pct_Discount.Sales_Volume_Increase", "double").alias("increase_5"),
        field("$.Elasticity.Estimated_Uplift_10pct_Discount.Percentage_Increase", "double").alias("percent_10"),
    )


@query(
    "sink_forecast_runs",
    V("products") + """, days AS (
        SELECT Product_ID, CAST(d AS DATE) AS date, round(Sales_Volume / (1 + isodow(d)), 4) AS volume
        FROM products, (SELECT unnest(generate_series(TIMESTAMP '2024-05-01', TIMESTAMP '2024-05-07', INTERVAL 1 DAY)) AS d))
    SELECT Product_ID AS productId, date AS predictedDate, volume AS predictedVolume,
           CASE WHEN before IS NULL THEN 'flat' WHEN volume > before THEN 'up' ELSE 'down' END AS trend,
           '2024-04-30 08:00:00' AS createdAt
    FROM (SELECT *, lag(volume) OVER (PARTITION BY Product_ID ORDER BY date) AS before FROM days)""",
)
def _(t):
    days = joins.horizon(t.products.select(F.col("Product_ID").alias("product_id"), "Sales_Volume"), "2024-04-30")
    volume = F.round(F.col("Sales_Volume") / (2 + F.weekday("date")), 4)
    runs = trend_flags(days.select("product_id", "date", volume.alias("predicted_volume")), ["product_id"])
    path = scratch_path(t.spark, "runs")
    writers.append_forecast_runs(runs, path, "2024-04-30 08:00:00")
    return t.spark.read.parquet(path).withColumn("createdAt", F.date_format("createdAt", "yyyy-MM-dd HH:mm:ss"))


@query(
    "model_artifact_roundtrip",
    V("products") + """, rated AS (SELECT *, greatest(0, least(1, coalesce((Original_Price - Discounted_Price) / nullif(Original_Price, 0), 0))) AS rate FROM products)
    SELECT Product_ID, round((SELECT regr_intercept(Sales_Volume, rate) FROM rated) + (SELECT regr_slope(Sales_Volume, rate) FROM rated) * rate, 3) AS prediction
    FROM rated""",
)
def _(t):
    rows = cleaning.with_discount_rate(t.products)
    line = Pipeline(
        stages=[
            VectorAssembler(inputCols=["Discount_Rate"], outputCol="features"),
            LinearRegression(labelCol="Sales_Volume"),
        ]
    ).fit(rows)
    path = scratch_path(t.spark, "model")
    line.write().overwrite().save(path)
    return rounded(PipelineModel.load(path).transform(rows).select("Product_ID", "prediction"), 3)


@query(
    "report_sink_long",
    V("products") + """
    SELECT 'brands' AS section, 'n' AS metric, Brand AS key, CAST(count(*) AS DOUBLE) AS value FROM products GROUP BY Brand
    UNION ALL SELECT 'types', 'n', Category, CAST(count(*) AS DOUBLE) FROM products GROUP BY Category
    UNION ALL SELECT 'types', 'rating', Category, round(avg(Avg_Star_Rating), 6) FROM products GROUP BY Category""",
)
def _(t):
    by_type = t.products.groupBy("Category").agg(
        F.count(F.lit(1)).alias("n"), F.avg("Avg_Star_Rating").alias("rating")
    )
    path = scratch_path(t.spark, "report")
    writers.write_table(
        profile.union_all(
            [
                profile.report_rows("brands", profile.value_counts(t.products, "Brand"), "value", ["n"]),
                profile.report_rows("types", by_type, "Category", ["n", "rating"]),
            ]
        ),
        path,
    )
    return rounded(t.spark.read.parquet(path))


CARD = """concat('<ul><li class="item"><a class="main-contain" href="/p/', Product_ID, '-x/" data-name="', Name,
    '" data-brand="', if(Product_ID like '%7', '', Brand), '"><strong class="price">',
    format_number(round(Discounted_Price), 0), '₫</strong><p class="price-old">',
    format_number(round(Original_Price), 0), '₫</p><div class="rating_Compare"><div class="vote-txt"><i></i><b>',
    cast(Avg_Star_Rating as int), '</b></div><span>Đã bán ', cast(Sales_Volume as int), ',5k</span></div></a></li>',
    '<li class="other"><a href="/no">no card</a></li></ul>')"""


@query(
    "extract_catalog",
    V("products") + """
    SELECT Product_ID || '-x' AS Product_ID, Name,
           CASE WHEN Product_ID LIKE '%7' THEN upper(Name[1]) || split_part(Name, ' ', 1)[2:] ELSE Brand END AS Brand,
           Category, CAST(CAST(round(Original_Price) AS BIGINT) AS VARCHAR) AS Original_Price,
           CAST(CAST(round(Discounted_Price) AS BIGINT) AS VARCHAR) AS Discounted_Price,
           'standard' AS Delivery_Options, CAST(CAST(Sales_Volume AS BIGINT) * 1000 + 500 AS VARCHAR) AS Sales_Volume,
           CAST(CAST(Avg_Star_Rating AS INT) AS VARCHAR) AS Avg_Star_Rating, '' AS Total_Reviews,
           'https://shop.example/p/' || Product_ID || '-x/' AS Product_URL
    FROM products""",
)
def _(t):
    pages = t.products.select(
        F.col("Product_ID").cast("long").alias("page_id"), F.col("Category").alias("category"), F.expr(CARD).alias("html")
    )
    return html.parse_catalog(pages, "https://shop.example").select(*readers.PRODUCT_FIELDS)


NODE = """concat('<div><li class="par"><div class="cmt-top-star">', repeat('<i class="iconcmt-starbuy"></i>', coalesce(cast(Star_Rating as int), 0)),
    '</div><div class="cmt-content"><p class="cmt-txt">', replace(replace(replace(Review_Text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '</p></div>',
    if(Support_Contacted = '1', '<div class="support">called on 30/05/2026</div>', ''),
    '<a href="javascript:likeRating(', Review_ID, ')">useful (', Helpfulness_Count, ')</a></li></div>')"""


@query(
    "extract_reviews",
    V("reviews") + f""", squeezed AS (
        SELECT *, array_to_string({sql.words_sql('Review_Text')}, ' ') AS words FROM reviews)
    SELECT 'review-' || Review_ID AS Review_ID, Product_ID, Product_Name,
           CASE WHEN Support_Contacted = '1' THEN '30/05/2026' ELSE '' END AS Review_Date,
           coalesce(Star_Rating, '') AS Star_Rating,
           words || CASE WHEN Support_Contacted = '1' THEN CASE WHEN words = '' THEN '' ELSE ' || ' END || 'called on 30/05/2026' ELSE '' END AS Review_Text,
           Helpfulness_Count, Support_Contacted, 'vi' AS Language_Code
    FROM squeezed WHERE words <> '' OR Support_Contacted = '1' OR Star_Rating IS NOT NULL""",
)
def _(t):
    pages = t.reviews.select(
        F.col("ordinal").alias("page_id"),
        F.col("Product_ID").alias("product_id"),
        F.col("Product_Name").alias("product_name"),
        F.expr(NODE).alias("html"),
    )
    return html.parse_reviews(pages).select(*readers.REVIEW_FIELDS)


@query(
    "page_links",
    """SELECT page_id, link, count(*) AS n FROM (
         SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS link FROM pages)
       GROUP BY page_id, link""",
)
def _(t):
    links = F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)">'), 1)
    return t.pages.select("page_id", F.explode(links).alias("link")).groupBy("page_id", "link").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "page_fields",
    """SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
              regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS heading,
              regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages""",
)
def _(t):
    return t.pages.select("page_id", *[c.alias(n) for n, c in html.page_fields(F.col("html")).items()])


@query(
    "page_paragraphs",
    f"""SELECT page_id, unnest(p) AS paragraph, generate_subscripts(p, 1) AS place FROM (
         SELECT page_id, {html.paragraphs_sql('html')} AS p FROM pages)""",
)
def _(t):
    blocks = html.paragraphs(F.col("html"))
    return t.pages.select("page_id", F.posexplode(blocks).alias("at", "paragraph")).select(
        "page_id", "paragraph", (F.col("at") + 1).cast("long").alias("place")
    )


@query(
    "validate_required",
    """SELECT 'Customer_ID' AS missing, count(*) >= 5 AS enough_rows, false AS valid FROM lineitem""",
)
def _(t):
    return readers.validation_report(t.baskets, ["Transaction_ID", "Product_ID", "Customer_ID"], 5)


@query(
    "optional_source_empty",
    V("products") + "SELECT Product_ID, Brand, CAST(0.5 AS DOUBLE) AS Sentiment_Score FROM products",
)
def _(t):
    scored = readers.read_optional(t.spark, f"{t.folder}/reviews_scored.parquet", readers.SCORED_SCHEMA)
    return joins.left_join_sentiment(t.products.select("Product_ID", "Brand"), scored)


@query(
    "page_review_count",
    r"""SELECT page_id, CAST(coalesce(list_max(list_transform(regexp_extract_all(url || ' ' || html, '(?:page=|track\()([0-9]+)', 1),
               lambda x: CAST(x AS INT))), 1) AS INT) AS pages FROM pages""",
)
def _(t):
    whole = F.concat_ws(" ", "url", "html")
    return t.pages.select("page_id", html.page_count(whole, r"(?:page=|track\()([0-9]+)").alias("pages"))


@query(
    "page_review_total",
    """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size * 1000 + 500 AS VARCHAR)
              ELSE CAST(p_size AS VARCHAR) END AS total FROM part""",
)
def _(t):
    size = F.col("p_size").cast("string")
    stated = F.when(F.col("p_partkey") % 2 == 0, F.concat(size, F.lit(",5k"))).otherwise(size)
    words = F.concat("p_name", F.lit(" • "), stated, F.lit(" Đánh giá"))
    return t.part.select("p_partkey", html.review_total(words).alias("total"))


# Projections, filters, cleaning ---------------------------------------------


@query("coerce_numeric", V("messy") + "SELECT p_partkey, round(TRY_CAST(raw AS DOUBLE), 6) AS value FROM messy")
def _(t):
    return rounded(t.messy.select("p_partkey", numeric.coerce_double(F.col("raw")).alias("value")))


@query("parse_number", V("messy") + f"SELECT p_partkey, round({sql.number_sql('raw')}, 6) AS value FROM messy")
def _(t):
    return rounded(t.messy.select("p_partkey", numeric.parse_number(F.col("raw")).alias("value")))


@query(
    "parse_compact_count",
    V("messy") + r""", found AS (
        SELECT p_partkey, replace(regexp_extract(lower(raw), '([0-9]+([.,][0-9]+)?)\s*([km])?', 1), ',', '.') AS number,
               regexp_extract(lower(raw), '([0-9]+([.,][0-9]+)?)\s*([km])?', 3) AS suffix FROM messy)
    SELECT p_partkey, CASE suffix
        WHEN 'k' THEN CAST(CAST(trunc(CAST(number AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)
        WHEN 'm' THEN CAST(CAST(trunc(CAST(number AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR)
        ELSE replace(number, '.', '') END AS value FROM found""",
)
def _(t):
    return t.messy.select("p_partkey", numeric.parse_compact_count(F.col("raw")).alias("value"))


@query("numeric_text", V("messy") + "SELECT p_partkey, regexp_replace(raw, '[^0-9]', '', 'g') AS value FROM messy")
def _(t):
    return t.messy.select("p_partkey", numeric.digits(F.col("raw")).alias("value"))


GAPPY = ["Original_Price", "Sales_Volume", "Total_Reviews"]


@query(
    "impute_median",
    V("gappy_products") + "SELECT Product_ID, " + ", ".join(
        f"round(coalesce({c}, (SELECT median({c}) FROM gappy_products)), 4) AS {c}" for c in GAPPY
    ) + " FROM gappy_products",
)
def _(t):
    filled = cleaning.impute_median(t.gappy_products, GAPPY)
    return rounded(filled.select("Product_ID", *GAPPY), 4)


@query(
    "impute_constant",
    V("gappy_products", "raw_products") + """
    SELECT g.Product_ID, coalesce(r.Brand, 'unknown') AS Brand, round(coalesce(g.Sales_Volume, 0), 4) AS Sales_Volume
    FROM gappy_products g JOIN raw_products r ON g.Product_ID = r.Product_ID""",
)
def _(t):
    both = t.gappy_products.select("Product_ID", "Sales_Volume").join(
        t.raw_products.select("Product_ID", "Brand"), "Product_ID"
    )
    filled = cleaning.fill_unknown(cleaning.impute_constant(both, {"Sales_Volume": 0.0}))
    return rounded(filled.select("Product_ID", "Brand", "Sales_Volume"), 4)


@query(
    "discount_rate",
    V("gappy_products") + """
    SELECT Product_ID, round(greatest(0, least(1, coalesce((Original_Price - Discounted_Price) / nullif(Original_Price, 0), 0))), 6)
           AS Discount_Rate FROM gappy_products""",
)
def _(t):
    return rounded(cleaning.with_discount_rate(t.gappy_products).select("Product_ID", "Discount_Rate"))


SPECS = ["RAM", "ROM", "Battery", "Camera_MP"]


@query("extract_specs", V("spec_products") + f"SELECT Product_ID, Name, {sql.spec_columns()} FROM spec_products")
def _(t):
    return cleaning.with_specs(t.spec_products).select("Product_ID", "Name", *SPECS)


@query(
    "normalize_units",
    V("messy") + f"SELECT p_partkey, {sql.number_sql('raw')} AS Battery_mAh, {sql.number_sql('raw')} AS Camera_MP, raw AS note FROM messy",
)
def _(t):
    raw = t.messy.select("p_partkey", F.col("raw").alias("Battery_mAh"), F.col("raw").alias("Camera_MP"), F.col("raw").alias("note"))
    return cleaning.normalize_units(raw)


@query("calendar_features", V("raw_products") + f"SELECT Product_ID, {sql.calendar_sql('TRY_CAST(Inward_Date AS DATE)')} FROM raw_products")
def _(t):
    return cleaning.with_calendar(t.raw_products).select("Product_ID", "Day_of_Week", "Is_Weekend", "Is_Holiday")


@query("drop_null_keys", V("reviews") + "SELECT Review_ID, Star_Rating FROM reviews WHERE Star_Rating IS NOT NULL AND Review_ID IS NOT NULL")
def _(t):
    return cleaning.drop_null_keys(t.reviews, ["Review_ID", "Star_Rating"]).select("Review_ID", "Star_Rating")


@query(
    "filter_nonblank",
    V("messy") + f"""SELECT p_partkey, note FROM (
        SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN raw WHEN 1 THEN chr(160) || ' ' || chr(9) ELSE 'x' END AS note FROM messy)
    WHERE length(regexp_replace(note, '{sql.BLANK}', '', 'g')) > 0""",
)
def _(t):
    k = F.col("p_partkey") % 3
    note = F.when(k == 0, F.col("raw")).when(k == 1, "  \t").otherwise("x")
    return cleaning.filter_nonblank(t.messy.select("p_partkey", note.alias("note")), "note")


@query(
    "label_binary",
    V("reviews") + """SELECT Review_ID, CASE WHEN TRY_CAST(Star_Rating AS DOUBLE) >= 4 THEN 1
        WHEN TRY_CAST(Star_Rating AS DOUBLE) <= 2 THEN 0 END AS label FROM reviews""",
)
def _(t):
    return t.reviews.select("Review_ID", catalog.label_binary(F.col("Star_Rating")).alias("label"))


@query(
    "label_three_class",
    V("reviews") + f"""SELECT Review_ID, label, {sql.LABEL_NAME} AS label_name
        FROM (SELECT Review_ID, CAST({sql.label_three_sql('Star_Rating')} AS INT) AS label FROM reviews)""",
)
def _(t):
    labeled = t.reviews.select("Review_ID", catalog.label_three(F.col("Star_Rating")).alias("label"))
    return labeled.withColumn("label_name", catalog.label_name(F.col("label")))


@query(
    "segment_rule",
    V("gappy_products") + f"""SELECT Product_ID, {sql.segment_sql('Original_Price', '(2 + CAST(Avg_Star_Rating AS INT) * 2)')} AS cluster_name
        FROM gappy_products""",
)
def _(t):
    products = t.gappy_products.withColumns(
        {"Discounted_Price": F.col("Original_Price"), "RAM": 2 + F.col("Avg_Star_Rating") * 2}
    )
    return cleaning.with_segment(products).select("Product_ID", "cluster_name")


@query(
    "filter_valid_pricing",
    V("gappy_products") + "SELECT Product_ID, round(Original_Price, 2) AS Original_Price FROM gappy_products WHERE Original_Price > 0 AND Sales_Volume > 0",
)
def _(t):
    return rounded(cleaning.filter_valid_pricing(t.gappy_products).select("Product_ID", "Original_Price"), 2)


CHURN = """, risk AS (
    SELECT User_ID, email, (SELECT max(CAST(order_date AS DATE)) FROM customer_orders) - last AS recency,
           (SELECT max(CAST(order_date AS DATE)) FROM customer_orders) - (SELECT min(last) FROM (
               SELECT max(CAST(order_date AS DATE)) AS last FROM customer_orders GROUP BY User_ID)) AS longest
    FROM customers JOIN (SELECT User_ID, max(CAST(order_date AS DATE)) AS last FROM customer_orders GROUP BY User_ID) USING (User_ID))"""


@query(
    "churn_alert",
    V("customers", "customer_orders") + CHURN + """
    SELECT User_ID, email, round(recency / longest, 6) AS churn_probability FROM risk WHERE recency / longest > 0.7""",
)
def _(t):
    last = t.customer_orders.groupBy("User_ID").agg(F.max(F.to_date("order_date")).alias("last"))
    latest = t.customer_orders.agg(F.max(F.to_date("order_date"))).scalar()
    recency = F.date_diff(latest, F.col("last"))
    longest = last.agg(F.date_diff(latest, F.min("last"))).scalar()
    risk = t.customers.join(last, "User_ID").withColumn("churn_probability", recency / longest)
    return rounded(cleaning.churn_alert(risk))


SEGMENTED = f", segmented AS (SELECT *, {sql.segment_sql('Discounted_Price', 'CAST(4 AS INT)')} AS cluster_name FROM products)"


@query(
    "filter_brand_segment",
    V("products") + SEGMENTED + f"""
    SELECT Product_ID, Brand, cluster_name FROM segmented
    WHERE Brand = 'Brand#7' AND cluster_name = '{lexicon.SEGMENTS["upper_design"]}'""",
)
def _(t):
    segmented = cleaning.with_segment(t.products)
    return cleaning.filter_brand_segment(segmented, "Brand#7", lexicon.SEGMENTS["upper_design"]).select(
        "Product_ID", "Brand", "cluster_name"
    )


@query(
    "project_existing",
    V("products") + """SELECT Product_ID, Name, Brand, round(Discounted_Price, 2) AS Discounted_Price,
        Avg_Star_Rating, Total_Reviews FROM products""",
)
def _(t):
    return rounded(cleaning.cluster_listing(t.products), 2)


@query(
    "promo_simulation",
    V("products") + f", {sql.ELASTICITY}" + """
    SELECT Brand, Price_Elasticity, Average_Sales_Volume, increment, round(Price_Elasticity * increment, 6) AS growth_percent,
           round(Price_Elasticity * increment / 100 * Average_Sales_Volume, 6) AS added_sales,
           CASE WHEN Price_Elasticity > 0 THEN 'up' WHEN Price_Elasticity < 0 THEN 'down' ELSE 'none' END AS direction,
           CASE WHEN Price_Elasticity >= 0 THEN '+' ELSE '-' END AS sign
    FROM elasticity, (SELECT unnest(range(1, 31)) AS increment)""",
)
def _(t):
    simulated = pricing.promo_simulation(pricing.price_elasticity(t.products))
    return rounded(simulated.withColumn("increment", F.col("increment").cast("long")))


@query(
    "feature_vector_defaults",
    V("gappy_products") + """SELECT Product_ID AS product_id, round(coalesce(Original_Price, 0), 2) AS Discounted_Price,
        CAST(0 AS DOUBLE) AS Discount_Rate, Avg_Star_Rating, CAST(0 AS DOUBLE) AS Sentiment_Score,
        CAST(0 AS DOUBLE) AS Day_of_Week, CAST(0 AS DOUBLE) AS Is_Weekend, CAST(0 AS DOUBLE) AS Is_Holiday,
        CAST(0 AS DOUBLE) AS Sales_Volume_7d_mean FROM gappy_products""",
)
def _(t):
    requests = t.gappy_products.select(
        F.col("Product_ID").alias("product_id"), F.col("Original_Price").alias("Discounted_Price"), "Avg_Star_Rating"
    )
    return rounded(cleaning.feature_defaults(requests), 2)


@query(
    "plot_points",
    V("products") + """
    SELECT CASE WHEN CAST(Product_ID AS BIGINT) % 10 < 2 THEN 0 ELSE round(Original_Price, 2) END AS x,
           round(Sales_Volume, 2) AS y, CASE WHEN CAST(Product_ID AS BIGINT) % 5 = 0 THEN Product_ID ELSE Name END AS name,
           CASE WHEN CAST(Product_ID AS BIGINT) % 7 = 0 THEN 'Không xác định' ELSE Category END AS cluster,
           round(Discounted_Price, 2) AS price, 4 AS ram, 128 AS rom FROM products""",
)
def _(t):
    k = F.col("Product_ID").cast("long")
    products = t.products.select(
        "Product_ID",
        F.when(k % 10 == 0, float("nan")).when(k % 10 == 1, float("inf")).otherwise(F.col("Original_Price")).alias("PC1"),
        F.col("Sales_Volume").alias("PC2"),
        F.when(k % 5 != 0, F.col("Name")).alias("Name"),
        F.when(k % 7 != 0, F.col("Category")).alias("cluster_name"),
        "Discounted_Price",
        F.lit(4).alias("RAM"),
        F.lit(128).alias("ROM"),
    )
    return rounded(cleaning.plot_points(products), 2)


@query(
    "derive_url_fields",
    """WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS href,
                            unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)) AS name FROM pages)
    SELECT page_id, href, name, 'https://shop.example' || href AS Product_URL,
           coalesce(nullif(list_extract(string_split(regexp_replace(href, '/+$', ''), '/'), -1), ''),
                    regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS Product_ID,
           replace(upper(split_part(name, ' ', 1)[1]), 'ẞ', 'Ss') || lower(split_part(name, ' ', 1)[2:]) AS Brand
    FROM links""",
)
def _(t):
    hrefs = F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)">'), 1)
    names = F.regexp_extract_all("html", F.lit('<li><a href="[^"]*">([^<]*)</a>'), 1)
    links = t.pages.select("page_id", F.explode(F.arrays_zip(hrefs.alias("href"), names.alias("name"))).alias("l")).select(
        "page_id", "l.href", "l.name", F.lit("").alias("brand")
    )
    return cleaning.with_url_fields(links, "https://shop.example").select(
        "page_id", "href", "name", "Product_URL", "Product_ID", "Brand"
    )


@query(
    "review_weight",
    V("reviews") + "SELECT Review_ID, 1 + CAST(coalesce(TRY_CAST(Helpfulness_Count AS DOUBLE), 0) AS BIGINT) AS weight FROM reviews",
)
def _(t):
    return t.reviews.select("Review_ID", catalog.review_weight(F.col("Helpfulness_Count")).alias("weight"))


# Prices ---------------------------------------------------------------------


@query("price_elasticity", V("products") + f", {sql.ELASTICITY} SELECT * FROM elasticity")
def _(t):
    return pricing.price_elasticity(t.products)


@query(
    "most_elastic_brand",
    V("products") + f", {sql.ELASTICITY}" + """
    SELECT coalesce(max(brand), 'N/A') AS brand, max(e) AS elasticity FROM (
        SELECT Brand AS brand, Price_Elasticity AS e FROM elasticity WHERE Price_Elasticity > 0
        ORDER BY Price_Elasticity DESC, Brand LIMIT 1)""",
)
def _(t):
    return pricing.most_elastic_brand(pricing.price_elasticity(t.products))


@query(
    "elasticity_join",
    V("products") + f", {sql.ELASTICITY}" + """
    SELECT Product_ID, Brand, Price_Elasticity, Average_Sales_Volume FROM products JOIN elasticity USING (Brand)""",
)
def _(t):
    products = t.stored_products
    return pricing.elasticity_of_products(products.select("Product_ID", "Brand"), pricing.price_elasticity(products))


# Scalar families ------------------------------------------------------------


@query(
    "fn_dates",
    """SELECT isodow(l_shipdate) - 1 AS weekday, strftime(l_shipdate, '%m-%d') AS month_day,
              CAST(CAST(l_shipdate AS DATE) + 7 AS VARCHAR) AS next_week, count(*) AS n
       FROM lineitem GROUP BY ALL""",
)
def _(t):
    day = F.col("l_shipdate")
    return t.lineitem.groupBy(
        F.weekday(day).cast("long").alias("weekday"),
        F.date_format(day, "MM-dd").alias("month_day"),
        F.date_add(F.to_date(day), 7).cast("string").alias("next_week"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_math",
    """SELECT p_partkey, round_even(p_retailprice / 3, 2) AS third, greatest(0, least(1, p_size / 25.0 - 0.5)) AS clipped,
              abs(p_size - 25) AS distance, round(sqrt(p_size), 6) AS root FROM part""",
)
def _(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.bround(F.col("p_retailprice") / 3, 2).alias("third"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), size / 25.0 - 0.5)).alias("clipped"),
        F.abs(size - 25).alias("distance"),
        F.round(F.sqrt(size), 6).alias("root"),
    )


@query(
    "fn_arrays",
    """SELECT p_partkey, array_to_string(list_sort(w), ',') AS sorted, list_contains(w, 'ring') AS has_ring,
              array_to_string(list_slice(w, 1, 1), ',') AS head, len(list_distinct(w || w)) AS different
       FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""",
)
def _(t):
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey",
        F.array_join(F.array_sort(words), ",").alias("sorted"),
        F.array_contains(words, "ring").alias("has_ring"),
        F.array_join(F.slice(words, 1, 1), ",").alias("head"),
        F.size(F.array_distinct(F.concat(words, words))).cast("long").alias("different"),
    )


@query(
    "fn_maps",
    """SELECT key, CAST(sum(value) AS BIGINT) AS total FROM (
         SELECT unnest(['size', 'price']) AS key, unnest([p_size, CAST(round(p_retailprice) AS INT)]) AS value FROM part)
       GROUP BY key""",
)
def _(t):
    fields = F.map_concat(
        F.create_map(F.lit("size"), F.col("p_size")),
        F.create_map(F.lit("price"), F.round("p_retailprice").cast("int")),
    )
    return t.part.select(F.explode(fields)).groupBy("key").agg(F.sum("value").alias("total"))


@query(
    "fn_json",
    """SELECT event_type, CAST(json_extract_string(props, '$.k') AS INT) % 10 AS digit, count(*) AS n,
              '{"type":"' || event_type || '"}' AS document
       FROM events GROUP BY ALL""",
)
def _(t):
    parsed = F.from_json("props", "k int")
    return t.events.groupBy("event_type", (parsed["k"] % 10).alias("digit")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "document", F.to_json(F.struct(F.col("event_type").alias("type")))
    )
