"""SQL texts that several queries share."""

from __future__ import annotations

from shelfwise.sources.tables import ASPECTS, DICTIONARY

BLANK = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
FILLED = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
EDGE = r"[^\p{L}\p{N}_]"


def number_sql(x: str) -> str:
    """``x`` as a number the way shops write it."""
    t = f"lower(trim(CAST({x} AS VARCHAR)))"
    b = rf"ltrim(regexp_replace({t}, '[^0-9.,-]', '', 'g'), '-')"
    raw = rf"regexp_replace({t}, '[^0-9.,-]', '', 'g')"
    return rf"""CASE WHEN {t} IN ('', 'nan', 'none', 'unknown') THEN NULL ELSE
        (CASE WHEN {raw} LIKE '-%' THEN -1.0 ELSE 1.0 END)
        * TRY_CAST(CASE
            WHEN {b} LIKE '%.%' AND {b} LIKE '%,%' THEN
                CASE WHEN instr(reverse({b}), ',') < instr(reverse({b}), '.')
                     THEN replace(replace({b}, '.', ''), ',', '.') ELSE replace({b}, ',', '') END
            WHEN len(string_split_regex({b}, '[.,]')) > 2
                 OR (len(string_split_regex({b}, '[.,]')) = 2
                     AND length(string_split_regex({b}, '[.,]')[2]) = 3
                     AND length(string_split_regex({b}, '[.,]')[1]) > 1)
                THEN replace(replace({b}, '.', ''), ',', '')
            ELSE replace({b}, ',', '.') END AS DOUBLE)
        * (CASE WHEN {t} LIKE '%triệu%' OR {t} LIKE '%trieu%'
                     OR regexp_matches({t}, '[0-9]\s*m($|{EDGE})') THEN 1000000.0
                WHEN {t} LIKE '%nghìn%' OR {t} LIKE '%ngan%'
                     OR regexp_matches({t}, '[0-9]\s*k($|{EDGE})') THEN 1000.0 ELSE 1.0 END) END"""


def words_sql(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{BLANK}+'), lambda w: w <> '')"


def translate_sql(words: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DICTIONARY.items())
    return f"list_transform({words}, lambda w: CASE w {cases} ELSE w END)"


def clean_sql(x: str) -> str:
    t = f"lower(coalesce({x}, ''))"
    t = f"regexp_replace({t}, '<[^>]+>', ' ', 'g')"
    t = rf"regexp_replace({t}, 'https?://{FILLED}+|www\.{FILLED}+', ' ', 'g')"
    t = rf"regexp_replace({t}, '[^0-9a-zA-ZÀ-ỹ\s]', ' ', 'g')"
    return f"array_to_string({translate_sql(words_sql(t))}, ' ')"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def note_free_sql(x: str) -> str:
    return strip_sql(f"string_split(coalesce({x}, ''), '||')[1]")


def has_word(x: str, words) -> str:
    return f"regexp_matches({x}, '(^|{EDGE})({'|'.join(words)})($|{EDGE})')"


def clauses_sql(source: str, body: str) -> str:
    """``clauses`` view: one row per clause of three or more characters.

    Two passes over the separator word, as neighbours share their blank.
    """
    once = rf"regexp_replace(lower({body}), '(^|{EDGE})to($|{EDGE})', '\1.\2', 'g')"
    cut = rf"regexp_replace({once}, '(^|{EDGE})to($|{EDGE})', '\1.\2', 'g')"
    return rf"""clause_lists AS (
        SELECT Product_ID, ordinal, coalesce(TRY_CAST(Star_Rating AS DOUBLE), 5) AS stars,
               1 + CAST(coalesce(TRY_CAST(Helpfulness_Count AS DOUBLE), 0) AS BIGINT) AS weight,
               list_filter(list_transform(string_split_regex({cut}, '[,.]'),
                   lambda c: {strip_sql('c')}), lambda c: length(c) >= 3) AS parts
        FROM {source}),
    clauses AS (
        SELECT Product_ID, ordinal, stars, weight, unnest(parts) AS clause,
               generate_subscripts(parts, 1) - 1 AS place FROM clause_lists)"""


def aspects_sql(source: str, body: str) -> str:
    """``aspects`` view: clause, aspect and sentiment."""
    hits = []
    for aspect, words in ASPECTS.keywords.items():
        veto = "".join(f" AND NOT contains(clause, '{v}')" for v in ASPECTS.vetoes.get(aspect, ()))
        hits.append(f"SELECT *, '{aspect}' AS aspect FROM clauses WHERE {has_word('clause', words)}{veto}")
    good, bad = has_word("clause", ASPECTS.positive), has_word("clause", ASPECTS.negative)
    return f"""{clauses_sql(source, body)},
    matched AS ({' UNION ALL '.join(hits)}),
    aspects AS (
        SELECT *, CAST(CASE WHEN {bad} AND NOT {good} THEN 0 WHEN {good} AND NOT {bad} THEN 1
                       WHEN stars >= 4 THEN 1 WHEN stars <= 2 THEN 0 ELSE 0.5 END AS DOUBLE) AS sentiment
        FROM matched)"""


SCORES = """scores AS (
    SELECT Product_ID, aspect AS Aspect, round_even(sum(sentiment * weight) / sum(weight), 2) AS Score,
           count(*) AS clauses FROM aspects GROUP BY ALL)"""
SAMPLES = """samples AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY Product_ID, aspect, sentiment ORDER BY first) AS position FROM (
            SELECT Product_ID, aspect, sentiment, clause, min(ordinal * 100000000 + place) AS first
            FROM aspects WHERE sentiment <> 0.5 GROUP BY Product_ID, aspect, sentiment, clause)) WHERE position <= 5),
    lists AS (
        SELECT Product_ID, aspect AS Aspect,
               coalesce(string_agg(CASE WHEN sentiment = 1 THEN clause END, ' | ' ORDER BY position), '') AS Pros,
               coalesce(string_agg(CASE WHEN sentiment = 0 THEN clause END, ' | ' ORDER BY position), '') AS Cons,
               max(CASE WHEN sentiment = 1 AND position = 1 THEN clause END) AS pro,
               max(CASE WHEN sentiment = 0 AND position = 1 THEN clause END) AS con
        FROM samples GROUP BY ALL)"""
NAMES = """names AS (
    SELECT Product_ID, arg_min_null(Product_Name, ordinal) AS Product_Name FROM reviews GROUP BY ALL)"""

ELASTICITY = """valid AS (
    SELECT *, greatest(0, least(1, coalesce((Original_Price - Discounted_Price) / nullif(Original_Price, 0), 0)))
        AS Discount_Rate
    FROM products WHERE Original_Price > 0 AND Sales_Volume > 0),
fitted AS (
    SELECT Brand, count(*) AS n, avg(Original_Price) AS price, avg(Discount_Rate) AS rate,
           avg(Sales_Volume) AS sales,
           CASE WHEN var_pop(Discount_Rate) = 0 THEN 0 ELSE regr_slope(Sales_Volume, Discount_Rate) END AS beta,
           CASE WHEN var_pop(Sales_Volume) = 0 THEN 1 WHEN var_pop(Discount_Rate) = 0 THEN 0
                ELSE regr_r2(Sales_Volume, Discount_Rate) END AS r2
    FROM valid GROUP BY Brand HAVING count(*) >= 2),
elasticity AS (
    SELECT Brand, n AS Product_Count, round_even(price, 2) AS Average_Original_Price,
           round_even(rate, 4) AS Average_Discount_Rate, round_even(sales, 2) AS Average_Sales_Volume,
           round_even(r2, 4) AS Model_R2,
           round_even(CASE WHEN rate > 0 THEN beta * rate / sales ELSE beta / sales END, 4) AS Price_Elasticity,
           round_even(greatest(0, beta * 0.05), 2) AS Uplift_5pct,
           round_even(greatest(0, beta * 0.05) / sales * 100, 2) AS Uplift_5pct_Percent,
           round_even(greatest(0, beta * 0.1), 2) AS Uplift_10pct,
           round_even(greatest(0, beta * 0.1) / sales * 100, 2) AS Uplift_10pct_Percent
    FROM fitted WHERE (SELECT count(*) FROM valid) >= 5)"""


def specs_sql(name: str, price: str) -> dict[str, str]:
    t = f"lower({name})"
    pair = r"'([0-9]+)\s*g[b]?\s*[-/]\s*([0-9]+)\s*(g[b]?|t[b]?)'"
    single = rf"""coalesce(
        CAST(nullif(regexp_extract({t}, '([0-9]+)\s*t', 1), '') AS DOUBLE) * 1024,
        CAST(nullif(regexp_extract({t}, '([0-9]+)\s*gb?(?:\s*[^\s/]|\s*$)', 1), '') AS DOUBLE), 128)"""
    is_pair, iphone = f"regexp_matches({t}, {pair})", f"{t} LIKE '%iphone%'"
    basic = f"regexp_matches({t}, 'nokia 105|izi|fami|masstel|nokia 110')"
    return {
        "RAM": rf"""CASE WHEN {basic} THEN 0.048
            WHEN {iphone} AND regexp_matches({t}, '17|16') THEN 8
            WHEN {iphone} AND {t} LIKE '%15%' THEN CASE WHEN {t} LIKE '%pro%' THEN 8 ELSE 6 END
            WHEN {iphone} AND {t} LIKE '%14%' THEN 6 WHEN {iphone} THEN 4
            WHEN {is_pair} THEN CAST(regexp_extract({t}, {pair}, 1) AS DOUBLE)
            WHEN {single} >= 512 THEN 12 WHEN {single} >= 256 THEN 8
            WHEN {single} >= 128 THEN 6 WHEN {single} >= 64 THEN 4 ELSE 2 END""",
        "ROM": rf"""CASE WHEN {basic} THEN 0.128 WHEN {is_pair}
            THEN CAST(regexp_extract({t}, {pair}, 2) AS DOUBLE)
                 * CASE WHEN regexp_extract({t}, {pair}, 3) LIKE 't%' THEN 1024 ELSE 1 END
            ELSE {single} END""",
        "Battery": f"""CASE WHEN {basic} THEN 1000 WHEN regexp_matches({t}, 'power|neo') THEN 6000
            WHEN {iphone} AND regexp_matches({t}, 'max|plus') THEN 4400 WHEN {iphone} THEN 3200
            ELSE 5000 END""",
        "Camera_MP": f"""CASE WHEN {basic} THEN 0.3
            WHEN regexp_matches({t}, 'pro|ultra') THEN CASE WHEN {t} LIKE '%samsung%' THEN 108 ELSE 50 END
            WHEN {iphone} THEN 48 WHEN {price} > 7000000 THEN 50 ELSE 13 END""",
    }


def spec_columns(name: str = "Name", price: str = "Discounted_Price") -> str:
    return ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in specs_sql(name, price).items())


def calendar_sql(date: str) -> str:
    return f"""CAST(coalesce(isodow({date}) - 1, 0) AS INT) AS Day_of_Week,
        CAST(coalesce(isodow({date}) - 1, 0) >= 5 AS INT) AS Is_Weekend,
        CAST(coalesce(strftime({date}, '%m-%d') IN ('01-01', '04-30', '05-01', '09-02'), false) AS INT) AS Is_Holiday"""


def segment_sql(price: str, ram: str) -> str:
    return f"""CASE WHEN {price} < 1500000 THEN 'Điện thoại giá rẻ - Phổ thông cơ bản'
        WHEN {price} < 6000000 THEN CASE WHEN {ram} >= 6 THEN 'Tầm trung - Cấu hình tốt & Pin khoẻ'
            ELSE 'Tầm trung - Tiết kiệm & Đủ dùng' END
        WHEN {price} < 15000000 THEN CASE WHEN {ram} >= 8 THEN 'Cận cao cấp - Hiệu năng & Đa năng'
            ELSE 'Cận cao cấp - Thiết kế & Đủ dùng' END
        ELSE 'Cao cấp - Siêu phẩm công nghệ' END"""


def label_three_sql(stars: str) -> str:
    s = f"TRY_CAST({stars} AS DOUBLE)"
    return f"CASE WHEN {s} IS NULL THEN NULL WHEN {s} <= 2 THEN 0 WHEN {s} = 3 THEN 1 ELSE 2 END"


LABEL_NAME = "CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END"


def rules_sql(support: float, confidence: float, lift: float) -> str:
    """Itemsets of any length and every rule between their parts; needs ``WITH RECURSIVE``."""
    return f"""items AS (SELECT DISTINCT Transaction_ID, Product_ID FROM baskets),
    total AS (SELECT count(DISTINCT Transaction_ID) AS n FROM baskets),
    one AS (SELECT Product_ID AS a FROM items, total GROUP BY 1 HAVING count(*) >= {support} * any_value(n)),
    kept AS (SELECT * FROM items WHERE Product_ID IN (SELECT a FROM one)),
    parts AS (SELECT Transaction_ID, [Product_ID] AS part, Product_ID AS last FROM kept
              UNION ALL SELECT p.Transaction_ID, list_append(part, k.Product_ID), k.Product_ID
              FROM parts p JOIN kept k ON k.Transaction_ID = p.Transaction_ID AND k.Product_ID > p.last),
    lists AS (SELECT part, count(*) / any_value(n) AS support, count(*) AS freq FROM parts, total
              GROUP BY part HAVING count(*) >= {support} * any_value(n)),
    sets AS (SELECT array_to_string(part, ',') AS items, support, freq FROM lists),
    splits AS (
        SELECT array_to_string(l.part, ',') AS antecedent, s.support, l.support AS left_support,
               array_to_string(list_filter(s.part, lambda x: NOT list_contains(l.part, x)), ',') AS consequent
        FROM lists s JOIN lists l ON len(l.part) < len(s.part) AND list_has_all(s.part, l.part)),
    rules AS (
        SELECT antecedent, consequent, s.support, s.support / left_support AS confidence,
               s.support / left_support / r.support AS lift
        FROM splits s JOIN sets r ON r.items = consequent
        WHERE s.support / left_support >= {confidence} AND s.support / left_support / r.support >= {lift})"""


def phrases_sql(source: str, column: str) -> str:
    """``phrases``: neighbouring words of ``source`` that occur together far more often than alone."""
    return f"""pairs AS (
        SELECT w[i] AS first, w[i + 1] AS second, count(*) AS n
        FROM (SELECT w, unnest(range(1, len(w))) AS i FROM (SELECT {words_sql(column)} AS w FROM {source})) GROUP BY 1, 2),
    f AS (SELECT first, sum(n) AS nf FROM pairs GROUP BY 1), s AS (SELECT second, sum(n) AS ns FROM pairs GROUP BY 1),
    total AS (SELECT sum(n) AS t FROM pairs),
    phrases AS (SELECT * FROM (
        SELECT first, second, n, ln(n * t / (CAST(nf AS DOUBLE) * ns)) / -ln(n / t) AS npmi
        FROM pairs JOIN f USING (first) JOIN s USING (second), total WHERE n >= 20) WHERE npmi >= 0.3)"""


def segmented_sql(source: str, key: str, column: str) -> str:
    """``segmented``: texts with listed pairs joined, in a run of them every other one from the first on."""
    return f"""{phrases_sql(source, column)},
    listed_words AS (SELECT {key} AS id, {words_sql(column)} AS w FROM {source}),
    placed AS (SELECT id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS first, unnest(list_append(w[2:], NULL)) AS second FROM listed_words),
    marked AS (SELECT id, i, placed.first AS word, phrases.n IS NOT NULL AS listed
        FROM placed LEFT JOIN phrases ON phrases.first = placed.first AND phrases.second = placed.second),
    broken AS (SELECT *, sum(CASE WHEN listed THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY i) AS run FROM marked),
    turns AS (SELECT *, listed AND sum(CAST(listed AS INT)) OVER (PARTITION BY id, run ORDER BY i) % 2 = 1 AS joins FROM broken),
    glued AS (SELECT *, CASE WHEN lag(joins, 1, false) OVER (PARTITION BY id ORDER BY i) THEN '_' ELSE ' ' END || word AS piece FROM turns),
    segmented AS (SELECT id, trim(string_agg(piece, '' ORDER BY i)) AS segmented FROM glued GROUP BY id)"""
