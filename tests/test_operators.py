"""Golden rows and brute-force checks of the operators."""

import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.operators import aspects, baskets, evaluate, forecast, joins, phrases, pricing, profile, sentiment
from shelfwise.plans import flows
from shelfwise.session import stage
from shelfwise.sources import html, readers, writers


def test_price_elasticity(spark):
    rows = [("A", 100.0, 100.0 - d * 100, s) for d, s in [(0.0, 10.0), (0.1, 20.0), (0.2, 30.0)]]
    rows += [("B", 100.0, 90.0, 5.0), ("C", 100.0, 90.0, 5.0), ("C", 100.0, 90.0, 7.0), (None, 100.0, 90.0, 1.0)]
    df = spark.createDataFrame(rows, "Brand string, Original_Price double, Discounted_Price double, Sales_Volume double")
    found = {r["Brand"]: r for r in pricing.price_elasticity(df).collect()}
    assert set(found) == {"A", "C"}
    a, c = found["A"], found["C"]
    assert (a.Price_Elasticity, a.Model_R2, a.Uplift_5pct, a.Uplift_5pct_Percent) == (0.5, 1.0, 5.0, 25.0)
    assert (a.Uplift_10pct, a.Uplift_10pct_Percent) == (10.0, 50.0)
    assert (c.Price_Elasticity, c.Model_R2) == (0.0, 0.0)
    assert pricing.most_elastic_brand(pricing.price_elasticity(df)).first()["brand"] == "A"
    assert pricing.price_elasticity(df.where("Brand = 'A'")).count() == 0  # too few rows in all


def test_promo_simulation(spark):
    df = spark.createDataFrame([("A", 0.5, 20.0)], "Brand string, Price_Elasticity double, Average_Sales_Volume double")
    row = pricing.promo_simulation(df).where("increment = 10").first()
    assert (row.growth_percent, row.added_sales, row.direction, row.sign) == (5.0, 1.0, "up", "+")


def test_loo_brand_mean(spark):
    rows = [("A", 10.0), ("A", 20.0), ("A", 30.0), ("B", 40.0), (None, None), ("A", None)]
    df = spark.createDataFrame(rows, "Brand string, Sales_Volume double")
    found = forecast.with_loo_mean(df).collect()
    assert sorted((r.Brand or "", r.Sales_Volume or 0, r.Sales_Volume_7d_mean) for r in found) == [
        ("", 0, 25.0), ("A", 0, 25.0), ("A", 10.0, 25.0), ("A", 20.0, 20.0), ("A", 30.0, 15.0), ("B", 40.0, 25.0),
    ]


def test_trend_flags(spark):
    df = spark.createDataFrame([(1, d, v) for d, v in enumerate([5.0, 5.0, 6.0, 4.0])], "request_id int, date int, predicted_volume double")
    assert [r.trend for r in forecast.trend_flags(df).orderBy("date").collect()] == ["flat", "down", "up", "down"]


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")
    found = {(r.metric, r.key): r.value for r in evaluate.classification_metrics(df).collect()}
    assert found["accuracy", "all"] == 0.75 and found["f1", "1"] == pytest.approx(2 / 3)
    assert found["f1", "0"] == pytest.approx(0.8) and found["f1", "macro"] == pytest.approx(0.73333, abs=1e-4)


ASPECT_CASES = {
    "pin trâu nhưng camera mờ": [("Battery/Charging", "pin trâu", 1.0), ("Camera", "camera mờ", 0.0)],
    "máy đẹp": [("Camera", "máy đẹp", 1.0), ("Design/Build", "máy đẹp", 1.0)],
    "nhân viên nhiệt tình": [("Service/Staff", "nhân viên nhiệt tình", 1.0)],
    "sạc nhanh": [("Battery/Charging", "sạc nhanh", 1.0)],
}


def reviews(spark, rows):
    return spark.createDataFrame(rows, "Product_ID string, Product_Name string, ordinal long, Review_Text string, Star_Rating string, Helpfulness_Count string")


def test_extract_aspects(spark):
    df = reviews(spark, [("p", "P", i, t, "5", "0") for i, t in enumerate(ASPECT_CASES)])
    found = aspects.extract_aspects(df).collect()
    expected = [(i, *row) for i, rows in enumerate(ASPECT_CASES.values()) for row in rows]
    assert sorted((r.ordinal, r.aspect, r.clause, r.sentiment) for r in found) == sorted(expected)


def test_aspect_summary_round_trip(spark, tmp_path):
    rows = [("p", "First", 1, "pin tốt", "5", "2"), ("p", "Second", 2, "pin yếu", "1", "x"), ("q", None, 3, "pin", None, None), (None, "N", 4, "pin", "1", "0")]
    summary = aspects.aspect_summary(reviews(spark, rows))
    path = str(tmp_path / "doc")
    writers.write_json(writers.aspect_documents(summary), path)
    found = {r.Product_ID: r for r in readers.read_aspect_documents(spark, path).collect()}
    assert (found["p"].Product_Name, found["p"].Score, found["p"].Pros, found["p"].Cons) == ("First", 0.75, ["pin tốt"], ["pin yếu"])
    assert found["q"].Score == 1.0  # missing stars count as five
    verdict = {r.Product_ID: r for r in aspects.aspect_verdict(summary).collect()}
    assert (verdict["p"].verdict, verdict["p"].quote, verdict["q"].quote) == ("strength", "pin tốt", "pin")


def rule_set(rows):
    return {(r.antecedent, r.consequent): (round(r.support, 4), round(r.confidence, 4), round(r.lift, 4)) for r in rows}


def test_association_rules(spark):
    rows = [("1", "a"), ("1", "b"), ("2", "a"), ("2", "b"), ("3", "a"), ("4", "c"), ("2", "a")]
    df = spark.createDataFrame(rows, "Transaction_ID string, Product_ID string")
    found = rule_set(baskets.cross_sell_rules(df).collect())
    assert found == {("a", "b"): (0.5, 0.6667, 1.3333), ("b", "a"): (0.5, 1.0, 1.3333)}


def test_rules_against_brute_force(spark):
    sold = {i: {c for k, c in enumerate("abcde") if (i * 7 + k * k) % (k + 2) != 0} | {"f"} for i in range(60)}
    sold[0] = set()
    rows = [(str(i), p) for i, items in sold.items() for p in items] + [("0", "z")]
    types = {p: "smartphone" if p in "ace" else "accessory" for p in "abcdefz"}
    df = spark.createDataFrame([(t, p, types[p], n) for n, (t, p) in enumerate(rows)], "Transaction_ID string, Product_ID string, Product_Type string, ordinal long")
    n = len(sold)

    def support(items):
        return sum(set(items) <= s for s in sold.values()) / n

    expected = {}
    for size in range(2, 7):
        for whole in combinations("abcdef", size):
            if support(whole) < 0.1:
                continue
            for k in range(1, size):
                for left in combinations(whole, k):
                    right = tuple(x for x in whole if x not in left)
                    confidence = support(whole) / support(left)
                    lift = confidence / support(right)
                    typed = set(left) & set("ace") and set(right) & set("bdf")
                    if confidence >= 0.4 and lift >= 1.01 and typed:
                        expected[",".join(left), ",".join(right)] = (round(support(whole), 4), round(confidence, 4), round(lift, 4))
    found = rule_set(baskets.cross_sell_rules(df, 0.1, 0.4, 1.01).collect())
    assert expected and any("," in c for _, c in expected)
    assert found == expected


def test_cross_sell_lookup(spark):
    rules = spark.createDataFrame([("a, b", "c", 0.5, 2.0), ("b", "c", 0.5, 2.0)], "antecedent string, consequent string, confidence double, lift double")
    asked = spark.createDataFrame([("b",), ("x",)], "Product_ID string")
    assert [r.accessory_id for r in joins.cross_sell_lookup(asked, rules).collect()] == ["c", "c"]


def greedy(tokens, listed):
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in listed:
            out.append(f"{tokens[i]}_{tokens[i + 1]}")
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return " ".join(out)


def test_segment_phrases(spark):
    texts = ["a b a b c", "a a b", "b a b a b b", "", "c", "a b", "x a b y b c a"]
    listed = {("a", "b"), ("b", "a"), ("b", "c")}
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    pairs = spark.createDataFrame(list(listed), "first string, second string")
    found = {r.id: r.segmented for r in phrases.segment_phrases(docs, pairs, "id", "t").collect()}
    assert found == {i: greedy(t.split(), listed) for i, t in enumerate(texts)}


@pytest.mark.parametrize("most", [0, phrases.MOST_PHRASES])
def test_segmented_texts_move_no_words(spark, monkeypatch, most):
    monkeypatch.setattr(phrases, "MOST_PHRASES", most)
    texts = ["a b a b c", "a a b", "b a b a b b", "", None, "c", "x a b y b c a", "a a"]
    keys = [1, 2, None, 4, 5, 6, 7, 8]
    listed = {("a", "b"), ("b", "a"), ("b", "c")}
    docs = spark.createDataFrame(list(zip(keys, texts)), "id long, t string")
    pairs = spark.createDataFrame(list(listed), "first string, second string")
    found = phrases.segment_phrases(docs, pairs, "id", "t")
    assert {r.id: r.segmented for r in found.collect()} == {k: greedy((t or "").split(), listed) for k, t in zip(keys, texts)}
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    twice = {r.id: r.segmented for r in phrases.segment_phrases(docs.union(docs.where("id = 8")), pairs, "id", "t").collect()}
    assert twice.pop(8) == "a a a a" and len(twice) == len(keys) - 1


def test_words_counted_by_key_move_no_words(spark):
    docs = spark.createDataFrame([(1, "a it a"), (2, "it b"), (1, "a"), (None, "c c"), (3, None)], "id long, t string")
    entries = stage(spark.createDataFrame([("it", "the")], "token string, replacement string"), "entries")
    words = joins.dictionary_join(joins.dealt_by_key(docs, "id", "t"), entries, "id", "t")
    counted = words.groupBy("id", "token", "replacement").agg(F.count("*").alias("n"))
    assert sorted((r.id or 0, r.token, r.replacement, r.n) for r in counted.collect()) == [
        (0, "c", "c", 2), (1, "a", "a", 3), (1, "it", "the", 1), (2, "b", "b", 1), (2, "it", "the", 1),
    ]
    assert not re.search(r"hashpartitioning\([^()]*token", counted._jdf.queryExecution().executedPlan().toString())


def test_onehot_holds_bits(spark):
    items = [f"i{k}" for k in range(130)]
    rows = [("x", "i0"), ("x", "i62"), ("x", "i62"), ("x", "i63"), ("y", "i129"), ("y", "other"), ("z", "other"), ("n", None), (None, "i5")]
    found = baskets.basket_onehot(spark.createDataFrame(rows, "Transaction_ID string, Product_ID string"), items)
    assert found.columns == ["Transaction_ID", *items] and {t for _, t in found.dtypes[1:]} == {"int"}
    marked = {r[0]: [c for c, v in zip(found.columns[1:], r[1:]) if v] for r in found.collect()}
    assert marked == {"x": ["i0", "i62", "i63"], "y": ["i129"], "z": [], "n": [], None: ["i5"]}
    assert "pivotfirst" not in found._jdf.queryExecution().executedPlan().toString()


def test_label_reviews_keeps_first(spark):
    rows = [("p", "P", 3, "Tốt!", "5", "0"), ("p", "P", 1, "tốt || note", "4", "0"), ("p", "P", 2, "tốt", "1", "0"), ("p", "P", 4, "!!", "5", "0"), ("p", "P", 5, "x", None, "0")]
    found = flows.label_reviews(reviews(spark, rows)).orderBy("ordinal").collect()
    assert [(r.ordinal, r.label, r.Review_Text_NoNoise, r.Review_Text_Clean) for r in found] == [(1, 2, "tốt", "tốt"), (2, 0, "tốt", "tốt")]


def test_augmentation_sizes(spark):
    counted = {r.label: r["count"] for r in sentiment.default_augmentation(spark).groupBy("label").count().collect()}
    assert counted == {0: 300, 2: 100, 1: 250 + 95}


def test_sampled_sentences(spark):
    numbers = spark.range(64).select(sentiment.permuted(F.col("id"), 3, "k").alias("p")).collect()
    assert sorted(r.p for r in numbers) == list(range(64)) != [r.p for r in numbers]
    subjects = spark.createDataFrame([("a ",), ("b ",), ("b ",), (None,)], "s string")
    lists = [["x", "x ", "y"], [" p", " q", ""]]
    product = {(a + b + c).strip() for a in ("a ", "b ") for b in lists[0] for c in lists[1]}

    def drawn(n, key="k"):
        return [r.text for r in sentiment.sample_sentences(subjects, lists, F.concat, 1, n, key).collect()]

    assert set(drawn(100)) == product and len(drawn(100)) == len(product)
    for n in (1, 5, len(product)):  # a smaller sample is the start of a larger one
        assert len(drawn(n)) == n and set(drawn(n)) <= set(drawn(100)) and set(drawn(1)) <= set(drawn(n))
    assert drawn(5) != drawn(5, "other")
    assert sentiment.sample_sentences(subjects.limit(0), lists, F.concat, 1, 5, "k").count() == 0


CARD = """<ul><li class="item"><a class="main-contain" href="/dtdd/x-1" data-name="X 1 8GB/128GB" data-brand="BrandX">
<strong class="price">4.690.000₫</strong><p class="price-old">4.890.000₫</p>
<div class="rating_Compare"><div class="vote-txt"><i/><b>4.9</b></div><span>Đã bán 65,5k</span></div></a></li>
<li class="item"><a href="https://other.example/y/"><h3>some thing</h3></a></li><li class="item">no link</li></ul>"""
NODES = """<ul><li class="par"><div class="cmt-top-star"><i class="iconcmt-starbuy"></i><i class="iconcmt-starbuy"></i></div>
<div class="cmt-content"><p class="cmt-txt">pin yếu</p></div><div class="support">liên hệ ngày 30/05/2026</div>
<a href="javascript:likeRating(77)">Hữu ích (12)</a></li>
<li class="par"><div class="cmt-top-star"><i class="iconcmt-starbuy"></i></div></li><li class="par"><b>x</b></li></ul>"""


def test_catalog_cards(spark):
    pages = spark.createDataFrame([(1, "smartphone", CARD), (2, "smartphone", CARD), (3, "c", None)], "page_id long, category string, html string")
    cards = html.parse_catalog(pages, "https://shop.example")
    fresh = joins.new_products(cards, spark.createDataFrame([("https://other.example/y/",)], "Product_URL string"))
    assert cards.count() == 4
    row = fresh.collect()
    assert len(row) == 1 and row[0].page_id == 1
    assert tuple(row[0][c] for c in readers.PRODUCT_FIELDS) == (
        "x-1", "X 1 8GB/128GB", "BrandX", "smartphone", "4890000", "4690000", "standard", "65500", "4.9", "", "https://shop.example/dtdd/x-1",
    )
    second = cards.where("position = 1").first()
    assert (second.Product_ID, second.Brand, second.Product_URL) == ("y", "Some", "https://other.example/y/")


def test_review_nodes(spark):
    pages = spark.createDataFrame([(1, "p", "P", NODES)], "page_id long, product_id string, product_name string, html string")
    found = html.parse_reviews(pages).orderBy("position").collect()
    assert tuple(found[0][c] for c in readers.REVIEW_FIELDS) == (
        "review-77", "p", "P", "30/05/2026", "2", "pin yếu || liên hệ ngày 30/05/2026", "12", "1", "vi",
    )
    assert len(found) == 2 and (found[1].Star_Rating, found[1].Review_Text) == ("1", "")
    again = html.parse_reviews(pages).orderBy("position").collect()
    assert [r.Review_ID for r in again] == [r.Review_ID for r in found]


def test_merge_and_caps(spark):
    one = spark.createDataFrame([("r1", "p", 2), ("r2", "p", 1)], "Review_ID string, Product_ID string, ordinal long")
    two = spark.createDataFrame([("r1", "p", 0), ("r3", "p", 9)], "Review_ID string, Product_ID string, ordinal long")
    merged = joins.merge_reviews([one, two])
    assert sorted((r.Review_ID, r.ordinal) for r in merged.collect()) == [("r1", 2), ("r2", 1), ("r3", 9)]
    assert sorted(r.Review_ID for r in joins.cap_reviews(merged.drop("source"), 2).collect()) == ["r1", "r2"]


def test_validation(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="b"):
        readers.require_columns(df, ["A", "b"])
    with pytest.raises(ValueError, match="only 1"):
        readers.require_rows(df, 2)
    assert tuple(readers.validation_report(df, ["a", "b"], 1).first()) == ("b", True, False)
    with pytest.raises(FileNotFoundError):
        readers.first_existing(spark, ["/nowhere/a", "/nowhere/b"])


def test_csv_with_mark_and_line_breaks(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('﻿Product_ID,Name\n1,"a ""q""\nb"\n2,c\n', encoding="utf-8")
    found = readers.read_csv(spark, str(path), readers.text_schema(["Product_ID", "Name"])).collect()
    assert [tuple(r) for r in found] == [("1", 'a "q"\nb'), ("2", "c")]


def test_locale_order(spark):
    names = ["zed", "Điện", "da", "ân", "ăn", "An"]
    df = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "Product_ID string, Name string")
    ranked = profile.compare_sort(df, "name").orderBy("rank").collect()
    assert [r.Name for r in ranked] == ["An", "ăn", "ân", "da", "Điện", "zed"]


def test_operators_stay_in_the_jvm(spark):
    df = reviews(spark, [("p", "P", 1, "pin tốt", "5", "2")])
    for plan in [aspects.extract_aspects(df), flows.label_reviews(df), flows.clean_reviews(df)]:
        shown = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in shown and "CartesianProduct" not in shown and "NestedLoop" not in shown
    assert lexicon.SHORTHAND["k"] == "không"


def test_deep_and_unclosed_pages(spark):
    card = '<li class="item"><a class="main-contain" href="/p/{0}" data-name="n{0}" data-brand="b"></a>{1}'
    listing = "<ul>" + card.format(1, "") + card.format(2, '<strong class="price">900</strong>') + "</ul>"
    assert [(c["href"], c["price"]) for c in html.catalog_cards(listing)] == [("/p/1", ""), ("/p/2", "900")]
    assert html.read_html("<font>" * 5000 + "x").text() == "x"
    assert html.catalog_cards("<div>" * 5000 + listing)[1]["price"] == "900"


def test_paragraphs(spark):
    page = "<p><b>a &amp; b</b> c<p class='x'>d<br>e</p>loose<div><p>f</div>g<script>'<p>no</p>'</script><p> </p><pre>h</pre><P>i"
    (row,) = spark.createDataFrame([(page,)], "h string").select(html.paragraphs(F.col("h")).alias("p")).collect()
    assert row.p == ["a & b c", "d e", "f", "i"]


def test_rules_of_long_itemsets(spark):
    tx = [set("abcdef")] * 3 + [set("abcd")] * 2 + [set("ab"), set("c"), set("def"), set("x,y")] * 2
    df = spark.createDataFrame([(f"t{i}", p) for i, t in enumerate(tx) for p in t], "Transaction_ID string, Product_ID string")
    support = lambda s: sum(set(s) <= t for t in tx) / len(tx)
    expected = set()
    for n in range(2, 7):
        for items in combinations("abcdef", n):
            for k in range(1, n):
                for left in combinations(items, k):
                    right = tuple(x for x in items if x not in left)
                    confidence = support(items) / support(left)
                    if support(items) >= 0.15 and confidence >= 0.7 and confidence / support(right) >= 1.1:
                        expected.add((left, right, round(confidence, 6)))
    found = baskets.rule_arrays(baskets.frequent_itemsets(df, 0.15), 0.7, 1.1).where(~F.array_contains("a", "x") & ~F.array_contains("c", "x"))
    found = [r for r in found.collect() if not set("xy,") & set(r.a + r.c)]
    assert {(tuple(r.a), tuple(r.c), round(r.confidence, 6)) for r in found} == expected


@pytest.mark.parametrize("listed", [True, False])
def test_itemsets_of_odd_baskets(spark, monkeypatch, listed):
    if not listed:
        monkeypatch.setattr(baskets, "few_items", lambda df: None)
    tx = {"1": "abc", "2": "abc", "3": "ab", "4": "c", "5": "d", "6": "", None: "bc"}
    rows = [(t, p) for t, items in tx.items() for p in items or [None]]
    df = spark.createDataFrame(rows + rows[:4] + [("3", None)], "Transaction_ID string, Product_ID string")
    n, least = 6, 2  # rows without a transaction are a basket, but not one of all
    expected = set()
    for size in range(1, 4):
        for items in combinations("abcd", size):
            freq = sum(set(items) <= set(t) for t in tx.values())
            if freq >= least:
                expected.add((items, freq, round(freq / n, 9)))
    found = baskets.frequent_itemsets(df, 0.25)
    assert found.schema.simpleString() == "struct<items:array<string>,freq:bigint,support:double>"
    assert {(tuple(r["items"]), r.freq, round(r.support, 9)) for r in found.collect()} == expected
    assert baskets.frequent_itemsets(df.limit(0), 0.25).count() == 0


def test_baskets_alike_are_mined_as_one_row(spark, monkeypatch):
    rows = {}

    def counted(df, name="stage", even=False):
        rows[name] = (out := stage(df, name, even)).count()
        return out

    monkeypatch.setattr(baskets, "stage", counted)
    df = spark.createDataFrame([(f"t{i}", p) for i in range(300) for p in "abc"], "Transaction_ID string, Product_ID string")
    assert baskets.frequent_itemsets(df, 0.5).count() == 7
    assert [rows.get(f"grown_{k}") for k in (1, 2, 3)] == [3, 3, 1]
