"""Golden rows of the column expressions."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions import catalog, numeric, text
from shelfwise.operators.cleaning import with_parsed, with_specs


def apply(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v")).alias("out")).collect()]


NUMBERS = {
    "37990000": 37990000.0, "243,4k": 243400.0, "1.500": 1.5, "15.000": 15000.0, "12,5": 12.5,
    "1.234.567": 1234567.0, "1,234.5": 1234.5, "1.234,5": 1234.5, "5 triệu": 5e6, "10 nghìn": 1e4,
    "-3": -3.0, "--3": -3.0, "12mp": 12.0, "8m": 8e6, "5000mah": 5000.0, "unknown": None, "": None,
    "-": None, "10-20": None, ".": None, "-12.500": -12500.0, "-1.500": -1.5, "1.2,3,4": None,
    "1,2.3.4": None, "5.": 5.0, ".5": 0.5, "1,234": 1.234, None: None,
}


def test_parse_number(spark):
    assert apply(spark, list(NUMBERS), numeric.parse_number) == list(NUMBERS.values())
    df = spark.createDataFrame([(i, v) for i, v in enumerate(NUMBERS)], "i int, v string")
    parsed = with_parsed(df, ["v", "absent"]).orderBy("i").collect()
    assert [r["v"] for r in parsed] == list(NUMBERS.values())


def test_parse_compact_count(spark):
    cases = {"Đã bán 243,4k": "243400", "Đã bán 179": "179", "2m": "2000000", "1,5": "15", "": "", "none": ""}
    assert apply(spark, list(cases), numeric.parse_compact_count) == list(cases.values())


def test_coerce(spark):
    cases = {"1.5": 1.5, "x": None, "1d": None, "nan": None, None: None, "-2": -2.0}
    assert apply(spark, list(cases), numeric.coerce_double) == list(cases.values())


def test_discount_rate(spark):
    rows = [(100.0, 90.0), (0.0, 5.0), (100.0, 120.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "o double, d double")
    found = [r[0] for r in df.select(numeric.discount_rate(F.col("o"), F.col("d"))).collect()]
    assert found == pytest.approx([0.1, 0.0, 0.0, 0.0])


SPECS = [
    ("iPhone 17 Pro Max 256GB", 36990000.0, (8, 256, 4400, 50)),
    ("iPhone 17 256GB", 23990000.0, (8, 256, 3200, 48)),
    ("Samsung Galaxy A17 4GB/128GB", 4690000.0, (4, 128, 5000, 13)),
    ("Samsung Galaxy S26 Ultra 5G 12GB/256GB", None, (12, 256, 5000, 108)),
    ("Motorola G06 POWER 4GB/128GB", 2990000.0, (4, 128, 6000, 13)),
    ("Nokia 105 4G Pro", 750000.0, (0.048, 0.128, 1000, 0.3)),
    ("Nokia HMD 105 4G", 700000.0, (2, 4, 5000, 13)),
    ("OPPO 8GB/1TB", 9e6, (8, 1024, 5000, 50)),
]


def test_extract_specs(spark):
    df = spark.createDataFrame([s[:2] for s in SPECS], "Name string, Discounted_Price double")
    found = with_specs(df).collect()
    assert [(r.RAM, r.ROM, r.Battery, r.Camera_MP) for r in found] == [s[2] for s in SPECS]


def test_calendar(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-06",), ("2024-04-30",), ("bad",)], "d string")
    found = df.withColumns(catalog.calendar(catalog.read_date(F.col("d")))).drop("d").collect()
    assert [tuple(r) for r in found] == [(0, 0, 1), (5, 1, 0), (1, 0, 1), (0, 0, 0)]


def test_labels(spark):
    stars = ["1", "2", "3", "4", "5", "2.5", "good", None]
    assert apply(spark, stars, catalog.label_three) == [0, 0, 1, 2, 2, 2, None, None]
    assert apply(spark, stars, catalog.label_binary) == [0, 0, None, 1, 1, None, None, None]


def test_segment(spark):
    rows = [(1e6, 4.0), (3e6, 6.0), (3e6, 4.0), (1e7, 8.0), (1e7, 6.0), (2e7, 1.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "p double, r double")
    found = [r[0] for r in df.select(catalog.segment(F.col("p"), F.col("r"))).collect()]
    names = lexicon.SEGMENTS
    keys = ["basic", "mid_strong", "mid_saver", "upper_power", "upper_design", "premium", "premium"]
    assert found == [names[k] for k in keys]


def test_clean_text(spark):
    def clean(c):
        return text.clean_text(c, lexicon.SHORTHAND)

    cases = {
        "Máy xài OK!! <b>pin</b> k tốt 😀 http://a.vn": "máy dùng ok pin không tốt",
        "  ": "", None: "", "màn  đẹp lắm": "màn hình đẹp lắm",
    }
    assert apply(spark, list(cases), clean) == list(cases.values())


def test_signs_and_blanks_part_words(spark):
    """Also without a test of range after range for every character."""
    signs = [chr(n) for n in [*range(0xC0), 0x1680, 0x1EFA, 0x2003, 0x3042, 0x1F600] if not (chr(n).isascii() and chr(n).isalnum())]
    found = apply(spark, [f"a{s}b" for s in signs], lambda c: text.clean_text(c, {}))
    assert found == ["a b"] * len(signs)
    assert apply(spark, ["À×ỹ ß9"], lambda c: text.clean_text(c, {})) == ["à×ỹ ß9"]
    assert r"\s" not in text.BETWEEN_WORDS and "[^" not in text.BETWEEN_WORDS


def test_different_words_have_all_runs(spark):
    once, whole = ({*apply(spark, ["ab abc ab  b"], f)[0]} for f in (lambda c: text.char_ngrams(text.each_once(c)), text.char_ngrams))
    assert once == whole and apply(spark, ["ab abc ab  b", "", None], text.each_once) == ["ab abc b", "", None]


def test_one_letter_words_are_no_terms(spark):
    assert apply(spark, ["ở a bc d", "a", "ab c đe"], text.word_ngrams) == [["bc"], [], ["ab", "đe", "ab đe"]]


def test_dictionary_of_any_size(spark):
    words = {f"k{i}": f"v{i}" for i in range(5000)}
    assert apply(spark, ["k1 k4999 x k5000"], lambda c: text.clean_text(c, words)) == ["v1 v4999 x k5000"]


def test_shop_names_are_a_parameter(spark):
    words = lexicon.shorthand({"abc": "a big company"})
    assert apply(spark, ["ABC k"], lambda c: text.clean_text(c, words)) == ["a big company không"]


def test_translate_keeps_punctuation(spark):
    def spelled(c):
        return text.translate_shorthand(c, lexicon.SHORTHAND)

    assert apply(spark, ['Máy "ko" tốt, sp!!', ""], spelled) == ['máy "không" tốt, sản phẩm!!', ""]


def test_support_note(spark):
    cases = {"tốt || Bộ phận hỗ trợ": "tốt", "a": "a", None: ""}
    assert apply(spark, list(cases), text.strip_support_note) == list(cases.values())


def test_dates_and_helpful(spark):
    assert str(apply(spark, ["ngày 30/05/2026 x"], text.first_date)[0]) == "2026-05-30"
    assert apply(spark, ["Hữu ích (12)", "12 Hữu ích", "x", None], text.helpful_count) == ["12", "12", "0", "0"]


words = st.lists(st.text("abđ", min_size=1, max_size=7), max_size=8)


@settings(max_examples=15, deadline=None)
@given(words)
def test_ngrams_against_loops(spark, tokens):
    body = " ".join(tokens)
    terms = [t for t in tokens if len(t) > 1]
    pairs = terms + [" ".join(p) for p in zip(terms, terms[1:])]
    assert sorted(apply(spark, [body], text.word_ngrams)[0]) == sorted(pairs)
    expected = []
    for word in tokens:
        padded = f" {word} "
        for n in (4, 5):
            if len(padded) < 4:
                expected.append(padded)
                break
            expected += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    found = apply(spark, [body], lambda c: text.char_ngrams(c, (4, 5)))[0]
    assert sorted(found) == sorted(expected)


def test_whole_words_with_accents(spark):
    pattern = text.any_word(["đẹp", "ok"])
    found = apply(spark, ["rất đẹp", "đẹpx", "ok!", "book", "_ok"], lambda c: c.rlike(pattern))
    assert found == [True, False, True, False, False]
    assert apply(spark, ["a+b c", "aab c"], lambda c: c.rlike(text.any_word(["a+b"]))) == [True, False]


def plain_segments(line, phrases):
    words, out = line.split(), []
    while words:
        n = next((n for n in range(9, 1, -1) if n <= len(words) and " ".join(words[:n]) in phrases), 1)
        out.append("_".join(words[:n]))
        words = words[n:]
    return " ".join(out)


def test_segment_takes_the_longest_phrase_from_the_left(spark):
    rng = random.Random(7)
    phrases = {"a b", "b c", "b c d", "c a", "a a", "a b c d a", "d d", "é à", "d.d d", "x"}
    lines = [" ".join(rng.choice(["a", "b", "c", "d", "é", "à", "d.d", "zz"]) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    lines += ["", "  a   b ", "a b", "a b c", "a b c d a", "a", "a a a", "b c d d"]
    assert apply(spark, lines, lambda c: text.segment(c, phrases)) == [plain_segments(x, phrases) for x in lines]
    assert apply(spark, [None, "a  b"], lambda c: text.segment(c, [])) == ["", "a b"]
    assert apply(spark, [None], lambda c: text.segment(c, phrases)) == [""]


def test_segment_is_linear(spark):
    """A text of 200,000 words is no harder than its parts."""
    long = " ".join(["a", "b", "c"] * 70_000)
    assert apply(spark, [long], lambda c: text.segment(c, {"a b"})) == [" ".join(["a_b", "c"] * 70_000)]
