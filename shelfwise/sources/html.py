"""Listing and review pages to rows.

The whole page is one value, so pages are spread over tasks and each is read
by a small event handler; nothing outside the page is needed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfwise.functions import catalog, numeric, text

# Elements without content; classes and links of the crawled pages.
#: An opening tag ends an open element of the first set, up to the nearest of the second.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "option": ({"option"}, {"select"}), "p": ({"p"}, {"li", "td", "th", "div", "body"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}

LISTING = {
    "card": "item", "link": "main-contain", "title": "product-title", "price": "price",
    "price_box": "box-price", "rating_box": "rating_Compare", "vote": "vote-txt",
}
OLD_PRICE = ["price-old", "oldprice"]
SOLD_WORDS = ["bán", "ban"]
DEFAULT_DELIVERY = "standard"
REVIEW = {
    "node": "par", "content": "cmt-content", "words": "cmt-txt", "stars": "cmt-top-star",
    "star": "iconcmt-starbuy", "support": "support", "useful": "click-useful",
}
OTHER_NODES = ["comment-item", "cmt-item"]
USEFUL_LINK = "likeRating"
USEFUL_CLASSES = "useful|huu-ich"
USEFUL_WORDS = "hữu ích|huu ich"
PAGE_LINK = r"ratingCmtList\(([0-9]+)\)"
REVIEW_NOUN = r"(?:đánh|danh)\s*giá"


class Node:
    """An element with its attributes, children and text pieces."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.content: list[Node | str] = []

    @property
    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").split())

    def pieces(self) -> Iterator[Node | str]:
        """Elements and text below, in page order; a stack, so depth costs no recursion."""
        rest = list(reversed(self.content))
        while rest:
            item = rest.pop()
            yield item
            if isinstance(item, Node):
                rest += reversed(item.content)

    def walk(self) -> Iterator[Node]:
        return (item for item in self.pieces() if isinstance(item, Node))

    def find_all(self, test) -> list[Node]:
        return [node for node in self.walk() if test(node)]

    def find(self, *tests) -> Node | None:
        """First element that passes the first test any element passes."""
        for test in tests:
            for node in self.walk():
                if test(node):
                    return node
        return None

    def text(self) -> str:
        return " ".join(" ".join(p for p in self.pieces() if isinstance(p, str)).split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("root", {}, None)

    def close_open(self, tags: set[str], within: set[str]) -> None:
        """End an open element of ``tags`` that no element of ``within`` parts from here."""
        node = self.open
        while node.parent is not None and node.tag not in within:
            if node.tag in tags:
                self.open = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in IMPLIED_ENDS:
            self.close_open(*IMPLIED_ENDS[tag])
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.content.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.open.content.append(Node(tag, {k: v or "" for k, v in attrs}, self.open))

    def handle_endtag(self, tag):
        node = self.open
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.open = node.parent

    def handle_data(self, data):
        self.open.content.append(data)


def read_html(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def has_class(*names: str, tag: str | None = None):
    return lambda n: (tag is None or n.tag == tag) and bool(n.classes & set(names))


def is_tag(*tags: str):
    return lambda n: n.tag in tags


def inside(test, ancestor):
    def check(node: Node) -> bool:
        up = node.parent
        while up is not None:
            if ancestor(up):
                return test(node)
            up = up.parent
        return False

    return check


def any_of(*tests):
    return lambda n: any(t(n) for t in tests)


def _text_of(node: Node | None) -> str:
    return node.text() if node else ""


def _card(card: Node) -> dict[str, str] | None:
    link = card.find(lambda n: n.tag == "a" and ("href" in n.attrs or LISTING["link"] in n.classes))
    if link is None or not link.attrs.get("href"):
        return None
    rating = card.find(has_class(LISTING["rating_box"]))
    stars = rating.find(inside(is_tag("b"), has_class(LISTING["vote"]))) if rating else None
    sold = ""
    for span in rating.find_all(is_tag("span")) if rating else []:
        label = span.text()
        if any(word in label.lower() for word in SOLD_WORDS):
            sold = label
            break
    price = _text_of(
        card.find(
            any_of(
                has_class(LISTING["price"]),
                inside(is_tag("strong"), has_class(LISTING["price_box"])),
            )
        )
    )
    delivery = card.find(
        any_of(has_class("delivery"), lambda n: "ship" in n.attrs.get("class", ""))
    )
    return {
        "href": link.attrs["href"],
        "name": _text_of(card.find(has_class(LISTING["title"], tag="p")))
        or link.attrs.get("data-name", "")
        or _text_of(card.find(any_of(is_tag("h3", "h4"), has_class("name")))),
        "brand": link.attrs.get("data-brand", ""),
        "price": price,
        "old_price": _text_of(
            card.find(any_of(has_class(*OLD_PRICE), is_tag("strike")))
        )
        or price,
        "delivery": _text_of(delivery) or DEFAULT_DELIVERY,
        "sold": sold,
        "rating": _text_of(stars),
    }


def catalog_cards(html: str | None) -> list[dict[str, str]]:
    cards = read_html(html).find_all(has_class(LISTING["card"], tag="li"))
    return [row for row in map(_card, cards) if row]


def evenly(pages: DataFrame) -> DataFrame:
    """Pages dealt by key before the parser, whatever files they come in."""
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pages.repartition(tasks, "page_id")


CARD_FIELDS = ["href", "name", "brand", "price", "old_price", "delivery", "sold", "rating"]


def parse_catalog(pages: DataFrame, base_url: str) -> DataFrame:
    """Pages ``(page_id, category, html)`` to product rows with their order.

    Repeated URLs stay in; ``operators.joins.new_products`` keeps the first.
    """

    def cards(batches):
        for batch in batches:
            rows = [
                {"page_id": page, "Category": category, "position": place, **card}
                for page, category, html in zip(batch.page_id, batch.category, batch.html)
                for place, card in enumerate(catalog_cards(html))
            ]
            yield pd.DataFrame(rows, columns=["page_id", "Category", "position", *CARD_FIELDS])

    schema = "page_id long, Category string, position long, " + ", ".join(
        f"{f} string" for f in CARD_FIELDS
    )
    raw = evenly(pages.select("page_id", "category", "html")).mapInPandas(cards, schema)
    url = catalog.absolute_url(F.col("href"), base_url)
    slug = F.nullif(catalog.url_slug(url), F.lit(""))
    return raw.select(
        F.coalesce(slug, catalog.id_from_name(F.col("name"))).alias("Product_ID"),
        F.col("name").alias("Name"),
        catalog.brand_or_first_word(F.col("brand"), F.col("name")).alias("Brand"),
        "Category",
        numeric.digits(F.col("old_price")).alias("Original_Price"),
        numeric.digits(F.col("price")).alias("Discounted_Price"),
        F.col("delivery").alias("Delivery_Options"),
        numeric.parse_compact_count(F.col("sold")).alias("Sales_Volume"),
        F.col("rating").alias("Avg_Star_Rating"),
        F.lit("").alias("Total_Reviews"),
        url.alias("Product_URL"),
        "page_id",
        "position",
    )


def _review(node: Node) -> dict[str, str] | None:
    words = node.find(
        inside(any_of(has_class(REVIEW["words"]), is_tag("p")), has_class(REVIEW["content"])),
        has_class(REVIEW["words"]),
    )
    stars = node.find(has_class(REVIEW["stars"]))
    filled = len(stars.find_all(has_class(REVIEW["star"], tag="i"))) if stars else 0
    useful = node.find(
        any_of(
            lambda n: n.tag == "a"
            and USEFUL_LINK in n.attrs.get("href", "") + n.attrs.get("onclick", ""),
            has_class(REVIEW["useful"]),
            lambda n: re.search(USEFUL_CLASSES, n.attrs.get("class", "")) is not None,
        ),
        lambda n: n.tag in ("a", "span")
        and re.search(USEFUL_WORDS, n.text().lower()) is not None,
    )
    review = {
        "words": _text_of(words),
        "support": _text_of(node.find(has_class(REVIEW["support"]))),
        "stars": str(filled) if 1 <= filled <= 5 else "",
        "useful": _text_of(useful),
        "link": f"{useful.attrs.get('href', '')} {useful.attrs.get('onclick', '')}"
        if useful
        else "",
    }
    return review if review["words"] or review["support"] or review["stars"] else None


def review_nodes(html: str | None) -> list[dict[str, str]]:
    root = read_html(html)
    nodes = root.find_all(has_class(REVIEW["node"], tag="li")) or root.find_all(
        has_class(*OTHER_NODES)
    )
    return [row for row in map(_review, nodes) if row]


NODE_FIELDS = ["words", "support", "stars", "useful", "link"]


def parse_reviews(pages: DataFrame, id_prefix: str = "review-", language: str = "vi") -> DataFrame:
    """Pages ``(page_id, product_id, product_name, html)`` to review rows.

    Rating-only reviews stay.  A review without an id of its own gets one from
    a digest of its place and content, the same on every run.
    """

    def reviews(batches):
        keys = ["page_id", "product_id", "product_name"]
        for batch in batches:
            rows = [
                {**dict(zip(keys, key)), "position": place, **node}
                for *key, html in zip(*[batch[k] for k in keys], batch.html)
                for place, node in enumerate(review_nodes(html))
            ]
            yield pd.DataFrame(rows, columns=[*keys, "position", *NODE_FIELDS])

    schema = (
        "page_id long, product_id string, product_name string, position long, "
        + ", ".join(f"{f} string" for f in NODE_FIELDS)
    )
    raw = evenly(pages.select("page_id", "product_id", "product_name", "html")).mapInPandas(reviews, schema)
    has_support = F.col("support") != ""
    digest = F.sha2(
        F.concat_ws("\x1f", "product_id", "page_id", "position", "words", "support"), 256
    )
    return raw.select(
        F.coalesce(text.helpful_id(F.col("link"), id_prefix), digest).alias("Review_ID"),
        F.col("product_id").alias("Product_ID"),
        F.col("product_name").alias("Product_Name"),
        F.regexp_extract("support", r"([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})", 1).alias("Review_Date"),
        F.col("stars").alias("Star_Rating"),
        F.concat_ws(
            " || ", F.nullif("words", F.lit("")), F.nullif("support", F.lit(""))
        ).alias("Review_Text"),
        text.helpful_count(F.col("useful")).alias("Helpfulness_Count"),
        F.when(has_support, "1").otherwise("0").alias("Support_Contacted"),
        F.lit(language).alias("Language_Code"),
        "page_id",
        "position",
    )


def page_count(html, marker: str = PAGE_LINK):
    """Highest page number among the pagination links, else 1."""
    found = F.regexp_extract_all(html, F.lit(marker), 1)
    numbers = F.transform(found, lambda n: n.try_cast("int"))
    return F.coalesce(F.array_max(numbers), F.lit(1))


def review_total(words, noun: str = REVIEW_NOUN):
    """Stated number of reviews, with ``k`` for thousands; NULL if none."""
    pattern = rf"([0-9.,]+)\s*(k)?\s*{noun}"
    lowered = F.lower(words)
    number = F.translate(F.regexp_extract(lowered, pattern, 1), ",", ".")
    thousands = F.regexp_extract(lowered, pattern, 2) == "k"
    scaled = (number.try_cast("double") * 1000).try_cast("bigint").cast("string")
    plain = F.nullif(numeric.digits(number), F.lit(""))
    return F.when(thousands, F.coalesce(scaled, plain)).otherwise(plain)


# Elements of HTML that end a paragraph, and the references decoded in one.
BLOCKS = (
    "p|div|ul|ol|li|dl|dt|dd|table|tr|td|th|h[1-6]|article|section|nav|header|footer|aside|main|form|blockquote|pre|"
    "figure|figcaption|hr|body|html"
)
REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
SILENT = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
PARAGRAPH_START = r"(?i)<p(\s[^>]*)?>"
BLOCK_EDGE = rf"(?i)</?({BLOCKS})(\s[^>]*)?/?>"
START, EDGE = "\x01", "\x02"
PARAGRAPH = f"{START}([^{START}{EDGE}]*)"


def paragraphs(html):
    """Texts of ``p`` elements, each up to its end tag or the next edge of a block; blank ones leave.

    Inline tags are taken out and references decoded.
    """
    marked = F.regexp_replace(F.regexp_replace(html, SILENT, " "), PARAGRAPH_START, START)
    found = F.regexp_extract_all(F.regexp_replace(marked, BLOCK_EDGE, EDGE), F.lit(PARAGRAPH), 1)

    def plain(body):
        body = F.regexp_replace(body, "<[^>]*>", " ")
        for reference, sign in REFERENCES:
            body = F.replace(body, F.lit(reference), F.lit(sign))
        return F.trim(F.regexp_replace(body, r"\s+", " "))

    return F.filter(F.transform(found, plain), lambda p: p != "")


def paragraphs_sql(html: str) -> str:
    """The same for SQL engines with RE2."""

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''").replace(START, "' || chr(1) || '").replace(EDGE, "' || chr(2) || '") + "'"

    marked = f"regexp_replace(regexp_replace({html}, {quoted(SILENT)}, ' ', 'g'), {quoted(PARAGRAPH_START)}, {quoted(START)}, 'g')"
    found = f"regexp_extract_all(regexp_replace({marked}, {quoted(BLOCK_EDGE)}, {quoted(EDGE)}, 'g'), {quoted(PARAGRAPH)}, 1)"
    body = "regexp_replace(b, '<[^>]*>', ' ', 'g')"
    for reference, sign in REFERENCES:
        body = f"replace({body}, {quoted(reference)}, {quoted(sign)})"
    return rf"list_filter(list_transform({found}, lambda b: trim(regexp_replace({body}, '\s+', ' ', 'g'))), lambda p: p <> '')"


def page_fields(html) -> dict:
    """Title, heading and language of a page, as column expressions."""
    return {
        "title": F.regexp_extract(html, r"<title>([^<]*)</title>", 1),
        "heading": F.regexp_extract(html, r"<h1>([^<]*)</h1>", 1),
        "lang": F.regexp_extract(html, r'<html lang="([a-z]+)"', 1),
    }
