"""Main text of pages by a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.html_blocks import Block, blocks_of

HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

# Seed pages are put together from these parts.
MAIN_PARTS = [
    "<h1>{0}</h1>", "<p>{1}</p>", "<p><b>{0}</b> {1}</p>", "<p>{1}<p>{2}", "<p>{2} <a href=x>{0}</a> {1}</p>", "<h2>{0}</h2><p>{2}</p>",
    "<blockquote>{1}</blockquote>", "<ul><li>{1}</li><li>{0}</li></ul>", "<pre>{1}</pre>", "<div>{2}</div>", "<p><em>{2}</em></p>",
    "<figure><img src=x><figcaption>{0}</figcaption></figure>", "<table><tr><td>{0}</td><td>{1}</td></tr></table>", "<section><p>{2}</p></section>",
]
MAIN_HOLDERS = [
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>',
    '<div id="main-content">{}</div>', '<div class="post-body article">{}</div>', '<article class="entry"><div class="text">{}</div></article>',
]
OTHER_PARTS = [
    "<nav><ul><li><a href=x>{0}</a></li><li><a href=x>{0}</a></li></ul></nav>", "<header><h1>{0}</h1><p>{0}</p></header>",
    '<div class="header"><a href=x>{0}</a></div>', '<div class="menu"><ul><li><a href=x>{0}</a></li></ul></div>', "<footer>&copy; {0} {1}</footer>",
    '<div id="footer"><p>{1}</p></div>', "<aside><h3>{0}</h3><p>{1}</p></aside>", '<div class="sidebar"><p>{2}</p><ul><li>{0}</li></ul></div>',
    '<div class="cookie-notice"><p>{1}</p></div>', '<div class="notice banner">{1}</div>', '<div class="ad">{1}</div>', '<div class="advert"><p>{2}</p></div>',
    '<div class="promo sponsored">{1}</div>', "<form><label>{0}</label><input><button>{0}</button></form>", '<form class="newsletter"><p>{1}</p></form>',
    '<section class="comments"><h2>{0}</h2><div class="comment"><p>{2}</p></div></section>', '<div id="comments"><ul><li><p>{1}</p></li></ul></div>',
    '<div class="related"><ul><li><a href=x>{0}</a></li></ul></div>', '<div class="share social"><a href=x>{0}</a></div>',
    '<p class="cookie consent">{1}</p>', '<div class="breadcrumb"><a href=x>{0}</a> <a href=x>{0}</a></div>', '<div role="navigation"><a href=x>{0}</a></div>',
]
#: Such parts also stand inside the article's element.
INNER_OTHER = [p for p in OTHER_PARTS if any(w in p for w in ("ad\"", "advert", "aside", "comment", "share", "related", "newsletter", "notice", "nav>"))]


def seed_pages(count: int = 400, seed: int = 5) -> list[tuple[str, list[str]]]:
    """Pages of many layouts with the lines of their main text."""
    rng = np.random.Generator(np.random.PCG64(seed))
    syllables = ["ta", "re", "on", "mi", "the", "la", "en", "sch", "of", "de", "st", "ou", "er", "ing", "que", "é"]

    def words(low: int, high: int) -> str:
        made = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(low, high))]
        return (" ".join(made)).capitalize() + rng.choice([".", ".", "", "!"])

    def part(pattern: str) -> str:
        return pattern.format(words(1, 6), words(6, 30), words(25, 90))

    pages = []
    for _ in range(count):
        inner, lines = "", []
        for pattern in rng.choice(MAIN_PARTS, rng.integers(1, 9)):
            piece = part(pattern)
            lines += [b.text for b in blocks_of(piece)]
            inner += piece
            if rng.random() < 0.15:
                inner += part(rng.choice(INNER_OTHER))
        before = "".join(part(p) for p in rng.choice(OTHER_PARTS, rng.integers(0, 5)))
        after = "".join(part(p) for p in rng.choice(OTHER_PARTS, rng.integers(0, 5)))
        pages.append((f"<html><body>{before}{str(rng.choice(MAIN_HOLDERS)).format(inner)}{after}</body></html>", lines))
    return pages


def _step(value: int) -> int:
    return min(value.bit_length(), 10)


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of what is true of each block: ancestors, own tag, and its text."""
    out, total = [], len(blocks)
    for i, block in enumerate(blocks):
        tags = [tag for tag, _ in block.path]
        found = ["bias", f"tag:{tags[-1] if tags else ''}", f"pair:{'>'.join(tags[-2:])}"]
        found += [f"in:{t}" for t in dict.fromkeys(tags)]
        found += [f"name:{n}" for n in dict.fromkeys(n for _, names in block.path for n in names)]
        text = block.text
        words = text.count(" ") + 1
        found += [f"words:{_step(words)}", f"linked:{4 * block.linked // len(text)}", f"end:{text[-1] if text[-1] in '.!?…:' else 'x'}"]
        found += [f"commas:{_step(text.count(','))}", f"start:{'upper' if text[0].isupper() else 'digit' if text[0].isdigit() else 'x'}"]
        if "©" in text:
            found.append("sign:©")
        found.append("place:first" if i == 0 else "place:last" if i == total - 1 else "place:inner")
        out.append(found)
    return out


def labels_of(blocks: list[Block], lines: list[str]) -> list[int]:
    """1 for blocks that are lines of the main text, or headings that it begins with."""
    known = set(lines)
    first = lines[0] if lines else ""
    return [int(b.text in known or (b.path[-1][0] in HEADINGS if b.path else False) and first.startswith(b.text)) for b in blocks]


@dataclass
class Chain:
    """Weights of a trained field: of each feature for main text over other text, and of neighbours."""

    weights: dict[str, float]
    steps: np.ndarray  # from label to label

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The most likely labels of a page (Viterbi)."""
        if not blocks:
            return []
        get, ((oo, om), (mo, mm)) = self.weights.get, self.steps.tolist()
        other, main, back = 0.0, 0.0, []
        for i, names in enumerate(features(blocks)):
            gain = sum([get(n, 0.0) for n in names])
            if i:
                a, b, c, d = other + oo, main + mo, other + om, main + mm
                back.append((b > a, d > c))
                other, main = max(a, b), max(c, d)
            main += gain
        label = main > other
        out = [label]
        for from_main in reversed(back):
            label = from_main[label]
            out.append(label)
        return out[::-1]


def train_chain(pages: list[tuple[str, list[str]]], rounds: int = 120, rate: float = 0.15, decay: float = 1e-4, most_blocks: int = 400) -> Chain:
    """Weights of the highest likelihood, by gradient steps with forward-backward sums.

    All pages step along together.  A page of more than ``most_blocks`` blocks doesn't train.
    """
    names: dict[str, int] = {}
    cols, widths, gold, sizes = [], [], [], []
    for page, lines in pages:
        blocks = blocks_of(page)
        if not 0 < len(blocks) <= most_blocks:
            continue
        for found in features(blocks):
            cols += [names.setdefault(n, len(names)) for n in found]
            widths.append(len(found))
        sizes.append(len(blocks))
        gold += labels_of(blocks, lines)
    widths, gold = np.array(widths), np.array(gold)
    at, cols = np.repeat(np.arange(len(widths)), widths), np.array(cols)
    sizes = np.array(sizes)
    starts = np.cumsum(sizes) - sizes
    weights, steps = np.zeros(len(names)), np.zeros((2, 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(steps), np.zeros_like(steps)]
    pairs = np.ones(len(gold), bool)
    pairs[starts] = False
    true_steps = np.zeros((2, 2))
    np.add.at(true_steps, (gold[np.flatnonzero(pairs) - 1], gold[pairs]), 1)
    longest, total = int(sizes.max()), len(sizes)
    for t in range(1, rounds + 1):
        gain = np.bincount(at, weights=weights[cols], minlength=len(gold))
        scores = np.zeros((len(gold), 2))
        scores[:, 1] = gain
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        for i in range(longest):
            here = starts[sizes > i] + i
            ahead[here] = scores[here]
            if i:
                ahead[here] += np.logaddexp(ahead[here - 1, :1] + steps[0], ahead[here - 1, 1:] + steps[1])
        for i in range(longest - 2, -1, -1):
            here = starts[sizes > i + 1] + i
            after = behind[here + 1] + scores[here + 1]
            behind[here] = np.logaddexp(after[:, :1] + steps[:, 0], after[:, 1:] + steps[:, 1])
        whole = np.repeat(np.logaddexp(*ahead[starts + sizes - 1].T), sizes)
        chance = np.exp(ahead[:, 1] + behind[:, 1] - whole)
        second = np.flatnonzero(pairs)
        both = np.exp(
            ahead[second - 1][:, :, None] + steps[None] + (scores + behind)[second][:, None, :] - whole[second][:, None, None]
        ).sum(axis=0)
        slopes = [np.bincount(cols, weights=(gold - chance)[at], minlength=len(weights)) / total - decay * weights, (true_steps - both) / total - decay * steps]
        for k, (value, slope) in enumerate(zip((weights, steps), slopes)):
            mean, square = moments[2 * k], moments[2 * k + 1]
            mean *= 0.9
            mean += 0.1 * slope
            square *= 0.99
            square += 0.01 * slope * slope
            value += rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return Chain({n: float(weights[i]) for n, i in names.items()}, steps)


def labelled_pages(pages: DataFrame, texts: DataFrame, most: int = 2000) -> list[tuple[str, list[str]]]:
    """At most ``most`` pages whose address ends in the number of a known text, with that text's lines.

    The pages with the smallest hashes of their ids are taken; only these and their texts are read whole.
    """
    number = F.regexp_extract("url", r"/([0-9]+)(?:[.?#/][^/]*)?$", 1).try_cast("long")
    chosen = pages.select("page_id", number.alias("doc_id")).filter(F.col("page_id").isNotNull())
    chosen = chosen.filter("doc_id IS NOT NULL").orderBy(F.xxhash64("page_id"), "page_id").limit(most).select("page_id", "doc_id")
    rows = chosen.collect()
    if not rows:
        return []
    wanted = pages.sparkSession.createDataFrame([(r.page_id, r.doc_id) for r in rows], "page_id long, doc_id long")
    found = pages.select("page_id", "html").join(F.broadcast(wanted), "page_id")
    known = texts.select("doc_id", "text").join(F.broadcast(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
    made = found.join(known, "doc_id").filter("html IS NOT NULL AND text IS NOT NULL").select("html", "text").collect()
    out = []
    for r in made:
        lines = [" ".join(x.split()) for x in r.text.split("\n")]
        out.append((r.html, [x for x in lines if x]))
    return out


def extract_text(
    pages: DataFrame, model: Chain, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Main text of every page, by the model's decoding of its leaf blocks.

    A leaf block is a run of inline text between block elements; comments, scripts, styles and the
    head give none.  Character references are decoded, white space becomes one space, and the blocks
    kept are joined by a newline in page order.  Returns one row for each input row: ``id_col``,
    ``url_col``, ``text`` (empty for null or empty pages and pages without main text) and
    ``n_chars``.  Other columns are not read; unclosed and deeply nested elements cost no more.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        for batch in batches:
            texts = []
            for page in batch.column("html"):
                blocks = blocks_of(page.as_py() or "")
                texts.append("\n".join(b.text for b, main in zip(blocks, chain.decode(blocks)) if main))
            columns = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "n_chars"])

    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), pages[html_col].alias("html"))
    found = rows.mapInArrow(extract, "id long, url string, text string, n_chars long")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
