"""Quality classifier by co-training a view of the text and a view of the metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import bytes_of
from shelfwise.llm.decontaminate import BETWEEN, LOWER
from shelfwise.llm.repeats import mix, word_codes, word_spans

WORD_BITS = 18
STEPS = 16
STATISTICS = ["words", "length", "capitals", "marks", "digits", "beyond", "same", "distinct", "breaks"]
TEXT_SIZE = (1 << WORD_BITS) + STEPS * len(STATISTICS)
META_SIZE = 1 << 14

_byte = np.arange(256)
CAPITAL = (_byte >= 0x41) & (_byte <= 0x5A)
DIGIT = (_byte >= 0x30) & (_byte <= 0x39)
BEYOND = _byte >= 0x80
MARK = (_byte > 0x20) & (_byte < 0x7F) & ~CAPITAL & ~DIGIT & ~((_byte >= 0x61) & (_byte <= 0x7A))
BREAK = _byte == 0x0A


def _shares(lookup: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(lookup[data])])[offsets]
    return np.diff(total) / np.maximum(np.diff(offsets), 1)


def text_features(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of every feature that a row's text has: its words, hashed, and steps of its statistics."""
    data, offsets = bytes_of(texts)
    lower = LOWER[data]
    begins, ends, starts = word_spans(lower, offsets, BETWEEN)
    codes, counts = word_codes(lower, begins, ends), np.diff(starts)
    rows = np.repeat(np.arange(len(counts)), counts)
    words = codes >> np.uint64(64 - WORD_BITS)
    pairs = np.sort(rows.astype(np.uint64) << np.uint64(WORD_BITS) | words)
    pairs = pairs[np.insert(pairs[1:] != pairs[:-1], 0, True)] if len(pairs) else pairs
    held = (pairs >> np.uint64(WORD_BITS)).astype(np.int64)
    some = np.maximum(counts, 1)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (rows[1:] == rows[:-1])
    root = lambda share: np.sqrt(share) * (STEPS - 1)
    values = [
        np.log2(counts + 1), np.bincount(rows, weights=ends - begins, minlength=len(counts)) / some,
        root(_shares(CAPITAL, data, offsets)), root(_shares(MARK, data, offsets)), root(_shares(DIGIT, data, offsets)),
        root(_shares(BEYOND, data, offsets)), root(np.bincount(rows, weights=same, minlength=len(counts)) / some),
        np.bincount(held, minlength=len(counts)) / some * (STEPS - 1), root(_shares(BREAK, data, offsets)),
    ]
    steps = [(1 << WORD_BITS) + STEPS * k + np.clip(v, 0, STEPS - 1).astype(np.int64) for k, v in enumerate(values)]
    every = np.arange(len(counts))
    return np.concatenate([held, *[every] * len(steps)]), np.concatenate([(pairs & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64), *steps])


def meta_features(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature for every metadata column's value, and for pairs of values.

    Numbers count by powers of two, other values as text; a null is a value of its own.
    """
    size = len(columns[0]) if columns else 0
    codes = []
    for k, column in enumerate(columns):
        if pa.types.is_integer(column.type) or pa.types.is_floating(column.type):
            number = np.nan_to_num(column.cast(pa.float64(), safe=False).fill_null(-1).to_numpy(zero_copy_only=False))
            code = np.floor(np.log2(np.maximum(number, 0) + 1)).astype(np.int64).view(np.uint64) + np.uint64(1000) * (number < 0).astype(np.uint64)
        else:
            data, offsets = bytes_of(column.cast(pa.string()).fill_null("\0"))
            code = np.array([hash_of(data[s:e].tobytes()) for s, e in zip(offsets[:-1], offsets[1:])], np.uint64)
        codes.append(mix(code + np.uint64((k + 1) * 0x9E3779B9)))
    codes += [mix(a ^ (b * np.uint64(3))) for i, a in enumerate(codes) for b in codes[:i]]
    rows = np.tile(np.arange(size), len(codes))
    return rows, (np.concatenate(codes) % np.uint64(META_SIZE)).astype(np.int64) if codes else np.zeros(0, np.int64)


def hash_of(value: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(value)


@dataclass
class View:
    """A calibrated linear classifier over one view: logit = scale * (bias + weights) + shift."""

    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, rows: np.ndarray, cols: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(rows, weights=self.weights[cols], minlength=size) + self.bias

    def logits(self, rows: np.ndarray, cols: np.ndarray, size: int) -> np.ndarray:
        return self.scale * self.raw(rows, cols, size) + self.shift


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def descend(slope, values: list[np.ndarray], rounds: int, rate: float) -> None:
    """Gradient steps with per-weight rates, in place."""
    mean, square = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for t in range(1, rounds + 1):
        for k, g in enumerate(slope()):
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            values[k] -= rate * (mean[k] / (1 - 0.9**t)) / (np.sqrt(square[k] / (1 - 0.99**t)) + 1e-9)


@dataclass
class Sample:
    """Features of rows for one view."""

    rows: np.ndarray
    cols: np.ndarray
    size: int

    def of(self, wanted: np.ndarray) -> Sample:
        place = np.full(self.size, -1)
        place[wanted] = np.arange(len(wanted))
        keep = place[self.rows] >= 0
        return Sample(place[self.rows[keep]], self.cols[keep], len(wanted))


def fit_view(sample: Sample, labels: np.ndarray, width: int, least: float = 4.0, penalty: float = 1e-3) -> View:
    """Logistic regression on features whose share differs between the classes by ``least`` standard errors."""
    positive, total = max(1, int(labels.sum())), len(labels)
    negative = max(1, total - int(labels.sum()))
    inside = np.bincount(sample.cols, weights=labels[sample.rows], minlength=width)
    every = np.bincount(sample.cols, minlength=width)
    share = np.clip((every + 0.5) / (total + 1), 1e-9, 1 - 1e-9)
    gap = np.abs(inside / positive - (every - inside) / negative)
    told = gap / np.sqrt(share * (1 - share) * (1 / positive + 1 / negative)) >= least
    keep = told[sample.cols]
    rows, cols = sample.rows[keep], sample.cols[keep]
    place = np.cumsum(told) - 1
    weights, bias = np.zeros(int(told.sum())), np.array([np.log(positive / negative)])

    def slope() -> list[np.ndarray]:
        miss = sigmoid(np.bincount(rows, weights=weights[place[cols]], minlength=total) + bias[0]) - labels
        return [np.bincount(place[cols], weights=miss[rows], minlength=len(weights)) / total + penalty * weights / 10, np.array([miss.mean()])]

    descend(slope, [weights, bias], 150, 0.1)
    full = np.zeros(width)
    full[told] = weights
    return View(full, float(bias[0]))


def calibrate(view: View, sample: Sample, labels: np.ndarray) -> View:
    """Scale and shift of the logits on rows that didn't train, with smoothed targets."""
    raw = view.raw(sample.rows, sample.cols, sample.size)
    positive, negative = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    fit = [np.array([1.0]), np.array([0.0])]

    def slope() -> list[np.ndarray]:
        miss = sigmoid(fit[0] * raw + fit[1]) - target
        return [np.array([(miss * raw).mean()]), np.array([miss.mean()])]

    descend(slope, fit, 300, 0.05)
    return View(view.weights, view.bias, float(fit[0][0]), float(fit[1][0]))


@dataclass
class CoTrained:
    """Both views, and the weights of their logits in the combined one."""

    text: View
    meta: View
    mixture: np.ndarray

    def scores(self, texts: pa.Array, columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = len(texts)
        text, meta = self.text.logits(*text_features(texts), size), self.meta.logits(*meta_features(columns), size)
        return sigmoid(text), sigmoid(meta), sigmoid(self.mixture[0] * text + self.mixture[1] * meta + self.mixture[2])


def co_train(
    texts: Sample, metas: Sample, labels: np.ndarray, rounds: int = 4, sure: float = 0.97, share: float = 0.1,
) -> CoTrained | None:
    """Views that teach each other; ``labels`` is 1, 0 or -1 (none).

    A fifth of the labelled rows calibrates.  Every round both views are fitted and calibrated; each
    gives the other its pseudo-labels for unlabelled rows of which it is at least ``sure``, the
    surest first, up to ``share`` of the pool in both classes together.  At last the logits are
    combined by a logistic fit on the calibration rows.  None without both classes.
    """
    known, pool = np.flatnonzero(labels >= 0), np.flatnonzero(labels < 0)
    held, taught = known[::5], known[np.arange(len(known)) % 5 > 0]
    if len(np.unique(labels[held])) < 2 or len(np.unique(labels[taught])) < 2:
        return None
    sides, widths = (texts, metas), (TEXT_SIZE, META_SIZE)
    extra: list[dict[int, int]] = [{}, {}]
    views: list[View] = []
    for turn in range(rounds + 1):
        views = []
        for k, side in enumerate(sides):
            more = np.array(sorted(extra[k]), np.int64)
            rows = np.concatenate([taught, more])
            own = np.concatenate([labels[taught], np.array([extra[k][r] for r in more.tolist()], labels.dtype)]).astype(float)
            views.append(calibrate(fit_view(side.of(rows), own, widths[k]), side.of(held), labels[held].astype(float)))
        if turn == rounds or not len(pool):
            break
        for k, (side, view) in enumerate(zip(sides, views)):
            some = side.of(pool)
            chance = sigmoid(view.logits(some.rows, some.cols, some.size))
            surest = np.argsort(-np.abs(chance - 0.5), kind="stable")[: max(1, int(share * len(pool)))]
            for i in surest[np.maximum(chance, 1 - chance)[surest] >= sure].tolist():
                extra[1 - k].setdefault(int(pool[i]), int(chance[i] > 0.5))
    logits = [view.logits(s.rows, s.cols, s.size) for view, s in zip(views, (texts.of(held), metas.of(held)))]
    mixture = [np.array([1.0, 0.0, 0.0])]

    def slope() -> list[np.ndarray]:
        miss = sigmoid(mixture[0][0] * logits[0] + mixture[0][1] * logits[1] + mixture[0][2]) - labels[held]
        return [np.array([(miss * logits[0]).mean(), (miss * logits[1]).mean(), miss.mean()]) + 1e-3 * (mixture[0] - [1, 0, 0])]

    descend(slope, mixture, 300, 0.03)
    return CoTrained(views[0], views[1], mixture[0])


def train_quality(
    docs: DataFrame, labels: DataFrame, meta_cols: list[str], id_col: str = "doc_id", text_col: str = "text",
    quality_col: str = "quality", toxic_col: str = "toxic", most_labelled: int = 12_000, most_pool: int = 6_000,
) -> CoTrained | None:
    """Fit on at most ``most_labelled`` labelled and ``most_pool`` other rows, those of the smallest id hashes.

    A row is good if its quality is 1 and it isn't toxic; contradicting labels of an id make it bad.
    """
    good = F.when((F.col(quality_col) == 1) & (F.coalesce(toxic_col, F.lit(0)) == 0), 1).otherwise(0)
    told = labels.filter(F.col(quality_col).isNotNull() & F.col(id_col).isNotNull())
    told = told.select(F.col(id_col).cast("long").alias("id"), good.alias("good")).groupBy("id").agg(F.min("good").alias("good"))
    order = F.xxhash64("id"), F.col("id")
    chosen = {r.id: r.good for r in told.orderBy(*order).limit(most_labelled).collect()}
    ids = docs.select(docs[id_col].cast("long").alias("id")).filter("id IS NOT NULL")
    for r in ids.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(most_pool).collect():
        chosen.setdefault(r.id, -1)
    if not chosen:
        return None
    wanted = docs.sparkSession.createDataFrame(list(chosen.items()), "id long, good int")
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), F.struct(*[docs[c].alias(f"m{k}") for k, c in enumerate(meta_cols)]).alias("meta"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, len(batch), 1000):
                part = batch.slice(s, 1000)
                made = [text_features(part.column("text")), meta_features(part.column("meta").flatten())]
                lists = []
                for held, cols in made:
                    order = np.argsort(held, kind="stable")
                    cuts = np.searchsorted(held[order], np.arange(len(part) + 1))
                    lists.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(cols[order], pa.int32())))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("good"), *lists], ["id", "good", "words", "meta"])

    sample = rows.join(F.broadcast(wanted), "id").mapInArrow(featured, "id long, good int, words array<int>, meta array<int>").toArrow()
    sample = sample.sort_by("id")
    sides = []
    for name in ("words", "meta"):
        column = sample.column(name).combine_chunks()
        sizes = np.diff(column.offsets.to_numpy())
        sides.append(Sample(np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy().astype(np.int64), len(column)))
    return co_train(*sides, sample.column("good").to_numpy())


def classify_quality(
    docs: DataFrame, model: CoTrained | None, meta_cols: list[str], id_col: str = "doc_id", text_col: str = "text",
    threshold: float = 0.5, carry: list[str] | tuple = (),
) -> DataFrame:
    """Scores of every document by both views and combined; ``keep`` if the combined one reaches ``threshold``.

    One row for each input row: ``id_col``, ``text_score``, ``meta_score``, ``score``, ``keep``, and
    ``carried`` if ``carry`` names columns.  Null texts count as empty, null metadata as a value of
    its own.  Without a model (no labelled rows of both classes) scores are null and all rows stay.
    """
    held = [F.struct(*[docs[c] for c in carry]).alias("carried")] if carry else []
    rows = docs.select(
        docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
        F.struct(*[docs[c].alias(f"m{k}") for k, c in enumerate(meta_cols)]).alias("meta"), *held,
    )
    names = [F.col("id").alias(id_col), "text_score", "meta_score", "score", "keep", *(["carried"] if carry else [])]
    if model is None:
        none = {c: F.lit(None).cast("double") for c in ("text_score", "meta_score", "score")}
        return rows.withColumns(none | {"keep": F.lit(True)}).select(*names)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, len(batch), 1000):
                part = batch.slice(s, 1000)
                made = sent.value.scores(part.column("text"), part.column("meta").flatten())
                columns = [part.column("id"), *map(pa.array, made), pa.array(made[2] >= threshold)]
                columns += [part.column("carried")] if carry else []
                yield pa.RecordBatch.from_arrays(columns, ["id", "text_score", "meta_score", "score", "keep", *(["carried"] if carry else [])])

    extra = f", carried {rows.schema['carried'].dataType.simpleString()}" if carry else ""
    return rows.mapInArrow(score, f"id long, text_score double, meta_score double, score double, keep boolean{extra}").select(*names)
