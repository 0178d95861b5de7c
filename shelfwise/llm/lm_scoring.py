"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, each with a node for its leading bits; every node is kept for each
context of 0 to ``depth`` preceding bytes.  A node holds the Krichevsky-Trofimov estimate of the
decisions seen there, and its weighted probability is half that estimate and half the product of
the weighted probabilities of its longer contexts.  Scoring mixes the estimates of all depths with
the weights that follow.

Blocks of documents send their distinct byte strings (context and byte) with training counts; a
bucket holds all strings of some two-byte contexts and so the whole tree below them.  What lies
above is 256 contexts and the root: a few numbers each, summed over the buckets.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm import exchange
from shelfwise.llm.common import id_and_text, in_blocks, staged
from shelfwise.llm.repeats import grouped, word_codes

EDGE = 0xFF  # stands before and behind a text; no UTF-8 text holds it
HALF = np.log(0.5)
#: Two-byte contexts in another order, so that frequent ones spread over the buckets.
SHUFFLED = np.random.Generator(np.random.PCG64(77)).permutation(1 << 16).astype(np.uint64)
UNSHUFFLED = np.argsort(SHUFFLED).astype(np.uint64)
SPREAD = np.uint64(0x9E3779B97F4A7C15)  # odd, so that a product tells keys apart
REPLY = "block long, bucket int, payload binary"


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x >= 0.5."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        if not low.any():
            break
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


@dataclass
class Level:
    """Nodes of a depth that decide bit ``bit``, by sorted key (context, leading bits)."""

    keys: np.ndarray
    log_kt: np.ndarray
    chance: np.ndarray  # that the bit is one, by the estimate
    log_weighted: np.ndarray
    share: np.ndarray  # of the estimate in the mixture


def node_levels(strings: np.ndarray, counts: np.ndarray, below: list[Level] | None, sums: np.ndarray | None = None) -> list[Level]:
    """The eight levels of a depth from its sorted strings (context, byte) and counts.

    ``below`` are the levels a byte of context deeper (none at the full depth); ``sums`` instead gives
    the log products by context and node where they were summed elsewhere.
    """
    levels, counts = [], counts.astype(np.float64)
    for bit in range(8):
        prefix = (strings >> np.uint64(8) << np.uint64(bit)) | ((strings & np.uint64(255)) >> np.uint64(8 - bit))
        begins = np.flatnonzero(np.insert(prefix[1:] != prefix[:-1], 0, True)) if len(prefix) else np.zeros(0, np.int64)
        one = ((strings >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.float64)
        total, ones = (np.add.reduceat(v, begins) if len(begins) else np.zeros(0) for v in (counts, counts * one))
        keys, kt = prefix[begins], log_kt(total - ones, ones)
        if below is None and sums is None:
            weighted = kt
        else:
            if below is None:
                node = (np.uint64(1) << np.uint64(bit)) | (keys & np.uint64((1 << bit) - 1))
                product = sums[(keys >> np.uint64(bit)).astype(np.int64), node.astype(np.int64)]
            else:
                product = sum_to_parents(below[bit], bit, keys)
            weighted = np.logaddexp(kt, product) + HALF
        share = np.exp(HALF + kt - weighted) if below is not None or sums is not None else np.ones(len(keys))
        levels.append(Level(keys, kt, (ones + 0.5) / (total + 1.0), weighted, share))
    return levels


def parent_key(keys: np.ndarray, bit: int) -> np.ndarray:
    """The node's key in the context without its oldest byte, for keys of ``bit`` leading bits."""
    return (keys >> np.uint64(bit + 8) << np.uint64(bit)) | (keys & np.uint64((1 << bit) - 1))


def sum_to_parents(level: Level, bit: int, keys: np.ndarray) -> np.ndarray:
    place = np.searchsorted(keys, parent_key(level.keys, bit))
    return np.bincount(place, weights=level.log_weighted, minlength=len(keys))


def shorter(strings: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings without the oldest byte of context, and their summed counts."""
    keys, group, _ = grouped((strings >> np.uint64(16) << np.uint64(8)) | (strings & np.uint64(255)))
    return keys, np.bincount(group, weights=counts, minlength=len(keys)).astype(np.int64)


def plain_context(strings: np.ndarray, depth: int) -> np.ndarray:
    """The two nearest context bytes in their own order, nearest leading."""
    rest = np.uint64(8 * (depth - 2) + 8)
    return (UNSHUFFLED[(strings >> rest).astype(np.int64)] << rest) | (strings & ((np.uint64(1) << rest) - np.uint64(1)))


def subtree(strings: np.ndarray, counts: np.ndarray, depth: int) -> list[list[Level]]:
    """Levels of depths 2 to ``depth`` for a bucket's strings; of depth 2 first."""
    per_depth = [(strings, counts)]
    while len(per_depth) < depth - 1:
        per_depth.append(shorter(*per_depth[-1]))
    below, made = None, []
    for own, seen in per_depth:
        below = node_levels(own, seen, below)
        made.append(below)
    return made[::-1]


@dataclass
class Top:
    """Depths 0 and 1: estimates and their shares by node (1..255), for the root and 256 contexts."""

    root_chance: np.ndarray
    root_share: np.ndarray
    chance: np.ndarray
    share: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, sums: np.ndarray) -> Top:
        """From counts by (context, byte) and the log products by (context, node)."""
        strings = np.arange(1 << 16, dtype=np.uint64)
        first = node_levels(strings, counts.ravel(), None, sums)
        root = node_levels(np.arange(256, dtype=np.uint64), counts.sum(axis=0), first)
        table = lambda levels, name, rows: np.concatenate(
            [np.ones((rows, 1)), *[getattr(x, name).reshape(rows, -1) for x in levels]], axis=1)
        return cls(table(root, "chance", 1)[0], table(root, "share", 1)[0], table(first, "chance", 256), table(first, "share", 256))


def log10_chances(strings: np.ndarray, counts: np.ndarray, depth: int, top: Top) -> np.ndarray:
    """log10 of the mixture's probability of each string's byte in its context."""
    tree, out = subtree(strings, counts, depth), np.zeros(len(strings))
    plain = plain_context(strings, depth)
    nearest = (plain >> np.uint64(8 * depth)).astype(np.int64) & 255
    byte = strings & np.uint64(255)
    for bit in range(8):
        lead = (byte >> np.uint64(8 - bit)).astype(np.int64)
        node = (1 << bit) | lead
        chance = None
        for at in range(depth, 1, -1):
            level = tree[at - 2][bit]
            context = strings >> np.uint64(8 + 8 * (depth - at))
            place = np.searchsorted(level.keys, (context << np.uint64(bit)) | lead.astype(np.uint64))
            own = level.chance[place]
            chance = own if chance is None else level.share[place] * own + (1 - level.share[place]) * chance
        for own, share in ((top.chance[nearest, node], top.share[nearest, node]), (top.root_chance[node], top.root_share[node])):
            chance = share * own + (1 - share) * chance
        one = (byte >> np.uint64(7 - bit)) & np.uint64(1) == 1
        out += np.log10(np.where(one, chance, 1 - chance))
    return out


@dataclass(frozen=True)
class Model:
    """What every task needs to know: depth and buckets."""

    depth: int
    bits: int

    @property
    def width(self) -> int:
        return 8 * (self.depth + 1)

    def strings(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A block's words as codes, words of each text, strings to predict, and strings of each text."""
        lines = [b" ".join(t.lower().split()) for t in table.column("text").cast(pa.binary()).to_pylist()]
        sizes, pad = np.fromiter(map(len, lines), np.int64, len(lines)), self.depth
        edge = bytes([EDGE])
        stream = np.frombuffer(edge * pad + (edge * (pad + 1)).join(lines) + edge, np.uint8)
        firsts = np.cumsum(sizes + pad + 1) - sizes - 1
        gap = (stream == 0x20) | (stream == EDGE)
        begins = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        words = np.searchsorted(begins, np.append(firsts, len(stream)))
        near = stream[pad - 1 : -1].astype(np.uint16) << np.uint16(8) | stream[pad - 2 : -2]
        key = SHUFFLED[near]
        for back in range(3, pad + 1):
            key <<= np.uint64(8)
            key |= stream[pad - back : -back]
        key <<= np.uint64(8)
        key |= stream[pad:]
        wanted = np.ones(len(key), bool)
        for k in range(pad):
            wanted[firsts[1:] - pad - 1 - k] = False
        return word_codes(stream, begins, ends), np.diff(words), key[wanted], sizes + 1

    def counted(self, keys: np.ndarray, sizes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys, and their number in training texts."""
        trained = np.repeat(train, sizes)
        (seen, counts), (others, _) = runs(np.sort(keys[trained])), runs(np.sort(keys[~trained]))
        distinct, _ = runs(np.sort(np.concatenate([seen, others])))
        out = np.zeros(len(distinct), np.int64)
        out[np.searchsorted(distinct, seen)] = counts
        return distinct, out

    def send(self, table: pa.Table) -> pa.Table:
        block, train = table.column("block")[0].as_py(), ~held_out(table)
        codes, n_words, strings, n_strings = self.strings(table)
        words, seen = self.counted(codes, n_words, train)
        asked = exchange.requests(block, words, seen.astype(np.uint64), self.bits, 64)
        grams, counts = self.counted(strings, n_strings, train)
        more = exchange.requests(block, grams, counts.astype(np.uint64), self.bits, self.width, 1 << self.bits)
        return pa.concat_tables([asked, more])

    def is_words(self, table: pa.Table) -> bool:
        return table.column("bucket")[0].as_py() < 1 << self.bits

    def merged(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of a bucket, their summed counts, the place of each sent key, and the rows' sizes."""
        keys, counts, sizes = exchange.gathered(table)
        distinct, group, _ = grouped(keys)
        return distinct, np.bincount(group, weights=counts.astype(np.float64), minlength=len(distinct)).astype(np.int64), group, sizes

    def summary(self, table: pa.Table) -> pa.Table:
        """Of a bucket: distinct and all training words; or counts and log products by nearest byte."""
        keys, counts, _, _ = self.merged(table)
        if self.is_words(table):
            kind, slot, value = [0, 1], [0, 0], [float((counts > 0).sum()), float(counts.sum())]
        else:
            tree = subtree(keys, counts, self.depth)
            plain = plain_context(keys, self.depth)
            pair = (plain >> np.uint64(8 * self.depth) << np.uint64(8)) | (plain & np.uint64(255))
            by_byte = np.bincount(pair.astype(np.int64), weights=counts, minlength=1 << 16)
            by_node = np.zeros(1 << 16)
            for bit, level in enumerate(tree[0]):
                nearest = (UNSHUFFLED[(level.keys >> np.uint64(bit)).astype(np.int64)] >> np.uint64(8)).astype(np.int64)
                node = (1 << bit) | (level.keys & np.uint64((1 << bit) - 1)).astype(np.int64)
                by_node += np.bincount(nearest * 256 + node, weights=level.log_weighted, minlength=1 << 16)
            some, nodes = np.flatnonzero(by_byte), np.flatnonzero(by_node)
            kind = [2] * len(some) + [3] * len(nodes)
            slot, value = np.concatenate([some, nodes]), np.concatenate([by_byte[some], by_node[nodes]])
        return pa.table([pa.array(kind, pa.int32()), pa.array(slot, pa.int32()), pa.array(value, pa.float64())], names=["kind", "slot", "value"])

    def answer(self, table: pa.Table, top: Top) -> pa.Table:
        keys, counts, group, sizes = self.merged(table)
        found = counts[group] if self.is_words(table) else log10_chances(keys, counts, self.depth, top).astype(np.float32)[group]
        ends = np.cumsum(sizes)
        packed = [found[e - n : e].tobytes() for e, n in zip(ends, sizes)]
        return pa.table([table.column("block"), table.column("bucket"), pa.array(packed, pa.binary())], names=["block", "bucket", "payload"])

    def payloads(self, answers: pa.Table, keys: np.ndarray, width: int, first: int) -> np.ndarray:
        edges, out = exchange.cuts(keys, self.bits, width), np.zeros(len(keys))
        for bucket, payload in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist()):
            if 0 <= bucket - first < 1 << self.bits:
                out[edges[bucket - first] : edges[bucket - first + 1]] = np.frombuffer(payload, np.float32 if first else np.int64)
        return out

    def score(self, table: pa.Table, answers: pa.Table, totals: tuple[int, int, int]) -> pa.Table:
        tokens, distinct, ends_seen = totals
        out = held_out(table)
        codes, n_words, strings, n_strings = self.strings(table)

        def sums(keys: np.ndarray, sizes: np.ndarray, width: int, base: int, *values: Callable) -> list[np.ndarray]:
            """Sums by text of functions of what the buckets told of each key."""
            order = exchange.sorting(keys * SPREAD)
            ordered = keys[order]
            begins = np.flatnonzero(np.insert(ordered[1:] != ordered[:-1], 0, True)) if len(keys) else order
            distinct = ordered[begins]
            by_key = np.argsort(distinct)
            told = np.empty(len(distinct))
            told[by_key] = self.payloads(answers, distinct[by_key], width, base)
            text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
            times = np.diff(np.append(begins, len(keys)))
            return [np.bincount(text, weights=np.repeat(f(told), times), minlength=len(sizes)) for f in values]

        base, known = sums(codes, n_words, 64, 0, lambda c: np.log10((c + 1) / (tokens + distinct + 1)), lambda c: c > 0)
        (score,) = sums(strings, n_strings, self.width, 1 << self.bits, lambda x: x)
        columns = [
            table.column("id"), pa.array(out), pa.array(n_words + 1, pa.int64()),
            pa.array(known.astype(np.int64) + (ends_seen > 0), pa.int64()), pa.array([tokens] * len(out), pa.int64()),
            pa.array(base + np.log10((ends_seen + 1) / (tokens + distinct + 1))),
            pa.array(score), pa.array(n_strings, pa.int64()),
        ]
        return pa.table(columns, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"])


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and their numbers."""
    begins = np.flatnonzero(np.insert(ordered[1:] != ordered[:-1], 0, True)) if len(ordered) else np.zeros(0, np.int64)
    return ordered[begins], np.diff(np.append(begins, len(ordered)))


def held_out(table: pa.Table) -> np.ndarray:
    return table.column("held").to_numpy(zero_copy_only=False).astype(bool)


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 5, folds: int = 7, fold: int = 2,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """The model's log10 probability of every text, after learning from all texts but one fold.

    A row is held out if crc32 of its id as text leaves ``fold`` modulo ``folds``; a null id counts
    as empty text.  Texts (null: empty) are lower-cased in A-Z and read as their words (white space:
    x20, x09-x0D) with one space between and an end; the same events as in ``base_score``, the sum
    over words and end of log10((c + 1) / (N + V + 1)) with counts of the training part.

    One row for each input row, repeated rows included: ``id_col``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``n_bytes`` (scored, with the end) and
    ``bits_per_byte``; single chances travel as 32-bit floats.  Without any training text all chances are even.  Other columns are not read.
    """
    if depth < 2:
        raise ValueError("the depth is 2 at least")
    texts = id_and_text(docs, id_col, text_col)
    held = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))) % folds == fold
    texts = texts.withColumn("held", held)
    blocks, count = in_blocks(texts, block_bytes)
    model = Model(depth, min(16, max(0, (count - 1).bit_length())))
    asked = staged(blocks.groupBy("block").applyInArrow(lambda rows: model.send(rows), exchange.REQUEST), "strings")
    parts = asked.groupBy("bucket").applyInArrow(lambda rows: model.summary(rows), "kind int, slot int, value double")
    sums = staged(parts.groupBy("kind", "slot").agg(F.sum("value").alias("value")), "sums").collect()  # at most 2 x 65,536 rows
    arrays = {kind: np.zeros(1 << 16) for kind in range(4)}
    for r in sums:
        arrays[r.kind][r.slot] = r.value
    ends_seen = texts.agg(F.coalesce(F.sum((~held).cast("long")), F.lit(0)).alias("n")).first()["n"]
    totals = (int(arrays[1][0]) + ends_seen, int(arrays[0][0]) + (ends_seen > 0), ends_seen)
    top = Top.of(arrays[2].reshape(256, 256), arrays[3].reshape(256, 256))
    sent = docs.sparkSession.sparkContext.broadcast(top)
    answers = asked.groupBy("bucket").applyInArrow(lambda rows: model.answer(rows, sent.value), REPLY)
    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda rows, told: model.score(rows, told, totals), schema
    )
    bits = -F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")
    return scored.withColumnRenamed("id", id_col).withColumn("bits_per_byte", bits)
