"""N-gram Jaccard join: prefixes of single rare shingles and of combinations of frequent ones."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm import exchange
from shelfwise.llm.common import bytes_of, id_and_text, in_blocks, staged
from shelfwise.llm.components import components
from shelfwise.llm.linking import connected, distinct_prints, in_parts, shingle_prints
from shelfwise.llm.repeats import BASE, grouped, mix

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALONE, RARE, FREQUENT, HOT = range(4)
#: Shingles of a combination, by class.
TOGETHER = {RARE: 1, FREQUENT: 2, HOT: 3}


def word_line(text: Column | str) -> Column:
    """The words, lower-cased in A-Z and joined by one space."""
    return F.trim(F.regexp_replace(F.translate(text, UPPER, SMALL), r"[\x20\x09-\x0D]+", " "))


@dataclass(frozen=True)
class Prefixes:
    """Which keys a set is found by.

    Shingles have classes by the number of different texts that hold them: one text alone, up to ``rare``, up to
    ``frequent``, more.  They are ordered by class, then by fingerprint.  Two sets that link share all but a few of
    their shingles, so they share one or more of the first few that others hold.  Rare ones are keys by themselves.
    Frequent ones are dealt to groups by fingerprint, and keys are the combinations of two (three, if more than
    ``frequent`` texts hold them) within a group; since up to one (two) common shingles of each group may go without a
    key, prefixes are extended until each loss is made up for.
    """

    size: int = 5
    percent: int = 80
    rare: int = 8
    frequent: int = 256

    def __post_init__(self):
        if not 80 <= self.percent <= 100:  # below, groups could cost more than prefixes can make up for
            raise ValueError("percent must be from 80 to 100")

    def spare(self, n: int | np.ndarray) -> int | np.ndarray:
        """Shingles of a set of ``n`` that a linked set may lack."""
        return n - (self.percent * n + 99) // 100

    def classes(self, table: pa.Table) -> pa.Table:
        """A bucket's answers: the class of each shingle, two bits, first all lower then all upper ones."""
        keys, counts, sizes = exchange.gathered(table)
        distinct, group, _ = grouped(keys)
        held = np.bincount(group, weights=counts.astype(np.float64), minlength=len(distinct)).astype(np.int64)
        code = np.searchsorted([1, self.rare, self.frequent], held, side="left")[group].astype(np.uint8)
        ends = np.cumsum(sizes)
        parts = [code[e - n : e] for e, n in zip(ends, sizes)]
        packed = [np.packbits(c & 1).tobytes() + np.packbits(c >> 1).tobytes() for c in parts]
        return pa.table([table.column("block"), table.column("bucket"), pa.array(packed, pa.binary())], schema=exchange.REPLY_SCHEMA)

    def levels(self, n: int) -> set[int]:
        """Levels at which a set of ``n`` has keys: its own, and that of the smallest set it can link to.

        Sets of one level deal their shingles to the same number of groups, which is about in proportion to the size.
        """
        return {n.bit_length(), ((self.percent * n + 99) // 100).bit_length()}

    def keys(self, prints: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Keys of a set (sorted fingerprints and their classes); none if too many shingles are in no other text."""
        n = len(prints)
        needed = self.spare(n) - int((kinds == ALONE).sum()) + 1
        if needed < 1:
            return np.zeros(0, np.uint64)
        if 100 * n // self.percent == n:  # too small for a larger partner: only equal sets link
            return np.bitwise_xor.reduce(mix(prints * np.uint64(BASE) + np.uint64(n)), keepdims=True)
        rare = prints[kinds == RARE]
        if len(rare) >= needed:
            return mix(rare[:needed])
        found = [mix(rare)]
        for level in self.levels(n):
            found.append(self.combined(prints, kinds, needed - len(rare), level))
        return np.unique(np.concatenate(found))

    def combined(self, prints: np.ndarray, kinds: np.ndarray, needed: int, level: int) -> np.ndarray:
        """Combinations that make up for ``needed`` shingles, of the groups at a level."""
        groups: dict[tuple[int, int], list[int]] = {}
        for kind, dealt in ((FREQUENT, max(1, 1 << level >> 3)), (HOT, max(1, 1 << level >> 4))):
            of_kind = prints[kinds == kind]
            for x, g in zip(of_kind.tolist(), ((of_kind >> np.uint64(20)) % np.uint64(dealt)).tolist()):
                if not needed:
                    break
                group = groups.setdefault((kind, g), [])
                group.append(x)
                needed -= len(group) >= TOGETHER[kind]
        made = []
        for k in (2, 3):
            sets = [c for (kind, _), group in groups.items() if TOGETHER[kind] == k for c in itertools.combinations(group, k)]
            code = np.full(len(sets), k, np.uint64)
            for column in np.array(sets, np.uint64).reshape(-1, k).T:
                code = mix(code * np.uint64(BASE) + column)
            made.append(code)
        return np.concatenate(made)


@dataclass(frozen=True)
class Job:
    """Bits of buckets and of the fingerprints that count how many texts hold a shingle."""

    prefixes: Prefixes
    bits: int
    width: int

    def block(self, table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        """The block's rows by node, their distinct fingerprints, and where each row's begin."""
        table = table.sort_by([("id", "ascending")])
        prints, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for part in in_parts(table.column("text").combine_chunks()):
            found, firsts = distinct_prints(*shingle_prints(*bytes_of(part), self.prefixes.size))
            prints.append(found)
            sizes.append(np.diff(firsts))
        return table, np.concatenate(prints), np.cumsum(np.concatenate(sizes))

    def short(self, prints: np.ndarray) -> np.ndarray:
        return prints >> np.uint64(64 - self.width)

    def send(self, table: pa.Table) -> pa.Table:
        """Each distinct fingerprint of a block and how many of its texts hold it."""
        block = table.column("block")[0].as_py()
        keys, counts = np.unique(self.short(self.block(table)[1]), return_counts=True)
        return exchange.requests(block, keys, counts.astype(np.uint64), self.bits, self.width)

    def kinds(self, keys: np.ndarray, answers: pa.Table) -> np.ndarray:
        edges, kinds = exchange.cuts(keys, self.bits, self.width), np.zeros(len(keys), np.uint8)
        for bucket, packed in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()):
            s, e = edges[bucket], edges[bucket + 1]
            low, high = np.frombuffer(packed, np.uint8).reshape(2, -1)
            kinds[s:e] = np.unpackbits(low, count=e - s) | np.unpackbits(high, count=e - s) << 1
        return kinds

    def sign(self, table: pa.Table, answers: pa.Table) -> pa.Table:
        """Size, shingles that are in no other text, and keys of each node."""
        kind, names = pa.list_(pa.int64()), ["node", "size", "alone", "keys"]
        if not len(table):
            return pa.table([*[pa.array([], pa.int64())] * 3, pa.array([], kind)], names=names)
        table, prints, starts = self.block(table)
        keys, group = np.unique(self.short(prints), return_inverse=True)
        kinds = self.kinds(keys, answers)[group]
        alone = np.diff(np.concatenate([[0], np.cumsum(kinds == ALONE)])[starts])
        sizes = np.diff(starts)
        worth = (sizes > 0) & (alone <= self.prefixes.spare(sizes))
        made = [self.prefixes.keys(prints[s:e], kinds[s:e]).view(np.int64) if w else [] for s, e, w in zip(starts[:-1], starts[1:], worth)]
        return pa.table([table.column("id"), pa.array(sizes, pa.int64()), pa.array(alone, pa.int64()), pa.array(made, kind)], names=names)


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefixes: Prefixes = Prefixes(), block_bytes: int = 4 << 20,
) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` of every row.

    A text's set are its distinct runs of ``size`` words, lower-cased in A-Z; words are runs without white space (x20,
    x09-x0D), and fewer words are one run.  Sets link if their intersection is ``percent`` hundredths of their union
    or more, and ``component_id`` is the smallest id reachable.

    1. Texts of equal words are one node, so that copies cost a row each and no more.
    2. Blocks of nodes send each distinct fingerprint once, with the number of nodes; buckets answer with its class.
    3. Most nodes hold more shingles that no other does than a linked one may lack.  They have no keys and go no
       further.  The others have the keys of :class:`Prefixes`; nodes that share one are candidates.
    4. Candidates are connected by representatives of the keys (``linking``), verified on their words.

    All links are kept that connect different groups; none is sought by chance, so the result is exact.  Texts that
    are null, empty or without words have no set and link with nothing.  Rows without an id belong to the component of
    their text and may connect others; a component without any id has a null one.  Repeated rows give a row each,
    rows that share an id with different texts are texts of their own.  No rows give none; other columns stay outside.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("words", F.unhex(F.md5(word_line("text"))))
    nodes = rows.groupBy("words").agg(F.min("id").alias("least"), F.min("text").alias("text"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    texts = nodes.select(F.col("node").alias("id"), "text")
    blocks, count = in_blocks(texts, block_bytes)
    # About six bytes a shingle; 64 times as many values keep most shingles of one text alone.
    width = min(62, max(24, (count * block_bytes // 4).bit_length() + 6))
    job = Job(prefixes, max(0, (count - 1).bit_length()), width)
    told = staged(exchange.ask(blocks.groupBy("block").applyInArrow(lambda b: job.send(b), exchange.REQUEST), lambda b: prefixes.classes(b)), "classes")
    signed = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lambda b, a: job.sign(b, a), "node long, size long, alone long, keys array<long>")
    signed = staged(signed, "signed")

    members = signed.select("node", "size", "alone", F.explode("keys").alias("key"))
    links = connected(members, texts.withColumnRenamed("id", "node"), prefixes.size, prefixes.percent)
    named = nodes.select("node", "words", "least").join(components(links).distinct(), "node", "left").withColumn("group", F.coalesce("component", "node"))
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    known = staged(named.join(signed.select("node", "size"), "node").join(smallest, "group").select("words", "size", "component_id"), "named")
    found = rows.select("id", "words").join(known, "words")
    own = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id"))
    return found.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), own.alias("component_id"))
