"""Connect candidates that share keys, without the pairs of a group: by representatives, and bits of what nodes have of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import bytes_of, staged
from shelfwise.llm.components import components
from shelfwise.llm.repeats import BASE, mix, window_prints, word_codes, word_spans

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Text that a task takes apart at once.
PART_BYTES = 2 << 20


def shingle_prints(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit fingerprints of every run of ``size`` words of each text, repeats included, and where each text begins.

    A-Z is lower-cased; words are runs without white space (x20, x09-x0D).  Fewer words are one run.
    """
    data = LOWER[data]
    begins, ends, starts = word_spans(data, offsets)
    codes, words = word_codes(data, begins, ends), np.diff(starts)
    counts = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    firsts = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(starts[:-1] - firsts[:-1], counts) + np.arange(firsts[-1])
    prints, long = np.empty(len(at), np.uint64), np.repeat(words >= size, counts)
    prints[long] = window_prints(codes, size, at[long])
    for few in range(1, size):
        some = np.flatnonzero(words == few)
        made = np.full(len(some), few, np.uint64)
        for i in range(few):
            made = mix(made * np.uint64(BASE) + codes[starts[some] + i])
        prints[firsts[some]] = made
    return prints, firsts


def distinct_prints(prints: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct fingerprints, sorted, and where each text begins."""
    holder = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    order = np.lexsort((prints, holder))
    prints, holder = prints[order], holder[order]
    new = np.ones(len(prints), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (holder[1:] != holder[:-1])
    return prints[new], np.searchsorted(holder[new], np.arange(len(firsts)))


def in_parts(column: pa.Array) -> Iterator[pa.Array]:
    """Slices of a text column of about ``PART_BYTES`` each; a longer text is one of its own."""
    ends = np.cumsum(pc.binary_length(column.cast(pa.large_binary())).to_numpy(zero_copy_only=False)) if len(column) else []
    begin = 0
    while begin < len(column):
        past = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PART_BYTES, side="right"))
        end = max(begin + 1, past)
        yield column.slice(begin, end - begin)
        begin = end


def sets_of(column: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct fingerprints of each text, sorted."""
    out: list[np.ndarray] = []
    for part in in_parts(column):
        prints, firsts = distinct_prints(*shingle_prints(*bytes_of(part), size))
        out += np.split(prints, firsts[1:-1])
    return out


def word_sets(text: str, size: int) -> set[tuple[bytes, ...]]:
    words = text.encode().translate(bytes(LOWER)).split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def enough(common: int, one: int, other: int, percent: int) -> bool:
    return 100 * common >= percent * (one + other - common)


def compared(batch: pa.RecordBatch, size: int, percent: int) -> Iterator[tuple[bool, bytes, int]]:
    """For each row whether ``one`` and ``other`` have a Jaccard similarity of ``percent`` or more, which shingles of
    ``other`` the first has (a bit each), and how many it has besides.

    Sets of fingerprints turn most pairs down; what they let pass is compared by its words.
    """
    for one, other, x, y in zip(sets_of(batch.column("one"), size), sets_of(batch.column("other"), size), batch.column("one"), batch.column("other")):
        has = np.isin(other, one, assume_unique=True)
        common = int(has.sum())
        good = enough(common, len(one), len(other), percent)
        if good:
            a, b = word_sets(x.as_py(), size), word_sets(y.as_py(), size)
            good = enough(len(a & b), len(a), len(b), percent)
        yield good, np.packbits(np.pad(has, (0, -len(has) % 64))).tobytes(), len(one) - common


def possible(few: pa.Table, many: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different groups, of a row of each table, that may link by what both have of one set.

    Two sets share what both have of that set, and beside it no more than either has outside it in common with any.
    """

    def unpacked(table: pa.Table) -> tuple[np.ndarray, ...]:
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(table), -1)
        return bits, *(table.column(c).to_numpy() for c in ("node", "group", "size", "free"))

    (bits, node, group, size, free), (bits_2, node_2, group_2, size_2, free_2) = unpacked(few), unpacked(many)
    found, step = [], max(1, (1 << 20) // max(1, bits_2.size))
    for s in range(0, len(node), step):
        at = slice(s, s + step)
        both = np.bitwise_count(bits[at, None, :] & bits_2[None, :, :]).sum(axis=2, dtype=np.int64)
        most = both + np.minimum(free[at, None], free_2[None, :])
        good = (100 * most >= percent * (size[at, None] + size_2[None, :] - most)) & (group[at, None] != group_2[None, :])
        x, y = np.nonzero(good)
        found.append((node[at][x], node_2[y]))
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))


def connected(members: DataFrame, texts: DataFrame, size: int, percent: int, few_bytes: int = 1 << 20, many_bytes: int = 16 << 20) -> DataFrame:
    """Verified links ``a``, ``b`` that connect whatever the links among all members of each key connect.

    ``members`` has ``key``, ``node``, ``size`` (of its set of shingles) and ``alone`` (how many of these no other node
    has, or 0); ``texts`` has ``node`` and ``text``.

    1. Every key names a representative: its node whose keys are the most shared.  All its nodes are compared with it
       by their words.  Nodes have most of their representatives in common over their keys, so a group of copies
       costs its rows and not its pairs.
    2. Nodes that met a representative and are still in different groups may link with each other.  Each left a bit
       for every shingle of the representative.  These tell, without the texts, the most that two nodes can have in
       common; nodes outside a representative's largest group are held against all of its nodes in blocks of bits.
    3. The few pairs that pass are compared by their words.

    So every pair that shares a key is compared, connected already, or shown to be too far apart.
    """
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    shared = staged(members.join(sizes, "key"), "shared")
    scores = staged(shared.groupBy("node").agg(F.sum("held").alias("score"), F.min("size").alias("size"), F.min("alone").alias("alone")), "scores")
    texts = staged(texts.join(scores.select("node"), "node", "left_semi"), "texts")
    ranked = shared.select("key", "node").join(scores.select("node", "score"), "node")
    reps = ranked.groupBy("key").agg(F.max(F.struct("score", F.negative("node").alias("order"))).alias("best")).select("key", (-F.col("best.order")).alias("rep"))
    met = shared.select("key", "node").join(reps, "key").filter("node != rep").select("node", "rep").distinct()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, bits, extra = ([*zip(*compared(batch, size, percent))] if batch.num_rows else ([], [], []))
            made = [batch.column("a"), batch.column("b"), pa.array(good, pa.bool_()), pa.array(bits, pa.binary()), pa.array(extra, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, ["a", "b", "good", "bits", "extra"])

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        first = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("one")), "a")
        both = first.join(texts.select(F.col("node").alias("b"), F.col("text").alias("other")), "b").select("a", "b", "one", "other")
        return staged(both.mapInArrow(compare, "a long, b long, good boolean, bits binary, extra long"), name)

    star = verified(met.select(F.col("node").alias("a"), F.col("rep").alias("b")), "star")
    links = star.filter("good").select("a", "b")
    groups = components(links).distinct()
    known = star.select(F.col("b").alias("rep"), F.col("a").alias("node"), "bits", "extra").join(scores, "node").join(groups, "node", "left")
    known = staged(known.select("rep", "node", "bits", "size", F.greatest(F.col("extra") - F.col("alone"), F.lit(0)).alias("free"), F.coalesce("component", "node").alias("group")), "known")
    by_group = known.groupBy("rep", "group").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("bits")).alias("bytes"))
    apart = by_group.groupBy("rep").agg(
        F.count(F.lit(1)).alias("groups"), F.max_by("group", F.struct("n", "group")).alias("largest"),
        F.sum("bytes").alias("all"), F.max_by("bytes", F.struct("n", "group")).alias("main"),
    ).filter("groups > 1")
    blocks = [F.ceil(F.greatest(c, F.lit(1)) / n).cast("int") for c, n in ((F.col("all") - F.col("main"), few_bytes), (F.col("all"), many_bytes))]
    apart = staged(apart.select("rep", "largest", blocks[0].alias("i_of"), blocks[1].alias("j_of")), "apart")
    open_nodes = known.join(apart, "rep")
    own = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    kept = [F.col(c).alias(c) for c in ("rep", "node", "bits", "size", "free", "group")]
    few = open_nodes.filter(F.col("group") != F.col("largest")).select(*kept, own("i_of").alias("i"), every("j_of").alias("j"))
    many = open_nodes.select(*kept, own("j_of").alias("j"), every("i_of").alias("i"))

    def pairs(few: pa.Table, many: pa.Table) -> pa.Table:
        x, y = possible(few, many, percent) if len(few) and len(many) else (np.zeros(0, np.int64),) * 2
        return pa.table([pa.array(np.maximum(x, y), pa.int64()), pa.array(np.minimum(x, y), pa.int64())], names=["a", "b"])

    close = few.groupBy("rep", "i", "j").cogroup(many.groupBy("rep", "i", "j")).applyInArrow(pairs, "a long, b long").distinct()
    tried = star.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    close = verified(close.join(tried, ["a", "b"], "left_anti"), "close")
    return links.union(close.filter("good").select("a", "b"))
