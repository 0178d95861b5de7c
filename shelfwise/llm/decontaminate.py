"""Benchmark decontamination with a positional inverted index, dealt by documents.

A shard of the index holds some megabytes of documents: for every term the ascending positions of
its occurrences.  Test phrases are found by intersecting lists shifted by the terms' offsets, from
the term that is rarest in all documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import bytes_of, id_and_text, ids_of, staged
from shelfwise.llm.repeats import word_codes, word_spans

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Everything in ASCII but digits and small letters parts words.
BETWEEN = np.zeros(256, bool)
BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

INDEX = (
    "shard long, ids array<long>, starts array<int>, terms array<long>, sizes array<int>, positions array<int>"
)
FOUND = "shard long, row int, id long, n_words long, hits array<int>, items array<string>"


def words_of(text: str | None) -> np.ndarray:
    """Fingerprints of a text's words."""
    data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    begins, ends, _ = word_spans(data, np.array([0, len(data)]), BETWEEN)
    return word_codes(data, begins, ends)


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases of test items as term fingerprints, and the items that each belongs to."""

    windows: list[np.ndarray]
    items: list[tuple[str, ...]]

    @classmethod
    def of(cls, rows: list[tuple[str | None, str | None]], size: int) -> Phrases:
        holders: dict[bytes, set] = defaultdict(set)
        for item, text in rows:
            terms = words_of(text)
            for i in range(max(1, len(terms) - size + 1) if len(terms) else 0):
                holders[terms[i : i + size].tobytes()].add(item)
        return cls([np.frombuffer(w, np.uint64) for w in holders], [tuple(i for i in names if i is not None) for names in holders.values()])

    @property
    def terms(self) -> np.ndarray:
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *self.windows]))


def build_index(docs: DataFrame, terms: np.ndarray, shard_bytes: int = 4 << 20) -> DataFrame:
    """The postings of ``terms`` in rows of ``common.id_and_text``, a row for each shard of documents.

    A shard takes whole documents up to ``shard_bytes``, or one longer document.
    """
    terms = np.unique(terms)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            shard = (np.cumsum(sizes) - sizes) // shard_bytes
            edges = np.concatenate([np.flatnonzero(np.insert(shard[1:] != shard[:-1], 0, True)), [len(shard)]]) if len(shard) else [0]
            for s, e in zip(edges[:-1], edges[1:]):
                part = pa.Table.from_batches([batch.slice(s, e - s)])
                data, offsets = bytes_of(part.column("text"))
                data = LOWER[data]
                begins, ends, starts = word_spans(data, offsets, BETWEEN)
                codes = word_codes(data, begins, ends)
                place = np.minimum(np.searchsorted(terms, codes), len(terms) - 1) if len(terms) else np.zeros(len(codes), np.int64)
                at = np.flatnonzero(terms[place] == codes) if len(terms) else np.zeros(0, np.int64)
                at = at[np.argsort(place[at], kind="stable")]
                held, counts = np.unique(place[at], return_counts=True)
                row = [ids_of(part), starts, terms[held].view(np.int64) if len(terms) else held, counts, at]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
                lists = [pa.array([x.astype(k.to_pandas_dtype())], pa.list_(k)) for x, k in zip(row, kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), *lists], ["shard", "ids", "starts", "terms", "sizes", "positions"])

    made = docs.select("id", "text").mapInArrow(index, INDEX)
    return made.withColumn("shard", F.monotonically_increasing_id())


def frequencies(index: DataFrame) -> dict[int, int]:
    """Occurrences of each term of the index; as many as the test phrases' terms."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x"))
    counts = pairs.groupBy("x.terms").agg(F.sum("x.sizes").alias("n"))
    return {r["terms"] & (2**64 - 1): r["n"] for r in counts.collect()}


def intersect(postings: dict[int, np.ndarray], window: np.ndarray, rarest: np.ndarray, slop: int = 0) -> np.ndarray:
    """Starts of the window: every term at its offset, or up to ``slop`` places from there.

    ``rarest`` lists offsets from the rarest term on; an empty list ends the search.
    """
    first = postings.get(int(window[rarest[0]]))
    if first is None:
        return np.zeros(0, np.int64)
    starts = first - rarest[0]
    if slop:
        starts = np.unique((starts[:, None] + np.arange(-slop, slop + 1)[None, :]).ravel())
    starts = starts[starts >= 0]
    for j in rarest[1:]:
        if not len(starts):
            break
        other = postings.get(int(window[j]))
        if other is None:
            return starts[:0]
        low = np.searchsorted(other, starts + j - slop)
        starts = starts[other[np.minimum(low, len(other) - 1)] - (starts + j) <= slop] if slop else starts[other[np.minimum(low, len(other) - 1)] == starts + j]
    return starts


def postings_of(row: dict) -> dict[int, np.ndarray]:
    ends = np.cumsum(row["sizes"])
    return {int(t) & (2**64 - 1): row["positions"][e - n : e] for t, n, e in zip(row["terms"], row["sizes"], ends)}


def search(index: DataFrame, phrases: Phrases, counts: dict[int, int], slop: int = 0) -> DataFrame:
    """A row for each document: words inside an occurrence of a phrase, and the items that occur.

    With ``slop`` every term may stand up to that many places from its own (a proximity match); the
    words between the outermost possible places count as inside.
    """
    wanted = []
    for window, items in zip(phrases.windows, phrases.items):
        seen = [counts.get(int(t), 0) for t in window]
        if all(seen):
            wanted.append((window, np.argsort(seen, kind="stable"), items))
    sent = index.sparkSession.sparkContext.broadcast(wanted)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ids", "starts", "terms", "sizes", "positions")}
                postings, starts = postings_of(row), row["starts"]
                total = int(starts[-1])
                change, names = np.zeros(total + 1, np.int64), defaultdict(set)
                for window, rarest, items in sent.value:
                    found = intersect(postings, window, rarest, slop)
                    if not len(found):
                        continue
                    last = found + len(window) - 1
                    holder = np.searchsorted(starts, found, side="right") - 1
                    inside = (last < total) & (last < starts[np.minimum(holder + 1, len(starts) - 1)])
                    for s, d in zip(found[inside].tolist(), holder[inside].tolist()):
                        low, high = max(s - slop, int(starts[d])), min(s + len(window) + slop, int(starts[d + 1]))
                        change[low] += 1
                        change[high] -= 1
                        names[d].update(items)
                hit = np.flatnonzero(np.cumsum(change)[:-1] > 0)
                cut = np.searchsorted(hit, starts)
                local = hit - np.repeat(starts[:-1], np.diff(cut))
                n = len(row["ids"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("shard")[i].as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()),
                        pa.array(row["ids"], pa.int64()), pa.array(np.diff(starts), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(local, pa.int32())),
                        pa.array([sorted(names.get(d, ())) for d in range(n)], pa.list_(pa.string())),
                    ],
                    ["shard", "row", "id", "n_words", "hits", "items"],
                )

    return index.mapInArrow(find, FOUND)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = 13, share: int = 20, slop: int = 0, block_bytes: int = 1 << 20,
) -> DataFrame:
    """How much of every document lies in phrases of ``benchmark``.

    Words are runs of small letters, digits and non-ASCII bytes after lower-casing A-Z.  Phrases are
    all windows of ``window`` words of an item, or the item itself if it has fewer words but some.
    Test items go in blocks of at most ``block_bytes`` (a longer item is a block), each against an
    index of its terms; the blocks' results add up.

    One row for each input row: ``id_col``, ``n_words``, ``n_hit``, ``hits`` (word positions inside
    an occurrence), ``items`` (ids as text, sorted), ``contaminated``: some words are hit, at least
    one in ``share``.  Null texts have no words; an item without id hits words but isn't listed;
    repeated rows are rows of their own.  Other columns are not read.
    """
    texts = id_and_text(docs, id_col, text_col)
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"), benchmark[item_text_col].alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks, found = max(1, -(-2 * total // block_bytes)), None
    texts = texts if blocks == 1 else staged(texts, "texts")
    for block in range(blocks):
        dealt = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        phrases = Phrases.of([tuple(r) for r in dealt.collect()], window)
        index = staged(build_index(texts, phrases.terms), "index")
        hits = search(index, phrases, frequencies(index), slop)
        # Every block scans the same stored rows, so a shard has the same documents in all of them.
        found = hits if found is None else found.union(hits)
    if blocks > 1:
        found = found.groupBy("shard", "row").agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    n_hit = F.size("hits").cast("long")
    unset = F.when(F.col("id") != (1 << 63) - 1, F.col("id"))
    return found.select(
        unset.alias(id_col), "n_words", n_hit.alias("n_hit"), "hits", "items",
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
