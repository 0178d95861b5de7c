"""SimHash near-dedup: fingerprints meet in the middle of their balls."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import id_and_text, staged
from shelfwise.llm.components import components

BITS = 64
#: Rows of variants that a task makes and sorts.
TASK_ROWS = 400_000


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words, lower-cased in A-Z; of all words, if fewer."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(line, 42)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[: 1 - size].tolist()
    return np.array([digest(line[b:e], 42) for b, e in zip(begins, ends[size - 1 :].tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if over half of the hashes have it, as a signed long; 0 without hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        rows = hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(texts: DataFrame, size: int) -> DataFrame:
    """``id``, ``fp`` of rows of ``common.id_and_text``."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t.as_py(), size)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.int64())], ["id", "fp"])

    return texts.select("id", "text").mapInArrow(of, "id long, fp long")


def punctures(parts: int) -> list[np.uint64]:
    """Masks that leave out one of ``parts`` runs of bits each."""
    edges = [round(BITS * i / parts) for i in range(parts + 1)]
    full = (1 << BITS) - 1
    return [np.uint64(full ^ (((1 << (e - s)) - 1) << s)) for s, e in zip(edges, edges[1:])]


def ball(fps: np.ndarray, mask: np.uint64) -> np.ndarray:
    """Every fingerprint under the mask with at most one of the mask's bits flipped, by row."""
    bits = np.array([0] + [1 << i for i in range(BITS) if int(mask) >> i & 1], np.uint64)
    return (fps & mask)[:, None] ^ bits[None, :]


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a group that connect what its links at ``radius`` connect; at most one less than its rows."""
    if len(fps) == 2:
        return [(1, 0)] if int(fps[0] ^ fps[1]).bit_count() <= radius else []
    links, left = [], np.arange(len(fps))
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= radius
            links += [(int(x), int(at)) for x in left[near]]
            frontier += left[near].tolist()
            left = left[~near]
    return links


def _links(batches: Iterator[pa.RecordBatch], radius: int, most: int) -> Iterator[pa.RecordBatch]:
    """Verified links (``a`` with ``b``) of each run of equal keys; rows of longer runs with ``b`` null."""
    open_key, open_fps, open_reps, long_run = None, np.zeros(0, np.uint64), np.zeros(0, np.int64), False

    def flush(a: list, b: list, fp: list) -> None:
        nonlocal open_fps, open_reps
        if long_run or len(open_fps) > most:
            a += open_reps.tolist()
            b += [None] * len(open_reps)
            fp += open_fps.view(np.int64).tolist()
        elif len(open_fps) > 1:
            pairs = forest(open_fps, radius)
            a += [int(open_reps[x]) for x, _ in pairs]
            b += [int(open_reps[y]) for _, y in pairs]
            fp += [None] * len(pairs)
        open_fps, open_reps = open_fps[:0], open_reps[:0]

    def made(a: list, b: list, fp: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, fp)], ["a", "b", "fp"])

    for batch in batches:
        keys, fps, reps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "rep"))
        if not len(keys):
            continue
        fps, a, b, fp = fps.view(np.uint64), [], [], []
        begins = np.flatnonzero(np.insert(keys[1:] != keys[:-1], 0, True))
        ends = np.append(begins[1:], len(keys))
        worth = ends - begins > 1
        worth[[0, -1]] = True  # may go on from or into another batch
        for s, e in zip(begins[worth].tolist(), ends[worth].tolist()):
            if keys[s] != open_key:
                flush(a, b, fp)
                open_key, long_run = keys[s], False
            open_fps, open_reps = np.append(open_fps, fps[s:e]), np.append(open_reps, reps[s:e])
            if len(open_fps) > most:
                long_run = True
                flush(a, b, fp)
        yield made(a, b, fp)
    a, b, fp = [], [], []
    flush(a, b, fp)
    yield made(a, b, fp)


def _whole_balls(nodes: DataFrame) -> DataFrame:
    """Links among fingerprints that share a long run, without looking at pairs.

    Every fingerprint emits all variants up to one flipped bit (near) and those with two flipped bits
    of the same half (far).  Of three differing bits two lie in one half, so any two fingerprints
    within three bits meet on a variant that one of them is near to.  All others at that variant
    lie within three bits of a near one, which they link to.
    """
    ones = [1 << i for i in range(BITS)]
    twos = [1 << i | 1 << j for i in range(BITS) for j in range(i) if (i < 32) == (j < 32)]
    flips = np.array([0, *ones, *twos], np.uint64)
    near = np.arange(len(flips)) <= BITS

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            reps = batch.column("rep").to_numpy(zero_copy_only=False)
            for s in range(0, len(fps), 64):
                part = fps[s : s + 64]
                keys = (part[:, None] ^ flips[None, :]).view(np.int64).ravel()
                rows = [pa.array(keys), pa.array(np.repeat(reps[s : s + 64], len(flips))), pa.array(np.tile(near, len(part)))]
                yield pa.RecordBatch.from_arrays(rows, ["key", "rep", "near"])

    variants = nodes.mapInArrow(emit, "key long, rep long, near boolean")
    centres = variants.filter("near").groupBy("key").agg(F.min("rep").alias("b"))
    return variants.join(centres, "key").filter("rep > b").select(F.col("rep").alias("a"), "b").distinct()


def simhash_links(nodes: DataFrame, parts: int = 3, most: int = 4096) -> DataFrame:
    """Links ``a``, ``b`` among ``nodes`` (``fp``, ``rep``) that connect all within three bits.

    Half of a radius of three is no whole number, so one of ``parts`` runs of bits is left out in
    turn: some run holds a differing bit, and what remains differs in at most two.  Every
    fingerprint emits all variants of the remaining bits within half of that, one flipped bit, and
    rows are shuffled on variants.  Candidates are verified on all 64 bits; a run of equal variants
    gives a spanning forest of its links, not its pairs.  Runs beyond ``most`` go another exact way.
    """
    masks = punctures(parts)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            reps = batch.column("rep").to_numpy(zero_copy_only=False)
            for s in range(0, len(fps), 256):
                part = fps[s : s + 256]
                keys = np.concatenate([ball(part, mask) for mask in masks], axis=1)
                rows = [keys.view(np.int64).ravel(), np.repeat(part.view(np.int64), keys.shape[1]), np.repeat(reps[s : s + 256], keys.shape[1])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["key", "fp", "rep"])

    tasks = max(1, -(-nodes.count() * sum(1 + int(m).bit_count() for m in masks) // TASK_ROWS))
    variants = nodes.repartition(tasks, "fp").mapInArrow(emit, "key long, fp long, rep long")
    runs = variants.repartition(tasks, "key").sortWithinPartitions("key")
    found = staged(runs.mapInArrow(lambda rows: _links(rows, 3, most), "a long, b long, fp long"), "near")
    links = found.filter("b IS NOT NULL").select("a", "b")
    crowded = found.filter("b IS NULL").select("fp", F.col("a").alias("rep")).distinct()
    if crowded.isEmpty():
        return links
    return links.union(_whole_balls(crowded.repartition(tasks, "fp")))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id_col``, ``fingerprint`` (hex) and ``component_id`` of every row.

    Texts are lower-cased in A-Z; words are runs without white space (x20, x09-x0D); shingles of
    ``shingle`` words count as often as they occur, fewer words are one shingle, none (or a null
    text) give fingerprint zero.  Fingerprints within three bits link, and ``component_id`` is the
    smallest id reachable.  Equal fingerprints are one node, so copies cost one row each.  Rows
    without an id take the component of an equal fingerprint and never name or link one; where
    there is none, ``component_id`` is null.
    """
    prints = staged(fingerprints(id_and_text(docs, id_col, text_col), shingle), "prints")
    nodes = staged(prints.groupBy("fp").agg(F.min("id").alias("rep")), "nodes")
    groups = components(simhash_links(nodes.filter("rep IS NOT NULL")))
    named = nodes.join(groups, nodes.rep == groups.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )
