"""Which windows of units (bytes or words) also start in a document with a smaller id.

Positions of every document are sampled by a perfect difference cover modulo a period ``v``: for any
two positions some shift below ``v`` brings both onto sampled ones.  So equal windows of ``n`` units
hold an equal aligned anchor of ``n - v + 1`` units at the same shift in both.

1. Every block of documents names its anchors (fingerprints of the sampled positions' windows) and
   asks which of the names occur in another block, and which whole texts have a smaller id.  Those
   copies are cut whole and hold no string that the first of them has not.
2. Only windows that reach over an anchor known elsewhere are looked at whole: their fingerprints
   go with the smallest id of the block, one bucket of fingerprints at a time being sorted.
3. Documents mark the units that a window with a smaller id elsewhere covers.

No step gathers the holders of a window: a block answers for all of its documents.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from shelfwise.llm import exchange
from shelfwise.llm.common import binary_column, bytes_of, ids_of, in_blocks, staged

#: Perfect difference covers: every residue but 0 is a difference of exactly one pair.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
ANCHOR_WIDTH = 48
SEGMENT = 1 << 17

_random = np.random.Generator(np.random.PCG64(20_240_601))
BYTE_CODE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_random.integers(0, 1 << 61)) * 8 + 5
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _windows(codes: np.ndarray, n: int) -> np.ndarray:
    power, length, made, done = codes, 1, None, 0
    while n:
        step = np.uint64(pow(BASE, length, 1 << 64))
        if n & 1:
            if made is None:
                made = power
            else:
                size = min(len(made), len(power) - done)
                made = made[:size] * step + power[done : done + size]
            done += length
        n >>= 1
        if n:
            power = power[:-length] * step + power[length:]
            length *= 2
    return made


def window_prints(codes: np.ndarray, n: int, at: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the ``n`` units from each of the sorted positions ``at``."""
    out = np.empty(len(at), np.uint64)
    for s in range(0, max(0, len(codes) - n + 1), SEGMENT):
        lo, hi = np.searchsorted(at, [s, s + SEGMENT])
        if lo < hi:
            out[lo:hi] = _windows(codes[s : s + SEGMENT + n - 1], n)[at[lo:hi] - s]
    return mix(out)


@dataclass
class Units:
    """The documents of a block as one row of unit codes."""

    ids: np.ndarray
    codes: np.ndarray
    starts: np.ndarray  # of each document, and the end
    prints: np.ndarray  # two fingerprints of each whole text

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), self.sizes)


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_CODE[data], offsets


def word_spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and the number of words before each document."""
    gap = outside[data]
    before = np.ones(len(data) + 1, bool)
    before[1:] = gap
    before[offsets] = True
    begins = np.flatnonzero(~gap & before[:-1])
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:]
    after[offsets[(offsets > 0)] - 1] = True
    ends = np.flatnonzero(~gap & after) + 1
    return begins, ends, np.searchsorted(begins, offsets)


def word_codes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each word's bytes."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    lengths = ends - begins
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    inside = np.arange(total) - np.repeat(firsts, lengths)
    powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(0, int(lengths.max()) - 1), BASE, np.uint64), dtype=np.uint64)])
    parts = BYTE_CODE[data[np.repeat(begins, lengths) + inside]] * powers[inside]
    return mix(np.add.reduceat(parts, firsts))


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins, ends, starts = word_spans(data, offsets)
    return word_codes(data, begins, ends), starts


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted keys, the group of each key, and the first place of each group."""
    order = exchange.sorting(keys)
    ordered = keys[order]
    begins = np.ones(len(keys), bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(begins) - 1
    return ordered[begins], group, order[begins]


@dataclass(frozen=True)
class Search:
    """Parameters of a job: units, window, period and the buckets' bits."""

    units: Callable
    window: int
    period: int
    bits: int

    def block(self, table: pa.Table) -> tuple[pa.Table, Units]:
        """The block's rows by id, and their units."""
        table = table.sort_by([("id", "ascending")])
        data, offsets = bytes_of(table.column("text"))
        codes, starts = self.units(data, offsets)
        texts = [memoryview(data)[s:e] for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        prints = np.array([xxhash.xxh64_intdigest(t, seed) for seed in (1, 2) for t in texts], np.uint64)
        return table, Units(ids_of(table), codes, starts, prints)

    def anchors(self, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions; their distinct names, the name of each, and whether the block has it twice."""
        at, holder = self.sampled(units)
        keys, group, first = grouped(self.names(units, at))
        twice = np.zeros(len(keys), bool)
        twice[group[units.ids[holder] != units.ids[holder[first]][group]]] = True
        return at, keys, group, twice

    def sampled(self, units: Units) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the cover that begin an anchor, and their documents."""
        length, cover = self.window - self.period + 1, np.array(COVERS[self.period])
        last = units.sizes - length  # an anchor may begin at
        rounds = np.where(units.sizes >= self.window, last // self.period + 1, 0)
        each = np.repeat(np.arange(len(rounds)), rounds)
        turn = np.arange(len(each)) - np.repeat(np.cumsum(rounds) - rounds, rounds)
        place = (turn * self.period)[:, None] + cover[None, :]
        inside = (place <= last[each][:, None]).ravel()
        holder = np.repeat(each, len(cover))[inside]
        return place.ravel()[inside] + units.starts[holder], holder

    def names(self, units: Units, at: np.ndarray) -> np.ndarray:
        return window_prints(units.codes, self.window - self.period + 1, at) >> np.uint64(64 - ANCHOR_WIDTH)

    def copies(self, units: Units, answers: pa.Table) -> np.ndarray:
        """Documents whose whole text a smaller id has."""
        keys, group, first = grouped(units.prints)
        ids = np.tile(units.ids, 2)
        later = exchange.flags_of(answers, keys, self.bits, 64, 1 << self.bits)[group] | (ids > ids[first][group])
        return later.reshape(2, -1).all(axis=0)

    def candidates(self, units: Units, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows with an anchor that another document has, but in whole copies; and these."""
        at, keys, group, twice = self.anchors(units)
        known = twice | exchange.flags_of(answers, keys, self.bits, ANCHOR_WIDTH)
        at, copies = at[known[group]], self.copies(units, answers)
        holder = np.searchsorted(units.starts, at, side="right") - 1
        at, holder = at[~copies[holder]], holder[~copies[holder]]
        return self.around(units, at, holder), copies

    def around(self, units: Units, at: np.ndarray, holder: np.ndarray) -> np.ndarray:
        """Starts of whole windows that reach over an anchor."""
        if not len(at):
            return at
        begins = np.maximum(at - self.period + 1, units.starts[holder])
        ends = np.minimum(at + 1, units.starts[holder + 1] - self.window + 1)
        begins = np.maximum(begins, np.insert(np.maximum.accumulate(ends)[:-1], 0, 0))  # what is listed already
        sizes = np.maximum(ends - begins, 0)
        return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())

    def whole_windows(self, units: Units, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct fingerprints of the windows, each one's group, its smallest id, and the window's id."""
        keys, group, first = grouped(window_prints(units.codes, self.window, at))
        ids = units.ids[np.searchsorted(units.starts, at, side="right") - 1]
        return keys, group, ids[first], ids

    def send_anchors(self, table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        _, units = self.block(table)
        names = np.sort(self.names(units, self.sampled(units)[0]))
        names = names[np.insert(names[1:] != names[:-1], 0, True)] if len(names) else names
        asked = exchange.requests(block, names, None, self.bits, ANCHOR_WIDTH)
        keys, _, first = grouped(units.prints)
        texts = exchange.requests(block, keys, np.tile(units.ids, 2)[first].view(np.uint64), self.bits, 64, 1 << self.bits)
        return pa.concat_tables([asked, texts])

    def known(self, table: pa.Table) -> pa.Table:
        """A bucket's answers: whether another block has the anchor, or a smaller id the text."""
        texts = table.column("bucket")[0].as_py() >> self.bits
        return exchange.smaller_elsewhere(table) if texts else exchange.elsewhere(table)

    def send_windows(self, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return exchange.REQUEST_SCHEMA.empty_table()
        block = table.column("block")[0].as_py()
        _, units = self.block(table)
        keys, _, least, _ = self.whole_windows(units, self.candidates(units, answers)[0])
        return exchange.requests(block, keys, least.view(np.uint64), self.bits, 64)

    def covered(self, table: pa.Table, answers: pa.Table) -> tuple[pa.Table, Units, np.ndarray]:
        """The block's rows by id, their units, and the units that are repeats."""
        table, units = self.block(table)
        is_anchor = answers.column("kind").to_numpy(zero_copy_only=False) == 1
        at, copies = self.candidates(units, answers.filter(pa.array(is_anchor)))
        keys, group, least, ids = self.whole_windows(units, at)
        seen = exchange.flags_of(answers.filter(pa.array(~is_anchor)), keys, self.bits, 64)
        at = at[seen[group] | (ids > least[group])]
        change = np.zeros(len(units.codes) + 1, np.int64)
        if len(at):
            change += np.bincount(at, minlength=len(change))
            change -= np.bincount(at + self.window, minlength=len(change))
        whole = np.repeat(copies & (units.sizes >= self.window), units.sizes)
        return table, units, whole | (np.cumsum(change)[:-1] > 0)


def spans_of(covered: np.ndarray, units: Units) -> tuple[pa.Array, np.ndarray]:
    """Maximal covered runs of each document, counted from its start, and the covered units of each."""
    edge = np.zeros(len(covered) + 1, bool)
    edge[units.starts] = True
    now, before = covered, np.insert(covered[:-1], 0, False)
    begins = np.flatnonzero(now & (~before | edge[:-1]))
    after = np.append(covered[1:], False) if len(covered) else covered
    ends = np.flatnonzero(now & (~after | edge[1:])) + 1
    holder = np.searchsorted(units.starts, begins, side="right") - 1
    offsets = np.searchsorted(holder, np.arange(len(units.ids) + 1)).astype(np.int32)
    base = units.starts[holder]
    runs = pa.StructArray.from_arrays([pa.array(begins - base, pa.int64()), pa.array(ends - base, pa.int64())], ["begin", "end"])
    removed = np.concatenate([[0], np.cumsum(covered)])[units.starts]
    return pa.ListArray.from_arrays(pa.array(offsets), runs), np.diff(removed)


def remove_repeats(
    texts: DataFrame, units: Callable, cut: Callable, window: int, period: int, block_bytes: int,
) -> DataFrame:
    """``texts`` (see ``common.id_and_text``) with the units that a repeated window covers cut out.

    Adds ``n_units``, ``n_removed``, ``spans`` (begin and end in units) and ``kept`` (binary).
    ``cut(data, offsets, keep_units, units)`` gives the kept bytes and their offsets.
    """
    blocks, count = in_blocks(texts, block_bytes)
    search = Search(units, window, period, max(0, (count - 1).bit_length()))
    narrow = blocks.select("block", "id", "text")
    known = staged(exchange.ask(narrow.groupBy("block").applyInArrow(lambda rows: search.send_anchors(rows), exchange.REQUEST), lambda rows: search.known(rows)), "anchors")
    sent = narrow.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(lambda rows, told: search.send_windows(rows, told), exchange.REQUEST)
    seen = staged(exchange.ask(sent, exchange.smaller_elsewhere), "windows")
    answers = known.withColumn("kind", F.lit(1)).unionAll(seen.withColumn("kind", F.lit(2)))
    carried = [c for c in texts.columns if c not in ("id", "text")]

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        table, units, covered = search.covered(table, answers)
        spans, removed = spans_of(covered, units)
        data, offsets = bytes_of(table.column("text"))
        kept, kept_offsets = cut(data, offsets, ~covered, units)
        columns = [table.column("id"), table.column("text"), *[table.column(c) for c in carried]]
        columns += [pa.array(units.sizes, pa.int64()), pa.array(removed, pa.int64()), spans, binary_column(kept, kept_offsets)]
        return pa.table(columns, names=["id", "text", *carried, "n_units", "n_removed", "spans", "kept"])

    # Types as they are, for a carried struct may have fields that can't be null.
    schema = StructType.fromDDL("id long, text string")
    for field in texts.schema:
        if field.name in carried:
            schema = schema.add(field.name, field.dataType)
    for field in StructType.fromDDL("n_units long, n_removed long, spans array<struct<begin:long,end:long>>, kept binary"):
        schema = schema.add(field)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, schema)


def cut_bytes(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray, units: Units) -> tuple[bytes, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum(keep)])
    return data[keep].tobytes(), ends[offsets]


def cut_words(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray, units: Units) -> tuple[bytes, np.ndarray]:
    """Kept words, joined by one space."""
    begins, ends, starts = word_spans(data, offsets)
    lengths = np.where(keep, ends - begins + 1, 0)  # with a space behind each kept word
    out_ends = np.cumsum(lengths)
    total = int(out_ends[-1]) if len(out_ends) else 0
    out = np.full(total, 0x20, np.uint8)
    kept_begins, kept_lengths = begins[keep], (ends - begins)[keep]
    inside = np.arange(int(kept_lengths.sum())) - np.repeat(np.cumsum(kept_lengths) - kept_lengths, kept_lengths)
    to = (out_ends - lengths)[keep]
    out[np.repeat(to, kept_lengths) + inside] = data[np.repeat(kept_begins, kept_lengths) + inside]
    bounds = np.concatenate([[0], out_ends])[starts]
    filled = np.diff(bounds) > 0  # the space behind a document's last word goes
    drop = bounds[1:][filled] - 1
    keep_out = np.ones(total, bool)
    keep_out[drop] = False
    sizes = np.diff(bounds) - filled
    return out[keep_out].tobytes(), np.concatenate([[0], np.cumsum(sizes)])

