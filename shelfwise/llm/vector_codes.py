"""Vector codes: one codebook a part, assigned by the boxes of Hilbert-sorted flat blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import staged
from shelfwise.llm.integer_vectors import integers, matrix, moved, summed

HEX = np.array([f"{i:02x}" for i in range(256)], "S2")
SLAB = "size int, ids array<long>, orders binary, item int, points binary, low binary, high binary, sums binary"


def curve_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of every row on the Hilbert curve through a grid of ``bits`` bits a dimension (Skilling's method)."""
    x, dims = cells.astype(np.int64).T.copy(), cells.shape[1]
    for b in range(bits - 1, 0, -1):
        q, p = np.int64(1 << b), np.int64((1 << b) - 1)
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(on, p, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << b), (1 << b) - 1, 0)
    x ^= turn
    place = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            place = place << 1 | (x[i] >> b & 1)
    return place


def curve_order(points: np.ndarray) -> np.ndarray:
    """Rows in the order of the curve over their own range; of many dimensions the leading ones count."""
    dims = min(points.shape[1], 31)
    bits = max(2, min(10, 62 // dims))
    shifted = points[:, :dims].astype(np.int64) - points[:, :dims].min(axis=0)
    return np.argsort(curve_place(shifted >> max(0, int(shifted.max()).bit_length() - bits), bits), kind="stable")


@dataclass(frozen=True)
class Codec:
    """``parts`` codebooks of ``entries`` entries, moved ``rounds`` times; vectors in slabs, their parts in blocks.

    A slab is one row of the stored table.  Its blocks hold the neighbours on the curve of one part,
    with their box (least and largest of each component) and sums.
    """

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    slab: int = 16_384
    block: int = 32

    def slabs(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of ``id``, ``label``, ``v`` as slabs of at most ``slab`` rows."""
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, self.slab - rows))
                rows += held[-1].num_rows
                batch = batch.slice(held[-1].num_rows)
                if rows == self.slab:
                    yield self.packed(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield self.packed(pa.Table.from_batches(held))

    def packed(self, table: pa.Table) -> pa.RecordBatch:
        vectors = matrix(table.column("v"))
        n, kind = len(vectors), np.int16 if np.abs(vectors).max(initial=0) < 1 << 15 else np.int32
        orders, points, low, high, sums = [], [], [], [], []
        starts = np.arange(0, n, self.block)
        for part in np.split(vectors, self.parts, axis=1):
            order = curve_order(part)
            ordered = part[order]
            orders.append(order.astype(np.uint16 if self.slab <= 1 << 16 else np.uint32))
            points.append(ordered)
            low.append(np.minimum.reduceat(ordered, starts, axis=0))
            high.append(np.maximum.reduceat(ordered, starts, axis=0))
            sums.append(np.add.reduceat(ordered, starts, axis=0, dtype=np.int64))
        flat = lambda x, t: np.stack(x).astype(t).tobytes()
        ends = pa.array([0, n], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, table.column(c).combine_chunks()) for c in ("id", "label")]
        row = [pa.array([n], pa.int32()), lists[0], pa.array([flat(orders, orders[0].dtype)], pa.binary()), pa.array([np.dtype(kind).itemsize], pa.int32())]
        row += [pa.array([flat(x, kind)], pa.binary()) for x in (points, low, high)] + [pa.array([flat(sums, np.int64)], pa.binary()), lists[1]]
        return pa.RecordBatch.from_arrays(row, ["size", "ids", "orders", "item", "points", "low", "high", "sums", "labels"])

    def unpacked(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Points, boxes and sums by part."""
        kind = {2: np.int16, 4: np.int32}[row["item"]]
        shaped = lambda name, n, t: np.frombuffer(row[name], t).reshape(self.parts, n, -1)
        blocks = -(-row["size"] // self.block)
        return shaped("points", row["size"], kind), shaped("low", blocks, kind), shaped("high", blocks, kind), shaped("sums", blocks, np.int64)

    def shortlists(self, low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Blocks by entries: whether the entry can be the nearest one of a point in the block's box.

        It can't if its distance to the box is over the largest that some entry has to any place of it.
        """
        book, low, high = book[None, :, :], low.astype(np.int64)[:, None, :], high.astype(np.int64)[:, None, :]
        near = np.maximum(np.maximum(low - book, book - high), 0)
        far = np.maximum(np.abs(book - low), np.abs(high - book))
        least, most = (near * near).sum(axis=2), (far * far).sum(axis=2)
        return least <= most.min(axis=1, keepdims=True)

    def nearest(self, points: np.ndarray, listed: np.ndarray, book: np.ndarray, singles: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Nearest listed entry of every point, ties to the smaller, and the squared distance to it.

        Without ``singles``, blocks with one listed entry are passed over.
        """
        blocks, width = len(listed), points.shape[1]
        span = int(max(points.max(), book.max())) - int(min(points.min(), book.min()))
        kind = np.int32 if width * span * span < 1 << 31 else np.int64
        padded = np.concatenate([points, np.repeat(points[-1:], blocks * self.block - len(points), axis=0)]).astype(kind).reshape(blocks, self.block, width)
        book, sizes = book.astype(kind), listed.sum(axis=1)
        code, error = np.zeros((blocks, self.block), np.uint8), np.zeros((blocks, self.block), np.int64)
        for size in np.unique(sizes if singles else sizes[sizes > 1]).tolist():
            of_size = np.flatnonzero(sizes == size)
            step = max(1, (1 << 18) // (self.block * size))
            for s in range(0, len(of_size), step):
                which = of_size[s : s + step]
                entries = np.nonzero(listed[which])[1].reshape(len(which), size)
                away = np.zeros((len(which), self.block, size), kind)
                for d in range(width):
                    gap = padded[which, :, d, None] - book[entries, d][:, None, :]
                    away += gap * gap
                best = away.argmin(axis=2)
                code[which] = np.take_along_axis(entries, best, axis=1)
                error[which] = np.take_along_axis(away, best[:, :, None], axis=2)[:, :, 0]
        return code.ravel()[: len(points)], error.ravel()[: len(points)]

    def sums(self, batches: Iterator[pa.RecordBatch], books: np.ndarray) -> np.ndarray:
        """Count and sums of what falls to each entry: parts x entries x (1 + width), flat."""
        total = np.zeros((self.parts, books.shape[1], books.shape[2] + 1), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                held = np.full(-(-row["size"] // self.block), self.block)
                held[-1] = row["size"] - self.block * (len(held) - 1)
                for part, (points, low, high, sums) in enumerate(zip(*self.unpacked(row))):
                    listed = self.shortlists(low, high, books[part])
                    code, _ = self.nearest(points, listed, books[part], singles=False)
                    whole = listed.sum(axis=1) == 1  # all of the block goes to one entry: its sums do
                    np.add.at(total[part], listed[whole].argmax(axis=1), np.column_stack([held, sums])[whole])
                    rest = ~np.repeat(whole, held)
                    np.add.at(total[part], code[rest], np.column_stack([np.ones(rest.sum(), np.int64), points[rest]]))
        return total.ravel()

    def coded(self, batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.drop_columns(["ids", "labels"]).to_pylist()):
                orders = np.frombuffer(row["orders"], np.uint16 if self.slab <= 1 << 16 else np.uint32).reshape(self.parts, -1)
                codes, error = np.empty((row["size"], self.parts), np.uint8), np.zeros(row["size"], np.int64)
                for part, (points, low, high, _) in enumerate(zip(*self.unpacked(row))):
                    code, away = self.nearest(points, self.shortlists(low, high, books[part]), books[part])
                    codes[orders[part], part] = code
                    error[orders[part]] += away
                text = HEX[codes].view(f"S{2 * self.parts}").ravel()
                made = [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(text.tolist(), pa.binary()).cast(pa.string()), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(made, ["id", "label", "code", "error"])


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", codec: Codec = Codec(),
) -> DataFrame:
    """``id_col``, ``label_col``, ``code``, ``error``, ``label_error``, ``codebooks_sha256`` of every vector that takes part.

    Components become ``floor(scale * x)``.  Each of ``parts`` equal runs of components has its own codebook, begun
    with the rows of the smallest ids; ``rounds`` times all parts go to the nearest entry (squared distance, ties to the
    smaller number) and entries to the floor of the mean.  ``code`` is two hex digits a part, ``error`` the squared
    distance over all parts, ``label_error`` its sum over rows of an equal label, nulls together.

    Vectors are stored once in slabs.  A round looks at the boxes of blocks first: only entries on a block's shortlist
    are tried by the integer kernels, and a block with one entry listed adds its stored sums without a look at its
    points.  No row is shuffled; the driver gets the codebooks' sums, whose number is fixed by the parameters.

    Vectors that are null or hold null or non-finite components take no part, nor (see ``integer_vectors``) integers too
    large for distances in a long, nor vectors of a length that ``parts`` doesn't divide or other than that of the first
    row.  Rows without an id come last, repeated rows count each; rows of equal id are ordered by their vector.  With fewer
    rows than entries codebooks are smaller.  No rows give none.  Other columns stay outside, whatever their names.
    """
    label = vectors[label_col] if label_col in vectors.columns else F.lit(None).cast("int")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), label.alias("label"), integers(vectors[vector_col], codec.scale).alias("v"))
    rows = rows.filter((F.size("v") > 0) & (F.size("v") % codec.parts == 0))
    in_order = [F.col("id").asc_nulls_last(), F.col("v")]
    first = rows.orderBy(*in_order).limit(codec.entries).select("v").collect()
    if len({len(r.v) for r in first}) > 1:  # rows of another length among the first
        first = rows.filter(F.size("v") == len(first[0].v)).orderBy(*in_order).limit(codec.entries).select("v").collect()
    width = len(first[0].v) if first else codec.parts
    rows = rows.filter(F.size("v") == width)
    books = np.array([r.v for r in first], np.int64).reshape(len(first), codec.parts, width // codec.parts).transpose(1, 0, 2)

    kind = rows.schema["label"].dataType.simpleString()
    slabs = staged(rows.mapInArrow(codec.slabs, f"{SLAB}, labels array<{kind}>"), "slabs")
    for _ in range(codec.rounds if first else 0):
        totals = summed(slabs.select("size", "item", "points", "low", "high", "sums"), lambda batches: codec.sums(batches, books), codec.parts * len(first) * (1 + books.shape[2]))
        totals = totals.reshape(*books.shape[:2], -1)
        books = np.stack([moved(old, new[:, 1:], new[:, 0]) for old, new in zip(books, totals)])
    found = staged(slabs.mapInArrow(lambda batches: codec.coded(batches, books), f"id long, label {kind}, code string, error long"), "codes")
    by_label = staged(found.groupBy("label").agg(F.sum("error").alias("label_error")), "by_label").withColumnRenamed("label", "same")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return found.join(by_label, F.col("label").eqNullSafe(F.col("same"))).select(
        F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"),
    )
