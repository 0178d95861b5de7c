"""Ask every block of texts' keys of all other blocks, in packed rows.

A block sends each of its distinct 64-bit keys once, whatever the number of its documents that
hold it; the keys go to buckets by their leading bits, sorted and packed as differences.  A bucket
answers each block with one bit a key.  So a key that a third of all documents hold costs one
entry a block, and a row of the shuffle stands for thousands of keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

REQUEST = "block long, bucket int, size int, keys binary, vals binary"
REPLY = "block long, bucket int, bits binary"
REQUEST_SCHEMA = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("size", pa.int32()), ("keys", pa.binary()), ("vals", pa.binary())])
REPLY_SCHEMA = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary())])


def planes(values: np.ndarray) -> bytes:
    """64-bit values byte by byte of rank, so that empty leading bytes compress."""
    return pa.compress(values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def from_planes(data: bytes, size: int) -> np.ndarray:
    raw = pa.decompress(data, 8 * size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(from_planes(data, size), dtype=np.uint64)


def sorting(keys: np.ndarray) -> np.ndarray:
    """The stable order of 64-bit keys.

    Sorts the leading bits with the places behind them, which is much faster than an argsort; keys
    that differ in the last bits alone are rare, and send it back to that.
    """
    places = max(1, len(keys) - 1).bit_length()
    low = np.uint64((1 << places) - 1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    ordered = keys[order]
    return order if (ordered[1:] >= ordered[:-1]).all() else np.argsort(keys, kind="stable")


def bucket_bits(total_bytes: int, bucket_bytes: int) -> int:
    return max(0, math.ceil(math.log2(max(1, total_bytes / bucket_bytes))))


def cuts(keys: np.ndarray, bits: int, width: int) -> np.ndarray:
    """Where each bucket begins in sorted ``keys`` of ``width`` bits; one more at the end."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(width - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def requests(block: int, keys: np.ndarray, vals: np.ndarray | None, bits: int, width: int, base: int = 0) -> pa.Table:
    """Rows for the distinct sorted keys of a block; ``vals`` is one 64-bit value a key.

    Keys of several kinds take buckets from another ``base`` each.
    """
    edges = cuts(keys, bits, width)
    full = np.flatnonzero(np.diff(edges))
    spans = [(edges[b], edges[b + 1]) for b in full]
    return pa.table(
        [
            pa.array([block] * len(full), pa.int64()),
            pa.array((full + base).astype(np.int32)),
            pa.array([e - s for s, e in spans], pa.int32()),
            pa.array([pack_sorted(keys[s:e]) for s, e in spans], pa.binary()),
            pa.array([b"" if vals is None else planes(vals[s:e]) for s, e in spans], pa.binary()),
        ],
        schema=REQUEST_SCHEMA,
    )


def gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Keys, values and row sizes of a bucket."""
    sizes = table.column("size").to_numpy()
    keys, vals = table.column("keys").to_pylist(), table.column("vals").to_pylist()
    values = np.concatenate([from_planes(x, n) for x, n in zip(vals, sizes.tolist())]) if any(vals) else None
    return np.concatenate([unpack_sorted(x, n) for x, n in zip(keys, sizes.tolist())]), values, sizes


def replies(table: pa.Table, flags: np.ndarray, sizes: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes)
    packed = [np.packbits(flags[e - n : e]).tobytes() for e, n in zip(ends, sizes)]
    return pa.table([table.column("block"), table.column("bucket"), pa.array(packed, pa.binary())], schema=REPLY_SCHEMA)


def elsewhere(table: pa.Table) -> pa.Table:
    """A bit for each key that another block sent as well."""
    keys, _, sizes = gathered(table)
    order = sorting(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    flags = np.zeros(len(keys), bool)
    flags[order] = np.append(same, False) | np.insert(same, 0, False)
    return replies(table, flags, sizes)


def smaller_elsewhere(table: pa.Table) -> pa.Table:
    """A bit for each key that came with a smaller value from another block."""
    keys, vals, sizes = gathered(table)
    order = sorting(keys)
    ordered, own = keys[order], vals.view(np.int64)[order]
    begins = np.insert(ordered[1:] != ordered[:-1], 0, True)
    least = np.minimum.reduceat(own, np.flatnonzero(begins))[np.cumsum(begins) - 1]
    flags = np.zeros(len(keys), bool)
    flags[order] = own > least
    return replies(table, flags, sizes)


def flags_of(answers: pa.Table, keys: np.ndarray, bits: int, width: int, base: int = 0) -> np.ndarray:
    """The answers to a block, in the order of its sorted keys."""
    edges, flags = cuts(keys, bits, width), np.zeros(len(keys), bool)
    for bucket, packed in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()):
        if 0 <= bucket - base < 1 << bits:
            s, e = edges[bucket - base], edges[bucket - base + 1]
            flags[s:e] = np.unpackbits(np.frombuffer(packed, np.uint8), count=e - s)
    return flags


def ask(sent: DataFrame, reduce: Callable[[pa.Table], pa.Table]) -> DataFrame:
    return sent.groupBy("bucket").applyInArrow(reduce, REPLY)
