"""Plain Python versions that the operators are held against."""

import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def key(doc_id):
    return float("inf") if doc_id is None else doc_id


def repeats(rows, units_of, window, join):
    """(id, units, removed, runs, digest) of each row, by first holders of every window."""
    first = {}
    for doc_id, text in rows:
        units = units_of((text or "").encode())
        for i in range(len(units) - window + 1):
            w = tuple(units[i : i + window])
            first[w] = min(first.get(w, float("inf")), key(doc_id))
    out = []
    for doc_id, text in rows:
        units = units_of((text or "").encode())
        gone = [False] * len(units)
        for i in range(len(units) - window + 1):
            if first[tuple(units[i : i + window])] < key(doc_id):
                gone[i : i + window] = [True] * window
        runs = sum(g and not p for g, p in zip(gone, [False, *gone]))
        kept = join([u for u, g in zip(units, gone) if not g])
        out.append((doc_id, len(units), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)
