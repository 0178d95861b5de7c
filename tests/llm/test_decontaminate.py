import hashlib
import random
import re

import numpy as np
import pytest

from shelfwise.llm.decontaminate import decontaminate, intersect
from shelfwise.llm.queries import QUERIES

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def plain(docs, items, size=13):
    phrases = {}
    for item, text in items:
        t = terms(text)
        for i in range(max(1, len(t) - size + 1) if t else 0):
            phrases.setdefault(tuple(t[i : i + size]), set()).add(item)
    lengths = {len(p) for p in phrases}
    out = []
    for doc, text in docs:
        t, hit, names = terms(text), set(), set()
        for i in range(len(t)):
            for n in lengths:
                w = tuple(t[i : i + n])
                if len(w) == n and w in phrases:
                    hit |= set(range(i, i + n))
                    names |= phrases[w]
        names = sorted(str(n) for n in names if n is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc, len(t), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(t)))
    return sorted(out, key=str)


def made(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "ñandú", "A1"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([3, 13, 20, 40]))) for i in range(12)] + [(50, None), (51, "--"), (None, text(14)), (3, text(15)), (60, "only")]
    docs = []
    for i in range(60):
        inner = items[rng.randrange(12)][1].upper() if i % 2 else ""
        docs.append((i, f"{text(rng.randint(0, 80))}, {inner}-{text(rng.randint(0, 200))}"))
    docs += [(70, None), (71, ""), (None, docs[1][1]), docs[1], docs[1], (72, text(30_000)), (73, "ONLY"), (74, items[14][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_against_brute_force(spark, block_bytes):
    docs, items = made()
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, hits int")
    got = decontaminate(frame, bench, block_bytes=block_bytes).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in got]
    assert sorted(rows, key=str) == plain(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontaminate(none, bench).count() == 0
    assert [tuple(r)[:3] for r in decontaminate(some, bench).collect()] == [(1, 2, 0)]


def test_proximity():
    postings = {1: np.array([0, 9]), 2: np.array([2, 12]), 3: np.array([4, 20])}
    window, rarest = np.array([1, 2, 3]), np.array([0, 1, 2])
    assert intersect(postings, window, rarest).tolist() == []
    found = intersect(postings, window, rarest, slop=2)
    plain_found = [s for s in range(30) if all(any(abs(p - s - j) <= 2 for p in postings[t]) for j, t in enumerate((1, 2, 3)))]
    assert found.tolist() == plain_found


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op6_decontaminate"](spark, folder).collect()), key=str)
    assert got == plain(docs, items)
    assert any(r[-1] for r in got)
