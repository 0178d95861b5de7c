import math
import random

import numpy as np
import pytest

from shelfwise.llm.ann_search import Tables, ann_search
from shelfwise.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def plain(rows, k=5, every=50):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        best = {}
        for i, a in good:
            for j, b in good:
                if i == q and j != q and len(a) == len(b):
                    best[j] = max(best.get(j, -2), float(a @ b / math.sqrt((a @ a) * (b @ b))))
        for rank, (j, s) in enumerate(sorted(best.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k], 1):
            out.append((q, rank, j, s))
    return out


def recall(found, expected):
    found = {(r[0], r[2]) for r in found}
    return sum((r[0], r[2]) in found for r in expected) / len(expected)


def test_probes_come_by_rising_cost():
    hashing = Tables(hashes=4, probes=40)
    inside = np.array([0.1, 0.45, 0.8, 0.3])
    sets = hashing.perturbations(inside)
    cost = [sum((inside[h] if d < 0 else 1 - inside[h]) ** 2 for h, d in s) for s in sets]
    assert cost == sorted(cost) and sets[0] == [] and len(sets) == 40
    assert len({tuple(sorted(s)) for s in sets}) == 40 and all(len({h for h, _ in s}) == len(s) for s in sets)


@pytest.mark.parametrize("bucket_rows, slot_rows", [(3, 50), (4096, 40_000)])
def test_ties_copies_and_bad_vectors(spark, bucket_rows, slot_rows):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(1, 120)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(150, 175)] + [(200, [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]), (200, [2.0, 4.0, 6.0, 8.0, 10.0, 12.0])]
    rows += [(250, None), (300, [0.0] * 6), (350, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (400, [float("nan")] + [1.0] * 5), (450, [float("inf")] * 6)]
    rows += [(None, [1.0] * 6), (500, [1.0, 2.0]), (501, [2.0, 1.0]), (550, []), (60, rows[2][1])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = sorted(tuple(r) for r in ann_search(frame, hashing=Tables(probes=400), bucket_rows=bucket_rows, slot_rows=slot_rows).collect())
    expected = plain(rows)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in got], [r[3] for r in expected], atol=1e-12)


def test_empty_and_tiny_tables(spark):
    assert ann_search(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(0, [1.0, 0.0], "", 1), (1, [0.0, 1.0], "", 1), (2, [-1.0, 0.1], "", 1)]
    assert [r.vec_id for r in ann_search(spark.createDataFrame(rows, SCHEMA)).orderBy("rank").collect()] == [1, 2]


def test_recall(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op1_ann_search"](spark, folder).collect()]
    expected = plain(rows)
    assert len(got) == len(expected) and recall(got, expected) >= 0.9


@pytest.mark.parametrize("probes", [400, 1])
def test_ties_of_different_vectors(spark, probes):
    """Multiples by powers of two are different vectors of the same cosine; the smallest ids come first."""
    rng = random.Random(9)
    ids = rng.sample(range(1, 50), 40)
    rows = [(0, [1.0, 0.5, 0.25, 0.0])] + [(i, [x * 2.0**n for x in (1.0, 1.0, 0.0, 0.5)]) for n, i in enumerate(ids)]
    got = ann_search(spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA), hashing=Tables(probes=probes)).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == sorted(ids)[:5]
