"""Codes and clusters of vectors against plain loops."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest

from shelfwise.llm import vector_codes as vc
from shelfwise.llm.threshold_clusters import Clustering, SortedLists, threshold_clusters

SCHEMA = "vec_id long, embedding array<double>, label string, code string, cluster int, v string"


def frame(spark, rows):
    """With columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, v, g, "x", 1, "y") for i, v, g in rows], SCHEMA)


def whole(vector):
    return [math.floor(256 * x) for x in vector]


def kept(rows, dims):
    good = [(i, whole(v), g) for i, v, g in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(256 * x) < 2**26 for x in v)]
    return sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def nearest(x, book):
    away = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
    return min(range(len(book)), key=lambda e: (away[e], e)), min(away)


def step(points, book):
    chosen = [nearest(x, book)[0] for x in points]
    groups = [[x for x, e in zip(points, chosen) if e == i] for i in range(len(book))]
    return [[sum(c) // len(g) for c in zip(*g)] if g else old for g, old in zip(groups, book)]


def plain_codes(rows, parts, entries, rounds, dims):
    good, width = kept(rows, dims), dims // parts
    books, codes, errors = [], [""] * len(good), [0] * len(good)
    for p in range(parts):
        points = [v[p * width : (p + 1) * width] for _, v, _ in good]
        book = points[:entries]
        for _ in range(rounds):
            book = step(points, book)
        books.append(book)
        for n, x in enumerate(points):
            e, away = nearest(x, book)
            codes[n] += f"{e:02x}"
            errors[n] += away
    labels = {}
    for (_, _, g), error in zip(good, errors):
        labels[g] = labels.get(g, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, g, code, error, labels[g], digest) for (i, _, g), code, error in zip(good, codes, errors)]


def made(n, dims, seed=1):
    """Clustered vectors with ties, repeats, and such as take no part."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-0.4, 0.4) for _ in range(dims)] for _ in range(7)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], rng.choice(["a", "b", None])) for i in rng.sample(range(10 * n), n)]
    rows += [(rows[0][0], rows[0][1], "a"), (7_000_001, rows[1][1], None), (None, rows[2][1], "b"), (None, None, "c")]
    odd = [None, [], [0.1], [0.1] * (dims - 1) + [None], [0.1] * (dims - 1) + [math.nan], [math.inf] + [0.0] * (dims - 1), [1e300] * dims]
    return rows + [(-5 - i, v, "a") for i, v in enumerate(odd)] + [(-100, [0.0] * dims, "z"), (7_000_002, [500.0] * dims, "a")]


@pytest.mark.parametrize("slab, block", [(16_384, 32), (50, 4), (7, 3)])
def test_codes_are_plain_ones(spark, slab, block):
    rows = made(120, 8)
    codec = vc.Codec(parts=4, entries=6, rounds=2, slab=slab, block=block)
    got = vc.vector_codes(frame(spark, rows), codec=codec).collect()
    want = plain_codes(rows, 4, 6, 2, 8)
    order = lambda r: (r[0] is None, r[0] or 0, r[2], str(r[1]))
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_codes_of_few_rows(spark):
    empty = vc.vector_codes(frame(spark, []))
    assert empty.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    one = vc.vector_codes(frame(spark, [(3, [0.5] * 32, None)])).drop("codebooks_sha256").collect()
    assert [tuple(r) for r in one] == [(3, None, "00" * 16, 0, 0)]
    assert vc.vector_codes(frame(spark, [(3, [0.5] * 32, None)]).drop("label")).first().code == "00" * 16


def test_first_row_names_the_length(spark):
    rows = [(5, [0.1] * 32, "a"), (1, [0.2] * 16, "a"), (2, [0.2] * 17, "a"), (3, [0.3] * 16, "b")]
    assert sorted(r.vec_id for r in vc.vector_codes(frame(spark, rows)).collect()) == [1, 3]


@pytest.mark.parametrize("dims, bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = vc.curve_place(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
    assert sorted(vc.curve_order(np.zeros((5, 100), np.int32)).tolist()) == list(range(5))


def test_shortlists_lose_no_nearest_entry():
    rng = np.random.default_rng(4)
    codec = vc.Codec(parts=1, entries=20, block=8)
    points, book = rng.integers(-40, 40, (403, 3)).astype(np.int32), rng.integers(-40, 40, (20, 3))
    points = points[vc.curve_order(points)]
    starts = np.arange(0, len(points), 8)
    listed = codec.shortlists(np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts), book)
    code, error = codec.nearest(points, listed, book)
    assert [(c, e) for c, e in zip(code.tolist(), error.tolist())] == [nearest(x, book.tolist()) for x in points.tolist()]
    assert listed.mean() < 0.7  # and they save work


def plain_clusters(rows, clusters, dims, rounds):
    good = kept(rows, dims)
    drawn = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    book = [v for _, v, _ in drawn[:clusters]]
    for _ in range(rounds):
        book = step([v for _, v, _ in good], book)
    found = [(i, *nearest(v, book)) for i, v, _ in good]
    of = lambda c: sum(d for _, e, d in found if e == c)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in book]
    return [(i, c, d, of(c), sum(d for _, _, d in found), digest[c]) for i, c, d in found]


def test_clusters_are_plain_ones(spark):
    rows = made(150, 6)
    got = threshold_clusters(frame(spark, rows), job=Clustering(clusters=9, dims=6, rounds=3, rows=32)).drop("centroid").collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=order) == sorted(plain_clusters(rows, 9, 6, 3), key=order)
    few = threshold_clusters(frame(spark, rows[:4]), job=Clustering(dims=6)).collect()
    assert len(few) == 4 and {r.inertia for r in few} == {sum(r.distance for r in few)}
    assert threshold_clusters(frame(spark, [])).count() == 0


def test_threshold_stops_late_enough():
    """Ties go to the smaller number, and lists are left before their end."""
    rng = np.random.default_rng(2)
    for dims, spread in [(1, 3), (2, 4), (3, 1000), (16, 50)]:
        centroids, vectors = rng.integers(-spread, spread, (30, dims)), rng.integers(-spread, spread, (200, dims))
        cluster, away = SortedLists(centroids).nearest(vectors)
        assert list(zip(cluster.tolist(), away.tolist())) == [nearest(x, centroids.tolist()) for x in vectors.tolist()]
    seen = []
    lists = SortedLists(np.arange(0, 4000, 100)[:, None] * np.ones((1, 3), int))
    lists.take = lambda who, centroid, *rest: (seen.append(len(who)), SortedLists.take(lists, who, centroid, *rest))
    assert lists.nearest(np.array([[210, 190, 205]]))[0].tolist() == [2] and sum(seen) <= 4
