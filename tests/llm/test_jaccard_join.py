"""The Jaccard join against all pairs, and its prefixes against their promise."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_near_copies import made_texts, plain_components, shingles

from shelfwise.llm import jaccard_join as jj
from shelfwise.llm import linking
from shelfwise.llm.components import components
from shelfwise.llm.repeats import bytes_of

SCHEMA = "doc_id long, text string, node long, words string, key int, size int, component_id string"


def frame(spark, rows):
    """With columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, t, 1, "w", 2, 3, "c") for i, t in rows], SCHEMA)


def plain(rows):
    """Smallest id reachable of every row; without words a row is alone."""
    names, solid = {}, [(k, t) for k, (_, t) in enumerate(rows) if shingles(t)]
    by_place = dict(zip([k for k, _ in solid], plain_components(solid)))
    for k in by_place:
        ids = [rows[j][0] for j in by_place if by_place[j] == by_place[k] and rows[j][0] is not None]
        names[k] = min(ids, default=None)
    return [(i, len(shingles(t)), names[k] if k in names else i) for k, (i, t) in enumerate(rows)]


def check(spark, rows, **given):
    got = jj.jaccard_join(frame(spark, rows), **given)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(plain(rows), key=order)


def crowd():
    """Many texts of a few words and of one stock of phrases, so that most shingles are common; copies and near copies."""
    rng = random.Random(8)
    phrases = [" ".join(rng.choice("abcdefghijkl") for _ in range(7)) for _ in range(40)]
    texts = []
    for _ in range(60):
        text = [w for _ in range(rng.randint(1, 12)) for w in rng.choice(phrases).split()]
        for _ in range(rng.randint(1, 4)):
            texts.append(" ".join(text))
            text = text[:]
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice("abcxyz")
    return texts


@pytest.mark.parametrize("rare, frequent", [(8, 256), (1, 3)])
def test_components_are_plain_ones(spark, rare, frequent):
    rows = [*enumerate(crowd(), 1)]
    check(spark, rows, prefixes=jj.Prefixes(rare=rare, frequent=frequent), block_bytes=6000)


def test_chains_and_odd_rows(spark):
    rows = made_texts()
    rows += [(None, rows[0][1]), (None, "nowhere else at all"), (910, "a a a a a"), (911, "a a a a a a a"), (3, "another text of id three"), (3, rows[9][1])]
    rows += [(912, "x " * 30_000), (913, "x  " * 30_000 + "y"), (914, None), (914, None), (915, "one"), (916, "ONE"), (917, "É"), (918, "é")]
    check(spark, rows)
    assert jj.jaccard_join(frame(spark, [])).count() == 0
    check(spark, [(None, None), (None, ""), (2, " \t")])


@pytest.mark.parametrize("percent", [80, 90, 100])
def test_linked_sets_share_a_key(percent):
    """For random sets and classes, every pair at the limit meets."""
    rng = np.random.default_rng(5)
    prefixes = jj.Prefixes(percent=percent)
    for trial in range(1500):
        n = int(rng.integers(1, 120))
        one = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        n = len(one)
        other = one.copy()
        while True:  # swap or drop shingles as long as the pair links
            longer = rng.random() < 0.3 and len(other) > 1
            less = np.delete(other, rng.integers(len(other)))
            more = less if longer else np.append(less, rng.integers(0, 1 << 63, dtype=np.uint64))
            if not linking.enough(len(np.intersect1d(one, more)), n, len(more), percent):
                break
            other = more
        other = np.unique(other)
        kind = lambda x: 1 + (x % np.uint64(97) * np.uint64(trial % 7) % np.uint64(3)).astype(np.uint8)
        kinds = [np.where(np.isin(x, y) | (x % np.uint64(2) > 0), kind(x), jj.ALONE) for x, y in ((one, other), (other, one))]
        assert len(np.intersect1d(prefixes.keys(one, kinds[0]), prefixes.keys(other, kinds[1])))


def test_classes_of_shingles():
    keys, counts = np.array([1, 5, 9, 12], np.uint64) << np.uint64(20), np.array([1, 1, 200, 3], np.uint64)
    sent = [jj.exchange.requests(7, keys, counts, 0, 40), jj.exchange.requests(8, keys[1:], counts[1:], 0, 40)]
    told = jj.Prefixes().classes(pa.concat_tables(sent))
    job = jj.Job(jj.Prefixes(), 0, 40)
    assert job.kinds(keys, told.slice(0, 1)).tolist() == [jj.ALONE, jj.RARE, jj.HOT, jj.RARE]
    assert job.kinds(keys[1:], told.slice(1, 1)).tolist() == [jj.RARE, jj.HOT, jj.RARE]


def test_shingle_prints():
    texts = ["", "a b", "A  b", "b a", "a b c d e", "x a b c d e", "a b c d e a b c d e", None, "É\x0bé"]
    prints, firsts = linking.shingle_prints(*bytes_of(pa.array([t or "" for t in texts])), 5)
    of = [prints[s:e].tolist() for s, e in zip(firsts[:-1], firsts[1:])]
    assert [len(x) for x in of] == [0, 1, 1, 1, 1, 2, 6, 0, 1]
    assert of[1] == of[2] != of[3] and of[4][0] == of[5][1] == of[6][0] == of[6][5] and len(set(of[6])) == 5
    sets = linking.sets_of(pa.array([t or "" for t in texts]), 5)
    assert [len(x) for x in sets] == [len(shingles(t)) for t in texts]


def variants(seed, copies, words, least, most):
    """Texts that each differ from one in ``least`` to ``most`` words."""
    rng = random.Random(seed)
    base = [f"{seed}w{i}" for i in range(words)]
    for n in range(copies):
        text = base[:]
        for at in rng.sample(range(words), rng.randint(least, most)):
            text[at] = f"{seed}v{n}w{at}"
        yield " ".join(text)


@pytest.mark.parametrize("blocks", [(1 << 20, 16 << 20), (100, 400)])
def test_groups_cost_rows_not_pairs(spark, blocks, monkeypatch):
    """Near copies, some too far from all others: nearly all pairs are settled by bits, and none wrongly."""
    texts = [*variants(1, 80, 100, 0, 6), *variants(2, 60, 60, 1, 4), *variants(3, 30, 40, 3, 5)]
    compared = spark.sparkContext.accumulator(0)
    plain = linking.compared

    def counted(batch, *given):
        compared.add(batch.num_rows)
        return plain(batch, *given)

    monkeypatch.setattr(linking, "compared", counted)
    members = [(key, n, len(shingles(t)), 0) for n, t in enumerate(texts) for key in {int(t.split("w")[0].split("v")[0]), n % 5 + 10}]
    nodes = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "node long, text string")
    links = linking.connected(spark.createDataFrame(members, "key long, node long, size long, alone long"), nodes, 5, 80, *blocks)
    groups = {r.node: r.component for r in components(links).distinct().collect()}
    assert [groups.get(n, n) for n in range(len(texts))] == plain_components([*enumerate(texts)])
    assert compared.value < 2500  # of 5,365 pairs within the three kinds


def test_bits_bound_what_sets_share():
    """No pair that links is turned down by what both have of a third set."""
    rng = np.random.default_rng(6)
    third = np.unique(rng.integers(0, 1 << 60, 90, dtype=np.uint64))
    rows = []
    for n in range(60):
        kept = third[rng.random(len(third)) > rng.uniform(0, 0.3)]
        other = rng.integers(0, 1 << 60, rng.integers(0, 20), dtype=np.uint64) if n % 3 else rows[n - 1][-1][-5:] if n else third[:0]
        own = np.unique(np.concatenate([kept, other]))
        has = np.isin(third, own)
        rows.append((n, n, len(own), len(own) - int(has.sum()), np.packbits(np.pad(has, (0, -len(has) % 64))).tobytes(), own))
    table = pa.table([pa.array(c) for c in zip(*[r[:5] for r in rows])], names=["node", "group", "size", "free", "bits"])
    found = {*zip(*(x.tolist() for x in linking.possible(table, table, 80)))}
    linked = {(a, b) for a in range(60) for b in range(60) if a != b and linking.enough(len(np.intersect1d(rows[a][5], rows[b][5])), rows[a][2], rows[b][2], 80)}
    assert linked and linked <= found and len(found) < 60 * 59 * 0.8
