import random

import numpy as np
import pytest
import xxhash
from brute import WORD

from shelfwise.llm import simhash_dedup as sd
from shelfwise.llm.components import components
from shelfwise.llm.queries import QUERIES


def plain_print(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """(id, print) to the smallest id reachable."""
    names = [i for i, _ in prints]
    old = None
    while names != old:
        old = names[:]
        for a, (_, x) in enumerate(prints):
            for b, (_, y) in enumerate(prints):
                if (x ^ y).bit_count() <= 3:
                    names[a] = names[b] = min(names[a], names[b])
    return names


def test_fingerprint():
    for text in ["", "a", "A b", "One two THREE four five", "x y z " * 70, "É é\tÉ\n\x0bb  c"]:
        assert sd.fingerprint(sd.shingle_hashes(text, 3)) & (2**64 - 1) == plain_print(text)


def test_spark_hashes_alike(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert row.h & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("most", [2, 4096])
def test_links_connect_all_within_three_bits(spark, most):
    rng = random.Random(1)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):
        seed = rng.getrandbits(64)
        fps.add(seed)
        for _ in range(6):
            x = seed
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << bit
            fps.add(x)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << b) for b in range(64)}
    prints = list(enumerate(sorted(fps)))
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), i) for i, f in prints], "fp long, rep long")
    links = sd.simhash_links(nodes, most=most)
    for r in links.collect():
        assert (prints[r.a][1] ^ prints[r.b][1]).bit_count() <= 3
    found = {r.node: r.component for r in components(links).collect()}
    assert [found.get(i, i) for i, _ in prints] == plain_components(prints)


def test_components_of_chain_and_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_rows_without_text_or_id(spark):
    rows = [(1, None), (2, ""), (3, "a b c d"), (4, "A b c d"), (None, "a b c d"), (None, "only here"), (3, "a b c d")]
    got = sd.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got if r.component_id) == [(0, 3), (1, 1), (2, 1), (3, 3), (3, 3), (4, 3)]
    assert len(got) == 7 and {r.fingerprint for r in got if r.doc_id in (1, 2)} == {"0" * 16}
    assert sd.simhash_dedup(spark.createDataFrame([], "doc_id long, text string, fp int")).count() == 0


def test_query(spark, folder):
    rows = [(r.doc_id, plain_print(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected = [(i, f"{f:016x}", c) for (i, f), c in zip(rows, plain_components(rows))]
    assert sorted(map(tuple, QUERIES["op2_simhash_dedup"](spark, folder).collect())) == sorted(expected)
