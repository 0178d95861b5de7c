import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import WORD

from shelfwise.llm import lm_scoring as lm
from shelfwise.llm.queries import QUERIES


def plain(rows, depth):
    """Context-tree weighting over dictionaries, and the counts of words."""
    train = [(i, t) for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2]
    words = lambda t: WORD.findall((t or "").encode().lower())
    nodes, known = defaultdict(lambda: [0, 0]), {(): True}

    def decisions(t):
        stream = [255] * depth + list(b" ".join(words(t))) + [255]
        for k in range(depth, len(stream)):
            bits = f"{stream[k]:08b}"
            for b in range(8):
                yield tuple(stream[k - depth : k][::-1]), bits[:b], int(bits[b])

    for _, t in train:
        for context, lead, bit in decisions(t):
            for d in range(depth + 1):
                nodes[context[:d], lead][bit] += 1
    children = defaultdict(list)
    for context, lead in list(nodes):
        if context:
            children[context[:-1], lead].append((context, lead))
    kt = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)
    memo = {}

    def weighted(node):
        if node not in memo:
            own = kt(nodes.get(node, [0, 0]))
            if len(node[0]) < depth:
                own = np.logaddexp(own, sum(weighted(c) for c in children.get(node, []))) - math.log(2)
            memo[node] = own
        return memo[node]

    def chance(context, lead):
        p = None
        for d in range(depth, -1, -1):
            node = (context[:d], lead)
            n = nodes.get(node, [0, 0])
            own = (n[1] + 0.5) / (sum(n) + 1)
            share = math.exp(math.log(0.5) + kt(n) - weighted(node)) if d < depth else 1
            p = share * own + (1 - share) * (p or 0)
        return p

    counts = Counter(w for _, t in train for w in [*words(t), None])
    total = sum(counts.values())
    out = []
    for i, t in rows:
        score = sum(math.log10(chance(c, lead) if bit else 1 - chance(c, lead)) for c, lead, bit in decisions(t))
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in tokens)
        out.append((i, zlib.crc32(str("" if i is None else i).encode()) % 7 == 2, len(tokens), sum(counts[w] > 0 for w in tokens), total, base, score))
    return out


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 7.5, 8, 30.5, 1e4, 1e9])
    assert np.allclose(lm.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("block_bytes, depth", [(200, 4), (8 << 20, 5), (300, 2)])
def test_against_brute_force(spark, block_bytes, depth):
    rng = random.Random(2)
    words = ["The", "cat", "dog", "über", "ran", "at", "a"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(70, None), (71, ""), (None, "the\ncat"), rows[4], rows[4], (72, "x" * 400), (73, "unseen wörds ñ")]
    frame = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, score int")
    got = lm.score_texts(frame, depth=depth, block_bytes=block_bytes).collect()
    by = lambda r: (str(r[0]), r[2])
    for a, b in zip(sorted(map(tuple, got), key=by), sorted(plain(rows, depth), key=by), strict=True):
        assert a[:5] == b[:5]
        assert np.allclose(a[5:7], b[5:7], rtol=1e-6)


def test_empty_table(spark):
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_learns(spark, folder):
    rows = QUERIES["op7_lm_scoring"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [r for r in rows if r.held_out]
    bits = sum(r.bits_per_byte * r.n_bytes for r in held) / sum(r.n_bytes for r in held)
    assert bits < 3.5
    assert all(r.score < 0 for r in rows)
