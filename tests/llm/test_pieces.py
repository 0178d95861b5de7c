import os
import random
import time

import numpy as np
import pytest

from shelfwise.llm.pieces import SPACE, SWAP, PieceModel, combinations, decode_pieces, edited, encode_pieces
from shelfwise.llm.queries import PIECES, QUERIES

pytestmark = pytest.mark.skipif(not os.path.exists(PIECES), reason="no model")


@pytest.fixture(scope="module")
def model():
    return PieceModel.load(PIECES)


@pytest.fixture(scope="module")
def toy():
    words = ["<unk>", *[f"<0x{b:02X}>" for b in range(256)], "a", "b", "c", "ab", "bc", "abc", SPACE, SPACE + "a", "ca", "é", "cab", SPACE + SPACE]
    scores = [0.0] * 257 + [-3.0, -3.5, -4.0, -4.5, -5.0, -6.2, -2.0, -3.1, -4.4, -6.0, -7.7, -3.3]
    return PieceModel.of(words, scores, [True] * 257 + [False] * 12, 1)


def every_path(model, text):
    """(score, ids) of all segmentations, best first."""
    prepared = SPACE + text.translate(SWAP)
    pieces = {p: i for i, p in enumerate(model.pieces) if model.ids.get(p) == i}

    def walk(at):
        if at == len(prepared):
            yield 0.0, ()
            return
        for end in range(at + 1, len(prepared) + 1):
            part = prepared[at:end]
            if part in pieces:
                step = model.scores[pieces[part]], (pieces[part],)
            elif end == at + 1:
                step = model.floor, tuple(model.bytes_first + b for b in part.translate(SWAP).encode())
            else:
                continue
            for score, ids in walk(end):
                yield step[0] + score, step[1] + ids

    return sorted(walk(0), key=lambda x: -x[0])


def check(model, texts, count):
    made = model.encode_all(texts, count)
    for k, text in enumerate(texts):
        ids = made.ids[made.offsets[k] : made.offsets[k + 1]].tolist()
        expected = every_path(model, text)[:count]
        scores = [made.scores[k], *[s for s, _ in made.changes[k]]]
        assert np.allclose(scores, [s for s, _ in expected]), text
        found = [tuple(ids), *[tuple(edited(ids, e)) for _, e in made.changes[k]]]
        everything = dict((i, s) for s, i in every_path(model, text))
        assert len(set(found)) == len(found) and np.allclose([everything[f] for f in found], scores)


def test_best_against_all_paths(toy, model):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc é▁x") for _ in range(rng.randint(1, 11))) for _ in range(60)] + ["abc" * 5]
    check(toy, texts, 4)
    check(model, ["the", "Hi you", "a  bc", "né▁\n", "of."], 3)


def test_long_units_and_short_ones_agree(toy):
    text = "abcabcab" * 5
    found = toy.best(SPACE + text, 3)
    assert [f[0] for f in found] == sorted([f[0] for f in found], reverse=True)
    made = toy.encode_all([text], 3)
    assert np.isclose(made.scores[0], found[0][0]) and np.isclose(made.changes[0][0][0], found[1][0])
    (score, loss, size, ids) = toy.solve([SPACE + text[:24]], 32)
    best = toy.best(SPACE + text[:24], 2)
    assert np.isclose(score[0], best[0][0]) and np.isclose(loss[0], best[0][0] - best[1][0])
    assert toy.decode(ids.tolist()) == text[:24]


def test_runs_of_one_letter(toy, model):
    check(toy, ["a" * 9, "abc" * 4, "cab" * 4], 7)
    twins = PieceModel.of(["a", "aa", "aaa"], [-1.0, -2.0, -3.0], [False] * 3, 0)  # every path ties
    found = twins.best("a" * 40, 6)
    assert len({ids for _, ids in found}) == 6 and {s for s, _ in found} == {-40.0}
    assert [len(set(twins.best("aaa", n))) for n in (1, 2, 4, 9)] == [1, 2, 4, 4]
    for m, paths in ((toy, 1), (model, 3), (twins, 3)):
        begun = time.monotonic()
        best = m.best("a" * 100_000, 3)
        assert time.monotonic() - begun < 5 * 2 and len({ids for _, ids in best}) == paths  # twice, for slow machines
        assert all("".join([m.pieces[i] for i in ids]) == "a" * 100_000 for _, ids in best)


def test_combinations():
    lists = [[0, 1.0, 2.5], [0, 0.5], [0]]
    assert [round(s, 2) for s, _ in combinations(lists, 10)] == [0, 0.5, 1.0, 1.5, 2.5, 3.0]


@pytest.mark.parametrize("text", ["", " ", "  two  spaces ", "▁ literal ▁▁", "tab\tnew\nline\r\n", "ñandú 漢字 😀 \x00 ", "x" * 5000, " \n" * 700])
def test_round_trip(model, text):
    made = model.encode_all([text], 2)
    assert model.decode(made.ids.tolist()) == text


def test_rows(spark, model):
    rows = [(1, "a b", "s"), (None, None, "s"), (1, "a b", "s"), (2, "", "s")]
    made = encode_pieces(spark.createDataFrame(rows, "doc_id long, text string, ids string"), model, 2, carry=["ids"])
    got = decode_pieces(made, model).collect()
    assert [(r.doc_id, r.decoded) for r in got] == [(1, "a b"), (None, ""), (1, "a b"), (2, "")] and got[0].carried.ids == "s"
    assert got[1]["ids"] == [] and got[1].alternatives == [] and len(got[0].alternatives) == 1
    assert encode_pieces(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_query(spark, folder):
    got = QUERIES["op10_sentence_pieces"](spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.round_trip and all(s <= r.score for s in r.next_scores) for r in got)
