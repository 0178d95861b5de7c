import random

import pytest
from brute import WORD, repeats
from pyspark.sql import functions as F

from shelfwise.llm.common import hex_digest
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.repeats import COVERS
from shelfwise.llm.substring_dedup import substring_dedup
from shelfwise.llm.suffix_dedup import suffix_dedup

SCHEMA = "doc_id long, block int, text string, spans string, kept int"


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 5)))
    passage = " ".join(word() for _ in range(40))
    line = " ".join(word() for _ in range(13))
    rows = []
    for i in range(n):
        text = " ".join(word() for _ in range(rng.randint(0, 60)))
        if i % 3 == 0:
            text = f"{text} {passage[rng.randint(0, 20):]}\n{text[:20]}"
        if i % 4 == 0:
            text = f"{line}\t{text}"
        rows.append((rng.randint(0, 1 << 40), 1, text, "x", None))
    rows += [(rows[0][0] + 1, 1, rows[0][2], "x", 1), rows[3], rows[3], (5, 1, None, None, None), (6, 1, "", "", 1)]
    rows += [(None, 1, rows[6][2], "n", 1), (None, 1, rows[6][2], "n", 1), (7, 1, "ab " * 300, "", 1), (8, 1, "ab " * 500, "", 1), (9, 1, " \n ", "", 1)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("period", sorted(COVERS))
def test_covers(period):
    differences = [(a - b) % period for a in COVERS[period] for b in COVERS[period] if a != b]
    assert sorted(differences) == list(range(1, period))


@pytest.mark.parametrize("block_bytes", [400, 4 << 20])
def test_bytes_against_brute_force(spark, block_bytes):
    rows = corpus()
    found = suffix_dedup(spark.createDataFrame(rows, SCHEMA), block_bytes=block_bytes)
    got = found.select("doc_id", "n_bytes", "n_removed", F.size("spans"), hex_digest("kept")).collect()
    assert sorted(map(tuple, got), key=str) == repeats([(r[0], r[2]) for r in rows], list, 50, bytes)


@pytest.mark.parametrize("block_bytes", [400, 4 << 20])
def test_words_against_brute_force(spark, block_bytes):
    rows = corpus(4)
    found = substring_dedup(spark.createDataFrame(rows, SCHEMA), block_bytes=block_bytes, carry=["kept"])
    got = found.select("doc_id", "n_words", "n_removed", F.size("spans"), hex_digest("kept")).collect()
    assert sorted(map(tuple, got), key=str) == repeats([(r[0], r[2]) for r in rows], WORD.findall, 13, b" ".join)


def test_spans_cut_what_is_removed(spark):
    rows = corpus(5)
    for r in suffix_dedup(spark.createDataFrame(rows, SCHEMA)).collect():
        assert sum(s.end - s.begin for s in r.spans) == r.n_removed
        assert len(r.kept) == r.n_bytes - r.n_removed


@pytest.mark.parametrize("operator", [suffix_dedup, substring_dedup])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0


def test_queries(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = QUERIES["op5_substring_dedup"](spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == [(a, b, c, e) for a, b, c, _, e in repeats(rows, WORD.findall, 13, b" ".join)]
    got = QUERIES["op4_suffix_dedup"](spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == repeats(rows, bytes, 50, bytes)
