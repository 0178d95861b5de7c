import hashlib

import pytest
from brute import WORD, repeats
from test_decontaminate import plain as plain_contamination
from test_near_copies import plain_components

from pyspark.sql import functions as F

import corpus_pipeline as cp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def test_near_duplicates(spark, folder, rows):
    got = cp.near_duplicates(spark, frame(spark, rows), folder)
    names = plain_components(rows)  # five-word shingles, Jaccard 0.8, on the whole table
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in got.collect()) == sorted({n for n in names})
    odd = [(1, "a b c d"), (1, "a b c d"), (1, "z y x w v"), (None, "same text here"), (None, "same text here"), (9, None)]
    assert sorted((r.doc_id or 0, r.text or "") for r in cp.near_duplicates(spark, frame(spark, odd), folder).collect()) == [(0, "same text here"), (1, "a b c d"), (1, "z y x w v"), (9, "")]


def test_repeated_passages(spark, folder, rows):
    got = {r.doc_id: r for r in cp.repeated_passages(spark, frame(spark, rows), folder).collect()}
    texts = dict(rows)
    for doc, n, removed, _, _ in repeats(rows, WORD.findall, 13, b" ".join):
        if removed:
            assert len(got[doc].text.split()) == n - removed and got[doc].n_chars == len(got[doc].text)
        else:
            assert got[doc].text == texts[doc]
    odd = [(None, "x " * 30), (2, None), (3, "x " * 30)]
    assert sorted((r.doc_id or 0, r.text or "") for r in cp.repeated_passages(spark, frame(spark, odd), folder).collect())[1:2] == [(2, "")]


def test_repeated_passages_go_by_row(spark, folder):
    """One order for all rows: by id, then by text; rows without an id come last."""
    passage = " ".join(f"p{i}" for i in range(20))

    def cut(*rows):
        return sorted((r.doc_id or 0, r.text) for r in cp.repeated_passages(spark, frame(spark, rows), folder).collect())

    for word in "abcdefgh":
        assert cut((5, f"{passage} own five"), (None, f"{passage} {word}")) == [(0, word), (5, f"{passage} own five")]
    kept, lost = sorted([f"{passage} first", f"{passage} second"], key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert cut((5, f"{passage} first"), (5, f"{passage} second"), (4, "x")) == sorted([(4, "x"), (5, kept), (5, lost.removeprefix(f"{passage} "))])
    assert len(set(cut((None, f"{passage} one"), (None, f"{passage} two")))) == 2
    assert sum(passage in t for _, t in cut((None, f"{passage} one"), (None, f"{passage} two"))) == 1


def test_stages_carry_clashing_columns(spark, folder):
    """Columns of the names that operators use inside pass through."""
    names = ["id", "block", "key", "node", "words", "label", "score", "carried", "kept", "component_id", "n_removed"]
    docs = frame(spark, [(1, "one two three"), (2, None), (None, "")]).withColumns({n: F.lit(n) for n in names})
    for name, stage in cp.STAGES[1:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and all(r[n] == n for r in out.collect() for n in names), name
    assert cp.tokens(spark, docs, folder).count() == 3


def test_benchmark_passages(spark, folder, rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = cp.benchmark_passages(spark, frame(spark, [*rows, (None, items[0][1]), (None, "clean")]), folder).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(r[0] for r in plain_contamination(rows, items) if not r[-1])
    assert [r.text for r in got if r.doc_id is None] == ["clean"]


def test_quality_keeps_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = cp.quality(spark, docs, folder)
    assert kept.schema == docs.schema and 0 < kept.count() <= docs.count()
    assert kept.exceptAll(docs).count() == 0


def test_tokens_have_the_next_segmentations(spark, folder):
    """The last stage lists segmentations as the operator's own query does."""
    docs = frame(spark, [(1, "one two three"), (2, None), (3, ""), (4, "aaaa " * 9)])
    model = cp.PieceModel.load(cp.PIECES)
    got = {r.doc_id: r for r in cp.tokens(spark, docs, folder).collect()}
    asked = {r.doc_id: r for r in cp.encode_pieces(docs, model, 3).collect()}
    assert all(got[k].ids == asked[k].ids and got[k].alternatives == asked[k].alternatives for k in asked)
    assert [len(got[k].alternatives) for k in (1, 2, 3, 4)] == [2, 0, 0, 2]


def test_run(spark, folder):
    found = cp.run(spark, folder).collect()
    assert len({r.doc_id for r in found}) == len(found) > 50 and all(r.round_trip and r.n_pieces == len(r.ids) for r in found)
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_passages", "benchmark_passages", "tokens"] and cp.ORACLE_SQL is None


def test_empty_documents(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        docs_out = stage(spark, docs, folder)
        assert docs_out.count() == 0
