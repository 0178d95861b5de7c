import random

import numpy as np
import pyarrow as pa

from shelfwise.llm import quality as q
from shelfwise.llm.queries import METADATA, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep int"


def made(n=600, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(80)]
    docs, labels = [], []
    for i in range(n):
        kind = rng.choice(["good", "good", "shout", "repeat", "toxic"])
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        if kind == "shout":
            text = [w.upper() + "!!" for w in text]
        if kind == "repeat":
            text = [w for w in text[:10] for _ in range(10)]
        if kind == "toxic":
            text.insert(rng.randrange(len(text)), "scum")
        docs.append((i, " ".join(text), rng.choice(["en", "de"]), "spam" if kind != "good" and rng.random() < 0.7 else "site", len(text), 1))
        labels.append((i, int(kind in ("good", "toxic")), int(kind == "toxic"), kind))
    return docs, labels


def test_features_by_hand():
    rows, cols = q.text_features(pa.array(["Ab ab, c", "", "12"]))
    words = {r: sorted(c for r2, c in zip(rows, cols) if r2 == r and c < 1 << q.WORD_BITS) for r in range(3)}
    assert [len(words[r]) for r in range(3)] == [2, 0, 1]
    assert (np.bincount(rows, minlength=3) - [2, 0, 1] == len(q.STATISTICS)).all() and cols.max() < q.TEXT_SIZE
    rows, cols = q.meta_features([pa.array(["a", None, "a"]), pa.array([8, 9, None])])
    by = [set(cols[rows == r]) for r in range(3)]
    assert len(by[0] & by[2]) == 1 and len(by[0] & by[1]) == 1 and all(len(b) == 3 for b in by)


def test_held_out_accuracy_and_pseudo_labels(spark):
    docs, labels = made()
    frame = spark.createDataFrame(docs, SCHEMA)
    told = spark.createDataFrame([x[:3] for x in labels[:300]], "doc_id long, quality int, toxic int")
    model = q.train_quality(frame, told, METADATA)
    got = {r.doc_id: r for r in q.classify_quality(frame, model, METADATA).collect()}
    rest = [(i, quality and not toxic) for i, quality, toxic, _ in labels[300:]]
    right = np.mean([got[i].keep == bool(good) for i, good in rest])
    assert right > 0.95
    brier = np.mean([(got[i].score - good) ** 2 for i, good in rest])
    assert brier < 0.06 and np.mean([(got[i].meta_score > 0.5) == bool(good) for i, good in rest]) > 0.6


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 2, 400)
    labels = np.where(np.arange(400) < 60, truth, -1)
    text = q.Sample(np.arange(400), truth * 1, 400)
    meta = q.Sample(np.arange(400), np.where(rng.random(400) < 0.9, truth, 1 - truth) + 5, 400)
    model = q.co_train(text, meta, labels, sure=0.9)
    chance = q.sigmoid(model.text.logits(text.rows, text.cols, 400))
    assert ((chance > 0.5) == truth).all() and model.mixture[0] > 0.5
    assert q.co_train(text, meta, np.where(labels == 1, 1, -1)) is None


def test_odd_rows(spark):
    docs, labels = made(200)
    odd = [(None, None, None, None, None, None), (900, "", "en", "", -5, 1), (900, "", "en", "", -5, 1), (901, "scum " * 40_000, None, "site", 1 << 60, 1)]
    frame = spark.createDataFrame(docs + odd, SCHEMA)
    told = spark.createDataFrame([x[:3] for x in labels] + [(None, 1, 0), (5, None, None), (12345, 1, 0), (3, 0, None)], "doc_id long, quality int, toxic int")
    model = q.train_quality(frame, told, METADATA)
    got = q.classify_quality(frame, model, METADATA, carry=["keep", "text"]).collect()
    assert len(got) == 204 and all(0 <= r.score <= 1 for r in got) and not [r for r in got if r.doc_id == 901][0].keep
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert q.train_quality(frame, none, METADATA) is None
    assert all(r.keep and r.score is None for r in q.classify_quality(frame, None, METADATA).collect())
    empty = spark.createDataFrame([], SCHEMA)
    assert q.train_quality(empty, none, METADATA) is None and q.classify_quality(empty, model, METADATA).count() == 0


def test_query(spark, folder):
    got = {r.doc_id: r for r in QUERIES["op8_quality_classifier"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    good = [got[r.doc_id].keep for r in labels if r.doc_id in got and r.quality == 1 and r.toxic == 0]
    assert np.mean(good) > 0.9  # the smallest table has too few labels to hold the rest to a figure
