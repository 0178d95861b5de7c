import random

import numpy as np
import pyarrow as pa

import corpus_pipeline as cp
from shelfwise.llm import near_copies as nc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(one, other):
    a, b = shingles(one), shingles(other)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_components(texts):
    names, old = [i for i, _ in texts], None
    near = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i][1], texts[j][1]) >= 0.8]
    while names != old:
        old = names[:]
        for i, j in near:
            names[i] = names[j] = min(names[i], names[j])
    return names


def made_texts():
    """Chains of texts that each differ from the last in a few words, and texts on their own."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    for group in range(40):
        text = [rng.choice(words) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(rng.randint(1, 6)):
            texts.append(" ".join(text))
            text = text[:]
            for _ in range(rng.randint(1, max(1, len(text) // 60))):
                text[rng.randrange(len(text))] = rng.choice(words)
    rng.shuffle(texts)
    return [*enumerate(texts, 1), (900, None), (901, " \n"), (902, "A b"), (903, "a  B"), (904, "a c")]


def test_components_by_jaccard(spark):
    texts = made_texts()
    got = nc.near_copies(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted(zip([i for i, _ in texts], plain_components(texts)))
    assert nc.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_simhash_balls_give_candidates(spark):
    """SimHashes that chain within three bits share a key, others don't; near texts are within reach of it."""
    rng = random.Random(5)
    base, far = rng.getrandbits(63), rng.getrandbits(63)
    prints = [base, base ^ 0b111, base ^ 0b111111, base ^ (0b1111 << 40), far, far]
    nodes = spark.createDataFrame(list(enumerate(prints)), "node long, fp long")
    key = {r.node: r.ball for r in nc.ball_keys(nodes).collect()}
    assert len(key) == 6 and key[0] == key[1] == key[2] and key[4] == key[5] and len({key[0], key[3], key[4]}) == 3
    sets = nc.sets_of(pa.array([" ".join(f"w{i}" for i in range(n, n + 2000)) for n in (0, 3, 5000)]), 5)
    one, near, other = ((nc.fingerprint(x)) & (1 << 64) - 1 for x in sets)
    assert (one ^ near).bit_count() <= 6 and 16 < (one ^ other).bit_count() < 48


def test_stage_links_at_08(spark, folder):
    """Copies of similarity 0.8 to 0.97 differ in more than three SimHash bits."""
    texts = [(i, t) for i, t in made_texts() if t]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], SCHEMA)
    assert sorted(r.doc_id for r in cp.near_duplicates(spark, docs, folder).collect()) == sorted(set(plain_components(texts)))


def test_words_and_fingerprints(spark):
    rows = spark.createDataFrame([("A\tb\x0bC ",), (" a b\r\nc",), ("a bc",), ("",), ("  ",), ("É b",), ("é b",)], "text string")
    got = [bytes(r.d) for r in rows.select(nc.word_digest("text").alias("d")).collect()]
    assert got[0] == got[1] and got[3] == got[4] and len(set(got)) == 5
    hashes = np.arange(1, 10_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert (nc.least_hashes(hashes) == nc.least_hashes(hashes[::-1])).all()
    assert len(set(nc.least_hashes(hashes).tolist())) == nc.FINGERPRINTS


def test_rows_of_one_id(spark, folder):
    """Rows go by themselves: an id may repeat with other texts."""
    one, two, three, copy = (" ".join(f"{c}{i}" for i in range(20)) for c in "abca")
    rows = [(3, one), (5, copy), (5, two), (7, two), (None, three), (None, one), (8, three), (8, three), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    got = sorted((r.doc_id, r.text or "") for r in cp.near_duplicates(spark, docs, folder).collect())
    assert got == [(3, one), (5, two), (8, three), (9, "")]


def test_contaminated_rows_of_one_id(spark, folder):
    item = next(r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect() if len(r.text.split()) > 20)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in [(5, item), (5, "clean"), (6, "fine")]], SCHEMA)
    assert sorted(r.text for r in cp.benchmark_passages(spark, docs, folder).collect()) == ["clean", "fine"]
