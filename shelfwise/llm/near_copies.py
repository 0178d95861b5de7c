"""Near copies by the share of common shingles: SimHash balls and least hashes find them, exact sets verify."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import staged
from shelfwise.llm.components import components
from shelfwise.llm.linking import connected, sets_of
from shelfwise.llm.simhash_dedup import fingerprint, simhash_links

#: Fingerprints of a text, each of so many least hashes.
FINGERPRINTS, EACH = 24, 5
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def least_hashes(hashes: np.ndarray, seed: int = 5) -> np.ndarray:
    """``FINGERPRINTS`` signed longs; two sets have a given one in common with chance similarity ** ``EACH``."""
    rng = np.random.Generator(np.random.PCG64(seed))
    factors = rng.integers(1 << 63, size=FINGERPRINTS * EACH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(hashes), 4096):
        mixed = hashes[None, part : part + 4096] * factors[:, None]
        least = np.minimum(least, mixed.min(axis=1))
    prints = np.arange(FINGERPRINTS, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for column in least.reshape(FINGERPRINTS, EACH).T:
        prints = (prints ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        prints ^= prints >> np.uint64(29)
    return prints.view(np.int64)


def word_digest(text: Column | str) -> Column:
    """Equal for texts of the same words, lower-cased in A-Z; words are runs without white space (x20, x09-x0D)."""
    line = F.regexp_replace(F.translate(text, UPPER, SMALL), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.md5(F.trim(line)))


def ball_keys(nodes: DataFrame) -> DataFrame:
    """``node`` and ``ball`` of ``nodes`` (``node, fp``), the same for nodes whose SimHashes connect within three bits."""
    prints = staged(nodes.groupBy("fp").agg(F.min("node").alias("rep")), "simhashes")
    groups = components(simhash_links(prints)).distinct().withColumnRenamed("node", "rep")
    named = prints.join(groups, "rep", "left").select("fp", F.coalesce("component", "rep").alias("ball"))
    return nodes.join(named, "fp").select("node", F.xxhash64(F.lit("ball"), "ball").alias("ball"))


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8,
) -> DataFrame:
    """``id_col`` and ``component_id`` of every row; ids may be of any type that has an order, without nulls.

    Shingles are as in ``simhash_dedup``, here as sets.  Texts whose sets have a Jaccard similarity of
    ``similarity`` or more link, and ``component_id`` is the smallest id reachable.  Texts of equal words
    are one node, as are all texts without words.  Candidates are nodes whose SimHashes, by ball hashing, connect
    within three bits, which finds the nearest copies, and nodes that share one of ``FINGERPRINTS`` fingerprints of
    least hashes; at similarity 0.8 none is shared with chance 0.00007.  Candidates are connected by
    representatives (``linking``) and verified on their words, so that a large group costs its rows and not its
    pairs.  Null and empty texts are texts without words; rows that share an id count each; long texts go whole.
    No rows give none; other columns stay outside.
    """
    kind, percent = docs.schema[id_col].dataType.simpleString(), round(100 * similarity)

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = sets_of(batch.column("text"), shingle)
            made = [batch.column("id"), batch.column("words"), pa.array([len(x) for x in sets], pa.int64()), pa.array([least_hashes(x) for x in sets], pa.list_(pa.int64())), pa.array([fingerprint(x) for x in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(made, ["id", "words", "size", "prints", "fp"])

    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")).withColumn("words", word_digest("text"))
    prints = staged(rows.mapInArrow(printed, f"id {kind}, words binary, size long, prints array<long>, fp long"), "prints")
    nodes = prints.groupBy("words").agg(F.min("id").alias("id"), F.first("size").alias("size"), F.first("prints").alias("prints"), F.first("fp").alias("fp"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    keyed = nodes.join(ball_keys(nodes), "node")
    shared = keyed.select("node", "size", F.lit(0).cast("long").alias("alone"), F.explode(F.concat("prints", F.array("ball"))).alias("key"))
    shared = staged(shared, "keys")
    met = staged(shared.join(shared.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "key"), "met")
    wanted = nodes.select("node", "id", "words").join(met.select("node").distinct(), "node", "left_semi")
    texts = rows.join(wanted, ["id", "words"]).groupBy("node").agg(F.min("text").alias("text"))

    links = connected(met, texts, shingle, percent)
    named = nodes.join(components(links).distinct(), "node", "left").select("words", "id", F.coalesce("component", "node").alias("group"))
    smallest = named.groupBy("group").agg(F.min("id").alias("component_id"))
    found = prints.select("id", "words").join(named.select("words", "group").join(smallest, "group").drop("group"), "words")
    return found.select(F.col("id").alias(id_col), "component_id")
