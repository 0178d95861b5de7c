"""The dealt operators as queries over the given tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.ann_search import ann_search
from shelfwise.llm.common import hex_digest, short_batches
from shelfwise.llm.decontaminate import decontaminate
from shelfwise.llm.html_extract import extract_text, labelled_pages, seed_pages, train_chain
from shelfwise.llm.licenses import license_scan, license_sql
from shelfwise.llm.jaccard_join import jaccard_join
from shelfwise.llm.lm_scoring import score_texts
from shelfwise.llm.pieces import PieceModel, decode_pieces, encode_pieces
from shelfwise.llm.quality import classify_quality, train_quality
from shelfwise.llm.simhash_dedup import simhash_dedup
from shelfwise.llm.sql import clusters_sql, codes_sql, contamination_sql, jaccard_sql, substring_sql, suffix_sql
from shelfwise.llm.substring_dedup import substring_dedup
from shelfwise.llm.suffix_dedup import suffix_dedup
from shelfwise.llm.threshold_clusters import threshold_clusters
from shelfwise.llm.vector_codes import vector_codes

#: The model is a parameter of the operator; queries take the public one of this machine.
PIECES = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

METADATA = ["lang", "source", "n_chars"]

#: Segmentations of a text that are found, the best one included.
SEGMENTATIONS = 3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_ann_search(spark: SparkSession, folder: str) -> DataFrame:
    return ann_search(table(spark, folder, "embeddings"))


@query
def op2_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup(table(spark, folder, "documents"))


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents")).withColumn("notices", F.array_join("notices", ","))


ORACLES["op3_license_scan"] = license_sql()


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), hex_digest("kept").alias("kept_sha256"),
    )


ORACLES["op4_suffix_dedup"] = suffix_sql()


@query
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", hex_digest("kept").alias("kept_sha256"))


ORACLES["op5_substring_dedup"] = substring_sql()


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        hex_digest(F.array_join("items", ",")).alias("items_sha256"), "contaminated",
    )


ORACLES["op6_decontaminate"] = contamination_sql()


@query
def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))


@query
def op9_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extract_text(pages, train_chain(seed_pages() + labelled_pages(pages, table(spark, folder, "documents"))))


@query
def op10_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = PieceModel.load(PIECES)
    encoded = encode_pieces(table(spark, folder, "documents"), model, SEGMENTATIONS)
    return decode_pieces(encoded, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "score", F.xxhash64("ids").alias("ids_hash"),
        F.transform("alternatives", lambda a: a["score"]).alias("next_scores"), F.xxhash64("alternatives").alias("alternatives_hash"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


@query
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = train_quality(documents, table(spark, folder, "labels"), METADATA)
    return classify_quality(documents, model, METADATA)


@query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes(table(spark, folder, "embeddings"))


ORACLES["op11_vector_codes"] = codes_sql()


@query
def op12_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(table(spark, folder, "documents"))


ORACLES["op12_jaccard_join"] = jaccard_sql()


@query
def op13_threshold_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return threshold_clusters(table(spark, folder, "embeddings")).drop("centroid")


ORACLES["op13_threshold_clusters"] = clusters_sql()
