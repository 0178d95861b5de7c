"""Documents to training tokens: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.functions.ranking import global_rank
from shelfwise.llm.common import short_batches, staged
from shelfwise.llm.decontaminate import decontaminate
from shelfwise.llm.near_copies import near_copies
from shelfwise.llm.pieces import PieceModel, decode_pieces, encode_pieces
from shelfwise.llm.quality import classify_quality, train_quality
from shelfwise.llm.queries import METADATA, PIECES, SEGMENTATIONS, table
from shelfwise.llm.substring_dedup import substring_dedup

KEY = "__key"


def ordered(docs: DataFrame) -> DataFrame:
    """With a key for rows, in the order of :func:`row_key`: the id, or a number above all ids where there is none.

    Rows of one id and different texts count against each other like any others; where there are such, all rows
    are numbered in that order instead.
    """
    doc_id = F.col("doc_id").cast("long")
    behind = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    rows = docs.withColumn(KEY, F.coalesce(doc_id, behind))
    twice = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), F.min(F.md5("text")).alias("a"), F.max(F.md5("text")).alias("b")).filter("n > 1 AND a != b")
    if twice.isEmpty() and not rows.filter(doc_id >= 1 << 62).limit(1).count():
        return rows
    keys = staged(docs.select(row_key().alias("row")).distinct(), "rows")
    places = global_rank(keys, F.col("row"), name=KEY)
    return docs.withColumn("__row", row_key()).join(places, F.col("__row") == F.col("row")).drop("__row", "row")


def row_key() -> Column:
    """A key that only rows of the same id and text share, in the order of ids; rows without one come last."""
    doc_id = F.col("doc_id").cast("long")
    return F.struct(doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.coalesce(F.md5("text"), F.lit("")).alias("text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts: of good quality and not toxic.

    Null and empty texts are judged by their metadata and no words.  Rows that repeat an id or all their columns are
    judged each; further columns are carried.  Without labelled rows all documents stay.
    """
    metadata = [c for c in METADATA if c in docs.columns]
    model = train_quality(docs, table(spark, sf_dir, "labels"), metadata)
    return classify_quality(docs, model, metadata, carry=docs.columns).filter("keep").select("carried.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id of each component of near copies, whatever else has this id.

    Rows without an id come last, in the order of a digest of their text.  Of rows with the same id and text one stays.
    Null and empty texts, and such without words, are one group.  Further columns are carried.
    """
    short_batches(spark)
    rows = docs.withColumn(KEY, row_key())
    found = staged(near_copies(rows, id_col=KEY), "components")
    left = rows.join(found.filter(F.col("component_id") != F.col(KEY)).select(KEY).distinct(), KEY, "left_anti")
    repeated = staged(found.filter(F.col("component_id") == F.col(KEY)).groupBy(KEY).count().filter("count > 1").select(KEY), "repeated")
    if not repeated.isEmpty():  # rows of the same id and text
        many = left.join(repeated, KEY, "left_semi").groupBy(KEY).agg(F.min(F.struct(*docs.columns)).alias("row"))
        return left.join(repeated, KEY, "left_anti").select(*docs.columns).unionByName(many.select("row.*"))
    return left.select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that an earlier row has; the others' texts as they are.

    Rows are in the order of ids; rows without one come last and rows that share one in the order of a digest of their
    text, so of any two the same one keeps a passage.  Rows of the same id and text keep both.  A null or empty text
    stays as it is.  Further columns are carried.
    """
    short_batches(spark)
    found = substring_dedup(ordered(docs), id_col=KEY, carry=docs.columns)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("carried.text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("carried.n_chars"))} if (
        "n_chars" in docs.columns) else {"text": text}
    return found.select(*[changed.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by a benchmark item; every row is judged by its own text.

    Null and empty texts stay; rows that repeat an id or all their columns are judged each; further columns are carried.
    """
    rows = staged(docs.withColumn(KEY, F.monotonically_increasing_id()), "numbered")
    found = decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col=KEY)
    gone = staged(found.filter("contaminated").select(KEY), "contaminated")
    return rows.join(gone, KEY, "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, whether they decode to it, and the next best segmentations; a null or empty text has no pieces.

    ``alternatives`` are as :func:`encode_pieces` has them: score and the runs of ``ids`` that differ.
    """
    short_batches(spark)
    model = PieceModel.load(PIECES)
    decoded = decode_pieces(encode_pieces(docs, model, SEGMENTATIONS), model)
    whole = F.col("decoded") == F.col("text")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "score", whole.alias("round_trip"), "ids", "alternatives")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("tokens", tokens),
]
#: No SQL fits a classifier or hashes by XXH64; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
