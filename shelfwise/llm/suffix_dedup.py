"""Dedup of byte strings by difference-cover anchors, as in ``substring_dedup``; no suffix array."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import id_and_text
from shelfwise.llm.repeats import byte_units, cut_bytes, remove_repeats


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, period: int = 13,
    block_bytes: int = 4 << 20, carry: list[str] | tuple = (),
) -> DataFrame:
    """Cut every byte covered by a string of ``length`` bytes that also starts in a smaller id.

    Anchors at the positions of a difference cover modulo ``period`` find the candidates; whole
    strings of ``length`` bytes are then compared by fingerprint.  Suffixes are not sorted.

    Returns one row for each input row: ``id_col``, ``n_bytes``, ``n_removed``, ``spans`` (maximal
    cut runs, begin and end), ``kept`` (binary) and, if ``carry`` names columns, ``carried``.
    Null texts are empty.  Rows with a null id are larger than all ids and equal among themselves;
    rows that repeat an id don't count against each other.  Other columns are not read.
    """
    found = remove_repeats(id_and_text(docs, id_col, text_col, carry), byte_units, cut_bytes, length, period, block_bytes)
    return found.select(
        F.col("id").alias(id_col), F.col("n_units").alias("n_bytes"), "n_removed", "spans", "kept",
        *(["carried"] if carry else []),
    )
