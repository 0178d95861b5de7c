"""Substring dedup of words by difference-cover anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import id_and_text
from shelfwise.llm.repeats import cut_words, remove_repeats, word_units


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, period: int = 7,
    block_bytes: int = 4 << 20, carry: list[str] | tuple = (),
) -> DataFrame:
    """Cut every word covered by a window of ``window`` words that also starts in a smaller id.

    Anchors of ``window - period + 1`` words are hashed at the positions of a difference cover
    modulo ``period`` only; any equal windows share an aligned anchor.  Anchors known in another
    document are extended to whole windows, which are then compared.

    Words are runs of bytes other than white space (x20, x09-x0D), unchanged.  Returns one row for
    each input row: ``id_col``, ``n_words``, ``n_removed``, ``spans`` (cut runs in words), ``kept``
    (the kept words joined by one space), ``text_col`` and, if ``carry`` names columns, ``carried``.
    Null texts have no words.  Rows with a null id are larger than all ids and equal among
    themselves; rows that repeat an id don't count against each other.  Other columns are not read.
    """
    found = remove_repeats(id_and_text(docs, id_col, text_col, carry), word_units, cut_words, window, period, block_bytes)
    return found.select(
        F.col("id").alias(id_col), F.col("n_units").alias("n_words"), "n_removed", "spans",
        F.col("kept").cast("string").alias("kept"), F.col("text").alias(text_col), *(["carried"] if carry else []),
    )
