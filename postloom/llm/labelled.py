"""Which labelled rows may be learned from, and label rows of one kind per id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id") -> Column:
    """True for the third of ids that is kept for testing: crc32 of the id as text, modulo 3, is 1.

    A NULL id counts as not held out; it has no label.
    """
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labels_of(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """One (id, label) per id that may be learned from. Repeated rows count once, ids with
    both labels and NULL or other labels not at all."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    return (
        known.groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("top"))
        .filter(F.col("label") == F.col("top"))
        .select("id", F.col("label").cast("int"))
    )
