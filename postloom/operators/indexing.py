"""Consecutive row numbers without moving all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.session import shared_dir

# monotonically_increasing_id() keeps the partition above, the row below bit 33.
_ROW_BITS = 33


def with_row_index(df: DataFrame, order: list[Column], name: str = "row_index") -> DataFrame:
    """Add 0, 1, 2, ... in the given order.

    Rows are range-partitioned and sorted, then written to the checkpoint folder so
    that the second pass sees the partitions the first one counted. Partition
    start numbers come from one count per partition. End ``order`` with a unique
    column: it makes the numbers repeatable and lets equal leading values split.
    """
    shared_dir(df.sparkSession)
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    row = F.monotonically_increasing_id()
    numbered = ordered.withColumns(
        {
            "_partition": F.shiftright(row, _ROW_BITS),
            "_row": row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    sizes = numbered.groupBy("_partition").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so the window is small and the broadcast is bounded
    # by the number of shuffle partitions.
    starts = sizes.select(
        "_partition", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return numbered.join(F.broadcast(starts), "_partition").select(
        *df.columns, (F.col("_start") + F.col("_row")).alias(name)
    )


def assign_ids(df: DataFrame, start: int = 0, order: str = "seq") -> DataFrame:
    """Gap-free surrogate ids following ``start``, in capture order.

    Only the capture order, which must be unique, is sorted and numbered; rows are joined to it.
    """
    numbered = with_row_index(df.select(order), [F.asc_nulls_last(order)], "id")
    return df.join(numbered, order).withColumn("id", F.col("id") + F.lit(start + 1))
