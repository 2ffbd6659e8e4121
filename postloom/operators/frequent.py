"""Most frequent values without shuffling the rare ones.

Every task summarises its values in a sketch of bounded size, Spark's own ``approx_top_k``; sketches
are merged in two steps, by groups of tasks first. What the merged
sketch holds are candidates, which are counted exactly. Rarer values can reach at most a known
count; if the last of the wanted values is not above it, the next round tracks more of them, and
after the largest sketch the plain grouping decides. The result is exact in every case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.operators.analytics import DELETED, tags_of, top
from postloom.session import scratch_path

TRACKED = 4096
MOST_TRACKED = 1 << 19
STEP = 16
GROUPS = 128
# A sketch that tracks m values misses a value with at most 3.5 / m of all rows; one that it tracks
# below that error is not returned either, so a value that is not returned has at most twice as many.
ERROR = 7.0


def _candidates(items: DataFrame, column: str, tracked: int) -> DataFrame:
    """Values of the merged sketch, as many as tracked at most, and the number of all rows; stored."""
    parts = items.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("_group")).agg(
        F.expr(f"approx_top_k_accumulate(`{column}`, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("rows")
    )
    # One group, but none of an empty input, which the combination cannot take.
    whole = parts.groupBy((F.col("_group") * 0).alias("_whole"))
    merged = whole.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("rows").alias("rows"))
    found = merged.select(F.explode_outer(F.expr(f"approx_top_k_estimate(sketch, {tracked})")).alias("found"), "rows")
    path = scratch_path(items.sparkSession, "frequent")
    found.select(F.col("found.item").alias(column), "rows").write.parquet(path)
    return items.sparkSession.read.parquet(path)


def most_frequent(items: DataFrame, column: str, limit: int, tracked: int = TRACKED) -> DataFrame:
    """The ``limit`` most frequent values of a column without NULLs and their counts, ties by value."""
    while tracked <= MOST_TRACKED:
        candidates = _candidates(items, column, tracked)
        # At most ``tracked`` short rows are broadcast.
        known = items.join(F.broadcast(candidates.select(column)), column, "left_semi")
        path = scratch_path(items.sparkSession, "counted")
        known.groupBy(column).agg(F.count(F.lit(1)).alias("count")).write.parquet(path)
        counted = items.sparkSession.read.schema(f"`{column}` string, count bigint").parquet(path)
        wanted = top(counted, "count", limit, column)
        total = candidates.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]
        seen, last = wanted.agg(F.count(F.lit(1)), F.min("count")).first()
        all_seen = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0] == total
        if all_seen or (seen == limit and last > ERROR * total / tracked):
            return wanted
        tracked *= STEP
    return top(items.groupBy(column).agg(F.count(F.lit(1)).alias("count")), "count", limit, column)


def top_hashtags(posts: DataFrame, limit: int = 20, tracked: int = TRACKED) -> DataFrame:
    """As :func:`analytics.top_hashtags`, for very many distinct hashtags."""
    return most_frequent(tags_of(posts), "hashtag", limit, tracked)


def top_authors(posts: DataFrame, limit: int = 10, tracked: int = TRACKED) -> DataFrame:
    """As :func:`analytics.top_authors`, for very many distinct authors."""
    known = posts.filter(F.col("author").isNotNull() & (F.col("author") != DELETED))
    return most_frequent(known.select("author"), "author", limit, tracked)
