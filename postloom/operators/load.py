"""Loading posts: validation, batch collapse and upsert.

A post's place is a struct of load, page, position and source, compared field by field, so no
count of loads, pages or positions is too large for it. Every stored row carries the places of
the first and of the latest capture of its key. A merge takes the fixed columns from the earlier
and the counters from the later one, so its result depends neither on the order in which batches
are merged nor on a batch being merged twice.

The stored table itself is in :mod:`postloom.operators.table`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.labels import engagement_etl
from postloom.functions.parse import now
from postloom.operators.collapse import collapse
from postloom.schema import ARRIVAL, KEY, MUTABLE, POSTS, STATIC, STORED

PLACES = T.StructType([STORED[name] for name in [*KEY, "first_at"]])


def _aligned(df: DataFrame, names: list[str]) -> DataFrame:
    """Select stored columns, casting them and filling absent ones."""

    def column(name: str) -> Column:
        data_type = STORED[name].dataType
        if name not in df.columns:
            return F.lit(None).cast(data_type).alias(name)
        return F.col(name).try_cast(data_type).alias(name)

    return df.select(*[column(n) for n in names])


def valid_key(df: DataFrame) -> Column:
    return (F.coalesce("post_id", F.lit("")) != "") & (F.coalesce("platform", F.lit("")) != "")


def ordered_seq(df: DataFrame) -> Column:
    """``seq``; a row without one raises, as no rule could place it."""
    unordered = F.raise_error(F.lit("a captured row has no seq")).cast(df.schema["seq"].dataType)
    return F.coalesce(F.col("seq"), unordered)


def arrival(df: DataFrame, load_no: int) -> Column:
    """Place over all loads of a row with a ``seq``, be it a number or a capture's place."""
    seq = ordered_seq(df)
    if isinstance(df.schema["seq"].dataType, T.StructType):
        parts = [seq["page"], seq["pos"], seq["source"]]
    else:
        parts = [seq, F.lit(0), F.lit(0)]
    fields = [F.lit(load_no), *parts]
    return F.struct(*[c.cast(f.dataType).alias(f.name) for c, f in zip(fields, ARRIVAL)])


def to_batch(
    transformed: DataFrame,
    load_no: int = 0,
    as_of: Column | None = None,
    latest_by: str = "arrival",
    whole: bool = False,
) -> DataFrame:
    """One stored row per key of a transformed batch, without ids yet.

    ``seq`` is the unique capture order within the load. Give every load the same number
    when their rows carry one order over all loads. Missing counters become 0. Rows without a
    key are left out; :func:`validate_load` reports them. ``whole`` as in :func:`collapse`.
    """
    counters = ["likes", "comments", "upvote_ratio", "retweet_count", "view_count"]
    rows = transformed.filter(valid_key(transformed))
    rows = rows.withColumn("first_at", arrival(rows, load_no)).withColumn("last_at", F.col("first_at"))
    if "processed_at" not in rows.columns:
        rows = rows.withColumn("processed_at", now() if as_of is None else as_of)
    rows = rows.withColumn("id", F.lit(None).cast("bigint"))
    rows = _aligned(rows, STORED.fieldNames()).fillna(0, subset=counters)
    return merge_all(rows, latest_by, whole)


def first_places(transformed: DataFrame, load_no: int = 0, as_of: Column | None = None, latest_by: str = "arrival") -> DataFrame:
    """The keys of a batch with the place of their first row; no other column is computed."""
    return to_batch(transformed, load_no, as_of, latest_by).select(*PLACES.fieldNames())


def merge_all(rows: DataFrame, latest_by: str = "arrival", whole: bool = False) -> DataFrame:
    """Stored rows merged to one row per key in a single combining aggregation.

    The fixed columns come from the first arrival, the counters from the latest
    one, or from the latest ``scraped_at`` when asked for. Of the rows of a post only the load
    that found it new gave one an id, which need not be the earliest arrival.
    """
    latest = F.col("last_at")
    if latest_by == "scraped_at":
        latest = F.struct("scraped_at", "last_at")
    ordered = rows.withColumn("_latest", latest)
    merged = collapse(ordered, KEY, [*STATIC, "first_at"], [*MUTABLE, "last_at"], "first_at", "_latest", ["id"], whole)
    return merged.select(*STORED.fieldNames())


def as_posts(stored: DataFrame) -> DataFrame:
    """Stored rows without the bookkeeping columns."""
    return stored.select(*POSTS.fieldNames())


def _sides(latest_by: str) -> list[Column]:
    """Merged row of a key that is on one side (``t``, ``b``) or on both."""
    in_t, in_b = F.col("t.first_at").isNotNull(), F.col("b.first_at").isNotNull()
    static_from_t = in_t & (~in_b | (F.col("t.first_at") <= F.col("b.first_at")))
    later_in_b = F.col("b.last_at") >= F.col("t.last_at")
    if latest_by == "scraped_at":
        # A missing capture time is earlier than any other.
        never = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
        old, new = (F.coalesce(f"{side}.scraped_at", never) for side in "tb")
        later_in_b = (new > old) | ((new == old) & later_in_b)
    counters_from_b = in_b & (~in_t | later_in_b)

    def column(name: str) -> Column:
        if name in [*KEY, "id"]:
            picked = F.coalesce(f"t.{name}", f"b.{name}")
        elif name in [*MUTABLE, "last_at"]:
            picked = F.when(counters_from_b, F.col(f"b.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            picked = F.when(static_from_t, F.col(f"t.{name}")).otherwise(F.col(f"b.{name}"))
        return picked.alias(name)

    return [column(n) for n in STORED.fieldNames()]


def upsert(target: DataFrame, batch: DataFrame, latest_by: str = "arrival") -> DataFrame:
    """Stored table after a batch: new keys are added, known keys get new counters.

    Both inputs hold one row per key, so no key can overload a task. Which side has the key
    decides, never a NULL value: a NULL fixed column stays NULL. A side that is already
    partitioned by the key, as the stored table is, is not shuffled.
    """
    t, b = target.alias("t"), batch.alias("b")
    on_key = (F.col("t.post_id") == F.col("b.post_id")) & (F.col("t.platform") == F.col("b.platform"))
    return t.join(b, on_key, "full_outer").select(*_sides(latest_by))


def known_posts(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of a collapsed batch whose key is already loaded."""
    return batch.join(target.select(*KEY), KEY, "left_semi")


def unknown_posts(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of a collapsed batch whose key is not loaded yet."""
    return batch.join(target.select(*KEY), KEY, "left_anti")


def validate_load(batch: DataFrame, target: DataFrame) -> DataFrame:
    """The batch with ``status`` (success, duplicate, error) and ``error``.

    Loaded keys and repeats within the batch are duplicates. The first row of
    every key is found by a combining minimum and matched back on key and ``seq``,
    so rows of a repeated key stay spread over the tasks.
    """
    valid = valid_key(batch)
    batch = batch.withColumn("seq", F.when(valid, ordered_seq(batch)).otherwise(F.col("seq")))
    firsts = batch.filter(valid).groupBy(*KEY).agg(F.min("seq").alias("seq"))
    accepted = unknown_posts(firsts, target).withColumn("_accepted", F.lit(True))
    checked = batch.join(accepted, [*KEY, "seq"], "left").select(
        *[F.col(c) for c in batch.columns], "_accepted"
    )
    return checked.withColumns(
        {
            "status": F.when(~valid_key(checked), "error")
            .when(F.col("_accepted"), "success")
            .otherwise("duplicate"),
            "error": F.when(~valid_key(checked), "post id or platform is missing"),
        }
    ).drop("_accepted")


def load_stats(validated: DataFrame) -> DataFrame:
    """One row: rows loaded, duplicates and errors of a validated batch."""
    return validated.agg(
        F.count_if(F.col("status") == "success").alias("loaded"),
        F.count_if(F.col("status") == "duplicate").alias("duplicates"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )


def relabel_engagement(stored: DataFrame) -> DataFrame:
    """Recompute the engagement level from the latest counters."""
    return stored.withColumn("engagement_level", engagement_etl())
