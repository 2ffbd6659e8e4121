"""The stored posts table: Parquet in buckets of the key, upserted bucket by bucket.

The table is an ordinary Spark table, partitioned by ``slot`` and bucketed by the key into as
many buckets as there are slots, where ``slot`` is the bucket's own number: a slot holds exactly
one bucket. Spark therefore reads it as partitioned by the key: an upsert shuffles the batch to
the buckets and joins each with its bucket in place, without an exchange above the stored scan,
and Spark's dynamic partition overwrite replaces only the slots that the batch has keys of.

Replay is left to the source: merging a batch again changes nothing, because rows carry the
places of their first and latest capture. Commits are Spark's: a slot is replaced after the job
has written all of them. The swap of a slot is a delete and a rename, as everywhere in Spark's
file tables, so readers should not read while a load commits, and a table belongs to one
writer at a time. DataFrames made before a load do not see it; ask the table again.

Loads that come in small parts, as micro-batches do, may leave their rows beside the buckets, in a
second table of the same layout, until those rows are as many as the buckets' own. What is read is
both merged in place, and the number of times a row is written grows with the logarithm of the
number of parts. If a load fails between merging these rows and removing them, they are merged again, which
changes nothing.

``id`` numbers new posts in the order of their arrival. A load reserves its numbers by appending
one row to ``loads`` before it writes, so a load that failed leaves a gap and never a repeat.

Statistics are kept up to date: as a post's platform, label, author and time are fixed with its first
load, every load adds the counts of its new posts, and repeated keys count no more. They are
trusted if they add up to the number of stored rows, which Parquet's file ends tell.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators import analytics, listing
from postloom.operators.indexing import with_row_index
from postloom.operators.load import PLACES, as_posts, first_places, merge_all, to_batch, upsert, validate_load
from postloom.operators.search import literal_trigrams, slots_with, trigrams_of
from postloom.schema import KEY, STORED
from postloom.session import scratch_path

LOADS = (
    "load bigint, first_id bigint, new_posts bigint, buckets int, latest_by string, "
    "in_order boolean, indexed boolean"
)
STATISTICS = "section string, name string, count bigint, oldest timestamp_ntz, newest timestamp_ntz"
# Stored texts are the bulk of what a load writes.
CODEC = "zstd"
# Folder of the rows that lie beside the buckets.
RECENT = "recent"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class PostsTable:
    """A stored posts table below one folder of the shared file system.

    ``buckets`` (by default as many as the session has shuffle partitions) is fixed with the first
    load and kept with the table, as is the rule that counters follow: the latest arrival or the
    latest ``scraped_at``. Choose buckets of some 256 MB; a load rewrites every bucket it has a key of. ``text_index`` lets loads index their texts for
    :meth:`matching`; give it from the first load on.
    """

    spark: SparkSession
    path: str
    buckets: int | None = None
    text_index: bool = False

    @property
    def name(self) -> str:
        """Name of the table in the session's catalog."""
        return f"postloom_{hashlib.md5(self.path.encode()).hexdigest()}"

    def _hadoop(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def loads(self) -> DataFrame:
        """One row per load: its number, the ids it reserved, and the table's settings."""
        path, fs = self._hadoop("loads")
        if not fs.exists(path):
            return self.spark.createDataFrame([], LOADS)
        return self.spark.read.schema(LOADS).parquet(f"{self.path}/loads")

    def _state(self) -> tuple[int, int, int, str | None]:
        """Next load number, next id, buckets and rule."""
        buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (row,) = self.loads().agg(
            F.coalesce(F.max("load") + 1, F.lit(0)).alias("load"),
            F.coalesce(F.max(F.col("first_id") + F.col("new_posts")), F.lit(1)).alias("id"),
            F.coalesce(F.max("buckets"), F.lit(buckets)).alias("buckets"),
            F.max("latest_by").alias("latest_by"),
        ).collect()
        return row["load"], row["id"], row["buckets"], row["latest_by"]

    def latest_by(self) -> str | None:
        """The rule the table was started with; None before its first load."""
        return self._state()[3]

    def _slot(self, buckets: int) -> Column:
        """The bucket that Spark puts a key into."""
        return F.pmod(F.hash(*KEY), F.lit(buckets)).alias("slot")

    def _table(self, buckets: int, folder: str = "posts") -> DataFrame:
        """The table, put into the session's catalog when it is not there yet."""
        name = self._catalog_name(folder)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STORED)
            path, fs = self._hadoop(folder)
            fs.mkdirs(path)
            location = path.toString().replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, slot INT) USING parquet OPTIONS (compression '{CODEC}') PARTITIONED BY (slot) "
                f"CLUSTERED BY ({', '.join(KEY)}) SORTED BY (platform, timestamp) INTO {buckets} BUCKETS LOCATION '{location}'"
            )
            self.spark.catalog.recoverPartitions(name)
        return self.spark.table(name)

    def _catalog_name(self, folder: str) -> str:
        return self.name if folder == "posts" else f"{self.name}_{folder}"

    def _refresh(self) -> None:
        """Forget what this session knows of the table's files, as another session loads too."""
        for folder in ("posts", RECENT):
            if self.spark.catalog.tableExists(self._catalog_name(folder)):
                self.spark.catalog.refreshTable(self._catalog_name(folder))

    def _has_recent(self) -> bool:
        path, fs = self._hadoop(RECENT)
        return fs.exists(path)

    def _slots(self, rows: DataFrame, buckets: int) -> set[int]:
        return {r["slot"] for r in rows.select(self._slot(buckets)).distinct().collect()}  # at most the buckets

    def _current(self, buckets: int, rule: str | None, slots: list[int] | None = None) -> DataFrame:
        """Rows of the buckets, merged in place with those that lie beside them."""

        def rows(folder: str) -> DataFrame:
            table = self._table(buckets, folder)
            return (table if slots is None else table.filter(F.col("slot").isin(slots))).select(*STORED.fieldNames())

        if not self._has_recent():
            return rows("posts")
        return upsert(rows("posts"), merge_all(rows(RECENT), rule or "arrival"), rule or "arrival")

    def load(
        self,
        transformed: DataFrame,
        load_no: int | None = None,
        latest_by: str | None = None,
        as_of: Column | None = None,
        defer: bool = False,
        unobserved: DataFrame | None = None,
    ) -> int:
        """Upsert a transformed batch; returns its load number.

        The batch is read twice: its keys and places first, which costs only what they are made of, then whole
        rows. Both times it must have the same keys. ``unobserved`` are the same rows without the observations that would make
        the first pass compute them whole.

        ``load_no`` replaces the next number: give 0 throughout when rows carry one order over all
        loads, then loads may come in any order. ``defer`` leaves the rows beside the buckets until they
        are as many as those in them; give it for loads that are small parts of the table.
        """
        spark = transformed.sparkSession
        if spark is not self.spark:  # a micro-batch has a session of its own, where its observations are made
            there = replace(self, spark=spark)
            there._refresh()
            try:
                return there.load(transformed, load_no, latest_by, as_of, defer, unobserved)
            finally:
                self._refresh()
        number, next_id, buckets, rule = self._state()
        if latest_by not in (None, rule or latest_by):
            raise ValueError(f"the table keeps the latest by {rule}, not by {latest_by}")
        rule = rule or latest_by or "arrival"
        order = (number if load_no is None else load_no, as_of, rule)
        # Whole rows are computed, shuffled and written once, with the merge. What has to be known before is of keys and places alone.
        path = scratch_path(self.spark, "keys")
        first_places(transformed if unobserved is None else unobserved, *order).write.parquet(path, compression=CODEC)
        keys = self.spark.read.schema(PLACES).parquet(path)
        waiting = self._table(buckets, RECENT) if self._has_recent() else None
        # Parquet's file ends tell the numbers of rows.
        later = defer and keys.count() + (waiting.count() if waiting is not None else 0) < self._table(buckets).count()
        slots = self._slots(keys, buckets)
        if waiting is not None and not later:
            slots |= self._slots(waiting, buckets)
        touched = F.col("slot").isin(sorted(slots))
        stored = self._table(buckets).filter(touched).select(*STORED.fieldNames())
        batch = to_batch(transformed, *order, whole=True)
        if self.text_index:
            batch = self._indexed(batch, number, buckets)
        # Only keys and places are sorted and numbered.
        new = keys.repartition(buckets, *KEY).join(stored.select(*KEY), KEY, "left_anti")
        if waiting is not None:
            new = new.join(waiting.filter(touched).select(*KEY), KEY, "left_anti")
        numbered = with_row_index(new, [F.asc("first_at"), *[F.asc(k) for k in KEY]], "_number")
        numbers = numbered.select(*KEY, (F.col("_number") + F.lit(next_id)).alias("_id"))
        row = (number, next_id, numbers.count(), buckets, rule, load_no is None, self.text_index)
        reserved = self.spark.createDataFrame([row], LOADS)
        reserved.coalesce(1).write.mode("append").parquet(f"{self.path}/loads")
        with_ids = self._dealt(batch, buckets).join(numbers.repartition(buckets, *KEY), KEY, "left")
        with_ids = with_ids.withColumn("id", F.col("_id")).select(*STORED.fieldNames())
        if later:
            self._table(buckets, RECENT)
            with_ids.select("*", self._slot(buckets)).write.insertInto(self._catalog_name(RECENT))
        else:
            if waiting is None:
                merged = upsert(stored, with_ids, rule).select(*STORED.fieldNames(), self._slot(buckets))
            else:
                merged = self.merge(stored, with_ids.unionByName(waiting.drop("slot")), buckets, rule, repeats=True)
            self._replace(merged)
            self._drop_recent()
        # The new posts are those with the numbers of this load.
        added = partial_statistics(self._table(buckets, RECENT if later else "posts").filter(touched & (F.col("id") >= next_id)))
        added.write.mode("overwrite").parquet(f"{self.path}/statistics/load={number}")
        return number

    def _dealt(self, batch: DataFrame, buckets: int) -> DataFrame:
        """A collapsed batch dealt to the buckets; the collapse has done so when there are as many shuffle partitions."""
        collapsed = not self.text_index and buckets == int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return batch if collapsed else batch.repartition(buckets, *KEY)

    def _indexed(self, batch: DataFrame, number: int, buckets: int) -> DataFrame:
        """The batch, stored because its texts are read twice, after its trigrams are written."""
        path = scratch_path(self.spark, "batch")
        batch.write.parquet(path, compression=CODEC)
        stored = self.spark.read.schema(STORED).parquet(path)
        texts = stored.select("post_text", self._slot(buckets))
        trigrams_of(texts).write.mode("overwrite").parquet(f"{self.path}/trigrams/load={number}")
        return stored

    def merge(self, stored: DataFrame, batch: DataFrame, buckets: int, rule: str, repeats: bool = False) -> DataFrame:
        """Stored rows after a batch; the batch is dealt to the buckets, the stored side stays.

        ``repeats``: the batch may hold several rows of a key.
        """
        dealt = batch.repartition(buckets, *KEY)
        merged = upsert(stored, merge_all(dealt, rule) if repeats else dealt, rule)
        return merged.select(*STORED.fieldNames(), self._slot(buckets))

    def _replace(self, rows: DataFrame) -> None:
        """Overwrite the slots that occur in the rows, and no other."""
        before = self.spark.conf.get(_OVERWRITE_MODE, "static")
        self.spark.conf.set(_OVERWRITE_MODE, "dynamic")
        try:
            rows.write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(_OVERWRITE_MODE, before)

    def _drop_recent(self) -> None:
        """Remove the rows beside the buckets, which are merged by now."""
        path, fs = self._hadoop(RECENT)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(RECENT)}")
        fs.delete(path, True)

    def stored(self, slots: list[int] | None = None) -> DataFrame:
        """Current stored rows, of some slots or of all, partitioned by the key."""
        _, _, buckets, rule = self._state()
        return self._current(buckets, rule, slots)

    def _all_loads(self, flag: str) -> bool:
        """Whether there are loads and all have a flag."""
        return bool(self.loads().agg(F.coalesce(F.every(flag), F.lit(False))).first()[0])

    def slots_of(self, term: str) -> list[int] | None:
        """Slots that a search term can be in, as many as there are at most; None for all."""
        trigrams = literal_trigrams(self.spark, term)
        if not trigrams or not self._all_loads("indexed"):
            return None
        postings = self.spark.read.schema("trigram string, slot int").parquet(f"{self.path}/trigrams/load=*")
        return [r["slot"] for r in slots_with(postings, trigrams).collect()]

    def matching(self, term: str) -> DataFrame:
        """Posts whose text contains a term, as :func:`listing.matching` finds them, reading only the
        slots that its trigrams are in."""
        return listing.matching(as_posts(self.stored(self.slots_of(term))), term)

    def search(self, term: str, limit: int = 100) -> DataFrame:
        """Matching posts, most liked first."""
        return listing.top_posts_by_likes(self.matching(term), limit)

    def statistics(self) -> dict[str, DataFrame]:
        """:func:`analytics.stats` from the kept counts, without reading posts.

        After loads with an order of their own, or if the counts do not add up, from the posts.
        """
        if self._all_loads("in_order"):
            kept = self.spark.read.schema(STATISTICS).parquet(f"{self.path}/statistics/load=*")
            merged = merged_statistics(kept)
            total = merged.filter(F.col("section") == "total").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
            if total == self.stored().count():
                authors = merged.filter(F.col("section") == "by_author").select(F.col("name").alias("author"), "count")
                return {
                    "counts": merged.filter(F.col("section") != "by_author"),
                    "top_authors": analytics.top(authors, "count", 10, "author"),
                }
        return analytics.stats(self.posts())

    def posts(self, platform: str | None = None) -> DataFrame:
        """The ``posts`` relation; filters and columns reach the scan."""
        rows = as_posts(self.stored())
        return rows.filter(F.col("platform") == platform) if platform else rows


def partial_statistics(posts: DataFrame) -> DataFrame:
    """Counts and time span of posts, in all, per platform, per sentiment and per author."""
    known = (F.col("author") != analytics.DELETED) & F.col("author").isNotNull()
    authors = posts.filter(known).groupBy(F.col("author").alias("name")).agg(F.count(F.lit(1)).alias("count"))
    none = F.lit(None).cast("timestamp_ntz")
    by_author = authors.select(F.lit("by_author").alias("section"), "name", "count", none.alias("oldest"), none.alias("newest"))
    return analytics.stats_bundle(posts).unionByName(by_author)


def merged_statistics(parts: DataFrame) -> DataFrame:
    """Partial statistics of disjoint sets of posts added up."""
    return parts.groupBy("section", "name").agg(
        F.sum("count").alias("count"), F.min("oldest").alias("oldest"), F.max("newest").alias("newest")
    )


def load_with_validation(
    transformed: DataFrame, table: PostsTable, as_of: Column | None = None
) -> DataFrame:
    """Load the rows that validation accepts; returns every row with its status and error.

    The verdict is stored before the load, so it does not change with the table.
    """
    path = scratch_path(table.spark, "validated")
    validate_load(transformed, table.stored()).write.parquet(path, compression=CODEC)
    checked = table.spark.read.parquet(path)
    accepted = checked.filter(F.col("status") == "success").drop("status", "error")
    table.load(accepted, as_of=as_of)
    return checked
