"""Near-duplicates: banded MinHash candidates, sequential Bayesian verification, exact check.

1. Documents with equal shingle sets form a class; only its smallest id goes on. Copies
   are counted together before any shuffle.
2. A class has ``bands * rows`` MinHash values. Classes that agree on a whole band share a
   bucket. At similarity 0.85 (0.8) a pair shares none of 32 buckets of 5 values with a
   probability of 7e-9 (3e-6).
3. Signatures of a candidate pair are compared a batch at a time. With a uniform prior, the
   chance that the similarity reaches the threshold after m of n values agree is
   P(Binomial(n + 1, threshold) <= m); a pair is dropped as soon as it falls below ``miss``.
4. Survivors are verified on their full shingle sets.
5. Links between classes are joined to components.

All pairs of a bucket are never made. A first pass links each bucket's members to its
smallest member. For the members of buckets that still hold several components, the sets are
counted shingle by shingle, and a second pass links each bucket's members to its most typical
one, with the smallest share of shingles that nobody else has. At the end, pairs of
*different* components are verified in two ways that together miss none that shares a bucket:

* pairs that share a shingle of at most RARE sets, found by an index of each set's rarest
  shingles (of two sets that reach the threshold, the rarest common shingle is among the
  first ``size - ceil(threshold * size) + 1`` of both);
* pairs of a bucket that share only more frequent shingles, if they have enough of those:
  ``common`` bounds their intersection (see ``_between``).

Pairs inside a component need no test, as they cannot change the result.

Cases: a NULL or empty text and one without words has no shingles and is a class of its own;
fewer words than a shingle form one shingle; very long texts are hashed a piece at a time, and
only their sets of 8 bytes a shingle are held; an empty table gives no rows; only the id and
text columns are read. In ``near_duplicates`` rows that repeat an id and the text are one document;
if their texts differ, the id stands for the first class that it is the smallest id of. A row with
a NULL id takes no part, is its own group and is kept. ``drop_duplicates`` decides by row.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.components import components
from postloom.llm.store import keep
from postloom.llm.textops import SPACED, mix, shingle_set, words

# A shingle of so many sets is looked up by itself; it bounds the pairs one shingle makes.
RARE = 16


@dataclass(frozen=True)
class Settings:
    """Link if 100 * intersection >= percent * union of sets of ``shingle``-word runs."""

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    batch: int = 32
    miss: float = 1e-6


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(1, n + 1, dtype=np.uint64)
    return mix(at) | np.uint64(1), mix(at + np.uint64(1 << 32))


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """n MinHash values of 32 bits of a set that is not empty; memory does not grow with the set."""
    a, b = _coefficients(n)
    low = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        values = shingles[None, at : at + 1024] * a[:, None]
        values += b[:, None]
        np.minimum(low, values.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def fewest_matches(n: int, threshold: float, miss: float) -> int:
    """Smallest m of n agreeing values at which the threshold is still likelier than ``miss``."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def class_of(shingles: np.ndarray) -> bytes:
    """128-bit hash of a sorted set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, settings: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, class, signature): the class is a 128-bit hash of the sorted set."""
    n = settings.bands * settings.rows

    def run(batches):
        for batch in batches:
            for group in words(batch.column(1), SPACED):
                out = []
                for i in range(len(group)):
                    s = shingle_set(group.hashes[group.bounds[i] : group.bounds[i + 1]], settings.shingle)
                    if len(s):
                        out.append((len(s), class_of(s), signature(s, n).tobytes()))
                    else:
                        out.append((0, None, None))
                ids = batch.column(0).slice(group.first, len(group))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([ids, *columns], ["id", "n_shingles", "class", "signature"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, n_shingles bigint, class binary, signature binary"
    )


def shingle_sets(docs: DataFrame, ids: DataFrame, classes: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """(id, set) of the given ids: sorted distinct shingles as bytes, stored.

    Of rows that repeat an id, the set that the id stands for in ``classes``.
    """

    def run(batches):
        for batch in batches:
            for group in words(batch.column(1), SPACED):
                sets = [
                    shingle_set(group.hashes[group.bounds[i] : group.bounds[i + 1]], settings.shingle)
                    for i in range(len(group))
                ]
                part = batch.column(0).slice(group.first, len(group))
                columns = [pa.array(c, pa.binary()) for c in ([class_of(s) for s in sets], [s.tobytes() for s in sets])]
                yield pa.RecordBatch.from_arrays([part, *columns], ["id", "class", "set"])

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = keep(ids.distinct(), "wanted")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, "id", "left_semi")
    found = texts.mapInArrow(run, f"id {kind}, class binary, set binary").dropDuplicates(["id", "class"])
    return keep(found.join(classes.select("id", "class"), ["id", "class"]).select("id", "set"), "sets")


def set_shingles(sets: DataFrame) -> DataFrame:
    """(id, shingle): a row for each shingle of each set, stored."""
    kind = sets.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shingles = np.frombuffer(batch.column(1)[i].as_buffer(), dtype=np.int64)
                part = pa.array([batch.column(0)[i].as_py()] * len(shingles), batch.column(0).type)
                yield pa.RecordBatch.from_arrays([part, pa.array(shingles)], ["id", "shingle"])

    return keep(sets.mapInArrow(run, f"id {kind}, shingle bigint"), "set-shingles")


def rare_shingles(each: DataFrame) -> DataFrame:
    """(id, shingle, sets): the shingles that at most RARE sets have."""
    counted = each.groupBy(F.col("shingle").alias("s")).agg(F.count(F.lit(1)).alias("sets")).filter(F.col("sets") <= RARE)
    rare = each.join(keep(counted, "rare-shingles"), F.col("shingle") == F.col("s"))
    return keep(rare.select("id", "shingle", "sets"), "rare")


def with_sizes(members: DataFrame, sets: DataFrame, rare: DataFrame) -> DataFrame:
    """Members with the size of their set, how many of its shingles another set has
    (``shared``), and how many more than RARE sets have (``common``)."""
    size = (F.octet_length("set") / 8).cast("bigint")
    counts = rare.groupBy(F.col("id").alias("i")).agg(F.count_if(F.col("sets") == 1).alias("alone"), F.count(F.lit(1)).alias("rare"))
    none = F.lit(0).cast("bigint")
    sized = sets.select("id", size.alias("size")).join(counts, F.col("id") == F.col("i"), "left")
    sized = sized.select(
        "id", "size", (F.col("size") - F.coalesce("alone", none)).alias("shared"), (F.col("size") - F.coalesce("rare", none)).alias("common")
    )
    return keep(members.join(keep(sized, "set-sizes"), "id"), "open-sizes")


def _enough(most: Column, settings: Settings) -> Column:
    """Whether an intersection of at most ``most`` can reach the threshold: it needs
    percent / (100 + percent) of the sum of the sizes."""
    return (100 + settings.percent) * most >= settings.percent * (F.col("size") + F.col("size2"))


def bands_of(settings: Settings) -> Column:
    """The bucket of a signature in each band."""
    width = 4 * settings.rows
    return F.array(*[F.xxhash64(F.lit(i), F.substring("signature", 1 + i * width, width)) for i in range(settings.bands)])


def buckets(classes: DataFrame, settings: Settings) -> DataFrame:
    """(id, bucket): a row for each band of each class."""
    return classes.select("id", F.explode(bands_of(settings)).alias("bucket"))


def likely(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) that sequential Bayesian verification on signatures does not rule out."""
    n = settings.bands * settings.rows
    steps = [*range(settings.batch, n, settings.batch), n]
    needed = [fewest_matches(k, settings.percent / 100, settings.miss) for k in steps]
    signed = classes.select("id", "signature")
    both = pairs.join(signed.toDF("a", "sa"), "a").join(signed.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint32).reshape(-1, n) for i in (2, 3)
            )
            alive, matches, at = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64), 0
            for step, least in zip(steps, needed):
                matches[alive] += (left[alive, at:step] == right[alive, at:step]).sum(axis=1)
                alive, at = alive[matches[alive] >= least], step
            kept = batch.take(pa.array(alive))
            yield pa.RecordBatch.from_arrays(kept.columns[:2], ["a", "b"])

    kind = classes.schema["id"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def verified(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold, with ``intersection`` and ``union_size``."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b")

    def run(batches):
        for batch in batches:
            shared, joined = [], []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in (2, 3))
                same = len(np.intersect1d(x, y, assume_unique=True))
                shared.append(same)
                joined.append(len(x) + len(y) - same)
            inter, union = np.array(shared, dtype=np.int64), np.array(joined, dtype=np.int64)
            link = 100 * inter >= settings.percent * union
            columns = [*batch.columns[:2], pa.array(inter), pa.array(union)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "intersection", "union_size"]).filter(pa.array(link))

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}, intersection bigint, union_size bigint")


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component, kept) of every row; kept: the smallest id of its component."""
    sketched = keep(sketches(docs, settings, id_col, text_col), "sketches")
    filled = sketched.filter("class IS NOT NULL AND id IS NOT NULL")
    by_class = keep(filled.groupBy("class").agg(F.min("id").alias("first")), "classes")
    # One row per id: an id that is the smallest of several classes, as its texts differ, stands for the first of them.
    classes = keep(
        filled.join(by_class.withColumnRenamed("class", "c"), (F.col("class") == F.col("c")) & (F.col("id") == F.col("first")))
        .groupBy("id")
        .agg(F.min("class").alias("class"), F.min_by("signature", "class").alias("signature")),
        "signatures",
    )
    rows = buckets(classes, settings)
    crowded = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = keep(rows.join(crowded.withColumnRenamed("bucket", "k"), F.col("bucket") == F.col("k")).select("bucket", "id"), "buckets")

    def confirm(pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        maybe = keep(likely(ordered, classes, settings), "likely")
        if sets is None:
            both = maybe.select(F.col("a").alias("id")).unionByName(maybe.select(F.col("b").alias("id")))
            sets = shingle_sets(docs, both, classes, settings, id_col, text_col)
        return keep(verified(maybe, sets, settings).select("a", "b"), "links")

    links = confirm(_stars(members.withColumn("component", F.col("id")), F.col("id")))
    reached = components(links)
    open_members = keep(_mixed(_labelled(members, reached)), "open-buckets")
    if open_members.limit(1).count():
        sets = shingle_sets(docs, open_members.select("id"), classes, settings, id_col, text_col)
        rare = rare_shingles(set_shingles(sets))
        sized = with_sizes(open_members, sets, rare)
        typical = F.struct((F.col("size") - F.col("shared")) / F.col("size"), F.col("id"))
        links = links.unionByName(confirm(_stars(sized, typical, settings), sets))
        reached = components(links)
        still = keep(_mixed(_labelled(sized, reached)), "open-buckets")
        pairs = _between(still, classes, settings).unionByName(_rarely_shared(still, rare, settings))
        links = links.unionByName(confirm(pairs, sets))
        reached = components(links)
    final = keep(
        by_class.join(reached, F.col("first") == F.col("id"), "left").select(
            F.col("class").alias("c"), F.coalesce("component", "first").alias("component")
        ),
        "class-components",
    )
    joined = sketched.drop("signature").join(final, F.col("class") == F.col("c"), "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "id"))
    return joined.select(
        "id", "n_shingles", component.alias("component"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def _labelled(members: DataFrame, reached: DataFrame) -> DataFrame:
    """Members with the component they are in; one that has no link is its own."""
    named = reached.select(F.col("id").alias("i"), F.col("component").alias("c"))
    joined = members.join(named, F.col("id") == F.col("i"), "left")
    return joined.select(*[c for c in members.columns if c != "component"], F.coalesce("c", "id").alias("component"))


def _mixed(labelled: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components."""
    several = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low != high")
        .select(F.col("bucket").alias("k"))
    )
    return labelled.join(several, F.col("bucket") == F.col("k"), "left_semi")


def _stars(labelled: DataFrame, order: Column, settings: Settings | None = None) -> DataFrame:
    """Each member of a bucket with the bucket's first member by an order, if they are in
    different components; with settings also only if their sizes allow a link."""
    own = [c for c in ("id", "component", "size", "shared") if c in labelled.columns]
    centres = keep(
        labelled.groupBy(F.col("bucket").alias("k")).agg(F.min_by(F.struct(*own), order).alias("centre")).select(
            "k", *[F.col(f"centre.{c}").alias(f"{c}2") for c in own]
        ),
        "centres",
    )
    wanted = (F.col("bucket") == F.col("k")) & (F.col("component") != F.col("component2"))
    if settings:
        wanted = wanted & _enough(F.least("shared", "shared2"), settings)
    return labelled.join(centres, wanted).select(F.col("id").alias("a"), F.col("id2").alias("b"))


def _between(sized: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of a bucket in different components that can reach the threshold by frequent
    shingles alone; each pair once, in the first bucket that both are in."""
    able = sized.filter((100 + settings.percent) * F.col("common") >= settings.percent * (F.col("size") + F.col("common")))
    able = keep(able.join(classes.select("id", bands_of(settings).alias("bands")), "id"), "able")
    other = able.select(F.col("bucket").alias("k"), *[F.col(c).alias(f"{c}2") for c in ("id", "component", "size", "common", "bands")])
    wanted = (F.col("bucket") == F.col("k")) & (F.col("component") < F.col("component2"))
    wanted = wanted & _enough(F.least("common", "common2"), settings)
    shared = F.filter(F.zip_with("bands", "bands2", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())
    wanted = wanted & (F.get(shared, F.lit(0)) == F.col("bucket"))
    return able.join(other, wanted).select(F.col("id").alias("a"), F.col("id2").alias("b"))


def _rarely_shared(sized: DataFrame, rare: DataFrame, settings: Settings) -> DataFrame:
    """Pairs in different components that share one of the rarest shingles of both.

    A shingle is shared by at most RARE sets, so a set meets at most RARE others by it.
    """
    one = sized.select("id", "component", "size", "shared").dropDuplicates(["id"])
    place = F.row_number().over(Window.partitionBy("id").orderBy("sets", "shingle"))
    first = F.col("size") - F.ceil(settings.percent * F.col("size") / 100) + 1
    ranked = rare.withColumn("place", place).join(one, "id").filter((F.col("place") <= first) & (F.col("sets") > 1))
    index = keep(ranked.select("shingle", "id", "component", "size", "shared"), "rare-index")
    other = index.toDF("s", "id2", "component2", "size2", "shared2")
    wanted = (F.col("shingle") == F.col("s")) & (F.col("component") < F.col("component2"))
    wanted = wanted & _enough(F.least("shared", "shared2"), settings)
    return index.join(other, wanted).select(F.col("id").alias("a"), F.col("id2").alias("b"))


def drop_duplicates(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, with all its columns: that with the smallest id, a NULL id last.

    Groups are of rows, under a number that is stored with them, so repeated rows, rows without
    an id and rows that share an id but not the text are told apart. Rows without words all stay.
    """
    row = "__row"
    while row in docs.columns:
        row += "_"
    stored = keep(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(stored, settings, row, text_col).select("id", "component")
    own = stored.select(F.col(row).alias("r"), F.col(id_col).alias("own"))
    order = F.struct(F.col("own").isNull().alias("none"), "own", "r")
    first = found.join(own, F.col("id") == F.col("r")).groupBy("component").agg(F.min(order).alias("first"))
    kept = keep(first.select(F.col("first.r").alias("__kept")), "kept-rows")
    return stored.join(kept, F.col(row) == F.col("__kept"), "left_semi").drop(row)
