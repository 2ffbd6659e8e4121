"""Sharding by a k-d tree over document metadata, in DataFrame functions only.

Dimensions: the logarithms of the size in bytes and of each measure (n_chars), and language and
source in the order of how often they occur. A node is split at the weighted median of its
widest dimension, sizes being the weights, until the tree has as many leaves as the target
bytes ask for. A width is the share of the dimension's span over all rows, so dimensions of
different units compare. Ties are ordered by a hash of the row, which is no dimension: a language
or source that holds a third of all rows is split inside, but never for its hash's sake.

Medians are found for all nodes of a level together: each round counts bytes in bins of a
node's open interval and goes on inside the bin that holds the median, until that bin holds
less than TOLERANCE of the node or a single value. The driver sees only these counts, about
COUNTS a round whatever the number of rows and nodes. A row finds its node by looking up
arrays with a dimension and a cut per node, so expressions do not grow with the tree. Texts
are read once; later rounds read the metadata.

Cases: a NULL text has size 1 and the checksum of no bytes; NULL languages and sources are a
value of their own; a NULL or negative measure counts as 0; repeated rows are ordered by their place in the stored metadata; an empty
table gives no rows; one row or one very long text cannot be split, so shards may be empty;
a missing dimension column raises, other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from postloom.llm.store import keep

COUNTS = 1 << 14
FEWEST_BINS = 8
TOLERANCE = 0.0005
KEY_BITS = 62
HIGH = 1 << KEY_BITS


@dataclass(frozen=True)
class Level:
    """Per node of a level: rows whose key of ``dimension`` is below ``cut`` go left.

    ``whole`` has the spans of the dimensions over all rows.
    """

    dimension: list[int]
    cut: list[int]
    whole: list[int]


def _log(number: Column) -> Column:
    """Logarithm of a number from 1 on, as 31 bits."""
    return F.floor(F.log2(number) * ((1 << 31) / 48.0)).cast("bigint")


def _by_frequency(count: Column, value: Column) -> Column:
    """How often a value occurs, as 20 bits of its logarithm, then 11 bits that keep values apart."""
    often = F.floor(F.log2(count) * ((1 << 20) / 48.0)).cast("bigint")
    return F.shiftleft(often, 11) + F.shiftrightunsigned(value, 53)


def metadata(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    by: tuple[str, ...] = ("lang", "source"),
    measures: tuple[str, ...] = ("n_chars",),
) -> DataFrame:
    """(id, size, text_crc32, part, row, d0, d1, ...): 31-bit dimensions, stored once without texts."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    size = (F.octet_length(text) + 1).cast("bigint")
    known = [_log(F.greatest(F.coalesce(F.col(m).cast("bigint"), F.lit(0)), F.lit(0)) + 1) for m in measures]
    numbers = [d.alias(f"d{i}") for i, d in enumerate([_log(size), *known])]
    values = [F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("\0"))).alias(f"v{i}") for i, c in enumerate(by)]
    read = keep(
        docs.select(
            F.col(id_col).alias("id"), size.alias("size"), F.crc32(text).alias("text_crc32"),
            F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), *numbers, *values,
        ),
        "kd-read",
    )
    meta = read
    for i in range(len(by)):
        # A row per value; where those are too many to broadcast, adaptive execution splits a hot value.
        counts = read.groupBy(f"v{i}").agg(F.count(F.lit(1)).alias(f"n{i}"))
        meta = meta.join(counts, f"v{i}")
    ranked = [_by_frequency(F.col(f"n{i}"), F.col(f"v{i}")).alias(f"d{len(numbers) + i}") for i in range(len(by))]
    plain = ["id", "size", "text_crc32", "part", "row", *[f"d{i}" for i in range(len(numbers))]]
    return keep(meta.select(*plain, *ranked), "kd-metadata")


def _key(dimension: int) -> Column:
    """Order along a dimension: its 31 bits, then 31 bits of a hash of the row."""
    tie = F.shiftrightunsigned(F.xxhash64("id", "row"), 33)
    return F.shiftleft(F.col(f"d{dimension}"), 31) + tie


def _at(values: list[int], place: Column) -> Column:
    return F.get(F.lit(values).cast("array<bigint>"), place)


def _keys(dimensions: int, chosen: Column) -> Column:
    return F.get(F.array(*[_key(i) for i in range(dimensions)]), chosen.cast("int"))


def _placed(meta: DataFrame, levels: list[Level], dimensions: int) -> DataFrame:
    """The metadata with the node of each row, one projection per level."""
    placed = meta.withColumn("node", F.lit(0))
    for level in levels:
        turn = _keys(dimensions, _at(level.dimension, F.col("node"))) >= _at(level.cut, F.col("node"))
        placed = placed.withColumn("node", 2 * F.col("node") + turn.cast("int"))
    return placed


def _spans(nodes: DataFrame, dimensions: int) -> list[Row]:
    """Bytes and the span of each dimension per node; a level has at most as many nodes as shards."""
    spans = [(F.max(f"d{i}") - F.min(f"d{i}")).alias(f"s{i}") for i in range(dimensions)]
    return nodes.groupBy("node").agg(F.sum("size").alias("bytes"), *spans).collect()


def _widest(row: Row, whole: list[int]) -> int:
    """The dimension whose span is the largest share of its span over all rows; the first of equals."""
    return max(range(len(whole)), key=lambda i: (row[f"s{i}"] / max(1, whole[i]), -i))


def _level(nodes: DataFrame, count: int, dimensions: int, whole: list[int] | None = None) -> Level:
    """The widest dimension of each of ``count`` nodes and the cut that halves its bytes, as nearly as rows allow.

    ``whole`` has the spans over all rows; the first level, whose only node is the root, has none.
    """
    rows = _spans(nodes, dimensions)
    spans = whole or [rows[0][f"s{i}"] if rows else 0 for i in range(dimensions)]
    widest = {r["node"]: (_widest(r, spans), r["bytes"]) for r in rows}
    chosen = [widest[n][0] if n in widest else 0 for n in range(count)]
    cuts = [HIGH] * count
    keyed = nodes.select("node", _keys(dimensions, _at(chosen, F.col("node"))).alias("key"), "size")
    bounds = {node: (0, HIGH, 0) for node in widest}  # interval of the cut, bytes below it
    while bounds:
        bins = max(FEWEST_BINS, COUNTS // len(bounds))
        steps = {node: max(1, -(-(b - a) // bins)) for node, (a, b, _) in bounds.items()}
        lows = [bounds[n][0] if n in bounds else HIGH for n in range(count)]
        widths = [steps.get(n, 1) for n in range(count)]
        inside = keyed.withColumns({"low": _at(lows, F.col("node")), "width": _at(widths, F.col("node"))}).filter("key >= low")
        binned = inside.select("node", F.expr("(key - low) div width").alias("bin"), "size").filter(F.col("bin") < bins)
        counts: dict[int, dict[int, int]] = {node: {} for node in bounds}
        for r in binned.groupBy("node", "bin").agg(F.sum("size").alias("bytes")).collect():
            counts[r["node"]][r["bin"]] = r["bytes"]
        for node in list(bounds):
            a, b, below = bounds[node]
            step, goal = steps[node], widest[node][1] / 2
            for at in sorted(counts[node]):
                held = counts[node][at]
                if below + held >= goal:
                    break
                below += held
            start = a + at * step
            if step == 1 or held <= TOLERANCE * widest[node][1]:
                cuts[node] = start if goal - below <= below + held - goal else start + step
                del bounds[node]
            else:
                bounds[node] = (start, min(b, start + step), below)
    return Level(chosen, cuts, spans)


def tree(meta: DataFrame, shards: int, dimensions: int) -> list[Level]:
    """Splits per level for a power of two of leaves of equal bytes."""
    levels: list[Level] = []
    while 1 << len(levels) < shards:
        whole = levels[0].whole if levels else None
        levels.append(_level(_placed(meta, levels, dimensions), 1 << len(levels), dimensions, whole))
    return levels


def leaves_for(meta: DataFrame, target_bytes: int) -> int:
    """The power of two of leaves that brings a leaf to at most about the target bytes."""
    total = meta.agg(F.sum("size")).first()[0] or 0
    leaves = 1
    while leaves * target_bytes < total:
        leaves *= 2
    return leaves


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source"), measures: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row; give shards or target bytes.

    The law is ``bytes``. Slots number a shard's rows from 0: a count per input partition
    gives each its first slot, so no task sees a whole shard.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    meta = metadata(docs, id_col, text_col, by, measures)
    leaves = shards or leaves_for(meta, target_bytes)
    if leaves & (leaves - 1):
        raise ValueError("the number of shards must be a power of two")
    dimensions = 1 + len(measures) + len(by)
    placed = _placed(meta, tree(meta, leaves, dimensions), dimensions)
    placed = placed.select("id", "size", "text_crc32", "part", "row", F.col("node").alias("shard"))
    per_part = keep(placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows")), "kd-parts")
    # A row per shard and input partition, which is far fewer than documents.
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_part.select(
        F.col("shard").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first")
    )
    own = Window.partitionBy("shard", "part").orderBy("row")
    numbered = placed.withColumn("place", F.row_number().over(own) - 1)
    joined = numbered.join(firsts, (F.col("shard") == F.col("s")) & (F.col("part") == F.col("p")))
    return joined.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("first") + F.col("place")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
