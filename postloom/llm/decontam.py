"""Benchmark decontamination with SimHash windows, in DataFrame functions only.

Words are runs of letters and digits, lower-cased; shingles are runs of five words (an item
of fewer words is one shingle). A document is contaminated by an item if one of its windows
of the item's length reaches the similarity: the shared weight of their shingles over their
joint weight, a shingle weighing as often as it occurs.

1. One pass over the texts stores the places of all shingles of the benchmark. Each item's
   rarest shingles, counted over benchmark and documents, together more than 1 - similarity of
   its weight, go to an index. A window without any of them cannot reach the similarity, so
   the windows of the item's length around the places of those are looked at, and no other.
   Overlapping ones form a region of the text.
2. Windows and items get a 128-bit SimHash of their shingles, where the second, third, ...
   occurrence of a shingle is a feature of its own, so that the weighted similarity is the
   similarity of two sets. A region is swept once: a shingle enters the window and leaves it,
   and running sums of these events are the fingerprints of all its windows. Work and storage
   grow with the region's length and not with windows times words. The radius follows from
   the item's number of shingles and the similarity: of the pairs that just reach it, less
   than one in 10^9 is farther apart (at 0.8 from 47 to 53 bits, see ``radius_of``).
3. Multi-index blocks: a fingerprint is cut into more blocks than the radius has bits. Two
   fingerprints within the radius agree on one block at least, so joining on (item, block
   number, block value) misses none of them. The distance itself is tested next.
4. The exact weighted similarity decides, by a second sweep of the regions that are left.

The benchmark's tables are joined by their keys. Spark broadcasts them where their stored size
is below the session's threshold, and shuffles otherwise; nothing here forces a broadcast.

Cases: a NULL or empty text, of a document or an item, has no shingles and matches nothing;
equal texts are looked at once, under a digest of the text, and each of their rows gets the
result, rows without an id too; rows that repeat an id give one row per item, with the best
window of all their texts; repeated items are compared once for each of their distinct texts;
a very long text is cut into its regions, and no row grows beyond the text; empty tables give
empty results; only id and text columns are read.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.store import keep

SHINGLE = 5
PERCENT = 80
RADIUS = 31
HALVES = 2  # 64-bit halves of a fingerprint
MISSED = 1e-9  # share of the pairs at the similarity that may lie outside the radius
MANY = 200  # items of more shingles have the radius of so many, which hardly changes any more


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles_at(df: DataFrame, size: int, words: str = "words") -> DataFrame:
    """A row per run of ``size`` words: its place ``pos`` from 0 and its hash ``shingle``.

    The runs are zipped slices of the array, so the hash is computed in generated code.
    """
    n = F.size(words)
    slices = [F.slice(words, F.lit(i + 1), F.greatest(n - size + 1, F.lit(0))).alias(f"w{i}") for i in range(size)]
    zipped = F.arrays_zip(*slices)
    run = df.select("*", F.posexplode(zipped).alias("pos", "run"))
    parts = [F.col("run")[f"w{i}"] for i in range(size)]
    return run.select(*df.columns, "pos", F.xxhash64(*parts).alias("shingle"))


def _all_sizes(df: DataFrame, sizes: list[int], words: str = "words") -> DataFrame:
    """Shingles of rows whose column ``size`` names their shingle size."""
    parts = [shingles_at(df.filter(F.col("size") == s), s, words) for s in sizes]
    return reduce(DataFrame.unionByName, parts)


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct items with their words, their shingle size and a key of their own."""
    words = benchmark.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("words"))
    filled = words.filter(F.size("words") > 0).distinct()
    sized = filled.withColumns({"n_words": F.size("words"), "size": F.least(F.size("words"), F.lit(SHINGLE))})
    return keep(sized.withColumn("item", F.monotonically_increasing_id()), "items")


def text_key(text: Column) -> Column:
    """The digest that stands for a text; NULL counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def places_of(docs: DataFrame, of_items: DataFrame, sizes: list[int], text_col: str) -> DataFrame:
    """(doc, n, size, shingle, pos): where the benchmark's shingles stand in the distinct texts of n words."""
    texts = docs.select(text_key(F.col(text_col)).alias("doc"), words_of(F.col(text_col)).alias("words"))
    texts = texts.withColumn("n", F.size("words"))
    found = []
    for size in sizes:
        own = of_items.filter(F.col("size") == size).select("shingle").distinct()
        each = shingles_at(texts.filter(F.col("n") >= size), size).select("doc", "n", F.lit(size).alias("size"), "shingle", "pos")
        found.append(each.join(own, "shingle", "left_semi").select(*each.columns))
    return keep(reduce(DataFrame.unionByName, found).distinct(), "item-places")


def index_of(shingles: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """(shingle, item, n_words, size): the rarest shingles of each item.

    Rarity is the number of occurrences in the whole benchmark and in the distinct texts.
    """
    each = shingles.groupBy("item", "n_words", "size", "shingle").agg(F.count(F.lit(1)).alias("times"))
    both = each.select("size", "shingle", "times").unionByName(
        places.groupBy("size", "shingle").agg(F.count(F.lit(1)).alias("times"))
    )
    spread = both.groupBy("size", "shingle").agg(F.sum("times").alias("occurrences"))
    by_rarity = Window.partitionBy("item").orderBy("occurrences", "shingle")
    before = F.coalesce(F.sum("times").over(by_rarity.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.col("n_words") - F.col("size") + 1
    ranked = each.join(spread, ["size", "shingle"]).withColumn("before", before)
    chosen = ranked.filter(100 * F.col("before") <= (100 - percent) * whole)
    return keep(chosen.select("shingle", "item", "n_words", "size"), "item-index")


def regions_of(places: DataFrame, index: DataFrame) -> DataFrame:
    """(region, doc, item, size, n_words, n, low, high): runs of begins of windows that hold an indexed shingle.

    A window may begin before its text and end after it; it is cut off there.
    """
    hits = places.join(index, ["size", "shingle"]).withColumn("span", F.col("n_words") - F.col("size"))
    by_place = Window.partitionBy("doc", "item").orderBy("pos")
    apart = F.coalesce(F.col("pos") - F.col("span") > F.lag("pos").over(by_place) + 1, F.lit(True))
    run = F.sum("apart").over(by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = hits.withColumn("apart", apart.cast("int")).withColumn("run", run)
    merged = runs.groupBy("doc", "item", "run", "size", "n_words", "span", "n").agg(F.min("pos").alias("low"), F.max("pos").alias("high"))
    regions = merged.select(
        F.monotonically_increasing_id().alias("region"), "doc", "item", "size", "n_words", "n", (F.col("low") - F.col("span")).alias("low"), "high"
    )
    return keep(regions, "regions")


def events_of(docs: DataFrame, regions: DataFrame, sizes: list[int], text_col: str) -> DataFrame:
    """(region, item, begin, sign, shingle, nth): what enters (1) and leaves (-1) a region's window when it comes to ``begin``.

    ``nth`` tells how many of that shingle the window has with it.
    """
    own = F.struct("region", "item", "size", "n_words", "low", "high")
    wanted = regions.groupBy(F.col("doc").alias("d")).agg(F.collect_list(own).alias("regions"))
    texts = docs.select(text_key(F.col(text_col)).alias("doc"), F.col(text_col).alias("text"))
    texts = texts.join(wanted, F.col("doc") == F.col("d"), "left_semi").groupBy("doc").agg(F.min("text").alias("text"))
    texts = texts.join(wanted, F.col("doc") == F.col("d")).select(words_of(F.col("text")).alias("words"), "regions")
    first = F.greatest("low", F.lit(0))
    part = F.slice("words", first + 1, F.col("high") + F.col("n_words") - first)
    each = texts.select("words", F.explode("regions").alias("r")).select("r.*", "words")
    each = each.select("region", "item", "size", "n_words", "low", "high", first.alias("first"), part.alias("words"))
    placed = _all_sizes(each, sizes).withColumn("at", F.col("first") + F.col("pos"))
    enters = F.struct(F.greatest(F.col("at") - F.col("n_words") + F.col("size"), "low").alias("begin"), F.lit(1).alias("sign"))
    leaves = F.struct((F.col("at") + 1).alias("begin"), F.lit(-1).alias("sign"))
    moves = placed.select("region", "item", "shingle", "at", "high", F.explode(F.array(enters, leaves)).alias("move"))
    moves = moves.select("region", "item", "shingle", "at", "high", "move.*").filter(F.col("begin") <= F.col("high"))
    so_far = Window.partitionBy("region", "shingle").orderBy("begin", "sign", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nth = F.sum("sign").over(so_far) + F.when(F.col("sign") < 0, 1).otherwise(0)
    counted = moves.repartition("region").select("region", "item", "begin", "sign", "shingle", nth.alias("nth"))
    return keep(counted, "window-events")


def _at_each_begin(events: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Running sums over the events of each region, at the last event of each begin."""
    by_begin = Window.partitionBy("region").orderBy("begin")
    until = by_begin.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = F.lead("begin").over(by_begin)
    summed = events.select("region", "item", "begin", after.alias("after"), *[F.sum(c).over(until).alias(k) for k, c in sums.items()])
    return summed.filter(F.col("after").isNull() | (F.col("after") > F.col("begin"))).drop("after")


def _counts(shingles: DataFrame, *key: str) -> DataFrame:
    return shingles.groupBy(*key, "shingle").agg(F.count(F.lit(1)).alias("times"))


def occurrences(counts: DataFrame, *key: str) -> DataFrame:
    """Each key's counted shingles, where the n-th occurrence of a shingle is a shingle of its own."""
    each = counts.withColumn("n", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")))
    return each.select(*key, F.xxhash64("shingle", "n").alias("shingle"))


def _differ(shared: int, first: int, second: int) -> float:
    """Chance that a bit differs between sets of ``shared`` equal and ``first`` and ``second`` own shingles."""

    def at_least(n: int) -> list[float]:  # k or more of n shingles have the bit set
        return [sum(comb(n, j) for j in range(k, n + 1)) / 2**n for k in range(n + 2)]

    ones, others = at_least(first), at_least(second)
    chance = 0.0
    for k in range(shared + 1):
        p = ones[min(max((shared + first) // 2 + 1 - k, 0), first + 1)]
        q = others[min(max((shared + second) // 2 + 1 - k, 0), second + 1)]
        chance += comb(shared, k) / 2**shared * (p * (1 - q) + q * (1 - p))
    return chance


@lru_cache(maxsize=None)
def _radius(n: int, percent: int) -> int:
    worst = 0.0
    for window in range(1, n + 1):  # a window has at most as many shingles as its item
        shared = -(-percent * (n + window) // (100 + percent))
        if shared <= window:
            worst = max(worst, _differ(shared, n - shared, window - shared))
    bits = 64 * HALVES
    beyond, radius = 0.0, bits
    while radius > 0:
        beyond += comb(bits, radius) * worst**radius * (1 - worst) ** (bits - radius)
        if beyond > MISSED:
            break
        radius -= 1
    return radius


def radius_of(percent: int) -> list[int]:
    """Radius by the item's number of shingles, 0 to ``MANY``; the last holds for all larger ones.

    The radius is taken for the window that just reaches the similarity and is farthest from
    the item, and does not fall below that of ``MANY`` shingles, as it varies with parity.
    """
    large = max(_radius(n, percent) for n in range(MANY - 9, MANY + 1))
    return [max(_radius(n, percent), large) if n else 0 for n in range(MANY)] + [large]


def _lanes(feature: Column, sign: Column | int = 1) -> dict[str, Column]:
    """What a feature adds to the counts of the bits: a value counts two bits, in the halves of a long."""
    lanes = {}
    for half in range(HALVES):
        h = F.xxhash64(feature, F.lit(half))
        for k in range(32):
            lanes[f"s{half}_{k}"] = sign * F.shiftrightunsigned(h, k).bitwiseAND(F.lit(0x0000000100000001))
    return lanes


def _bits(half: int) -> Column:
    """A half of a fingerprint from the counts: the bits that more than half of ``total`` features have."""
    out = F.lit(0).cast("bigint")
    for k in range(32):
        low = F.col(f"s{half}_{k}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"s{half}_{k}"), 32)
        for count, bit in ((low, k), (high, k + 32)):
            mask = 1 << bit if bit < 63 else -(1 << 63)
            out = out.bitwiseOR(F.when(2 * count > F.col("total"), F.lit(mask).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


def fingerprints(shingles: DataFrame, *key: str) -> DataFrame:
    """SimHash of each key's shingles with their multiplicity: (key, total, f0, f1)."""
    lanes = [F.sum(c).alias(k) for k, c in _lanes(F.col("shingle")).items()]
    summed = shingles.groupBy(*key).agg(F.count(F.lit(1)).alias("total"), *lanes)
    return summed.select(*key, "total", *[_bits(h).alias(f"f{h}") for h in range(HALVES)])


def window_fingerprints(events: DataFrame) -> DataFrame:
    """(window, region, item, begin, total, f0, f1): the SimHash of every window of the regions."""
    sums = {"total": F.col("sign"), **_lanes(F.xxhash64("shingle", "nth"), F.col("sign"))}
    summed = _at_each_begin(events, sums).filter("total > 0")
    prints = summed.select("region", "item", "begin", "total", *[_bits(h).alias(f"f{h}") for h in range(HALVES)])
    return keep(prints.withColumn("window", F.monotonically_increasing_id()), "window-prints")


def blocks(prints: DataFrame, bits: int) -> DataFrame:
    """A row per block of ``bits`` bits of each fingerprint."""
    per_half = 64 // bits
    values = [
        F.shiftrightunsigned(F.col(f"f{h}"), b * bits).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
        for h in range(HALVES)
        for b in range(per_half)
    ]
    return prints.select("*", F.posexplode(F.array(*values)).alias("block", "value"))


def within_radius(windows: DataFrame, items: DataFrame, radius: int | list[int] = RADIUS) -> DataFrame:
    """Windows whose fingerprint is within the radius of their item's: (window, item).

    A list has the radius by the item's number of shingles, its last one that of all larger items.
    """
    radii = [radius] if isinstance(radius, int) else radius
    if max(radii) >= 64 * HALVES:
        return windows.select("window", "item").distinct()
    bits = next(b for b in (4, 2, 1) if 64 * HALVES // b > max(radii))
    theirs = blocks(items.toDF("item", "item_total", "i0", "i1").withColumnsRenamed({"i0": "f0", "i1": "f1"}), bits)
    allowed = F.get(F.array(*map(F.lit, radii)), F.least(F.col("item_total"), F.lit(len(radii) - 1)).cast("int"))
    theirs = theirs.withColumnsRenamed({"f0": "i0", "f1": "i1"}).withColumn("allowed", allowed).drop("item_total")
    met = blocks(windows, bits).join(theirs, ["item", "block", "value"])
    far = F.bit_count(F.col("f0").bitwiseXOR(F.col("i0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("i1")))
    return met.filter(far <= F.col("allowed")).select("window", "item").distinct()


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc, item_id, best, n_windows): distinct texts that hold an item; ``doc`` is the ``text_key``,
    ``best`` the similarity and the negative start of the best window."""
    items = items_of(benchmark, item_id, item_text)
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # 1 to 5
    sizes = sizes or [SHINGLE]
    of_items = keep(_all_sizes(items.drop("item_id"), sizes).drop("words"), "item-shingles")
    places = places_of(docs, of_items, sizes, text_col)
    regions = regions_of(places, index_of(of_items, places, percent))
    events = events_of(docs, regions, sizes, text_col)
    prints = window_fingerprints(events)
    item_counts = keep(_counts(of_items, "item"), "item-counts")
    item_prints = fingerprints(occurrences(item_counts, "item"), "item")
    near = within_radius(prints.select("window", "item", "total", "f0", "f1"), item_prints, radius_of(percent))
    near = keep(prints.join(near, ["window", "item"], "left_semi").select("region", "begin", "total"), "near-windows")
    theirs = item_counts.withColumnsRenamed({"item": "i", "shingle": "s", "times": "item_times"})
    left = events.join(near.select("region").distinct(), "region", "left_semi")
    left = left.join(theirs, (F.col("item") == F.col("i")) & (F.col("shingle") == F.col("s")), "left")
    common = F.when(F.col("nth") <= F.col("item_times"), F.col("sign")).otherwise(0)
    shared = _at_each_begin(left, {"shared": common}).select("region", "begin", "shared")
    item_total = F.col("n_words") - F.col("size") + 1
    compared = (
        shared.join(near, ["region", "begin"])
        .join(regions, "region")
        .withColumn("joint", F.col("total") + item_total - F.col("shared"))
        .filter(100 * F.col("shared") >= percent * F.col("joint"))
        .withColumns({"similarity": F.col("shared") / F.col("joint"), "start": F.greatest("begin", F.lit(0))})
    )
    best = F.struct(F.col("similarity"), (-F.col("start")).alias("back"))
    by_start = Window.partitionBy("doc", "item_id").orderBy("start")
    apart = 2 * (F.col("start") - F.lag("start").over(by_start)) > F.col("n_words")
    found = (
        compared.join(items.select("item", "item_id"), "item")
        .withColumn("place", F.coalesce(apart, F.lit(True)).cast("int"))
        .groupBy("doc", "item_id")
        .agg(F.max(best).alias("best"), F.sum("place").alias("n_windows"))
    )
    return keep(found, "contaminated")


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, similarity, start, n_windows): documents that hold an item, best window first.

    ``start`` is the first word of the best window, the smallest of equally good ones;
    ``n_windows`` counts the places with windows that reach the similarity: windows that
    begin at most half an item's length after one another are at one place.
    """
    found = contaminated_texts(docs, benchmark, percent, text_col, item_id, item_text)
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("doc"))
    return (
        rows.join(found, "doc")
        .distinct()
        .groupBy("id", "item_id")
        .agg(F.max("best").alias("best"), F.sum("n_windows").alias("n_windows"))
        .select(F.col("id").alias(id_col), "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start"), "n_windows")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose text holds no passage of the benchmark, with all their columns; ids decide nothing."""
    gone = contaminated_texts(docs, benchmark, percent, text_col).select(F.col("doc").alias("__gone")).distinct()
    return docs.join(gone, text_key(F.col(text_col)) == F.col("__gone"), "left_anti")
