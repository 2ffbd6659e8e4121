"""Exact top-k inner products by Fagin's threshold algorithm, block by block.

Vectors are dealt into blocks of a bounded number of rows, queries into groups of a bounded
number. A task holds one block and one query group. It sorts the block along each dimension
once; for each query it reads the lists from the end that the sign of the query's component
asks for, scores every vector it meets for the first time, and stops when the sum of the
components at the depth reached, times the query, cannot beat the k-th score found. Depth
doubles per step, so a step is one matrix product. The k best of every block are merged by a
window with a limit, which Spark applies before the shuffle.

Components are integers and scores are exact in 64 bits (see ``quantised``).

Cases: a vector that is NULL, empty, or holds a NULL or non-finite component takes no part,
neither as query nor as candidate; a vector is compared with those of its own length only; a
row whose id equals the query's is not a candidate; repeated rows of another id are
candidates each, and repeated query rows count once; a NULL id is no query and no candidate;
ties go to the smaller id; fewer than k candidates give all; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.store import keep

BLOCK_ROWS = 16_384
QUERY_ROWS = 2_048
FIRST_DEPTH = 64
# Sums of products up to here are exact in a double, and a matrix product is fast there.
EXACT = 2**53


def quantised(vector: str, scale: int = 1024) -> Column:
    """Components as floor(scale * x), x as a double."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))


def whole(vector: str) -> Column:
    """True for a vector that has components, all of them finite."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def threshold_top_k(ids: np.ndarray, values: np.ndarray, query_id: int, query: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) of one block for one query.

    ``order[:, d]`` sorts the block by dimension d, ascending.
    """
    n, d = values.shape
    rising = query > 0
    used = np.flatnonzero(query)
    seen = ids == query_id
    best_ids, best = np.empty(0, np.int64), np.empty(0, values.dtype)
    at, depth = 0, min(FIRST_DEPTH, n)
    if not len(used):  # every score is 0: the smallest ids win
        rest = np.sort(ids[~seen])[:k]
        return rest, np.zeros(len(rest), values.dtype)
    while True:
        from_top = order[n - depth : n - at, used[rising[used]]]
        from_bottom = order[at:depth, used[~rising[used]]]
        new = np.zeros(n, dtype=bool)
        new[from_top.ravel()] = True
        new[from_bottom.ravel()] = True
        new &= ~seen
        seen |= new
        rows = np.flatnonzero(new)
        best = np.concatenate([best, values[rows] @ query])
        best_ids = np.concatenate([best_ids, ids[rows]])
        top = np.lexsort((best_ids, -best))[:k]
        best, best_ids = best[top], best_ids[top]
        if depth == n:
            return best_ids, best
        edge = np.where(rising, values[order[n - depth, np.arange(d)], np.arange(d)], values[order[depth - 1, np.arange(d)], np.arange(d)])
        # A vector not met yet scores at most this; an equal score could have a smaller id.
        if len(best) == k and edge @ query < best[-1]:
            return best_ids, best
        at, depth = depth, min(2 * depth, n)


def _matrix(column: pd.Series) -> np.ndarray:
    """Rows as doubles where all sums of products are exact in them, else as Python integers' 64 bits."""
    m = np.array(column.tolist(), dtype=np.int64)
    most = int(np.abs(m).max(initial=0))
    return m.astype(np.float64) if most * most * m.shape[1] < EXACT else m


def _search(k: int):
    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(block):
            ids, values = block["id"].to_numpy(), _matrix(block["v"])
            wanted = _matrix(queries["v"])
            if wanted.dtype != values.dtype or int(np.abs(wanted).max()) * int(np.abs(values).max()) * values.shape[1] >= EXACT:
                wanted, values = wanted.astype(np.int64), values.astype(np.int64)
            order = np.argsort(values, axis=0, kind="stable").astype(np.int32)
            for qid, q in zip(queries["id"].to_numpy(), wanted):
                found, scores = threshold_top_k(ids, values, qid, q, order, k)
                out["query_id"].append(np.full(len(found), qid))
                out["vec_id"].append(found)
                out["score"].append(scores.astype(np.int64))
        return pd.DataFrame({c: np.concatenate(v) if v else np.empty(0, np.int64) for c, v in out.items()})

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", scale: int = 1024, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that the condition ``queries`` selects."""
    usable = vectors.filter(whole(vector) & F.col(id_col).isNotNull())
    dealt = F.xxhash64(F.col(id_col), F.monotonically_increasing_id())
    stored = keep(
        usable.select(F.col(id_col).cast("bigint").alias("id"), quantised(vector, scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"), dealt.alias("dealt")),
        "vectors",
    ).withColumn("dim", F.size("v"))
    asked = keep(stored.filter("asks").select("id", "v", "dim").dropDuplicates(["id"]), "queries")
    blocks = max(1, -(-stored.count() // block_rows))
    groups = max(1, -(-asked.count() // query_rows))
    # Every block meets every query group; each side is copied once per part of the other.
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups))).withColumn("b", number(blocks))
    right = stored.withColumn("b", F.pmod(F.col("dealt"), F.lit(blocks))).withColumn("g", number(groups))
    keys = ["dim", "b", "g"]
    found = (
        left.select("dim", F.col("b").cast("bigint").alias("b"), "g", "id", "v")
        .groupBy(*keys)
        .cogroup(right.select("dim", "b", F.col("g").cast("bigint").alias("g"), "id", "v").groupBy(*keys))
        .applyInPandas(_search(k), "query_id bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
