"""Quality: regularised quadratic discriminant over transformed document statistics.

Each class gets a mean and a covariance of the statistics below, both aggregated over all
labelled documents by Spark. A covariance is shrunk towards the pooled one and towards its
own diagonal; its Cholesky factor is computed once and broadcast. The score of a text is the
logistic of the difference of log densities (Mahalanobis distance and determinant).

Cases: a NULL or empty text has the statistics of no words and is scored like any other;
labels that are NULL, not 0 or 1, or differ between rows of one id are not learned from; if
a class has no labelled document the score is 0.5 (keep); repeated rows give repeated
results; a NULL id is passed through; only the id and text columns are read, so other
columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from postloom.llm.labelled import labels_of
from postloom.llm.store import keep
from postloom.llm.textops import SPACED, Words, grams, not_bytes, words

THRESHOLD = 0.5
# Pseudo-counts of the rates, so that a few words do not make an extreme rate.
PRIOR = 4.0
LINES = not_bytes(b"\n\r")


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=np.float64)
    table[list(chars)] = 1
    return table


BYTE_CLASSES = {
    "upper": _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digit": _class(b"0123456789"),
    "shout": _class(b"!?"),
    "stop": _class(b".,;:"),
    "symbol": _class(b"|#<>{}[]()=*_/\\~^+@$%&\"`"),
    "line": _class(b"\n"),
}
FEATURES = ["words", "length", *BYTE_CLASSES, "distinct", "twice", "repeated", "top", "same_lines"]


def _ratio(part: np.ndarray | float, whole: np.ndarray | float, usual: float) -> np.ndarray:
    """Log of a rate that is drawn to its usual value when there is little text."""
    return np.log((part + PRIOR * usual) / (whole + PRIOR))


def statistics(group: Words) -> np.ndarray:
    """One row of statistics per text of a group."""
    n = np.diff(group.bounds).astype(np.float64)
    size = np.diff(group.offsets).astype(np.float64)
    sums = np.concatenate([[0], np.cumsum(group.lengths)])[group.bounds]
    out = [np.log1p(n), _ratio(np.diff(sums), n, 5.0)]
    counts = np.zeros((len(BYTE_CLASSES), len(group)))
    filled = size > 0
    if filled.any():
        starts = group.offsets[:-1][filled]
        for i, table in enumerate(BYTE_CLASSES.values()):
            # Adds up a long text in pieces, as its bytes may be many.
            counts[i, filled] = np.add.reduceat(table.astype(np.int32)[group.data], starts)
    usual = {"upper": 0.3, "digit": 0.02, "shout": 0.02, "stop": 0.2, "symbol": 0.02, "line": 0.03}
    for i, name in enumerate(BYTE_CLASSES):
        out.append(_ratio(counts[i], n, usual[name]))
    rows = np.zeros((5, len(group)))
    line_starts = group.data == 10
    for i in range(len(group)):
        h = group.hashes[group.bounds[i] : group.bounds[i + 1]]
        text = line_starts[group.offsets[i] : group.offsets[i + 1]]
        m = len(h)
        if m:
            _, times = np.unique(h, return_counts=True)
            rows[0, i] = len(times)
            rows[1, i] = np.count_nonzero(h[1:] == h[:-1])
            g = grams(h, 2)
            rows[2, i] = len(g) - len(np.unique(g))
            rows[3, i] = times.max()
            if text.any():
                rows[4, i] = _same_lines(group, i, h)
    out += [
        _ratio(rows[0], n, 0.8),
        _ratio(rows[1], n, 0.02),
        _ratio(rows[2], n, 0.02),
        _ratio(rows[3], n, 0.1),
        _ratio(rows[4], n, 0.02),
    ]
    return np.stack(out, axis=1)


def _same_lines(group: Words, i: int, h: np.ndarray) -> int:
    """Words of a text that lie in a line with the same words as an earlier line."""
    data = group.data[group.offsets[i] : group.offsets[i + 1]]
    inside = SPACED[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    before = np.concatenate([[0], np.cumsum(starts)])  # words that start before each byte
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([[0], before[breaks], [len(h)]]))
    place = np.arange(len(h)) - np.repeat(edges[:-1], np.diff(edges))
    key = np.add.reduceat(h * (place.astype(np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15)), edges[:-1])
    _, first = np.unique(key, return_index=True)
    sizes = np.diff(edges)
    return int(sizes.sum() - sizes[first].sum())


def statistics_of(column: pa.Array) -> np.ndarray:
    parts = [statistics(group) for group in words(column, SPACED)]
    return np.concatenate(parts) if parts else np.empty((0, len(FEATURES)))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats array<double>) of every document, over its whole text."""

    def run(batches):
        for batch in batches:
            found = statistics_of(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(found), pa.list_(pa.float64()))], ["id", "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, stats array<double>")


@dataclass(frozen=True)
class Side:
    """One class: mean, inverse Cholesky factor of the shrunk covariance, log determinant."""

    mean: np.ndarray
    whiten: np.ndarray
    log_det: float
    log_prior: float


@dataclass(frozen=True)
class Model:
    sides: tuple[Side, Side] | None


def _moments(stats: DataFrame, known: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products per class, added up on the executors."""
    d = len(FEATURES)

    def run(batches):
        total = {y: (0.0, np.zeros(d), np.zeros((d, d))) for y in (0, 1)}
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), dtype=np.float64).reshape(-1, d)
            labels = np.array(batch.column(1).to_pylist())
            for y in (0, 1):
                rows = x[labels == y]
                n, s, p = total[y]
                total[y] = (n + len(rows), s + rows.sum(0), p + rows.T @ rows)
        values = [[n, *s, *p.ravel()] for n, s, p in total.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(values, pa.list_(pa.float64()))], ["label", "moments"]
        )

    # Repeated rows of one labelled id count once.
    once = stats.join(known, "id").groupBy("id").agg(F.min("stats").alias("stats"), F.min("label").alias("label"))
    parts = once.select("stats", "label").mapInArrow(run, "label int, moments array<double>")
    each = parts.select("label", F.posexplode("moments").alias("i", "v")).groupBy("label", "i").agg(F.sum("v").alias("v"))
    out = {y: (0.0, np.zeros(d), np.zeros((d, d))) for y in (0, 1)}
    rows = each.collect()  # two classes times the moments of a fixed number of statistics
    for y in (0, 1):
        v = np.zeros(1 + d + d * d)
        for r in rows:
            if r["label"] == y:
                v[r["i"]] = r["v"]
        out[y] = (v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d))
    return out


def _covariance(n: float, s: np.ndarray, p: np.ndarray) -> np.ndarray:
    mean = s / n
    return p / n - np.outer(mean, mean)


def discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], to_pooled: float = 0.3, to_diagonal: float = 0.05, floor: float = 1e-3) -> Model:
    """Class means and factors of the shrunk covariances."""
    if min(moments[y][0] for y in (0, 1)) < 1:
        return Model(None)
    total = sum(m[0] for m in moments.values())
    covariances = {y: _covariance(*moments[y]) for y in (0, 1)}
    pooled = sum(moments[y][0] / total * covariances[y] for y in (0, 1))
    sides = []
    for y in (0, 1):
        n, s, _ = moments[y]
        c = (1 - to_pooled) * covariances[y] + to_pooled * pooled
        c = (1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c)) + floor * np.eye(len(c))
        factor = np.linalg.cholesky(c)
        whiten = np.linalg.inv(factor)
        sides.append(Side(s / n, whiten, 2 * float(np.log(np.diag(factor)).sum()), float(np.log(n / total))))
    return Model((sides[0], sides[1]))


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Model:
    """Fit on the statistics of all documents with a label that may be learned from."""
    return discriminant(_moments(stats, labels_of(labels, label_col, id_col)))


def score_rows(x: np.ndarray, model: Model) -> np.ndarray:
    """Probability of class 1 of each row of statistics."""
    if model.sides is None:
        return np.full(len(x), 0.5)
    logs = []
    for side in model.sides:
        z = (x - side.mean) @ side.whiten.T
        logs.append(side.log_prior - 0.5 * (side.log_det + (z * z).sum(1)))
    return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(id, score, predicted) from the statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
            p = score_rows(x, shared.value)
            found = [pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["id", "score", "predicted"])

    schema = StructType([stats.schema["id"]]).add("score", DoubleType()).add("predicted", IntegerType())
    return stats.select("id", "stats").mapInArrow(run, schema)


def drop_low(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents predicted to be good, with all their columns, in one pass over the texts."""
    columns = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = columns.index(text_col)

    def run(batches):
        for batch in batches:
            p = score_rows(statistics_of(batch.column(at)), shared.value)
            yield batch.filter(pa.array(p >= THRESHOLD))

    named = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    return named.mapInArrow(run, named.schema).toDF(*columns)


def stored_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics of all documents, written once: they are small, the texts are not moved."""
    return keep(with_statistics(docs, id_col, text_col), "quality-stats")
