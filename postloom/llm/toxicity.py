"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, word pairs and pairs with one word between of a text,
hashed into 2**bits places. FTRL-proximal keeps a learning rate per coordinate; its L1 term
leaves few weights other than zero, so the model is a short list that is broadcast.

Training uses at most ``rows_per_class`` labelled documents of each class, those with the
smallest hash of their id (all if fewer), in one task that reads them as a stream. That
bound is the only limit: every document is scored, on its whole text.

Cases: a NULL or empty text and one without words get the score of the intercept alone;
labels that are NULL, not 0 or 1, or differ between rows of one id are not learned from;
without any labelled document the score is 0 (nothing is known to be toxic); repeated rows
are learned from once, by their smallest text, and give repeated results; a NULL id is passed through; only the id and text columns are read,
so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.labelled import labels_of
from postloom.llm.store import keep
from postloom.llm.textops import ALPHANUMERIC, Words, mix, words

THRESHOLD = 0.7


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 0.1
    epochs: int = 5
    rows_per_class: int = 8000


@dataclass(frozen=True)
class Model:
    """Sorted places of the weights that are not zero, their weights, and the intercept."""

    places: np.ndarray
    weights: np.ndarray
    intercept: float
    bits: int


def features(group: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and row of every word, word pair and skip pair of a group of texts."""
    h, bounds = group.hashes, group.bounds
    row = np.repeat(np.arange(len(group)), np.diff(bounds))
    parts, rows = [mix(h ^ np.uint64(0x11))], [row]
    for gap, seed in ((1, 0x22), (2, 0x33)):
        if len(h) > gap:
            same = row[gap:] == row[:-gap]
            pair = mix(h[:-gap] * np.uint64(0x9FB21C651E98DF25) + h[gap:] + np.uint64(seed))
            parts.append(pair[same])
            rows.append(row[gap:][same])
    places = np.concatenate(parts) >> np.uint64(64 - bits)
    return places.astype(np.int64), np.concatenate(rows)


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_rows(rows: list[np.ndarray], labels: list[int], settings: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over rows of distinct feature places, in the order given.

    The intercept is a coordinate without L1. Returns places, weights and the intercept.
    """
    size = 1 << settings.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    a, b, l1, l2 = settings.alpha, settings.beta, settings.l1, settings.l2
    ones = sum(labels)
    # Both classes weigh the same together.
    weight = (len(labels) / max(1, 2 * (len(labels) - ones)), len(labels) / max(1, 2 * ones))

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[at], n[at]
        limit = np.where(at == size, 0.0, l1)
        shrunk = np.sign(zs) * limit - zs
        return np.where(np.abs(zs) <= limit, 0.0, shrunk / ((b + np.sqrt(ns)) / a + l2))

    for _ in range(settings.epochs):
        for places, y in zip(rows, labels):
            at = np.append(places, size)
            w = weights(at)
            g = (sigmoid(w.sum()) - y) * weight[y]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / a
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    kept = np.flatnonzero(w[:size])
    return kept, w[kept], float(w[size])


def _distinct_rows(column: pa.Array, bits: int) -> Iterator[np.ndarray]:
    for group in words(column, ALPHANUMERIC):
        places, row = features(group, bits)
        order = np.lexsort((places, row))
        places, row = places[order], row[order]
        first = np.ones(len(places), dtype=bool)
        first[1:] = (places[1:] != places[:-1]) | (row[1:] != row[:-1])
        places, row = places[first], row[first]
        yield from np.split(places, np.searchsorted(row, np.arange(1, len(group))))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Train on labelled documents. Ids with more than one document are used once."""
    known = labels_of(labels, label_col, id_col).withColumn("order", F.xxhash64("id"))
    sides = [known.filter(F.col("label") == y).orderBy("order", "id").limit(settings.rows_per_class) for y in (0, 1)]
    # At most 2 * rows_per_class ids: small enough to broadcast whatever the tables' sizes.
    sample = F.broadcast(keep(sides[0].unionByName(sides[1]).coalesce(1), "toxic-sample"))
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sample, "id")
    # An id that very many rows repeat comes down to one text before any shuffle.
    chosen = chosen.groupBy("id", "label", "order").agg(F.min("text").alias("text"))

    def train(batches):
        rows, known_labels, at = [], [], []
        for batch in batches:
            ids, ys, order = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for i, places in enumerate(_distinct_rows(batch.column(1), settings.bits)):
                rows.append(places.astype(np.int32))
                known_labels.append(ys[i])
                at.append((order[i], ids[i]))
        by = sorted(range(len(rows)), key=lambda i: at[i])  # the same order whatever the partitions
        if len(set(known_labels)) == 2:
            places, weights, intercept = fit_rows([rows[i] for i in by], [known_labels[i] for i in by], settings)
        else:
            places, weights = np.empty(0, np.int64), np.empty(0)
            intercept = 35.0 if known_labels and known_labels[0] else -35.0
        out = [pa.array(np.append(places, -1), pa.int64()), pa.array(np.append(weights, intercept), pa.float64())]
        yield pa.RecordBatch.from_arrays(out, ["place", "weight"])

    fitted = keep(
        chosen.select("id", "text", "label", "order").repartition(1).mapInArrow(train, "place bigint, weight double"),
        "toxic-model",
    )
    found = fitted.orderBy("place").toPandas()  # at most 2**bits + 1 rows, few after L1
    if found.empty:
        return Model(np.empty(0, np.int64), np.empty(0), -35.0, settings.bits)
    return Model(found["place"].to_numpy()[1:], found["weight"].to_numpy()[1:], float(found["weight"].iloc[0]), settings.bits)


def score_column(column: pa.Array, model: Model) -> np.ndarray:
    """Probability of each text."""
    out = np.full(len(column), float(sigmoid(model.intercept)))
    if not len(model.places):
        return out
    wanted = np.zeros(1 << model.bits, dtype=bool)
    wanted[model.places] = True
    for group in words(column, ALPHANUMERIC):
        places, row = features(group, model.bits)
        hit = wanted[places]
        # A feature counts once per text.
        pairs = np.unique(row[hit] * (1 << model.bits) + places[hit])
        w = model.weights[np.searchsorted(model.places, pairs & ((1 << model.bits) - 1))]
        total = np.bincount(pairs >> model.bits, weights=w, minlength=len(group))
        out[group.first : group.first + len(group)] = sigmoid(total + model.intercept)
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_columns: list[str] | None = None) -> DataFrame:
    """The kept columns (the id by default) with ``score`` and ``predicted`` after them.

    ``keep_columns`` may name any columns but ``score`` and ``predicted``.
    """
    columns = keep_columns or [id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    taken = docs.select(*[F.col(c) for c in columns], F.col(text_col).alias("__text"))

    def run(batches):
        for batch in batches:
            p = score_column(batch.column(len(columns)), shared.value)
            found = [pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *found], [*columns, "score", "predicted"])

    from pyspark.sql.types import DoubleType, IntegerType, StructType

    schema = StructType([docs.schema[c] for c in columns]).add("score", DoubleType()).add("predicted", IntegerType())
    return taken.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    columns = docs.columns
    named = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    at = columns.index(text_col)
    scored = score(named, model, f"c{columns.index(id_col)}", f"c{at}", named.columns)
    return scored.filter("predicted = 0").drop("score", "predicted").toDF(*columns)
