"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.llm.common import by_size, hash_sample, lean, saved, table
from crmtide.llm.words import hashed, lower_bytes, mix

BITS = 20
SIZE = 1 << BITS
#: Most labelled rows the classifier is fitted on, the first in the order of a hash of their ids.
FIT_ROWS = 20_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 0.1
_CHUNK = 1_000_000
_BARE = bytes.maketrans(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 31)


def features(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text, coordinate) of every word, word pair and pair with one word between, without punctuation."""
    word, bounds = hashed([t.translate(_BARE) for t in lower_bytes(texts)])
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    owners, coordinates = [owner], [mix(word, 11)]
    for gap in (1, 2):
        together = owner[gap:] == owner[:-gap]
        pair = mix(mix(word[:-gap], 11 + gap) ^ word[gap:], 21 + gap)
        owners.append(owner[gap:][together])
        coordinates.append(pair[together])
    return np.concatenate(owners), (np.concatenate(coordinates) >> np.uint64(64 - BITS)).astype(np.int64)


def distinct(owner: np.ndarray, coordinate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(owner << BITS | coordinate)
    return key >> BITS, key & (SIZE - 1)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The proximal step: a coordinate whose gradients sum up to L1 at most has weight zero."""
    return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)


def _bias(z: float, n: float) -> float:
    return -z / ((BETA + np.sqrt(n)) / ALPHA)


class State:
    """Gradient sums z and squared sums n of each coordinate; the last one is the bias, which has no penalty."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def learn(self, coordinates: np.ndarray, label: int) -> None:
        z, n = self.z[coordinates], self.n[coordinates]
        w, bias = weights(z, n), _bias(self.z[SIZE], self.n[SIZE])
        p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
        g = p - label
        for at, have in ((coordinates, w), (SIZE, bias)):
            step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
            self.z[at] += g - step * have
            self.n[at] += g * g


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Non-zero weights, and the bias at ``SIZE``, learned from the rows in turn."""
    state = State()
    for batch in batches:
        texts, labels = (c.to_pylist() for c in batch.columns)
        for a, b in by_size([t or "" for t in texts], _CHUNK):
            owner, coordinate = distinct(*features(texts[a:b]))
            ends = np.searchsorted(owner, np.arange(b - a + 1))
            for i, label in enumerate(labels[a:b]):
                state.learn(coordinate[ends[i] : ends[i + 1]], int(label))
    w = weights(state.z, state.n)
    w[SIZE] = _bias(state.z[SIZE], state.n[SIZE])
    kept = np.nonzero(w)[0]
    yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(w[kept])], ["i", "w"])


def fit(labelled: DataFrame, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, bias), non-zero weights only, of rows (id, text, label); their number must be bounded.

    The rule learns from one row after the other, so one task reads the rows, a
    batch at a time, in the order of a hash, once per epoch. The gradient sums
    stay in that task; what leaves it has one number per non-zero weight.
    """
    rows = labelled.withColumn("turn", F.xxhash64("id")).repartition(1).sortWithinPartitions("turn", "id", "label")
    rows = saved(rows.select("text", "label"), "labelled").coalesce(1)
    turns = reduce(DataFrame.unionAll, [rows] * epochs).coalesce(1)
    found = turns.mapInArrow(lean(_train), "i long, w double").toArrow()
    at, w = (found[c].to_numpy() for c in ("i", "w"))
    of_bias = at == SIZE
    return at[~of_bias], w[~of_bias], float(w[of_bias].sum())


def _scorer(model) -> Callable:
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w, bias = model.value
        dense = np.zeros(SIZE)
        dense[at] = w
        for batch in batches:
            texts = batch.tolist()
            sums = np.zeros(len(texts))
            for a, b in by_size([t or "" for t in texts], _CHUNK):
                owner, coordinate = features(texts[a:b])
                heavy = dense[coordinate] != 0
                owner, coordinate = distinct(owner[heavy], coordinate[heavy])
                sums[a:b] = np.bincount(owner, dense[coordinate], b - a)
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums + bias, -35, 35))))

    # A filter on the score must not move below it: texts would be scored for the filter and again for the column.
    return F.pandas_udf(lean(score), "double", F.PandasUDFType.SCALAR_ITER).asNondeterministic()


def held_out(id_column: str, remainder: int) -> Column:
    """Rows whose crc32 of the id as text leaves this remainder by 5; false for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == remainder, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """All columns of ``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5).

    Only texts are scored. Labels (``doc_id``, ``toxic``) teach if their row is
    not held out, ``fit_rows`` of them at most; a NULL label teaches nothing,
    of several labels of an id the largest counts. A NULL or empty text has
    no feature and gets the score of the bias, as all do if there is no label.
    Rows with a NULL id are scored, repeated rows alike. Columns of the three
    names are replaced, others are carried; only texts go to Python, a batch at a
    time, and a text is scored whole, however long. An empty table gives no rows.
    """
    taught = labels.filter(F.col("toxic").isNotNull() & ~held_out("doc_id", 0) & F.col("doc_id").isNotNull())
    taught = taught.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("label"))
    chosen = hash_sample(taught, ["id"], fit_rows)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(fit(texts.join(F.broadcast(chosen), "id")))
    made = ("held_out", "score", "predicted")
    kept = [c for c in docs.columns if c not in made]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(text_column).cast("string").alias("text"))
    scored = rows.select("row", _scorer(model)("text").alias("score"))
    return scored.select(
        "row.*",
        held_out(f"row.{id_column}", 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return scored.select("doc_id", "held_out", "score", "predicted")
