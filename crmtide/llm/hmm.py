"""Hidden Markov language model over classes of words."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.llm.common import by_size, chunks, remove, saved, table
from crmtide.llm.toxicity import held_out
from crmtide.llm.words import hashed, lower_bytes

STATES = 8
#: A word's class is the first 16 bits of its hash; the end of a text has a class of its own.
CLASSES = 1 << 16
END = -7
#: The first rounds only find a starting point: each covers one in so many training rows, chosen by a hash.
START_SHARE, START_ROUNDS = 8, 12
#: Rounds over all training rows.
ROUNDS = 3
#: Words whose counts every task holds; all others are joined.
FREQUENT = 1 << 16
#: Tokens of texts that are counted together; a longer text is counted alone.
TOGETHER = 1 << 19
SMOOTH = 20_000.0
_CHUNK = 8_000_000


def tokens(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word and, after each text's last, END; first token of each text and the end of all)."""
    raw = lower_bytes(texts)
    parts, counts = [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
    for a, b in by_size(raw, _CHUNK):
        word, bounds = hashed(raw[a:b])
        parts.append(np.insert(word.view(np.int64), bounds[1:], END))
        counts.append(np.diff(bounds) + 1)
    return np.concatenate(parts), np.cumsum(np.concatenate(counts))


def classes(token: np.ndarray) -> np.ndarray:
    return np.where(token == END, CLASSES, (token.view(np.uint64) >> np.uint64(48)).astype(np.int64)).astype(np.int32)


class Model:
    """Start, transition and emission probabilities; ``emit`` has a row per class."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, unigram: np.ndarray, states: int) -> Model:
        noise = np.random.default_rng(5).gamma(1.0, 1.0, (len(unigram), states))
        emit = unigram[:, None] * noise
        move = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, unigram: np.ndarray) -> Model:
        emit = emit + SMOOTH * unigram[:, None]
        start, move = start + 1, move + 1
        return cls(start / start.sum(), move / move.sum(axis=1)[:, None], emit / emit.sum(axis=0))

    def log_likelihood(self, label: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """ln P of each text by the scaled forward recursion, all texts a step at a time, the longest first."""
        lengths = np.diff(bounds)
        order = np.argsort(-lengths, kind="stable")
        begins, left = bounds[:-1][order], lengths[order]
        alive = len(order) - np.searchsorted(left[::-1], np.arange(left[0] if len(left) else 0), "right")
        chance, onward = np.ascontiguousarray(self.emit.T), np.ascontiguousarray(self.move.T)
        out, a = np.zeros(len(order)), np.repeat(self.start[:, None], len(order), axis=1)
        for t, n in enumerate(alive):
            a = onward @ a[:, :n] if t else a
            a *= chance.take(label[begins[:n] + t], axis=1)
            scale = a.sum(axis=0)
            out[:n] += np.log(scale)
            a /= scale
        found = np.empty(len(order))
        found[order] = out
        return found

    def expect(self, texts: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        """Adds the expected counts of whole texts, longest first, by the forward and the backward recursion.

        Tokens lie by step, each step's texts side by side, a row per state: no
        place is padding, and all arithmetic runs along the texts of a step.
        """
        lengths = np.array([len(s) for s in texts])
        n, steps, states = len(texts), int(lengths[0]), len(self.start)
        alive = n - np.searchsorted(lengths[::-1], np.arange(steps), "right")
        at = np.concatenate([[0], np.cumsum(alive)])
        x = np.empty(at[-1], np.intp)
        for i, s in enumerate(texts):
            x[at[: len(s)] + i] = s
        chance, onward = np.ascontiguousarray(self.emit.T), np.ascontiguousarray(self.move.T)
        forward, scales = np.empty((states, len(x))), np.empty(len(x))
        for t, m in enumerate(alive):
            own = slice(at[t], at[t] + m)
            a = forward[:, own]
            if t:
                np.matmul(onward, forward[:, at[t - 1] : at[t - 1] + m], out=a)
            else:
                a[:] = self.start[:, None]
            a *= chance.take(x[own], axis=1)
            scales[own] = 1 / a.sum(axis=0)
            a *= scales[own]
        backward, moved = np.ones((states, n)), np.zeros((states, states))
        for t in range(steps - 1, -1, -1):
            m = alive[t]
            own = slice(at[t], at[t] + m)
            forward[:, own] *= backward[:, :m]
            if t:
                ahead = chance.take(x[own], axis=1)
                ahead *= backward[:, :m]
                ahead *= scales[own]
                moved += forward[:, at[t - 1] : at[t - 1] + m] @ ahead.T
                np.matmul(self.move, ahead, out=backward[:, :m])
        start += forward[:, :n].sum(axis=1)
        move += moved * self.move
        for k in range(states):
            emit[:, k] += np.bincount(x, forward[k], len(emit))


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, counts = np.unique(tokens(batch.column(0).to_pylist())[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], ["word", "c"])


def _labeller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of each text's tokens in turn, as bytes of int32."""
    for batch in batches:
        token, bounds = tokens(batch.column(0).to_pylist())
        label = classes(token)
        yield pa.RecordBatch.from_arrays([pa.array([label[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())], ["label"])


def _expecter(model) -> Callable:
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        states = len(own.start)
        start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(own.emit)
        for batch in batches:
            waiting = sorted((np.frombuffer(t, np.int32) for t in batch.column(0).to_pylist()), key=len, reverse=True)
            for a, b in chunks([len(t) for t in waiting], TOGETHER):
                own.expect(waiting[a:b], start, move, emit)
        met = np.nonzero(emit.any(axis=1))[0]
        rows = np.concatenate([start[None, :], move, emit[met]])
        kinds = np.concatenate([-1 - np.arange(states + 1), met]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds), *[pa.array(rows[:, k]) for k in range(states)]], ["kind", *[f"s{k}" for k in range(states)]]
        )

    return expect


def labelled(texts: DataFrame) -> DataFrame:
    """(label) of ``texts`` (text): what ``baum_welch`` reads, to be saved for all its rounds."""
    return texts.mapInArrow(_labeller, "label binary")


def baum_welch(texts: DataFrame, model: Model, unigram: np.ndarray) -> Model:
    """One round over all ``texts`` (label): counts expected in each partition, summed by class."""
    spark, states = texts.sparkSession, len(model.start)
    now = spark.sparkContext.broadcast(model)
    names = [f"s{k}" for k in range(states)]
    counts = texts.mapInArrow(_expecter(now), "kind int, " + ", ".join(f"{c} double" for c in names))
    found = counts.groupBy("kind").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    now.destroy()
    if not (found["kind"].to_numpy() >= 0).any():
        return model
    sums = np.zeros((CLASSES + 1, states))
    kinds, values = found["kind"].to_numpy(), np.column_stack([found[c].to_numpy() for c in names])
    sums[kinds[kinds >= 0]] = values[kinds >= 0]
    rest = np.zeros((states + 1, states))
    rest[-1 - kinds[kinds < 0]] = values[kinds < 0]
    return Model.of_counts(rest[0], rest[1:], sums, unigram)


def _scorer(shared) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, word, logs, log_class = shared.value
        place = pd.Index(word)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            token, bounds = tokens(batch.column(1).to_pylist())
            label = classes(token)
            likelihood = model.log_likelihood(label, bounds) / np.log(10)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            at = place.get_indexer(token)
            frequent = at >= 0
            of = lambda values, rows: np.bincount(rows, values, batch.num_rows)
            log_words = of(logs[at[frequent]], owner[frequent])
            order = np.lexsort((token[~frequent], owner[~frequent]))
            rare, rows = token[~frequent][order], owner[~frequent][order]
            new = np.ones(len(rare), bool)
            new[1:] = (rare[1:] != rare[:-1]) | (rows[1:] != rows[:-1])
            begins = np.nonzero(new)[0]
            times = np.diff(np.append(begins, len(rare)))
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows[begins], minlength=batch.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(uid + np.arange(batch.num_rows)),
                    batch.column(0),
                    pa.array(np.diff(bounds)),
                    pa.array(of(frequent[frequent].astype(float), owner[frequent]).astype(np.int64)),
                    pa.array(log_words),
                    pa.array(likelihood - of(log_class[label], owner)),
                    pa.ListArray.from_arrays(ends, pa.array(rare[begins])),
                    pa.ListArray.from_arrays(ends, pa.array(times)),
                ],
                ["uid", "id", "n_tokens", "known", "log_words", "log_rest", "rare", "times"],
            )
            uid += batch.num_rows

    return score


def score_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; scores are log10.

    The model gives a text P(classes of its tokens) by a hidden Markov model,
    times P(token | class) for each token: (c + 0.5) / (tokens of the class + half
    the number of its words and one unknown). The room for unknown words costs up to
    log2(1 + 32768 / training tokens) bits a token, which matters on tiny data only. Words are cut at ASCII white
    space, A-Z lowered; each text ends in one end token, so a NULL or empty text
    is that token alone. Counts cover all training rows; words that are not among
    the most frequent are joined with theirs. Baum-Welch counts whole texts,
    first of every ``START_SHARE``-th training row, then of all. Rows with a NULL or repeated id are
    scored like others (NULL trains). A text is scored whole, however long. Other
    columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    training = rows.filter(~held_out("id", 1))
    counts = training.select("text").mapInArrow(_counter, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counts = saved(counts, "word-counts")

    kind = F.when(F.col("word") == END, CLASSES).otherwise(F.shiftrightunsigned("word", 48)).cast("int")
    by_class = counts.groupBy(kind.alias("kind")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).toArrow()
    at = by_class["kind"].to_numpy()
    n, v = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    n[at], v[at] = by_class["n"].to_numpy(), by_class["v"].to_numpy()
    total, words = int(n.sum()), int(v.sum())
    of_class = n + 0.5 * (v + 1)
    unigram = of_class / of_class.sum()

    model = Model.first(unigram, STATES)
    # Words are cut and hashed once, not again in every round.
    start = training.filter(F.pmod(F.xxhash64("id", "text"), F.lit(START_SHARE)) == 0).select("text")
    start = saved(labelled(start), "start-labels")
    for _ in range(START_ROUNDS):
        model = baum_welch(start, model, unigram)
    whole = saved(labelled(training.select("text")), "labels")
    for _ in range(ROUNDS):
        model = baum_welch(whole, model, unigram)
    remove(whole)

    top = counts.orderBy(F.col("c").desc(), "word").limit(FREQUENT).orderBy("word").toArrow()
    logs = np.log10(top["c"].to_numpy() + 0.5)
    shared = spark.sparkContext.broadcast((model, top["word"].to_numpy(), logs, np.log10(of_class)))
    kind_of_id = rows.schema["id"].dataType.simpleString()
    schema = f"uid long, id {kind_of_id}, n_tokens long, known long, log_words double, log_rest double"
    scored = saved(rows.mapInArrow(_scorer(shared), schema + ", rare array<long>, times array<long>"), "scored")

    pairs = scored.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    pairs = pairs.select("uid", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    found = pairs.join(counts, "word", "left").groupBy("uid")
    found = found.agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("log_rare"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("known_rare"),
    )
    log_words = F.col("log_words") + F.coalesce("log_rare", F.lit(0.0))
    each = float(np.log10(total + 0.5 * (words + 1)))
    return scored.join(found, "uid", "left").select(
        F.col("id").alias(id_column),
        held_out("id", 1).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (log_words - F.col("n_tokens") * each).alias("base_score"),
        (log_words + F.col("log_rest")).alias("score"),
    )


def op6_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents", "doc_id", "text"))
