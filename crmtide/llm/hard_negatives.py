"""Hard negatives by rotated one-bit codes: popcount estimates, residual intervals, integer scores of what is left."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crmtide.llm.common import saved, table
from crmtide.llm.topk import whole

POSITIVES, NEGATIVES, EVERY = 5, 10, 100
#: Percent of the positive's score between which a negative's lies.
LOW, HIGH = 30, 90
#: One-bit codes of a vector: the first of it, each other one of what the codes before leave out.
LEVELS = 4
#: Bits of a rotated anchor's components.
BITS = 8
#: Components of the rows and of the anchors that meet in one group.
ROWS, ANCHORS = 1 << 19, 1 << 16
_PAIRS = 1 << 22


@lru_cache(maxsize=4)
def rotation(width: int) -> np.ndarray:
    """An orthogonal matrix drawn by the width alone."""
    q, r = np.linalg.qr(np.random.default_rng(width).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    room = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    room[:, : bits.shape[1]] = bits
    return np.packbits(room, axis=1, bitorder="little").view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signs, alignments, length of the rest) of each vector after rotation.

    A code vector has components of +-1 / sqrt(width), the signs of what is left of
    the vector; its alignment is the inner product with that, and what is
    orthogonal to it is left for the next code. Four codes leave about an eighth.
    """
    left = vectors.astype(np.float64) @ rotation(vectors.shape[1]).T
    codes, aligned = [], []
    for _ in range(LEVELS):
        bits = left >= 0
        codes.append(_packed(bits))
        aligned.append(np.abs(left).sum(axis=1) / np.sqrt(vectors.shape[1]))
        left = left - np.where(bits, 1, -1) * (aligned[-1] / np.sqrt(vectors.shape[1]))[:, None]
    return np.stack(codes, axis=1), np.stack(aligned, axis=1), np.sqrt((left**2).sum(axis=1))


def intervals(codes: np.ndarray, aligned: np.ndarray, rest: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, half width) of the inner product of each coded vector (row) with each anchor (column).

    An anchor's rotated components are rounded to ``BITS`` bits, so that its
    product with a code vector is a sum of bit counts. The estimate adds up
    alignment times product over the codes. What it misses is at most the
    alignments times the length of what rounding left out, plus the length of the
    anchor's part orthogonal to the last code vector times the length of the rest
    (Cauchy-Schwarz). Nothing in it is random: no vector lies outside.
    """
    width = anchors.shape[1]
    turned = anchors.astype(np.float64) @ rotation(width).T
    half = (1 << BITS - 1) - 1
    step = np.maximum(np.abs(turned).max(axis=1), 1e-300) / half
    whole_steps = np.rint(turned / step[:, None]).astype(np.int64)
    lost = np.sqrt(((turned - whole_steps * step[:, None]) ** 2).sum(axis=1))
    shifted = whole_steps + half + 1
    planes = [_packed((shifted >> j & 1).astype(bool)) for j in range(BITS)]
    estimate = np.zeros((len(codes), len(anchors)))
    for level in range(codes.shape[1]):
        of_set = np.zeros((len(codes), len(anchors)), np.int32)
        for j, plane in enumerate(planes):
            for w in range(codes.shape[2]):
                of_set += np.bitwise_count(codes[:, level, w, None] & plane[None, :, w]).astype(np.int32) << j
        ones = np.bitwise_count(codes[:, level]).sum(axis=1, dtype=np.int64)
        signed = 2 * (of_set - (half + 1) * ones[:, None]) - whole_steps.sum(axis=1)
        product = signed * (step / np.sqrt(width))
        estimate += aligned[:, level, None] * product
    square = (turned**2).sum(axis=1)
    across = np.sqrt(np.maximum(square - np.maximum(np.abs(product) - lost, 0) ** 2, 0))
    all_aligned = aligned.sum(axis=1)[:, None]
    slack = 1e-9 * np.sqrt(square) * (all_aligned + rest[:, None]) + 1e-6
    return estimate, all_aligned * lost + across * rest[:, None] + slack


def _best(scores: np.ndarray, k: int) -> float:
    """The k-th largest, or less than all if there are fewer."""
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def search(
    estimate: np.ndarray, width: np.ndarray, score: Callable[[np.ndarray], np.ndarray], ids: np.ndarray, rows: np.ndarray,
    low: float, high: float, k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows, scores) of the ``k`` of ``rows`` with the highest scores within [low, high], and how many were scored.

    The rows that look best are scored first: the k-th of those within the range
    is a floor for all others. A row whose interval ends below the floor or
    begins above the range is out; the scores of all that are left decide.
    """
    top, bottom = estimate[rows] + width[rows], estimate[rows] - width[rows]
    rows, top, bottom = (x[(top >= low) & (bottom <= high)] for x in (rows, top, bottom))
    if not len(rows):
        return rows, np.empty(0, np.int64), 0
    centre = np.where(estimate[rows] <= high, estimate[rows], -np.inf)
    first = np.argpartition(centre, len(rows) - 4 * k)[-4 * k :] if len(rows) > 4 * k else np.arange(len(rows))
    known = score(rows[first])
    floor = max(low, _best(known[(known >= low) & (known <= high)], k))
    left = rows[top >= floor]
    scores = score(left)
    fit = (scores >= floor) & (scores <= high)
    left_in, scores = left[fit], scores[fit]
    best = np.lexsort((ids[left_in], -scores))[:k]
    return left_in[best], scores[best], len(left)


def _coder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        widths = batch.column(3).to_numpy()
        vectors = batch.column(2).to_numpy(zero_copy_only=False)
        for width in np.unique(widths):
            at = np.nonzero(widths == width)[0]
            for some in np.array_split(at, max(1, len(at) * int(width) // ROWS)):
                codes, aligned, rest = encode(np.stack(vectors[some]))
                own = batch.take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(list(aligned)), pa.array(rest)],
                    ["id", "label", "v", "width", "code", "aligned", "rest"],
                )


def _searcher(k: int, positives: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Best rows of a block for each anchor: of its own label, or of other labels within each of its score ranges."""

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        data, asked = pdf[~pdf["asks"]], pdf[pdf["asks"]]
        out: list[tuple] = []
        if len(data) and len(asked):
            vectors = np.stack(data["v"].to_numpy()).astype(np.int64)
            ids, labels = data["id"].to_numpy(), data["label"].to_numpy()
            codes = np.frombuffer(b"".join(data["code"]), np.uint64).reshape(len(data), LEVELS, -1)
            aligned, rest = np.stack(data["aligned"].to_numpy()), data["rest"].to_numpy()
            step = max(1, _PAIRS // len(data))
            for at in range(0, len(asked), step):
                some = asked.iloc[at : at + step]
                anchors = np.stack(some["v"].to_numpy()).astype(np.int64)
                estimate, width = (np.ascontiguousarray(x.T) for x in intervals(codes, aligned, rest, anchors))
                for e, w, v, i, label, ranges in zip(estimate, width, anchors, some["id"], some["label"], some["ranges"]):
                    score = lambda rows, v=v: vectors[rows] @ v
                    rows = np.nonzero((ids != i) & ((labels == label) == positives))[0]
                    for r in [(1, None)] if positives else [(int(x["place"]), int(x["score"])) for x in ranges]:
                        low, high = (-np.inf, np.inf) if positives else (-(-LOW * r[1] // 100), HIGH * r[1] // 100)
                        if low <= high:
                            found, scores, _ = search(e, w, score, ids, rows, low, high, k)
                            out += [(i, r[0], ids[x], s) for x, s in zip(found, scores)]
        return pd.DataFrame(out, columns=["anchor", "place", "id", "score"]).astype("int64")

    return find


def _meet(index: DataFrame, anchors: DataFrame, width: int, rows: int, asked: int, k: int, positives: bool) -> DataFrame:
    """(anchor, place, id, score, rank): the ``k`` best of all rows of one width, from the best of every block of rows."""
    blocks, parts = max(1, -(-rows * width // ROWS)), max(1, -(-asked * width // ANCHORS))
    names = ["part", "block", "asks", "id", "label", "v", "code", "aligned", "rest", "ranges"]
    none = F.lit(None).cast(anchors.schema["ranges"].dataType)
    data = index.filter(F.col("width") == width).withColumns(
        {
            # Rows that are equal in all columns are spread too.
            "block": F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int"),
            "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))),
            "asks": F.lit(False),
            "ranges": none,
        }
    )
    asking = anchors.filter(F.col("width") == width).withColumns(
        {
            "part": F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"),
            "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))),
            "asks": F.lit(True),
        }
    )
    met = data.select(*names).unionByName(asking.select(*names)).groupBy("part", "block")
    found = met.applyInPandas(_searcher(k, positives), "anchor long, place int, id long, score long")
    best = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    every: int = EVERY,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``every`` divides. A score is the inner product
    of whole numbers, components times ``scale`` rounded down; it must fit 63
    bits. An anchor's positives are its ``positives`` best rows of the same
    label; for each of them come the ``negatives`` best rows of other labels
    whose score is 30 to 90 percent of the positive's. Ties go to the smaller
    id; a positive of negative score has no range.

    Rows without id, label or vector and vectors that are empty or hold a NULL
    or a non-finite component take no part; vectors of different lengths do not
    meet. Rows that repeat an id are not candidates of that id and each one for
    others; of an anchor's id, the row with the smallest label and vector asks.
    Other columns are ignored; an empty table gives no rows. Labels are
    integers. Every row is coded once; blocks of rows meet blocks of anchors,
    and each gives back its best rows only, so no list of pairs exists.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label_column).cast("long").alias("label"),
        whole(vector_column, scale).alias("v"),
    )
    rows = rows.filter("id is not null and label is not null and v is not null").withColumn("width", F.size("v"))
    schema = "id long, label long, v array<long>, width int, code binary, aligned array<double>, rest double"
    index = saved(rows.mapInArrow(_coder, schema), "codes")
    first = F.min(F.struct("label", "v", "width", "code", "aligned", "rest")).alias("row")
    anchors = index.filter(F.col("id") % every == 0).groupBy("id").agg(first).select("id", "row.*")
    anchors = saved(anchors, "anchors")
    sizes = {r["width"]: r["n"] for r in index.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = {r["width"]: r["n"] for r in anchors.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges = F.lit(None).cast("array<struct<place:int,score:long>>")
    out = None
    for width, n in sorted(asked.items()):
        near = _meet(index, anchors.withColumn("ranges", ranges), width, sizes[width], n, positives, True)
        near = saved(near.select("anchor", F.col("rank").alias("place"), "id", "score"), "positives")
        wanted = near.groupBy(F.col("anchor").alias("id")).agg(F.collect_list(F.struct("place", "score")).alias("ranges"))
        far = _meet(index, anchors.join(wanted, "id"), width, sizes[width], n, negatives, False)
        named = near.withColumnsRenamed({"id": "positive_id", "score": "positive_score"})
        found = far.join(named, ["anchor", "place"]).select(
            F.col("anchor").alias("anchor_id"),
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        out = vectors.sparkSession.createDataFrame([], kind)
    return out


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""
