"""Exact top-k inner products by reading sorted lists without random access."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crmtide.llm.common import saved, table

BLOCK = 4096
QUERY_BLOCK = 1024
#: Steps in which the lists are read; after each, the bounds are looked at.
STEPS = 8


def scan(queries: np.ndarray, vectors: np.ndarray, k: int, steps: int = STEPS) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For each query (rows, scores, step it stopped at): its ``k`` largest inner products and all that tie with the last.

    A list holds the rows in the order of one component. It is read from the
    large end where a query's component is positive, from the small end where it
    is negative, all lists to the same depth, a step at a time; what was read of
    a row is added up. Its score lies between that sum plus the least, and plus
    the most, that the unread part of every other list allows. A query stops when
    no row but a few (4 k) can reach the k-th of the least scores; the scores of
    those few are then resolved. With the last step all lists are read, and the
    sums are the scores. The additions for a block of queries are products of
    matrices.
    """
    n, found = len(vectors), [None] * len(queries)
    rank = np.argsort(np.argsort(vectors, axis=0, kind="stable"), axis=0)
    ordered, v = np.sort(vectors, axis=0), vectors.astype(np.float64)
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    left, read, before = np.arange(len(queries)), np.zeros((n, len(queries))), 0
    for step in range(1, steps + 1):
        to = n * step // steps
        p, q = up[left], down[left]
        read += (v * ((rank >= n - to) & (rank < n - before))) @ p.T + (v * ((rank < to) & (rank >= before))) @ q.T
        before = to
        if to == n:
            bounds = np.partition(read, n - k, axis=0)[n - k] if n > k else np.full(len(left), -np.inf)
            for at, score, bound in zip(left, read.T, bounds):
                rows = np.nonzero(score >= bound)[0]
                found[at] = (rows, score[rows].astype(np.int64), step)
            break
        if n <= k or not to:
            continue
        large, small = (rank >= n - to).astype(np.float64), (rank < to).astype(np.float64)

        def unread(of_large: np.ndarray, of_small: np.ndarray) -> np.ndarray:
            most_p, most_q = p * of_large, q * of_small
            return most_p.sum(axis=1) + most_q.sum(axis=1) - large @ most_p.T - small @ most_q.T

        least = read + unread(ordered[0], ordered[-1])
        bound = np.partition(least, n - k, axis=0)[n - k]
        open_ = read + unread(ordered[n - to - 1], ordered[to]) >= bound
        ended = open_.sum(axis=0) <= 4 * k
        for at in np.nonzero(ended)[0]:
            rows = np.nonzero(open_[:, at])[0]
            found[left[at]] = (rows, vectors[rows] @ queries[left[at]], step)
        left, read = left[~ended], read[:, ~ended]
        if not len(left):
            break
    return found


def _searcher(k: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        data, asked = pdf[~pdf["asks"]], pdf[pdf["asks"]]
        out = []
        if len(data) and len(asked):
            vectors = np.stack(data["v"].to_numpy()).astype(np.int64)
            ids, query_ids = data["id"].to_numpy(), asked["id"].to_numpy()
            own = int(np.unique(ids[np.isin(ids, query_ids)], return_counts=True)[1].max(initial=0))
            for at in range(0, len(asked), 256):
                queries = np.stack(asked["v"].iloc[at : at + 256].to_numpy()).astype(np.int64)
                for query_id, (rows, score, _) in zip(query_ids[at : at + 256], scan(queries, vectors, k + own)):
                    other = ids[rows] != query_id
                    rows, score = rows[other], score[other]
                    best = np.lexsort((ids[rows], -score))[:k]
                    out += [(query_id, ids[r], s) for r, s in zip(rows[best], score[best])]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return search


def whole(vector: str, scale: int) -> Column:
    """Components times ``scale``, rounded down; NULL where one is NULL or not finite."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    fit = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fit & (F.size(parts) > 0), F.transform(parts, lambda x: F.floor(x * scale)))


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other rows for each row whose id ``every`` divides.

    Scores are inner products of whole numbers, ties go to the smaller id. Rows
    whose id or vector is NULL or whose vector is empty or holds a NULL or a
    non-finite component take no part; nor do pairs of vectors of different
    lengths. Of rows that repeat an id, none is a candidate for a query of that
    id, each is one for others, and the query is asked once for each of them but
    answered as one. Other columns are ignored; an empty table gives no rows. Queries and rows meet in
    blocks: each block of rows sorts its lists once for a block of queries and
    gives k rows per query.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), whole(vector_column, scale).alias("v"))
    rows = saved(rows.filter("id is not null and v is not null").withColumn("width", F.size("v")), "whole-vectors")
    n = rows.count()
    blocks, query_blocks = max(1, -(-n // BLOCK)), max(1, -(-n // every // QUERY_BLOCK))
    data = rows.withColumns(
        {
            "block": F.pmod(F.xxhash64("id", "v"), F.lit(blocks)),
            "ask": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))),
            "asks": F.lit(False),
        }
    )
    asked = rows.filter(F.col("id") % every == 0).dropDuplicates(["id", "v"])
    asked = asked.withColumns(
        {
            "ask": F.pmod(F.xxhash64("id", "v", F.lit(1)), F.lit(query_blocks)).cast("int"),
            "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))),
            "asks": F.lit(True),
        }
    )
    names = ["width", "ask", "block", "asks", "id", "v"]
    met = data.select(*names).unionByName(asked.select(*names))
    found = met.groupBy("width", "ask", "block").applyInPandas(_searcher(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
