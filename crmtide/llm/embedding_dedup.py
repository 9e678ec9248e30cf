"""Near-duplicate embeddings: product quantisation over inverted lists, exact cosine rerank."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.llm.common import hash_sample, saved, table
from crmtide.llm.components import components

THRESHOLD = 0.93
SAMPLE = 8192
SUBSPACES, CODES = 8, 256
#: Part of the link radius within which the border to another list makes that list be probed. Of two linked
#: vectors on both sides of a border, one lies within half the radius of it, so every link is met.
MARGIN = 0.5
BLOCK, VISITORS, QUERIES = 2048, 32768, 512


def k_means(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(1)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(points @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)
        sums, counts = np.zeros_like(centres), np.bincount(nearest, minlength=len(centres))
        np.add.at(sums, nearest, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


class Model:
    """Coarse centres of unit vectors and codebooks of the residuals' subspaces, from a bounded sample."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        self.centres = k_means(sample, lists)
        residuals = sample - self.centres[self.nearest(sample)]
        self.cuts = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        self.books = [k_means(residuals[:, a:b], CODES) for a, b in zip(self.cuts[:-1], self.cuts[1:])]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return np.argmax(x @ self.centres.T - (self.centres**2).sum(axis=1) / 2, axis=1)

    def probes(self, x: np.ndarray, own: np.ndarray, radius: float) -> np.ndarray:
        """Lists (a column each) whose border lies nearer to a vector than the margin of the radius."""
        d = (self.centres**2).sum(axis=1) - 2 * (x @ self.centres.T)
        apart = np.sqrt(((self.centres[:, None] - self.centres[None]) ** 2).sum(axis=2))[own]
        return d - d[np.arange(len(x)), own][:, None] <= 2 * MARGIN * radius * apart + 1e-9

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, length of what they leave out) of residuals."""
        codes, left = np.empty((len(residuals), len(self.books)), np.uint8), np.zeros(len(residuals))
        for m, book in enumerate(self.books):
            part = residuals[:, self.cuts[m] : self.cuts[m + 1]]
            codes[:, m] = np.argmax(part @ book.T - (book**2).sum(axis=1) / 2, axis=1)
            left += ((part - book[codes[:, m]]) ** 2).sum(axis=1)
        return codes, np.sqrt(left)

    def distances(self, residuals: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distances between query residuals and coded ones, from one table of each query per subspace."""
        out = np.zeros((len(residuals), len(codes)), np.float32)
        for m, book in enumerate(self.books):
            part = residuals[:, self.cuts[m] : self.cuts[m + 1]]
            own = (part**2).sum(axis=1)[:, None] - 2 * part @ book.T + (book**2).sum(axis=1)
            out += own.astype(np.float32)[:, codes[:, m]]
        return np.sqrt(np.maximum(out, 0))


def _unit(vectors) -> np.ndarray:
    x = np.stack(list(vectors)).astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _lister(model: Model, radius: float) -> Callable:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column(2).to_numpy(zero_copy_only=False))
            own = model.nearest(x)
            near = model.probes(x, own, radius)
            near[np.arange(len(x)), own] = False
            others = [np.nonzero(row)[0] for row in near]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own, pa.int32()), pa.array(others, pa.list_(pa.int32()))],
                ["id", "label", "v", "copies", "list", "probes"],
            )

    return place


def _forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple]:
    """Edges that connect what ``links`` connects: every row and column to the smallest of its component."""
    low_left, low_right = left.copy(), right.copy()
    most = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(low_left, np.where(links, low_right[None, :], most).min(axis=1))
        new_right = np.minimum(low_right, np.where(links, new_left[:, None], most).min(axis=0))
        if (new_left == low_left).all() and (new_right == low_right).all():
            break
        low_left, low_right = new_left, new_right
    return [(a, b) for ids, low in ((left, low_left), (right, low_right)) for a, b in zip(ids, low) if a != b]


def _linker(model: Model, threshold: float, radius: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        stored = pdf[pdf["stored"]]
        out: list[tuple] = []
        if len(stored):
            y, y_ids, y_copies = _unit(stored["v"]), stored["id"].to_numpy(), stored["copies"].to_numpy()
            here = int(stored["list"].iloc[0])
            centre = model.centres[here]
            codes, left_out = model.encode(y - centre)
            y_asks = model.probes(y, np.full(len(y), here), radius)
            y_links = np.zeros(len(y), np.int64)
            asking = pdf[pdf["asks"]]
            for at in range(0, len(asking), QUERIES):
                some = asking.iloc[at : at + QUERIES]
                x, x_ids, x_copies = _unit(some["v"]), some["id"].to_numpy(), some["copies"].to_numpy()
                likely = model.distances(x - centre, codes) <= (radius + left_out + 1e-3)[None, :]
                # Two of the same block meet twice: the smaller id asks.
                likely &= ~some["same"].to_numpy()[:, None] | (x_ids[:, None] < y_ids[None, :])
                # Two that ask each other's list meet twice: the one from the earlier list counts.
                home = some["home"].to_numpy()
                likely &= ~((home > here)[:, None] & y_asks[:, home].T)
                rows, columns = np.nonzero(likely.any(axis=1))[0], np.nonzero(likely.any(axis=0))[0]
                if not len(rows):
                    continue
                links = (x[rows] @ y[columns].T >= threshold) & likely[np.ix_(rows, columns)]
                y_links[columns] += links.T @ x_copies[rows]
                out += [(i, None, n) for i, n in zip(x_ids[rows], links @ y_copies[columns]) if n]
                out += [(a, b, 0) for a, b in _forest(links, x_ids[rows], y_ids[columns])]
            out += [(i, None, n) for i, n in zip(y_ids, y_links) if n]
        found = pd.DataFrame(out, columns=["a", "b", "n"])
        return found.astype({"a": "int64", "b": "Int64", "n": "int64"})

    return link


def _pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): links (b not NULL) that connect linked classes, and the number of vectors linked with a."""
    radius = float(np.sqrt(2 - 2 * threshold))
    n = classes.count()
    sample = hash_sample(classes.select("id", "v"), ["id"], SAMPLE).select("v").toArrow()["v"]
    model = Model(_unit(sample.to_numpy()), int(np.clip(np.sqrt(n) / 8, 1, 1024)))
    kind = classes.schema["v"].dataType.simpleString()
    schema = f"id long, label string, v {kind}, copies long, list int, probes array<int>"
    placed = saved(classes.select("id", "label", "v", "copies").mapInArrow(_lister(model, radius), schema), "lists")
    sizes = placed.groupBy("label", "list").agg(F.count(F.lit(1)).alias("m"))
    labels = sizes.groupBy("label").agg(F.sum("m").alias("of_label"))
    sizes = sizes.join(labels, "label").select(
        "label",
        "list",
        F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.col("of_label") / VISITORS).cast("int").alias("parts"),
    )
    at = placed.join(sizes, ["label", "list"]).withColumns(
        {
            "block": F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"),
            "part": F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int"),
        }
    )
    none, one = F.lit(False), F.lit(True)
    names = ["label", "list", "block", "part", "id", "v", "copies", "home", "stored", "asks", "same"]
    home = at.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "label", "list", "block", F.col("to").alias("part"), "id", "v", "copies", F.col("list").alias("home"),
        one.alias("stored"), (F.col("to") == F.col("part")).alias("asks"), one.alias("same"),
    )
    beside = (
        at.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .filter("to > block")
        .select(
            "label", "list", F.col("to").alias("block"), "part", "id", "v", "copies", F.col("list").alias("home"),
            none.alias("stored"), one.alias("asks"), none.alias("same"),
        )
    )
    visits = at.select("label", F.col("list").alias("home"), F.explode("probes").alias("list"), "part", "id", "v", "copies")
    visits = visits.join(sizes.select("label", "list", "blocks"), ["label", "list"])
    visits = visits.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "list", "block", "part", "id", "v", "copies", "home",
        none.alias("stored"), one.alias("asks"), none.alias("same"),
    )
    met = reduce(DataFrame.unionByName, [home.select(*names), beside.select(*names), visits.select(*names)])
    by = met.groupBy("label", "list", "block", "part")
    return saved(by.applyInPandas(_linker(model, threshold, radius), "a long, b long, n long"), "vector-links")


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) for each row of ``vectors``.

    Two vectors link when their labels are equal and their cosine, in double
    precision, is ``threshold`` or more. Equal vectors of a label are one class
    that counts as often as it occurs. The index is fitted on ``SAMPLE`` vectors
    and holds all of them: a vector is kept in the list of its nearest centre as
    codes of its residual. It asks its own list and each other one whose border
    is near enough that a link may cross it; a code's distance plus what the code leaves out decides whether the
    pair's exact cosine is computed, so that step misses nothing. Vectors that
    are NULL, empty, zero or hold a NULL or a non-finite component, rows without
    label and rows without id (component NULL) link with nothing and are kept.
    Vectors of different lengths do not link. Rows that repeat an id are all
    returned. Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).alias("_v"),
    )
    single = vectors.schema[vector_column].dataType.elementType.simpleString() == "float"
    parts = F.transform("_v", lambda x: x.cast("float" if single else "double"))
    big = F.lit(float("inf"))
    fit = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)) & F.exists("_v", lambda x: x != 0)
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fit, F.lit(False))
    rows = rows.select("id", "label", F.when(usable, parts).alias("v"))
    linked = rows.filter("v is not null").withColumn("width", F.size("v"))
    classes = linked.groupBy("label", "width", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = saved(classes, "vector-classes")
    found = [_pairs(classes.filter(F.col("width") == w["width"]), threshold) for w in classes.select("width").distinct().collect()]
    if not found:
        links = classes.select("id", F.lit(None).cast("long").alias("component"), F.lit(0).alias("more"))
    else:
        pairs = reduce(DataFrame.unionByName, found)
        counts = pairs.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("more"))
        roots = components(pairs.filter("b is not null").select("a", "b")).withColumnRenamed("node", "id")
        links = classes.select("id").distinct().join(counts, "id", "left").join(roots, "id", "left")
    of_class = classes.select("label", "v", F.col("id").alias("class"), "copies").join(
        links.withColumnRenamed("id", "class"), "class"
    )
    named = rows.join(of_class, ["label", "v"], "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "class", "id"))
    return named.select(
        F.col("id").alias(id_column),
        F.coalesce(F.col("copies") - 1 + F.coalesce("more", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.col("id").eqNullSafe(own).alias("kept"),
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS c FROM embeddings UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a),
c AS (SELECT a, min(c) AS c FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""
