"""Near-duplicate documents: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType

from crmtide.llm.common import lean, saved, table
from crmtide.llm.components import components
from crmtide.llm.words import lower_bytes, lowered, mix, sets, similar

BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
# Two sets of similarity 0.75 agree in 96 of 128 coordinates on average, with a deviation below 5.
LEAST_AGREEING = 70
BLOCK = 256
_EMPTY = np.uint64(2**64 - 1)
_CHUNK = 2_000_000


def sketch(shingle_sets: Sequence[np.ndarray], size: int = COORDINATES) -> np.ndarray:
    """A row of ``size`` coordinates per set; two sets agree in one with their Jaccard similarity.

    In round i < ``size`` every element is hashed to one bin, with a value in
    [i, i+1); a bin keeps its smallest value. Texts whose bins are all filled
    leave after that round, which for a set larger than ``size`` log ``size`` is
    the first one mostly. Round ``size`` + j puts every element into bin j, so
    that after twice ``size`` rounds no bin of any set with an element is empty.
    """
    lengths = np.array([len(s) for s in shingle_sets], np.int64)
    out = np.full((len(shingle_sets), size), _EMPTY)
    element = np.concatenate([np.empty(0, np.uint64), *shingle_sets])
    owner = np.repeat(np.arange(len(shingle_sets)), lengths)
    flat = out.reshape(-1)
    for i in range(2 * size):
        if not len(element):
            break
        h = mix(element, 1000 + i)
        to = (h >> np.uint64(40)).astype(np.int64) % size if i < size else np.int64(i - size)
        np.minimum.at(flat, owner * size + to, np.uint64(i << 32) | (h & np.uint64(0xFFFFFFFF)))
        active = np.unique(owner)
        open_ = np.zeros(len(shingle_sets), bool)
        open_[active] = (out[active] == _EMPTY).any(axis=1)
        stay = open_[owner]
        element, owner = element[stay], owner[stay]
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(coordinates), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = mix(keys ^ mix(coordinates[:, k::ROWS]))
    return keys


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, texts in lowered(batch.column(1), _CHUNK):
            found = sets(texts)
            coordinates = sketch(found)
            marks = (mix(coordinates) & np.uint64(255)).astype(np.uint8)
            keys = band_keys(coordinates).view(np.int64).reshape(-1)
            prints = [[int(mix(s, k).sum(dtype=np.uint64).view(np.int64)) for s in found] for k in (7001, 7002)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array(prints[0], pa.int64()),
                    pa.array(prints[1], pa.int64()),
                    pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * BANDS, keys),
                    pa.array([m.tobytes() for m in marks], pa.binary()),
                ],
                ["id", "n", "f0", "f1", "bands", "marks"],
            )


def _same_marks(a: pd.Series, b: pd.Series) -> pd.Series:
    left, right = (np.frombuffer(b"".join(x), np.uint8).reshape(-1, COORDINATES) for x in (a, b))
    return pd.Series((left == right).sum(axis=1).astype(np.int32))


# Otherwise a filter on the number counts it again, in workers of its own.
_agreeing = F.pandas_udf(_same_marks, IntegerType()).asNondeterministic()


@F.pandas_udf(BooleanType())
def _verified(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(lower_bytes(a), lower_bytes(b)):
        out.append(similar(*sets([x, y])))
    return pd.Series(out, dtype=bool)


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole shingle sets are similar enough; ``texts``: (id, text), an id once."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("_ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("_tb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.filter(_verified("_ta", "_tb")).select("a", "b")


def _across(pdf: pd.DataFrame) -> pd.DataFrame:
    """Verified links between documents of one block or two that are not connected yet.

    A pair is compared at the first band value it shares only. What is found to
    be linked counts as connected from then on.
    """
    first = pdf[pdf["block"] == pdf["i"]].sort_values("id")
    second = pdf[pdf["block"] == pdf["j"]].sort_values("id")
    band, alone = pdf["band"].iloc[0], pdf["i"].iloc[0] == pdf["j"].iloc[0]
    marks, bands = (np.frombuffer(b"".join(second["marks"]), np.uint8).reshape(-1, COORDINATES), np.stack(second["bands"]))
    ids, part, n = (second[c].to_numpy() for c in ("id", "component", "n"))
    known: dict[int, np.ndarray] = {}
    texts = dict(zip(pdf["id"], pdf["text"]))

    def whole(i: int) -> np.ndarray:
        if i not in known:
            known[i] = sets(lower_bytes([texts[i]]))[0]
        return known[i]

    merged: dict[int, int] = {}

    def root(c: int) -> int:
        while c in merged:
            c = merged[c]
        return c

    found = []
    for x, c, m, mark, keys in zip(*(first[k] for k in ("id", "component", "n", "marks", "bands"))):
        near = (marks == np.frombuffer(mark, np.uint8)).sum(axis=1) >= LEAST_AGREEING
        near &= (part != c) & (ids > x if alone else ids != x) & (4 * np.minimum(n, m) >= 3 * np.maximum(n, m))
        near[near] = (bands[near] == keys).argmax(axis=1) == band
        for at in np.nonzero(near)[0]:
            if root(c) != root(part[at]) and similar(whole(x), whole(ids[at])):
                found.append((x, ids[at]))
                merged[root(c)] = root(part[at])
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _with_component(df: DataFrame, parts: DataFrame, node: str) -> DataFrame:
    """Adds ``component``: the node itself where it has no link."""
    named = parts.withColumnsRenamed({"node": "_node"})
    return (
        df.join(named, F.col(node) == F.col("_node"), "left")
        .withColumn("component", F.coalesce("component", F.col(node)))
        .drop("_node")
    )


def link_classes(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component) of all classes (id, n, bands, marks) that have a verified link.

    A band value joins each of its classes to the smallest of them, not all to
    each other. First the likeliest pair of a class is verified, then those of
    its other pairs that still lie in two components. In the end, values whose
    classes are not all connected are taken in blocks, in which likely pairs
    across components are verified at once: so each pair that shares a band value
    is verified, connected already or unlike by its sketch, and no list of all
    pairs is made.
    """
    keys = classes.select("id", F.posexplode("bands").alias("band", "value")).select(
        "id", "band", F.xxhash64("band", "value").alias("key")
    )
    hubs = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top")).filter("hub <> top").drop("top")
    members = saved(keys.join(hubs, "key"), "members")
    marks = classes.select("id", "marks")
    stars = members.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    likely = (
        stars.join(marks.withColumnsRenamed({"id": "a", "marks": "ma"}), "a")
        .join(marks.withColumnsRenamed({"id": "b", "marks": "mb"}), "b")
        .select("a", "b", _agreeing("ma", "mb").alias("agreeing"))
        .filter(F.col("agreeing") >= LEAST_AGREEING)
    )
    likely = saved(likely, "likely")
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("agreeing", -F.col("a"))).alias("a")).select("a", "b")
    links = saved(verify(best, texts), "verified")
    parts = saved(components(links), "parts")

    rest = _with_component(_with_component(likely, parts, "a").withColumnRenamed("component", "ca"), parts, "b")
    rest = rest.filter("ca <> component").select("a", "b").join(best, ["a", "b"], "left_anti")
    links = links.unionByName(saved(verify(rest, texts), "verified"))
    parts = saved(components(links), "parts")

    others = _with_component(members.filter("id <> hub"), parts, "id")
    split = (
        others.groupBy("key")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("m"))
        .filter("x <> y")
        .select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    )
    dealt = (
        others.join(split, "key")
        .join(classes.select("id", "n", "bands", "marks"), "id")
        .join(texts, "id")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )
    far = saved(dealt.groupBy("key", "i", "j").applyInPandas(_across, "a long, b long").distinct(), "far")
    if far.isEmpty():
        return parts
    return components(links.unionByName(far))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``.

    Words are cut at ASCII white space, A-Z lowered; a text's set holds its
    distinct five-word shingles, or its whole sequence if it has fewer words.
    Texts link when 100 * intersection >= 75 * union. Equal sets form a class and
    are compared once. A text that is NULL or without words has an empty set and
    links with nothing, as does a row without id (component NULL, kept). Rows
    that repeat an id are all returned; an empty table gives no rows. Any other
    columns are ignored. Ids are integers.
    """
    base = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = "id long, n long, f0 long, f1 long, bands array<long>, marks binary"
    sketches = saved(base.mapInArrow(lean(_sketches), schema), "sketches")
    classes = (
        sketches.filter("n > 0 and id is not null")
        .groupBy("f0", "f1", "n")
        .agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("marks").alias("marks"))
    )
    classes = saved(classes, "classes")
    known = classes.select("id").distinct()
    texts = base.filter("id is not null").join(known, "id", "left_semi")
    parts = link_classes(classes, texts)
    labelled = _with_component(classes.select("f0", "f1", "n", "id"), parts, "id").drop("id")
    named = sketches.select("id", "n", "f0", "f1").join(labelled, ["f0", "f1", "n"], "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return named.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.col("id").eqNullSafe(own).alias("kept"),
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
    ELSE array_to_string(ws[i:i + 4], ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
e AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.both >= 75 * (x.n + y.n - p.both)),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a),
c AS (SELECT a, min(c) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""
