"""Sources mixed to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crmtide.llm.common import WORD, hex_bucket, partitions, positions, saved, shuffle_key, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
COPIES = 2
SEED = "mix-1"


def words(column: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def targets(docs: DataFrame, weights: Sequence[int], share: float, copies: int) -> DataFrame:
    """(_source, source_size, target): ``share`` of all sizes by weight, no source above ``copies`` times its own.

    What a source can't take goes to the others by weight. The level at which
    this ends is the highest of those that any number of full sources leaves:
    (budget - their caps) / (weights of the others), sources in the order of
    cap / weight. One row per source is all that is ordered here.
    """
    by = docs.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    n = len(weights)
    place = F.row_number().over(Window.orderBy((F.col("_source") == "").cast("int"), "_source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(place - 1, F.lit(n)) + 1)
    by = by.withColumn("_weight", weight).withColumn("_cap", copies * F.col("source_size"))
    full = Window.orderBy(F.col("_cap") / F.col("_weight"), (F.col("_source") == "").cast("int"), "_source")
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.lit(share) * F.sum("source_size").over(whole)
    left = budget - (F.sum("_cap").over(full) - F.col("_cap"))
    others = F.sum("_weight").over(whole) - (F.sum("_weight").over(full) - F.col("_weight"))
    level = F.max("_level").over(whole)
    return (
        by.withColumn("_level", left / others)
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_weight") * level))
        .select("_source", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    size_column: str = "size",
    id_column: str = "doc_id",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    copies: int = COPIES,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``times``, how often the mix takes the row (0 to ``copies``).

    Every source is shuffled by seed and laid out ``copies`` times in turn. A
    row's virtual finish time is its source's size up to and with it, divided by
    the source's target; all rows in the order of their finish times are taken
    as long as their sizes together stay within the budget. So no source runs
    ahead of its share by more than a row. Sources are weighted in the order of
    code points, NULL last, ``weights`` in turn. Sizes are whole numbers; NULL
    is 0, and a source without any size has target 0. Rows with a NULL or
    repeated id are rows like others; equal ones get the same finish time. Input
    columns of the three names are replaced. An empty table gives no rows.
    """
    buckets = 4 * partitions(docs.sparkSession)
    made = ("source_size", "target", "times")
    named = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit("")).alias("_source"),
        F.coalesce(F.col(size_column).cast("long"), F.lit(0)).alias("_size"),
        shuffle_key(seed, id_column, size_column).alias("_key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in made]).alias("_row"),
    ).withColumn("_b", hex_bucket("_key", buckets))
    queued = positions(named, "_source", "_b", ["_key"], "_size", targets(named, weights, share, copies))

    def finish(copy) -> Column:
        return F.coalesce(F.try_divide(F.col("_run") + copy * F.col("_sum"), F.col("target")), F.lit(0.0))

    turns = queued.select(
        F.lit(0).alias("_all"),
        "_source",
        "_key",
        "_size",
        F.explode(F.array(*[finish(c) for c in range(copies)])).alias("_finish"),
    )
    turns = turns.withColumn("_c", F.floor(buckets * F.col("_finish") / (1 + F.col("_finish"))).cast("int"))
    order = ["_finish", "_source", "_key"]
    placed = positions(turns, "_all", "_c", order, "_size")
    taken = placed.filter(F.col("_run") <= F.lit(share) * F.col("_sum") / copies)
    last = taken.agg(F.max(F.struct(*order)).alias("last")).first()["last"]
    if last is None:
        times = F.lit(0)
    else:
        end = F.struct(*[F.lit(last[c]).alias(c) for c in order])
        times = sum(
            F.when(F.struct(finish(c).alias("_finish"), F.col("_source"), F.col("_key")) <= end, 1).otherwise(0)
            for c in range(copies)
        )
    return queued.select("_row.*", "source_size", "target", times.cast("int").alias("times"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = saved(docs.select("doc_id", "source", words("text").alias("size")), "sizes")
    mixed = mix(sized)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce('=' || source, '') AS s,
  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
k AS (SELECT *, md5(concat_ws('|', 'mix-1', coalesce(doc_id::VARCHAR, '-'), size::VARCHAR)) AS key FROM d),
w AS (SELECT s, sum(size)::BIGINT AS ss, [3, 1, 2][(row_number() OVER (ORDER BY s = '', s) - 1) % 3 + 1] AS w
  FROM k GROUP BY s),
l AS (SELECT *, (1.5::DOUBLE * (sum(ss) OVER ())::DOUBLE - (sum(2 * ss) OVER o - 2 * ss)::DOUBLE)
    / (sum(w) OVER () - (sum(w) OVER o - w))::DOUBLE AS lev
  FROM w WINDOW o AS (ORDER BY 2 * ss / w::DOUBLE, s = '', s)),
t AS (SELECT *, least((2 * ss)::DOUBLE, w * max(lev) OVER ()) AS target FROM l),
q AS (SELECT k.*, t.ss, t.target, sum(size) OVER (PARTITION BY k.s ORDER BY key) AS run FROM k JOIN t ON k.s = t.s),
c AS (SELECT q.*, CASE WHEN target = 0 THEN 0 ELSE (run + c * ss)::DOUBLE / target END AS finish
  FROM q, range(2) r(c)),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, s, key) AS total, sum(ss) OVER () AS x FROM c),
b AS (SELECT 1.5::DOUBLE * sum(size) AS budget FROM k)
SELECT doc_id, size, ss AS source_size, target,
  sum(CASE WHEN total <= budget THEN size ELSE 0 END)::BIGINT AS taken
FROM g, b GROUP BY doc_id, size, ss, target
"""
