"""Shards that each hold the mixture of the whole: proportional stratified interleaving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.llm.common import hex_bucket, partitions, positions, saved, shuffle_key, table

SHARDS = 40
SEED = "interleave-1"


def interleave(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: str = SEED,
    id_column: str = "doc_id",
    source_column: str = "source",
    ties: Sequence[str] = (),
) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (place in the shard, gapless from 0).

    The rows of a source are shuffled by seed and ranked; row r of n stands at
    (r - 1/2) / n. All rows in the order of these fractions are cut into shards
    whose counts differ by one at most, so each shard has each source's share to
    within one row. A NULL source is a source of its own. Rows with a NULL id or
    a repeated one are placed like others; ``ties`` names the columns that tell
    them apart, and rows equal in those too may change places. Columns of the
    input named shard or slot are replaced. An empty table gives no rows.
    """
    buckets = 4 * partitions(docs.sparkSession)
    named = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit("")).alias("_source"),
        shuffle_key(seed, id_column, *ties).alias("_key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")]).alias("_row"),
    ).withColumn("_b", hex_bucket("_key", buckets))
    ranked = positions(named, "_source", "_b", ["_key"]).select(
        "_row",
        "_key",
        "_source",
        F.lit(0).alias("_all"),
        ((2 * F.col("_rank") - 1) / (2 * F.col("_n"))).alias("_at"),
        F.expr(f"int((2 * _rank - 1) * {buckets} div (2 * _n))").alias("_c"),
    )
    placed = positions(ranked, "_all", "_c", ["_at", "_key", "_source"])
    shard = F.expr(f"int((_rank - 1) * {shards} div _n)")
    return placed.select(
        "_row.*",
        shard.alias("shard"),
        (F.col("_rank") - 1 - F.expr(f"(int((_rank - 1) * {shards} div _n) * _n + {shards} - 1) div {shards}")).alias(
            "slot"
        ),
    )


def write_shards(placed: DataFrame, path: str, shards: int = SHARDS) -> None:
    """A folder per shard with its rows in the order of their slots; a shard is split where its rows are many."""
    placed.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = interleave(saved(docs, "sizes"), ties=["text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


ORACLE = r"""
WITH RECURSIVE g(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM g WHERE k < 8),
t AS (SELECT list(c ORDER BY i) AS tab FROM g WHERE k = 8),
d AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 16 AS size, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda h: ('0x' || h)::BIGINT)),
    lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1]))) AS text_crc32
  FROM documents, t),
k AS (SELECT *, coalesce('=' || source, '') AS s,
  md5(concat_ws('|', 'interleave-1', coalesce(doc_id::VARCHAR, '-'), text_crc32::VARCHAR)) AS key FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY key) AS r, count(*) OVER (PARTITION BY s) AS n FROM k),
p AS (SELECT *, row_number() OVER (ORDER BY (2 * r - 1) / (2 * n), key, s) - 1 AS p, count(*) OVER () AS m FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p * 40 // m)::INTEGER AS shard,
  p - ((p * 40 // m) * m + 39) // 40 AS slot, NULL::INTEGER AS grown_shard
FROM p
"""
