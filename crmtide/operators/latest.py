"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_ORDER = ("loaded_at", "exported_at", "src_filename")


def _tie_break(df: DataFrame) -> Column:
    """Row content, so that a full tie is settled the same way on every run."""
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*plain)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = LOAD_ORDER,
    method: str = "window",
) -> DataFrame:
    """Keep the row with the greatest ``order`` columns of every key.

    A NULL counts as the greatest value, as in the warehouse's descending sort.

    ``window``: the rank filter lets Spark cut every map partition down to one
    row per key before the shuffle, so a hot key costs its reducer one row per
    map task. ``aggregate``: the same through ``max_by``.
    """
    order = [c for c in order if c in df.columns]
    if method == "window":
        by = [F.col(c).desc_nulls_first() for c in order] + [_tie_break(df).desc()]
        ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
        return ranked.filter(F.col("_rank") == 1).drop("_rank")
    if method == "aggregate":
        rank = [c for o in order for c in (F.col(o).isNull().alias(f"_n_{o}"), F.col(o).alias(f"_o_{o}"))]
        rank.append(_tie_break(df).alias("_tie"))
        values = [c for c in df.columns if c not in keys]
        best = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*rank)).alias("_row"))
        return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    raise ValueError(f"unknown method {method!r}")
