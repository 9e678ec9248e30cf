"""File and partitioned-table writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmtide import schemas as S


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together before a partitioned write.

    A rebalance, not a repartition: adaptive execution splits a partition value
    that holds too much data over several tasks and merges the small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_silver(df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Append to a table partitioned by event hour."""
    writer = clustered(df, S.EVENT_HOUR).write.format(fmt).mode("append").partitionBy(*S.EVENT_HOUR)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_quarantine(bad: DataFrame, path: str, entity: str) -> None:
    clustered(bad, S.EVENT_HOUR).write.mode("append").partitionBy(*S.EVENT_HOUR).parquet(
        f"{path.rstrip('/')}/{entity}"
    )


def write_partitioned(df: DataFrame, root: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """Parquet in Hive layout; the partition columns live in the path only."""
    clustered(df, columns).write.mode(mode).partitionBy(*columns).parquet(root)


def write_bronze(df: DataFrame, root: str, entity: str, columns: Sequence[str] = tuple(S.EVENT_HOUR)) -> None:
    """JSON lines in Hive layout, one folder per entity."""
    clustered(df, columns).write.mode("append").partitionBy(*columns).json(f"{root.rstrip('/')}/{entity}")


def write_export(df: DataFrame, leaf: str, single_file: bool = False, max_records_per_file: int = 5_000_000) -> None:
    """Snappy Parquet into one leaf folder, replacing what it held.

    ``single_file`` funnels the leaf through one task: for small leaves only.
    """
    df = df.coalesce(1) if single_file else df.hint("rebalance")
    (
        df.write.mode("overwrite")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", 0 if single_file else max_records_per_file)
        .parquet(leaf)
    )
