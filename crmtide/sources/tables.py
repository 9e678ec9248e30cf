"""Catalog tables as sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def register_external(
    spark: SparkSession, name: str, schema: T.StructType, partitions: Sequence[str], path: str
) -> None:
    """Declare a partitioned Parquet table over existing files."""
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {name} ({_ddl(schema)}) USING PARQUET {by} LOCATION '{path}'")


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Register the partition directories found under the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
