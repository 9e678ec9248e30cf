"""Catalog lifecycle: databases, landing tables, views and materialised models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from crmtide import schemas as S
from crmtide.sinks.files import clustered


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def location(spark: SparkSession, table: str) -> str:
    """The folder that holds a table's files."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    return found["data_type"]


def create_landing(spark: SparkSession, table: str, name: str, fmt: str = "parquet") -> None:
    """Create or replace an empty typed landing table."""
    empty = spark.createDataFrame([], S.landing_table_schema(name))
    empty.write.format(fmt).mode("overwrite").saveAsTable(table)


def append_landing(df: DataFrame, table: str, full_refresh: bool = False) -> None:
    """Add loaded rows, or replace the table's content with them."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table, overwrite=full_refresh)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_view(
    spark: SparkSession,
    view: str,
    columns: Sequence[str],
    source: str,
    comment: str,
    column_docs: Mapping[str, str] = S.COLUMN_DOCS,
) -> None:
    """A view of the database over a table, with its documentation; it reads what the table holds when it is asked."""
    query = f"SELECT {', '.join(columns)} FROM {source}"
    named = ", ".join(
        f"`{c}`" + (f" COMMENT {_quoted(column_docs[c])}" if c in column_docs else "") for c in spark.sql(query).columns
    )
    spark.sql(f"CREATE OR REPLACE VIEW {view} ({named}) COMMENT {_quoted(comment)} AS {query}")


def with_docs(df: DataFrame, column_docs: Mapping[str, str]) -> DataFrame:
    """Attach column comments, which table creation stores in the catalog."""
    for name, text in column_docs.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": text})
    return df


def materialize(
    df: DataFrame,
    table: str,
    comment: str | None = None,
    column_docs: Mapping[str, str] = S.COLUMN_DOCS,
    fmt: str = "parquet",
    partitions: Sequence[str] = (),
) -> None:
    """Replace a table by the model's current result, with its documentation."""
    df = clustered(df, partitions) if partitions else df
    writer = with_docs(df, column_docs).write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(table)
    if comment:
        df.sparkSession.sql(f"COMMENT ON TABLE {table} IS {_quoted(comment)}")
