"""JSON-lines scan of change-record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from crmtide import schemas as S
from crmtide.functions.casts import cast_to

CORRUPT = "_corrupt_record"


def text_schema(entity: str, keep_corrupt: bool = False) -> T.StructType:
    """Every declared field as text: no inference pass, and no field can fail to parse."""
    names = [f.name for f in S.ENTITY_SCHEMAS[entity]] + ([CORRUPT] if keep_corrupt else [])
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_bronze(
    spark: SparkSession,
    entity: str,
    path: str,
    with_path_cols: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """One entity's files, fields as text; undeclared fields are dropped.

    A malformed line becomes an all-NULL row, which the required-field check
    quarantines. The hour of the directory is load time, not event time, so the
    path columns are only added on request.
    """
    schema = text_schema(entity, keep_corrupt)
    df = spark.read.schema(schema).option("multiLine", False).json(path)
    return df if with_path_cols else df.select(*schema.names)


def typed_bronze(df: DataFrame, entity: str) -> DataFrame:
    return cast_to(df, S.ENTITY_SCHEMAS[entity])
