"""Tolerant casts: a value that does not fit becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def try_number(source: Column) -> Column:
    """Whole number, rounding halves away from zero (12.5 -> 13)."""
    return source.try_cast(T.DecimalType(38, 0)).try_cast("bigint")


def try_typed(source: Column, from_type: T.DataType, to_type: T.DataType) -> Column:
    """Warehouse cast of one column: NULL when the value does not fit."""
    if from_type == to_type:
        return source
    if isinstance(to_type, _TEMPORAL) and not isinstance(from_type, _TEMPORAL):
        source = source.cast("string")
    if isinstance(to_type, T.LongType) and not isinstance(from_type, T.IntegralType):
        return try_number(source)
    return source.try_cast(to_type)


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns only, cast tolerantly; a column the input lacks is NULL."""
    present = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (
                try_typed(F.col(f.name), present[f.name], f.dataType)
                if f.name in present
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )


def cast_failed(df: DataFrame, schema: T.StructType) -> Column:
    """True when a value was present but could not be cast to its declared type."""
    present = {f.name: f.dataType for f in df.schema}
    failed = F.lit(False)
    for f in schema:
        from_type = present.get(f.name)
        if from_type is None or from_type == f.dataType or isinstance(f.dataType, T.StringType):
            continue
        source = F.col(f.name)
        failed = failed | (source.isNotNull() & try_typed(source, from_type, f.dataType).isNull())
    return failed


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Schema-driven cast of text fields as read from JSON lines.

    Whole numbers go through DOUBLE so that "20.5" truncates to 20, as a JSON
    number inferred as DOUBLE and then cast would.
    """

    def typed(f: T.StructField) -> Column:
        source = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.try_to_timestamp(source)
        if isinstance(f.dataType, T.DateType):
            return F.try_to_date(source)
        if isinstance(f.dataType, T.IntegralType):
            return source.try_cast("double").try_cast(f.dataType)
        return source.try_cast(f.dataType)

    return df.select(*[typed(f).alias(f.name) for f in schema])
