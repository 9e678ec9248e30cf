"""Column helpers shared by the jobs."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_fields(columns: Iterable[str]) -> Column:
    """Names of the required fields that hold nothing but spaces; an empty array passes."""
    named = [F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in columns]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def required_invalid(columns: Iterable[str]) -> Column:
    return F.size(missing_fields(columns)) > 0


def with_time_parts(df: DataFrame, ts: str, hour: bool = True) -> DataFrame:
    """year, month, day (and hour) of the event time."""
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    if hour:
        parts["hour"] = F.hour(ts)
    return df.withColumns(parts)


def with_stamp(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def with_constants(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def encode_extras(values: Mapping[str, Column]) -> Column:
    """Custom fields as JSON text, keys sorted, fields without a value left out."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), values[k].cast("string").alias("value")) for k in sorted(values)])
    return F.to_json(F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())))


def encode_extras_map(extras: Column) -> Column:
    """The same for a map column whose keys differ from row to row."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(extras))))


def extract(document: Column, path: str, type_name: str) -> Column:
    """Path into a VARIANT, cast tolerantly."""
    return F.try_variant_get(document, path, type_name)


def calendar_spine(df: DataFrame, key: str, last_day: Column, days: int = 14, name: str = "kpi_date") -> DataFrame:
    """One row per distinct key and day for the ``days`` days ending on ``last_day``."""
    return (
        df.select(key)
        .distinct()
        .withColumn(name, F.explode(F.sequence(F.date_sub(last_day, days - 1), last_day)))
    )


EVERY_CLIENT = "ALL"


def scoped(df: DataFrame, client_id: str = EVERY_CLIENT, day: datetime.date | str | None = None) -> DataFrame:
    """One tenant's rows, or every tenant's, of one feature day, or of all days.

    The day is a date or its ISO form; it must be given for a table kept by
    feature day and has no meaning for any other.
    """
    if not client_id:
        raise ValueError("client_id names a tenant or is ALL")
    if day is not None:
        day = datetime.date.fromisoformat(str(day))
        df = df.filter(F.col("feature_date") == F.lit(day)) if "feature_date" in df.columns else df
    return df if client_id == EVERY_CLIENT else df.filter(F.col("client_id") == client_id)


def union_modules(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name, keeping duplicates; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
