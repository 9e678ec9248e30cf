"""Good/bad split on required fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmtide.functions.columns import missing_fields, required_invalid

MISSING_REQUIRED = "missing_required_field"


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, bad); bad rows carry ``validation_reason`` and the names of the ``missing_fields``."""
    invalid = required_invalid(required)
    return df.filter(~invalid), with_reason(df.filter(invalid), required)


def with_reason(bad: DataFrame, required: list[str]) -> DataFrame:
    return bad.withColumns(
        {
            "validation_reason": F.lit(MISSING_REQUIRED),
            "missing_fields": F.array_join(missing_fields(required), ","),
        }
    )


def quarantine_report(bad: DataFrame) -> DataFrame:
    """Quarantined rows by reason and by what is missing."""
    return bad.groupBy("validation_reason", "missing_fields").agg(F.count("*").alias("row_count"))
