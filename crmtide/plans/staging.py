"""Staging projections over the landing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crmtide import schemas as S


def columns(name: str) -> list[str]:
    """The projection as SQL expressions, which the frames here and the catalog's views share."""
    typed = {
        "module_key": "upper(module_key) AS module_key",
        "extras_json": "try_parse_json(extras_json) AS extras_json",
    }
    return [typed.get(f.name, f"`{f.name}`") for f in S.landing_table_schema(name)]


def _staged(df: DataFrame, name: str) -> DataFrame:
    return df.selectExpr(*columns(name))


def stg_records(raw: DataFrame) -> DataFrame:
    """28 columns; module key in upper case, custom fields as VARIANT."""
    return _staged(raw, "records")


def stg_activity(raw: DataFrame) -> DataFrame:
    """25 columns; module key in upper case, custom fields as VARIANT."""
    return _staged(raw, "activity")


def stg_kpi(raw: DataFrame) -> DataFrame:
    """17 columns, unchanged."""
    return _staged(raw, "kpi")
