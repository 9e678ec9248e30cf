"""Data-quality checks; each returns the violations, an empty result passes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmtide import schemas as S


def violations(
    df: DataFrame, columns: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """(check_name, column_name, value, violations) of all given rules from one pass over the data.

    Only what breaks a rule is grouped. NULL is among the accepted values.
    """
    nothing = F.lit(None).cast("string")

    def broken(test: Column, check: str, c: str, value: Column) -> Column:
        return F.when(test, F.struct(F.lit(check).alias("check_name"), F.lit(c).alias("column_name"), value.alias("value")))

    found = [broken(F.col(c).isNull(), "not_null", c, nothing) for c in columns]
    for c, allowed in (accepted or {}).items():
        found.append(broken(~F.col(c).isin(list(allowed)), "accepted_values", c, F.col(c).cast("string")))
    rows = df.select(F.inline(F.array_compact(F.array(*found))))
    return rows.groupBy("check_name", "column_name", "value").agg(F.count("*").alias("violations"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``violations`` of the not-null rules alone: one counter per column, so no row is made for what breaks a rule."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    named = [
        F.struct(
            F.lit("not_null").alias("check_name"),
            F.lit(c).alias("column_name"),
            F.lit(None).cast("string").alias("value"),
            F.col(c).alias("violations"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*named))).filter("violations > 0")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, violations)"""
    return null_counts(df, columns).select("column_name", "violations")


def accepted_values(df: DataFrame, accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """(column_name, value, violations) of values outside their set."""
    return violations(df, accepted=accepted).select("column_name", "value", "violations")


def unique_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def _of_models(models: Mapping[str, DataFrame], rules: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.select(F.lit(m).alias("model"), "*") for m, df in rules.items() if m in models]
    return reduce(DataFrame.unionByName, parts)


def check_not_null(models: Mapping[str, DataFrame]) -> DataFrame:
    return _of_models(models, {m: null_counts(models[m], c) for m, c in S.NOT_NULL.items() if m in models})


def check_accepted_values(models: Mapping[str, DataFrame]) -> DataFrame:
    rules = {m: violations(models[m], accepted=a) for m, a in S.ACCEPTED_VALUES.items() if m in models}
    return _of_models(models, rules)


def check_unique_grain(models: Mapping[str, DataFrame], find: Callable[..., DataFrame] = unique_grain) -> DataFrame:
    """Duplicate keys, the key's values in ``value`` and its rows as ``violations``."""
    rules = {}
    for m, keys in S.UNIQUE_GRAIN.items():
        if m in models:
            rules[m] = find(models[m], keys).select(
                F.lit("unique_grain").alias("check_name"),
                F.lit(",".join(keys)).alias("column_name"),
                F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("value"),
                F.col("row_count").alias("violations"),
            )
    return _of_models(models, rules)


def run_checks(models: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of every declared rule of the given models; run it over built tables.

    Each model is read once for its value rules and once for its grain.
    """
    rules = {
        m: violations(df, S.NOT_NULL.get(m, ()), S.ACCEPTED_VALUES.get(m))
        for m, df in models.items()
        if m in S.NOT_NULL or m in S.ACCEPTED_VALUES
    }
    found = _of_models(models, rules)
    return found.unionByName(check_unique_grain(models)) if set(models) & set(S.UNIQUE_GRAIN) else found
