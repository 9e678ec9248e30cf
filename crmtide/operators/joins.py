"""Left joins whose two sides may both hold hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmtide.operators.skew import HOT_ROWS, hot_keys, is_hot

RECORD_KEYS = ["organization_id", "module_key", "record_id", "record_date"]
# Modules whose records take part in activity matching, with the id they match on.
MATCHED_MODULES = {"ACCOUNTS": "account_id", "LEADS": "lead_id"}


def fanout_left_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    hot: Sequence[int] | None = None,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """``left LEFT JOIN right`` on key equality; right key columns are not kept.

    Spark's runtime skew handling splits only the preserved side of an outer
    join, but both sides of an inner one. Keys that are hot on the right are
    therefore joined as inner join plus anti join against the distinct right
    keys (combined map-side), all others as a plain left join. ``hot`` lists the
    key hashes to treat that way; None treats every key as hot. Either way of
    joining is exact, whatever the list holds. ``key_source`` may name a cheaper
    frame with the same distinct keys as ``right``.
    """
    names = [f"_right_{k}" for k in right_keys]
    for a, b in zip(left_keys, right_keys):
        if left.schema[a].dataType != right.schema[b].dataType:
            raise ValueError(f"join keys {a} and {b} differ in type, so their hashes would not agree")
    right_keys_only = right if key_source is None else key_source
    right = right.withColumnsRenamed(dict(zip(right_keys, names)))
    right_keys_only = right_keys_only.select(*[F.col(k).alias(n) for k, n in zip(right_keys, names)])
    matches = reduce(Column.__and__, [F.col(k) == F.col(n) for k, n in zip(left_keys, names)])

    def split(a: DataFrame, b: DataFrame, keys: DataFrame) -> DataFrame:
        matched = a.join(b, matches, "inner").drop(*names)
        return matched.unionByName(a.join(keys.distinct(), matches, "left_anti"), allowMissingColumns=True)

    if hot is None:
        return split(left, right, right_keys_only)
    if not hot:
        return left.join(right, matches, "left").drop(*names)
    left_hot, right_hot = is_hot(left_keys, hot), is_hot(names, hot)
    cold = left.filter(~left_hot).join(right.filter(~right_hot), matches, "left").drop(*names)
    return cold.unionByName(split(left.filter(left_hot), right.filter(right_hot), right_keys_only.filter(right_hot)))


def by_record(activity: DataFrame) -> DataFrame:
    """One row per record an activity belongs to: its account and its lead."""
    owners = F.array(
        *[F.struct(F.lit(m).alias("module_key"), F.col(c).alias("record_id")) for m, c in MATCHED_MODULES.items()]
    )
    rest = [c for c in activity.columns if c not in MATCHED_MODULES.values()]
    return activity.select(*rest, F.inline(owners))


def split_matchable(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that can have activities, all others)."""
    matchable = F.coalesce(F.col("module_key").isin(list(MATCHED_MODULES)), F.lit(False))
    return records.filter(matchable), records.filter(~matchable)


def hot_records(rollup: DataFrame, min_rows: int = HOT_ROWS) -> list[int]:
    """Records that so many rollup rows of one day belong to that a task may not hold them."""
    keys = ["organization_id", "module_key", "record_id", "activity_date"]
    rows = by_record(rollup.select("organization_id", "activity_date", *MATCHED_MODULES.values()))
    return hot_keys(rows, keys, min_rows)


def join_record_activity(records: DataFrame, rollup: DataFrame, hot: Sequence[int] | None = None) -> DataFrame:
    """Records LEFT JOIN rollup, the module deciding which id has to match.

    The either/or condition becomes plain equality on (tenant, module, record,
    day) by unpivoting the rollup. Other modules never match: they skip the
    join and its shuffle. ``hot`` comes from ``hot_records``.
    """
    matchable, others = split_matchable(records)
    right_keys = ["organization_id", "module_key", "record_id", "activity_date"]
    joined = fanout_left_join(matchable, by_record(rollup), RECORD_KEYS, right_keys, hot)
    return joined.unionByName(others, allowMissingColumns=True)


def join_record_activity_by_module(records: DataFrame, rollup: DataFrame) -> DataFrame:
    """The same result with one join per module instead of the unpivot."""
    parts = []
    for module, id_column in MATCHED_MODULES.items():
        other_id = [c for c in MATCHED_MODULES.values() if c != id_column]
        parts.append(
            fanout_left_join(
                records.filter(F.col("module_key") == module),
                rollup.drop(*other_id),
                ["organization_id", "record_id", "record_date"],
                ["organization_id", id_column, "activity_date"],
            )
        )
    parts.append(split_matchable(records)[1])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def join_kpi_records(kpi: DataFrame, record_daily: DataFrame, day_source: DataFrame | None = None) -> DataFrame:
    """KPI days LEFT JOIN record-days of the same tenant and day.

    Every tenant-day holds many records, so every key counts as hot.
    ``day_source`` may name a cheaper frame with the same tenant-days.
    """
    shared = [c for c in record_daily.columns if c in kpi.columns and c != "organization_id"]
    keys = ["organization_id", "record_date"]
    return fanout_left_join(
        kpi, record_daily.drop(*shared), ["organization_id", "kpi_date"], keys, key_source=day_source
    )
