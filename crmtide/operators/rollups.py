"""Aggregations of activities and records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmtide.operators.joins import RECORD_KEYS, by_record, split_matchable

ROLLUP_KEYS = ["organization_id", "account_id", "lead_id", "activity_date"]
ROLLUP_MEASURES = ["total_activities", "call_count", "email_count", "task_count", "total_duration_seconds"]


def activity_rollup(activity: DataFrame) -> DataFrame:
    """Activity volume per tenant, account, lead and day; NULL keys form groups."""
    return activity.groupBy(*ROLLUP_KEYS).agg(
        F.count("*").alias("total_activities"),
        F.count_if(F.col("activity_type") == "CALL").alias("call_count"),
        F.count_if(F.col("activity_type") == "EMAIL").alias("email_count"),
        F.count_if(F.col("activity_type") == "TASK").alias("task_count"),
        F.sum("duration_seconds").alias("total_duration_seconds"),
    )


def rollup_per_record(activity: DataFrame) -> DataFrame:
    """Activity volume per record and day: the rollup without its second id."""
    return (
        by_record(activity_rollup(activity))
        .groupBy("organization_id", "module_key", "record_id", "activity_date")
        .agg(*[F.sum(m).alias(m) for m in ROLLUP_MEASURES])
    )


def record_day_totals(records: DataFrame, activity: DataFrame) -> DataFrame:
    """What a tenant-day scorecard needs from the record-days, without building them.

    A record appears once per rollup row it matches, and once if it matches
    none. That number of copies and the sum of the matched volumes are known per
    record and day, so each record is weighted by them instead of being fanned
    out. The join meets a unique right side: only its left side can be hot,
    which runtime skew handling splits.
    """
    per_record = (
        by_record(activity.groupBy(*ROLLUP_KEYS).agg(F.count("*").alias("volume")))
        .groupBy(*[F.col(c) for c in ("organization_id", "module_key", "record_id")], F.col("activity_date").alias("record_date"))
        .agg(F.count("*").alias("copies"), F.sum("volume").alias("volume"))
    )
    narrow = records.select(
        "organization_id",
        "module_key",
        "record_id",
        F.col("cdc_timestamp").cast("date").alias("record_date"),
        "health_score",
        "lead_score_hint",
        "amount_usd",
    )
    matchable, others = split_matchable(narrow)
    weighted = matchable.join(per_record, RECORD_KEYS, "left").unionByName(others, allowMissingColumns=True)
    copies = F.coalesce("copies", F.lit(1))

    def copies_if(condition):
        return F.sum(F.when(condition, copies).otherwise(F.lit(0)))

    return weighted.groupBy("organization_id", "record_date").agg(
        copies_if(F.col("module_key") == "LEADS").alias("lead_rows"),
        copies_if(F.col("module_key") == "OPPORTUNITIES").alias("opportunity_rows"),
        copies_if(F.col("module_key") == "ACCOUNTS").alias("account_rows"),
        F.sum(F.coalesce("volume", F.lit(0))).alias("volume"),
        F.sum(F.col("health_score") * copies).alias("health_sum"),
        copies_if(F.col("health_score").isNotNull()).alias("health_rows"),
        F.sum(F.col("lead_score_hint") * copies).alias("hint_sum"),
        copies_if(F.col("lead_score_hint").isNotNull()).alias("hint_rows"),
        F.sum(F.col("amount_usd") * copies).alias("amount_sum"),
    )


SNAPSHOT_KEYS = ["organization_id", "tenant_name", "tenant_domain", "tenant_company_size", "module_key"]


def module_snapshot(records: DataFrame) -> DataFrame:
    """Record distribution per tenant and module.

    The rows are first combined per (owner, team, stage), so the exact distinct
    counts expand and shuffle the few combinations rather than every record.
    """
    combined = records.groupBy(
        *SNAPSHOT_KEYS, "resolved_owner_id", "resolved_team_id", "resolved_stage_value"
    ).agg(
        F.count("*").alias("n"),
        F.sum("health_score").alias("health_sum"),
        F.count("health_score").alias("health_rows"),
        F.sum("lead_score_hint").alias("hint_sum"),
        F.count("lead_score_hint").alias("hint_rows"),
        F.sum("amount_usd").alias("amount_sum"),
        F.max("cdc_timestamp").alias("newest"),
    )
    return combined.groupBy(*SNAPSHOT_KEYS).agg(
        F.sum("n").alias("record_count"),
        F.count_distinct("resolved_owner_id").alias("owner_count"),
        F.count_distinct("resolved_team_id").alias("team_count"),
        F.count_distinct("resolved_stage_value").alias("stage_count"),
        F.try_divide(F.sum("health_sum"), F.sum("health_rows")).alias("avg_health_score"),
        F.try_divide(F.sum("hint_sum"), F.sum("hint_rows")).alias("avg_lead_score_hint"),
        F.sum("amount_sum").alias("total_amount_usd"),
        F.max("newest").alias("latest_cdc_timestamp"),
    )
