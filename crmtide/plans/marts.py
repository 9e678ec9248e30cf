"""Record-day, scorecard and mart models as DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmtide.operators import rollups
from crmtide.operators.joins import (
    RECORD_KEYS,
    join_kpi_records,
    join_record_activity,
    join_record_activity_by_module,
    split_matchable,
)
from crmtide.operators.rollups import ROLLUP_MEASURES
from crmtide.plans import staging

# Column order of the models and thresholds of the health status.
RECORD_COLUMNS = [
    "organization_id", "tenant_name", "tenant_domain", "tenant_company_size", "application_id",
    "module_key", "record_id", "record_name", "resolved_owner_id", "resolved_team_id",
    "resolved_territory_id", "resolved_stage_value",
]
RECORD_MEASURES = ["health_score", "lead_score_hint", "amount_usd"]
KPI_COLUMNS = [
    "organization_id", "tenant_name", "tenant_domain", "tenant_company_size", "kpi_date",
    "pipeline_created_count", "qualified_lead_count", "active_opportunity_count",
    "stage_conversion_rate", "avg_stage_dwell_days", "activity_volume", "goal_attainment_ratio",
    "pipeline_coverage_ratio", "kpi_readiness_status",
]
HEALTHY_COVERAGE, HEALTHY_CONVERSION, WATCH_COVERAGE = 1.10, 0.45, 0.85


def record_days(records: DataFrame) -> DataFrame:
    return records.select(
        *RECORD_COLUMNS, F.col("cdc_timestamp").cast("date").alias("record_date"), *RECORD_MEASURES
    )


def record_daily_activity(
    records: DataFrame,
    activity: DataFrame,
    dedup_grain: bool = False,
    by_module: bool = False,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Records with the activity volume of their change day.

    A record appears once per (account, lead) pair active on that day.
    ``dedup_grain`` adds those pairs up, giving one row per record version.
    ``hot`` comes from ``joins.hot_records`` of the activity rollup, to be looked
    for where the join is run; without it every key is joined the way hot ones
    are, which is as exact but shuffles more.
    """
    days = record_days(records)
    if dedup_grain:
        per_record = rollups.rollup_per_record(activity).withColumnRenamed("activity_date", "record_date")
        matchable, others = split_matchable(days)
        joined = matchable.join(per_record, RECORD_KEYS, "left").unionByName(others, allowMissingColumns=True)
    elif by_module:
        joined = join_record_activity_by_module(days, rollups.activity_rollup(activity))
    else:
        joined = join_record_activity(days, rollups.activity_rollup(activity), hot)
    return joined.select(
        *RECORD_COLUMNS,
        "record_date",
        *[F.coalesce(m, F.lit(0)).alias(m) for m in ROLLUP_MEASURES],
        *RECORD_MEASURES,
    )


def daily_scorecard(kpi: DataFrame, record_daily: DataFrame, day_source: DataFrame | None = None) -> DataFrame:
    """Tenant-day scorecard from record-days, best from their materialised table."""

    def seen(module: str) -> Column:
        return F.count_if(F.col("module_key") == module)

    joined = join_kpi_records(
        kpi.select(*KPI_COLUMNS),
        record_daily.select("organization_id", "record_date", "module_key", "total_activities", *RECORD_MEASURES),
        day_source,
    )
    return joined.groupBy(*KPI_COLUMNS).agg(
        seen("LEADS").alias("lead_records_seen"),
        seen("OPPORTUNITIES").alias("opportunity_records_seen"),
        seen("ACCOUNTS").alias("account_records_seen"),
        F.coalesce(F.sum("total_activities"), F.lit(0)).alias("crm_activities_joined"),
        F.coalesce(F.avg("health_score"), F.lit(0.0)).alias("avg_health_score"),
        F.coalesce(F.avg("lead_score_hint"), F.lit(0.0)).alias("avg_lead_score_hint"),
        F.coalesce(F.sum("amount_usd"), F.lit(0.0)).alias("pipeline_amount_usd"),
    )


def daily_scorecard_weighted(kpi: DataFrame, records: DataFrame, activity: DataFrame) -> DataFrame:
    """The same scorecard with records combined per tenant-day before the KPI join.

    Equal KPI rows merge into one group whose joined rows count once per copy.
    Days outside the KPI window cannot reach the result and are not read.
    """
    first, last = (kpi.select(f("kpi_date")).scalar() for f in (F.min, F.max))
    changed = F.col("cdc_timestamp").cast("date")
    records = records.filter(changed.between(first, last))
    activity = activity.filter(F.col("activity_date").between(first, last))
    totals = rollups.record_day_totals(records, activity).withColumnRenamed("record_date", "kpi_date")
    days = kpi.groupBy(*KPI_COLUMNS).agg(F.count("*").alias("kpi_copies"))

    def scaled(column: str, zero) -> Column:
        return F.coalesce(F.col(column) * F.col("kpi_copies"), F.lit(zero))

    def mean(total: str, rows: str) -> Column:
        return F.coalesce(F.try_divide(F.col(total), F.col(rows)), F.lit(0.0))

    return days.join(totals, ["organization_id", "kpi_date"], "left").select(
        *KPI_COLUMNS,
        scaled("lead_rows", 0).alias("lead_records_seen"),
        scaled("opportunity_rows", 0).alias("opportunity_records_seen"),
        scaled("account_rows", 0).alias("account_records_seen"),
        scaled("volume", 0).alias("crm_activities_joined"),
        mean("health_sum", "health_rows").alias("avg_health_score"),
        mean("hint_sum", "hint_rows").alias("avg_lead_score_hint"),
        scaled("amount_sum", 0.0).alias("pipeline_amount_usd"),
    )


def pipeline_health(scorecard: DataFrame) -> DataFrame:
    """Health status per tenant-day; a missing ratio falls through to AT_RISK."""
    coverage = F.col("pipeline_coverage_ratio")
    status = (
        F.when(F.col("kpi_readiness_status") == "BLOCKED", "BLOCKED")
        .when((coverage >= HEALTHY_COVERAGE) & (F.col("stage_conversion_rate") >= HEALTHY_CONVERSION), "HEALTHY")
        .when(coverage >= WATCH_COVERAGE, "WATCH")
        .otherwise("AT_RISK")
    )
    return scorecard.withColumn("pipeline_health_status", status)


def build_marts(
    raw_records: DataFrame, raw_activity: DataFrame, raw_kpi: DataFrame, hot: Sequence[int] | None = None
) -> dict[str, DataFrame]:
    """Every model of the project, lazily: each mart is one plan, run at its write.

    ``hot`` is that of ``record_daily_activity``.
    """
    records = staging.stg_records(raw_records)
    activity = staging.stg_activity(raw_activity)
    kpi = staging.stg_kpi(raw_kpi)
    scorecard = daily_scorecard_weighted(kpi, records, activity)
    return {
        "stg_records": records,
        "stg_activity": activity,
        "stg_kpi": kpi,
        "record_daily_activity": record_daily_activity(records, activity, hot=hot),
        "daily_scorecard": scorecard,
        "pipeline_health": pipeline_health(scorecard),
        "module_snapshot": rollups.module_snapshot(records),
    }
