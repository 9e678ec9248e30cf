"""Typed silver tables from their raw stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.functions.casts import try_number, try_typed

# Column order of the typed tables.
SILVER_COLUMNS = {
    "records": """organization_id tenant_name tenant_domain tenant_company_size application_id
        module_key record_id resolved_record_id resolved_owner_id resolved_team_id
        resolved_territory_id resolved_stage_value schema_version effective_schema_hash
        cdc_timestamp operation_type record_name employee_band annual_revenue_usd health_score
        extras_json pipeline_run_id lead_source lead_score_hint amount_usd forecast_category
        event_date year month day""".split(),
    "activity": """organization_id tenant_name tenant_domain application_id module_key record_id
        resolved_record_id resolved_owner_id resolved_team_id resolved_territory_id
        resolved_stage_value schema_version effective_schema_hash cdc_timestamp activity_date
        operation_type account_id lead_id pipeline_run_id activity_type duration_seconds outcome
        extras_json year month day""".split(),
    "kpi": """organization_id tenant_name tenant_domain tenant_company_size kpi_date
        pipeline_created_count qualified_lead_count active_opportunity_count
        stage_conversion_rate avg_stage_dwell_days activity_volume goal_attainment_ratio
        pipeline_coverage_ratio kpi_readiness_status pipeline_run_id""".split(),
}
# Month of this column is the last partition column; tenant and module lead.
SILVER_LAYOUT = {
    "records": (["organization_id", "module_key"], "cdc_timestamp", "cdc_month"),
    "activity": (["organization_id", "module_key"], "cdc_timestamp", "cdc_month"),
    "kpi": (["organization_id"], "kpi_date", "kpi_month"),
}


def _typed(name: str, column: str, text_timestamp: bool) -> Column:
    source = F.col(column)
    if column == "cdc_timestamp":
        return F.try_to_timestamp(source) if text_timestamp else source.cast("timestamp")
    if column in ("event_date", "activity_date", "kpi_date"):
        return source.try_cast("date")
    if column == "amount_usd":
        return try_number(source)
    if column in ("year", "month", "day"):
        return source.try_cast("int")
    return source


def aligned(name: str, stage: DataFrame) -> DataFrame:
    """A staged frame with every column of the silver table: declared types, NULL for what the files lack.

    Times stay as they are staged; ``silver_ctas`` reads both forms.
    """
    present, declared = dict((f.name, f.dataType) for f in stage.schema), S.LANDING_SCHEMAS[name]
    types = {f.name: f.dataType for f in declared if f.name != "cdc_timestamp"}

    def column(c: str) -> Column:
        if c not in present:
            return F.lit(None).cast(types.get(c, "string"))
        return try_typed(F.col(c), present[c], types[c]) if c in types else F.col(c)

    return stage.select(*[column(c).alias(c) for c in SILVER_COLUMNS[name]])


def silver_ctas(name: str, stage: DataFrame) -> DataFrame:
    """Typed projection with its month partition column."""
    text_timestamp = dict(stage.dtypes).get("cdc_timestamp") == "string"
    typed = stage.select(*[_typed(name, c, text_timestamp).alias(c) for c in SILVER_COLUMNS[name]])
    _, by, month = SILVER_LAYOUT[name]
    return typed.withColumn(month, F.trunc(F.col(by).cast("date"), "MM"))


def silver_partitions(name: str) -> list[str]:
    lead, _, month = SILVER_LAYOUT[name]
    return [*lead, month]
