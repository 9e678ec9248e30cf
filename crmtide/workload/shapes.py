"""The supplied test tables in the shapes the CRM jobs read.

Regions act as tenants, customers as accounts, suppliers as leads, orders as
opportunities, events as activities. All values are derived by expression, so
each shape grows with its table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.functions.columns import union_modules

EPOCH = "timestamp_ntz'2024-01-01 00:00:00'"
KPI_DAYS = 14


_plans: dict[tuple, DataFrame] = {}


def planned_once(build: Callable) -> Callable:
    """Keep the lazy plan a function builds per session and arguments; no rows are kept."""

    @wraps(build)
    def get(spark: SparkSession, *args):
        key = (id(spark), spark.sparkContext.applicationId, build.__name__, *args)
        if key not in _plans:
            _plans[key] = build(spark, *args)
        return _plans[key]

    return get


@planned_once
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    """values[index]; the last value for any other index."""
    chosen = F.lit(values[-1])
    for i in reversed(range(len(values) - 1)):
        chosen = F.when(index == i, values[i]).otherwise(chosen)
    return chosen


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


@planned_once
def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant attributes by nation: 25 rows at every scale."""
    slug = F.lower(F.replace("r_name", F.lit(" "), F.lit("_")))
    region = F.col("r_regionkey")
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == region
    ).select(
        "n_nationkey",
        F.concat(F.lit("org_"), slug).alias("organization_id"),
        F.col("r_name").alias("tenant_name"),
        _pick(region, ["Finance", "Health", "Retail", "Education", "Logistics"]).alias("tenant_domain"),
        _pick(region, ["Enterprise", "Mid-Market", "SMB", "Growth", "Enterprise"]).alias("tenant_company_size"),
        F.concat(F.lit("app_"), slug).alias("application_id"),
        _pick(region, ["risk_class", "care_type", "store_band", "course_mode", "fleet_size"]).alias("extra_key"),
    )


def with_tenant(df: DataFrame, nation_key: str, dim: DataFrame) -> DataFrame:
    """Tenant columns by nation key."""
    return df.join(dim, F.col(nation_key) == F.col("n_nationkey")).drop("n_nationkey")


def _record(df: DataFrame, k: str, prefix: str, module: str, **special: Column) -> DataFrame:
    """Landing record columns for one module; ``k`` numbers its rows."""
    n = F.col(k)
    record_id = _text(prefix, n)
    columns = {
        "module_key": F.when(n % 2 == 0, module).otherwise(module.lower()),
        "record_id": record_id,
        "resolved_record_id": record_id,
        "resolved_team_id": _text("team_", n % 4),
        "resolved_territory_id": _text("terr_", n % 3),
        "schema_version": F.lit("v2"),
        "effective_schema_hash": F.concat(F.lit("esh_"), F.col("organization_id"), F.lit(f"_{module.lower()}")),
        "cdc_timestamp": F.expr(f"{EPOCH} + make_dt_interval(cast({k} % 30 as int), cast({k} % 24 as int))"),
        "operation_type": F.when(n % 3 == 0, "INSERT").otherwise("UPDATE"),
        "extras_json": F.when(n % 50 == 7, "{broken").otherwise(
            F.concat(F.lit('{"'), F.col("extra_key"), F.lit('":"v'), (n % 3).cast("string"), F.lit('","seq":'), (n % 7).cast("string"), F.lit("}"))
        ),
        "pipeline_run_id": F.lit("run_1"),
        "src_filename": F.lit(f"{module.lower()}.parquet"),
        "loaded_at": F.expr("timestamp_ntz'2024-02-01 00:00:00'"),
        **special,
    }
    return df.withColumns(columns)


@planned_once
def record_modules(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accounts, leads and opportunities, each with its own sparse columns."""
    dim = tenants(spark, sf_dir)
    customer = with_tenant(table(spark, sf_dir, "customer"), "c_nationkey", dim)
    supplier = with_tenant(table(spark, sf_dir, "supplier"), "s_nationkey", dim)
    orders = with_tenant(
        table(spark, sf_dir, "orders").join(
            table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"),
        ),
        "c_nationkey",
        dim,
    )
    accounts = _record(
        customer, "c_custkey", "acct_", "ACCOUNTS",
        resolved_owner_id=_text("u_", F.col("c_nationkey")),
        resolved_stage_value=F.col("c_mktsegment"),
        record_name=F.col("c_name"),
        employee_band=F.when(F.col("c_acctbal") > 5000, "large").otherwise("small"),
        annual_revenue_usd=F.floor(F.col("c_acctbal") * 100).cast("bigint"),
        health_score=F.col("c_acctbal") / 97,
    )
    leads = _record(
        supplier, "s_suppkey", "lead_", "LEADS",
        resolved_owner_id=_text("u_", F.col("s_nationkey")),
        resolved_stage_value=F.lit("NEW"),
        record_name=F.col("s_name"),
        lead_source=_text("source_", F.col("s_suppkey") % 5),
        lead_score_hint=F.col("s_acctbal") / 97,
    )
    opportunities = _record(
        orders, "o_orderkey", "opp_", "OPPORTUNITIES",
        resolved_owner_id=F.col("o_orderpriority"),
        resolved_stage_value=F.col("o_orderstatus"),
        record_name=_text("Opportunity ", F.col("o_orderkey")),
        amount_usd=F.col("o_totalprice"),
        forecast_category=_text("category_", F.col("o_orderkey") % 3),
    )
    names = S.landing_table_schema("records").names
    return tuple(m.select(*[c for c in names if c in m.columns]) for m in (accounts, leads, opportunities))


@planned_once
def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_modules(*record_modules(spark, sf_dir)).select(*S.landing_table_schema("records").names)


@planned_once
def tenant_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the account they belong to and its tenant."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    events = table(spark, sf_dir, "events").join(customer, F.col("user_id") == F.col("c_custkey"))
    return with_tenant(events, "c_nationkey", tenants(spark, sf_dir)).withColumn("activity_date", F.col("ts").cast("date"))


@planned_once
def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    # One aggregated row, used as a scalar: no join.
    suppliers = table(spark, sf_dir, "supplier").select(F.count("*")).scalar()
    module = F.when(kind == "view", "calls").when(kind == "click", "EMAILS").otherwise("TASKS")
    record_id = _text("act_", F.col("event_id"))
    return tenant_events(spark, sf_dir).withColumns(
        {
            "module_key": module,
            "record_id": record_id,
            "resolved_record_id": record_id,
            "resolved_owner_id": _text("u_", F.col("event_id") % 6),
            "resolved_team_id": _text("team_", F.col("event_id") % 4),
            "resolved_territory_id": _text("terr_", F.col("event_id") % 3),
            "resolved_stage_value": F.lit(None).cast("string"),
            "schema_version": F.lit("v2"),
            "effective_schema_hash": F.concat(F.lit("esh_"), F.col("organization_id"), F.lit("_activity")),
            "cdc_timestamp": F.col("ts"),
            "operation_type": F.when(F.col("event_id") % 3 == 0, "INSERT").otherwise("UPDATE"),
            "account_id": _text("acct_", F.col("user_id")),
            "lead_id": _text("lead_", F.col("event_id") % suppliers),
            "activity_type": F.when(kind == "view", "CALL").when(kind == "click", "EMAIL").otherwise("TASK"),
            "duration_seconds": F.floor("value").cast("bigint"),
            "outcome": F.when(kind == "view", "CONNECTED").when(kind == "click", "OPENED").otherwise("DONE"),
            "extras_json": F.col("props"),
            "pipeline_run_id": F.lit("run_1"),
            "src_filename": F.lit("events.parquet"),
            "loaded_at": F.expr("timestamp_ntz'2024-02-01 00:00:00'"),
        }
    ).select(*S.landing_table_schema("activity").names)


@planned_once
def kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    day = F.dayofmonth("kpi_date") % 7
    events = tenant_events(spark, sf_dir)
    last = events.select(F.max("activity_date")).scalar()
    counted = (
        events.filter(F.col("activity_date") > F.date_sub(last, KPI_DAYS))
        .groupBy(
            "organization_id", "tenant_name", "tenant_domain", "tenant_company_size",
            F.col("activity_date").alias("kpi_date"),
        )
        .agg(
            of("purchase").alias("pipeline_created_count"),
            of("signup").alias("qualified_lead_count"),
            of("click").alias("active_opportunity_count"),
            of("view").alias("views"),
            F.sum(F.floor("value").cast("bigint")).alias("duration"),
            F.count("*").alias("activity_volume"),
        )
    )
    return counted.withColumns(
        {
            "stage_conversion_rate": F.try_divide(
                F.col("pipeline_created_count"), F.col("pipeline_created_count") + F.col("qualified_lead_count")
            ),
            "avg_stage_dwell_days": F.col("duration") / F.col("activity_volume") / 10,
            "goal_attainment_ratio": F.col("activity_volume") / 60,
            "pipeline_coverage_ratio": F.try_divide("active_opportunity_count", "views"),
            "kpi_readiness_status": F.when(day == 0, "BLOCKED").when(day == 1, "PARTIAL").otherwise("READY"),
            "pipeline_run_id": F.lit("run_1"),
            "src_filename": F.lit("kpi.parquet"),
            "loaded_at": F.expr("timestamp_ntz'2024-02-01 00:00:00'"),
        }
    ).select(*S.landing_table_schema("kpi").names)


@planned_once
def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn features from orders: one account-day is delivered many times."""
    k = F.col("o_orderkey")
    day = F.expr("date_add(date'2024-01-01', cast(o_orderkey % 30 as int))")
    return table(spark, sf_dir, "orders").select(
        _text("acct_", F.col("o_custkey") % 200).alias("account_id"),
        F.lit("app_crm").alias("application_id"),
        _text("client_", k % 3).alias("client_id"),
        day.alias("feature_date"),
        (k % 45).alias("days_since_last_touch"),
        (k % 31).alias("interaction_count_last_30d"),
        (k % 61).alias("interaction_count_last_60d"),
        (k % 17).alias("num_calls"),
        (F.col("o_totalprice") / 1000).alias("avg_call_duration"),
        (k % 501).alias("total_interactions_lifetime"),
        (k % 5).alias("support_tickets_last_30d"),
        ((k % 100) / 50).alias("engagement_trend_ratio"),
        (k % 365).alias("days_to_contract_end"),
        F.when(F.col("o_totalprice") > 200000, "HIGH").otherwise("LOW").alias("contract_value_tier"),
        (k % 365 < 90).alias("is_in_renewal_window"),
        ((k % 31) / 30).alias("interaction_frequency_score"),
        (F.col("o_orderstatus") == "F").alias("is_churned"),
        ((k % 1000) / 1000).alias("churn_risk_score"),
        F.when(k % 1000 > 700, "HIGH").when(k % 1000 > 300, "MEDIUM").otherwise("LOW").alias("risk_category"),
        _text("con_", k).alias("contract_id"),
        F.col("o_orderdate").cast("date").alias("contract_start_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 365).alias("contract_end_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("contract_value"),
        F.when(k % 2 == 0, "ACTIVE").otherwise("EXPIRED").alias("contract_status"),
        _text("Account ", F.col("o_custkey") % 200).alias("account_name"),
        F.lit("Travel").alias("industry"),
        F.lit("mid").alias("revenue_category"),
        F.lit("200_999").alias("employee_category"),
        F.expr("timestamp_ntz'2024-02-01 00:00:00' + make_dt_interval(0, 0, 0, o_orderkey)").alias("exported_at"),
        F.lit("ALL").alias("export_client_scope"),
        day.cast("string").alias("export_snapshot_date"),
        _text("load_", k % 2, ".parquet").alias("src_filename"),
        F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(cast(o_orderkey % 2 as int))").alias("loaded_at"),
    )


@planned_once
def lead_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead scores from events: a lead-day is scored many times."""
    k = F.col("event_id")
    day = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select(
        _text("lead_", F.col("user_id")).alias("lead_id"),
        F.lit("app_crm").alias("application_id"),
        _text("acct_", F.col("user_id")).alias("account_id"),
        _text("client_", F.col("event_type")).alias("client_id"),
        day.alias("feature_date"),
        F.col("value").alias("lead_score"),
        F.when(F.col("value") > 50, "HOT").otherwise("COLD").alias("lead_score_band"),
        (k % 31).alias("touchpoints_last_30d"),
        (k % 11).alias("days_since_last_touch"),
        _text("source_", k % 5).alias("lead_source"),
        F.when(k % 2 == 0, "OPEN").otherwise("WORKING").alias("lead_status"),
        _text("Company ", F.col("user_id")).alias("company"),
        F.lit("Travel").alias("industry"),
        F.col("ts").alias("exported_at"),
        F.lit("ALL").alias("export_client_scope"),
        day.cast("string").alias("export_snapshot_date"),
        _text("load_", k % 3, ".parquet").alias("src_filename"),
        F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, cast(event_id % 3 as int))").alias("loaded_at"),
    )
