"""Independent SQL for every registered query, over the supplied tables."""

from __future__ import annotations

from crmtide import schemas as S

TENANTS = """
tenants AS (
  SELECT n_nationkey,
         'org_' || lower(replace(r_name, ' ', '_')) AS organization_id,
         r_name AS tenant_name,
         CASE r_regionkey WHEN 0 THEN 'Finance' WHEN 1 THEN 'Health' WHEN 2 THEN 'Retail'
              WHEN 3 THEN 'Education' ELSE 'Logistics' END AS tenant_domain,
         CASE r_regionkey WHEN 0 THEN 'Enterprise' WHEN 1 THEN 'Mid-Market' WHEN 2 THEN 'SMB'
              WHEN 3 THEN 'Growth' ELSE 'Enterprise' END AS tenant_company_size,
         'app_' || lower(replace(r_name, ' ', '_')) AS application_id,
         CASE r_regionkey WHEN 0 THEN 'risk_class' WHEN 1 THEN 'care_type' WHEN 2 THEN 'store_band'
              WHEN 3 THEN 'course_mode' ELSE 'fleet_size' END AS extra_key
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def _record_module(source: str, k: str, prefix: str, module: str, special: dict[str, str]) -> str:
    """One module's landing records."""
    columns = {
        "organization_id": "organization_id",
        "tenant_name": "tenant_name",
        "tenant_domain": "tenant_domain",
        "tenant_company_size": "tenant_company_size",
        "application_id": "application_id",
        "module_key": f"CASE WHEN {k} % 2 = 0 THEN '{module}' ELSE '{module.lower()}' END",
        "record_id": f"'{prefix}' || {k}",
        "resolved_record_id": f"'{prefix}' || {k}",
        "resolved_owner_id": "NULL",
        "resolved_team_id": f"'team_' || ({k} % 4)",
        "resolved_territory_id": f"'terr_' || ({k} % 3)",
        "resolved_stage_value": "NULL",
        "schema_version": "'v2'",
        "effective_schema_hash": f"'esh_' || organization_id || '_{module.lower()}'",
        "cdc_timestamp": f"TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST({k} % 30 AS INT)) + to_hours(CAST({k} % 24 AS INT))",
        "operation_type": f"CASE WHEN {k} % 3 = 0 THEN 'INSERT' ELSE 'UPDATE' END",
        "record_name": "NULL",
        "employee_band": "CAST(NULL AS VARCHAR)",
        "annual_revenue_usd": "CAST(NULL AS BIGINT)",
        "health_score": "CAST(NULL AS DOUBLE)",
        "lead_source": "CAST(NULL AS VARCHAR)",
        "lead_score_hint": "CAST(NULL AS DOUBLE)",
        "amount_usd": "CAST(NULL AS DOUBLE)",
        "forecast_category": "CAST(NULL AS VARCHAR)",
        "extras_json": f"""CASE WHEN {k} % 50 = 7 THEN '{{broken'
            ELSE '{{"' || extra_key || '":"v' || ({k} % 3) || '","seq":' || ({k} % 7) || '}}' END""",
        "pipeline_run_id": "'run_1'",
        "src_filename": f"'{module.lower()}.parquet'",
        "loaded_at": "TIMESTAMP '2024-02-01 00:00:00'",
    } | special
    return f"SELECT {', '.join(f'{v} AS {c}' for c, v in columns.items())} FROM {source}"


RECORDS = (
    TENANTS
    + ", records_raw AS ("
    + " UNION ALL ".join(
        [
            _record_module(
                "customer JOIN tenants ON c_nationkey = n_nationkey", "c_custkey", "acct_", "ACCOUNTS",
                {
                    "resolved_owner_id": "'u_' || c_nationkey",
                    "resolved_stage_value": "c_mktsegment",
                    "record_name": "c_name",
                    "employee_band": "CASE WHEN c_acctbal > 5000 THEN 'large' ELSE 'small' END",
                    "annual_revenue_usd": "CAST(floor(c_acctbal * 100) AS BIGINT)",
                    "health_score": "c_acctbal / 97",
                },
            ),
            _record_module(
                "supplier JOIN tenants ON s_nationkey = n_nationkey", "s_suppkey", "lead_", "LEADS",
                {
                    "resolved_owner_id": "'u_' || s_nationkey",
                    "resolved_stage_value": "'NEW'",
                    "record_name": "s_name",
                    "lead_source": "'source_' || (s_suppkey % 5)",
                    "lead_score_hint": "s_acctbal / 97",
                },
            ),
            _record_module(
                "orders JOIN customer ON o_custkey = c_custkey JOIN tenants ON c_nationkey = n_nationkey",
                "o_orderkey", "opp_", "OPPORTUNITIES",
                {
                    "resolved_owner_id": "o_orderpriority",
                    "resolved_stage_value": "o_orderstatus",
                    "record_name": "'Opportunity ' || o_orderkey",
                    "amount_usd": "o_totalprice",
                    "forecast_category": "'category_' || (o_orderkey % 3)",
                },
            ),
        ]
    )
    + ")"
)

ACTIVITY_ONLY = """
tenant_events AS (
  SELECT e.*, t.*, CAST(ts AS DATE) AS event_day
  FROM events e JOIN customer ON user_id = c_custkey JOIN tenants t ON c_nationkey = n_nationkey
), activity_raw AS (
  SELECT organization_id, tenant_name, tenant_domain, application_id,
         CASE event_type WHEN 'view' THEN 'calls' WHEN 'click' THEN 'EMAILS' ELSE 'TASKS' END AS module_key,
         'act_' || event_id AS record_id, 'act_' || event_id AS resolved_record_id,
         'u_' || (event_id % 6) AS resolved_owner_id, 'team_' || (event_id % 4) AS resolved_team_id,
         'terr_' || (event_id % 3) AS resolved_territory_id,
         CAST(NULL AS VARCHAR) AS resolved_stage_value, 'v2' AS schema_version,
         'esh_' || organization_id || '_activity' AS effective_schema_hash,
         ts AS cdc_timestamp, event_day AS activity_date,
         CASE WHEN event_id % 3 = 0 THEN 'INSERT' ELSE 'UPDATE' END AS operation_type,
         'acct_' || user_id AS account_id,
         'lead_' || (event_id % (SELECT count(*) FROM supplier)) AS lead_id,
         CASE event_type WHEN 'view' THEN 'CALL' WHEN 'click' THEN 'EMAIL' ELSE 'TASK' END AS activity_type,
         CAST(floor(value) AS BIGINT) AS duration_seconds,
         CASE event_type WHEN 'view' THEN 'CONNECTED' WHEN 'click' THEN 'OPENED' ELSE 'DONE' END AS outcome,
         props AS extras_json, 'run_1' AS pipeline_run_id, 'events.parquet' AS src_filename,
         TIMESTAMP '2024-02-01 00:00:00' AS loaded_at
  FROM tenant_events
)"""
ACTIVITY = TENANTS + "," + ACTIVITY_ONLY

KPI_ONLY = """
kpi_counts AS (
  SELECT organization_id, tenant_name, tenant_domain, tenant_company_size, event_day AS kpi_date,
         CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS pipeline_created_count,
         CAST(count(*) FILTER (event_type = 'signup') AS BIGINT) AS qualified_lead_count,
         CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS active_opportunity_count,
         CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS views,
         CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS duration,
         CAST(count(*) AS BIGINT) AS activity_volume
  FROM tenant_events WHERE event_day > (SELECT max(event_day) FROM tenant_events) - INTERVAL 14 DAY
  GROUP BY ALL
), kpi_raw AS (
  SELECT organization_id, tenant_name, tenant_domain, tenant_company_size, kpi_date,
         pipeline_created_count, qualified_lead_count, active_opportunity_count,
         pipeline_created_count / CAST(nullif(pipeline_created_count + qualified_lead_count, 0) AS DOUBLE)
           AS stage_conversion_rate,
         CAST(duration AS DOUBLE) / activity_volume / 10 AS avg_stage_dwell_days,
         activity_volume,
         activity_volume / CAST(60 AS DOUBLE) AS goal_attainment_ratio,
         active_opportunity_count / CAST(nullif(views, 0) AS DOUBLE) AS pipeline_coverage_ratio,
         CASE day(kpi_date) % 7 WHEN 0 THEN 'BLOCKED' WHEN 1 THEN 'PARTIAL' ELSE 'READY' END AS kpi_readiness_status,
         'run_1' AS pipeline_run_id, 'kpi.parquet' AS src_filename, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at
  FROM kpi_counts
)"""
KPI = ACTIVITY + "," + KPI_ONLY
RAW = RECORDS + "," + ACTIVITY_ONLY + "," + KPI_ONLY


def _marts(records: str = "records_raw", activity: str = "activity_raw", kpi: str = "kpi_raw") -> str:
    """Staging, intermediate and mart models, the record join in its either/or form."""
    kpi_columns = """k.organization_id, k.tenant_name, k.tenant_domain, k.tenant_company_size, k.kpi_date,
         k.pipeline_created_count, k.qualified_lead_count, k.active_opportunity_count, k.stage_conversion_rate,
         k.avg_stage_dwell_days, k.activity_volume, k.goal_attainment_ratio, k.pipeline_coverage_ratio,
         k.kpi_readiness_status"""
    return f"""
stg_records AS (
  SELECT * REPLACE (upper(module_key) AS module_key) FROM {records}
), stg_activity AS (
  SELECT * REPLACE (upper(module_key) AS module_key) FROM {activity}
), stg_kpi AS (
  SELECT * FROM {kpi}
), rollup_rows AS (
  SELECT organization_id, account_id, lead_id, activity_date,
         CAST(count(*) AS BIGINT) AS total_activities,
         CAST(count(*) FILTER (activity_type = 'CALL') AS BIGINT) AS call_count,
         CAST(count(*) FILTER (activity_type = 'EMAIL') AS BIGINT) AS email_count,
         CAST(count(*) FILTER (activity_type = 'TASK') AS BIGINT) AS task_count,
         CAST(sum(duration_seconds) AS BIGINT) AS total_duration_seconds
  FROM stg_activity GROUP BY ALL
), record_daily_activity AS (
  SELECT r.organization_id, r.tenant_name, r.tenant_domain, r.tenant_company_size, r.application_id,
         r.module_key, r.record_id, r.record_name, r.resolved_owner_id, r.resolved_team_id,
         r.resolved_territory_id, r.resolved_stage_value, CAST(r.cdc_timestamp AS DATE) AS record_date,
         coalesce(a.total_activities, 0) AS total_activities, coalesce(a.call_count, 0) AS call_count,
         coalesce(a.email_count, 0) AS email_count, coalesce(a.task_count, 0) AS task_count,
         coalesce(a.total_duration_seconds, 0) AS total_duration_seconds,
         r.health_score, r.lead_score_hint, r.amount_usd
  FROM stg_records r LEFT JOIN rollup_rows a
    ON r.organization_id = a.organization_id AND CAST(r.cdc_timestamp AS DATE) = a.activity_date
   AND ((r.module_key = 'ACCOUNTS' AND r.record_id = a.account_id)
     OR (r.module_key = 'LEADS' AND r.record_id = a.lead_id))
), daily_scorecard AS (
  SELECT {kpi_columns},
         CAST(count(*) FILTER (r.module_key = 'LEADS') AS BIGINT) AS lead_records_seen,
         CAST(count(*) FILTER (r.module_key = 'OPPORTUNITIES') AS BIGINT) AS opportunity_records_seen,
         CAST(count(*) FILTER (r.module_key = 'ACCOUNTS') AS BIGINT) AS account_records_seen,
         CAST(coalesce(sum(r.total_activities), 0) AS BIGINT) AS crm_activities_joined,
         round(coalesce(avg(r.health_score), 0), 6) AS avg_health_score,
         round(coalesce(avg(r.lead_score_hint), 0), 6) AS avg_lead_score_hint,
         round(coalesce(sum(r.amount_usd), 0), 2) AS pipeline_amount_usd
  FROM stg_kpi k LEFT JOIN record_daily_activity r
    ON k.organization_id = r.organization_id AND k.kpi_date = r.record_date
  GROUP BY {kpi_columns}
), pipeline_health AS (
  SELECT *, CASE WHEN kpi_readiness_status = 'BLOCKED' THEN 'BLOCKED'
                 WHEN pipeline_coverage_ratio >= 1.10 AND stage_conversion_rate >= 0.45 THEN 'HEALTHY'
                 WHEN pipeline_coverage_ratio >= 0.85 THEN 'WATCH' ELSE 'AT_RISK' END AS pipeline_health_status
  FROM daily_scorecard
), module_snapshot AS (
  SELECT organization_id, tenant_name, tenant_domain, tenant_company_size, module_key,
         CAST(count(*) AS BIGINT) AS record_count,
         CAST(count(DISTINCT resolved_owner_id) AS BIGINT) AS owner_count,
         CAST(count(DISTINCT resolved_team_id) AS BIGINT) AS team_count,
         CAST(count(DISTINCT resolved_stage_value) AS BIGINT) AS stage_count,
         round(avg(health_score), 6) AS avg_health_score,
         round(avg(lead_score_hint), 6) AS avg_lead_score_hint,
         round(sum(amount_usd), 2) AS total_amount_usd,
         max(cdc_timestamp) AS latest_cdc_timestamp
  FROM stg_records GROUP BY ALL
)"""


MODELS = f"WITH {RAW}, {_marts()} "

LEADS = """
lead_scores AS (
  SELECT 'lead_' || user_id AS lead_id, 'app_crm' AS application_id, 'acct_' || user_id AS account_id,
         'client_' || event_type AS client_id, CAST(ts AS DATE) AS feature_date, value AS lead_score,
         CASE WHEN value > 50 THEN 'HOT' ELSE 'COLD' END AS lead_score_band,
         event_id % 31 AS touchpoints_last_30d, event_id % 11 AS days_since_last_touch,
         'source_' || (event_id % 5) AS lead_source,
         CASE WHEN event_id % 2 = 0 THEN 'OPEN' ELSE 'WORKING' END AS lead_status,
         'Company ' || user_id AS company, 'Travel' AS industry, ts AS exported_at,
         'ALL' AS export_client_scope, CAST(CAST(ts AS DATE) AS VARCHAR) AS export_snapshot_date,
         'load_' || (event_id % 3) || '.parquet' AS src_filename,
         TIMESTAMP '2024-03-01 00:00:00' + to_hours(CAST(event_id % 3 AS INT)) AS loaded_at
  FROM events
)"""
LEAD_PAYLOAD = ", ".join(S.LEAD_SCORE.names)
LEAD_KEY = "client_id, lead_id, feature_date"

CHURN = """
churn AS (
  SELECT 'acct_' || (o_custkey % 200) AS account_id, 'app_crm' AS application_id,
         'client_' || (o_orderkey % 3) AS client_id,
         CAST(DATE '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INT)) AS DATE) AS feature_date,
         o_orderkey % 45 AS days_since_last_touch, o_orderkey % 31 AS interaction_count_last_30d,
         o_orderkey % 61 AS interaction_count_last_60d, o_orderkey % 17 AS num_calls,
         o_totalprice / 1000 AS avg_call_duration, o_orderkey % 501 AS total_interactions_lifetime,
         o_orderkey % 5 AS support_tickets_last_30d,
         (o_orderkey % 100) / CAST(50 AS DOUBLE) AS engagement_trend_ratio,
         o_orderkey % 365 AS days_to_contract_end,
         CASE WHEN o_totalprice > 200000 THEN 'HIGH' ELSE 'LOW' END AS contract_value_tier,
         o_orderkey % 365 < 90 AS is_in_renewal_window,
         (o_orderkey % 31) / CAST(30 AS DOUBLE) AS interaction_frequency_score,
         o_orderstatus = 'F' AS is_churned,
         (o_orderkey % 1000) / CAST(1000 AS DOUBLE) AS churn_risk_score,
         CASE WHEN o_orderkey % 1000 > 700 THEN 'HIGH' WHEN o_orderkey % 1000 > 300 THEN 'MEDIUM' ELSE 'LOW' END
           AS risk_category,
         'con_' || o_orderkey AS contract_id, CAST(o_orderdate AS DATE) AS contract_start_date,
         CAST(CAST(o_orderdate AS DATE) + to_days(365) AS DATE) AS contract_end_date,
         CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS contract_value,
         CASE WHEN o_orderkey % 2 = 0 THEN 'ACTIVE' ELSE 'EXPIRED' END AS contract_status,
         'Account ' || (o_custkey % 200) AS account_name, 'Travel' AS industry, 'mid' AS revenue_category,
         '200_999' AS employee_category,
         TIMESTAMP '2024-02-01 00:00:00' + to_seconds(CAST(o_orderkey AS INT)) AS exported_at,
         'ALL' AS export_client_scope,
         CAST(CAST(DATE '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INT)) AS DATE) AS VARCHAR)
           AS export_snapshot_date,
         'load_' || (o_orderkey % 2) || '.parquet' AS src_filename,
         TIMESTAMP '2024-03-01 00:00:00' + to_days(CAST(o_orderkey % 2 AS INT)) AS loaded_at
  FROM orders
)"""

# Change records ----------------------------------------------------------


def _bronze(k: str, client: str, unit: str = "to_seconds(CAST({k} AS INT))") -> dict[str, str]:
    """Fields every entity shares, as they arrive."""
    return {
        "applicationId": f"CASE WHEN {k} % 90 = 17 THEN '   ' ELSE 'app_crm' END",
        "clientId": f"CASE WHEN {k} % 60 <> 11 THEN 'client_' || ({client}) END",
        "operationType": "'UPSERT'",
        "cdc_timestamp": f"CASE WHEN {k} % 70 <> 13 THEN TIMESTAMP '2024-01-01 00:00:00' + {unit.format(k=k)} END",
    }


def _second(ts: str) -> str:
    return f"CAST(date_trunc('second', {ts}) AS TIMESTAMP)"


_ENTITY_SQL: dict[str, tuple[str, dict[str, str]]] = {
    "account": (
        "customer",
        {
            "accountId": "CASE WHEN c_custkey % 40 = 7 THEN ' ' ELSE 'ACC' || c_custkey END",
            "accountName": "c_name",
            "industry": "c_mktsegment",
            "annualRevenue": "c_acctbal",
            "numberOfEmployees": "CASE WHEN c_custkey % 30 = 4 THEN NULL ELSE CAST(c_custkey % 900 AS INTEGER) END",
            "accountType": "CASE WHEN c_custkey % 2 = 0 THEN 'Customer' ELSE 'Prospect' END",
        }
        | _bronze("c_custkey", "c_nationkey", "to_days(CAST({k} % 30 AS INT)) + to_hours(CAST({k} % 24 AS INT))"),
    ),
    "lead": (
        "supplier",
        {
            "leadId": "'LED' || s_suppkey",
            "accountId": "CASE WHEN s_suppkey % 3 <> 0 THEN 'ACC' || s_suppkey END",
            "firstName": "s_name",
            "lastName": "'User'",
            "email": "'lead' || s_suppkey || '@example.test'",
            "company": "'Company ' || s_suppkey",
            "leadSource": "'source_' || (s_suppkey % 4)",
            "leadStatus": "CASE WHEN s_suppkey % 2 = 0 THEN 'OPEN' ELSE 'WORKING' END",
            "createdDate": "CASE WHEN s_suppkey % 10 <> 3 THEN TIMESTAMP '2023-12-01 00:00:00' + to_hours(CAST(s_suppkey % 100 AS INT)) END",
        }
        | _bronze("s_suppkey", "s_nationkey"),
    ),
    "opportunity": (
        "orders",
        {
            "opportunityId": "'OPP' || o_custkey",
            "leadId": "'LED' || (o_orderkey % 50)",
            "accountId": "'ACC' || o_custkey",
            "stage": "o_orderpriority",
            "probability": "CAST(CASE WHEN o_orderkey % 45 = 8 THEN 20 ELSE o_orderkey % 101 END AS INTEGER)",
            "amount": "o_totalprice",
            "createdDate": "o_orderdate",
        }
        | _bronze("o_orderkey", "o_orderkey % 3"),
    ),
    "contract": (
        "orders",
        {
            "contractId": "'CON' || o_orderkey",
            "accountId": "'ACC' || o_custkey",
            "contractValue": "o_totalprice",
            "contractStatus": "CASE WHEN o_orderkey % 2 = 0 THEN 'ACTIVE' ELSE 'EXPIRED' END",
            "contractStartDate": "CASE WHEN o_orderkey % 33 <> 9 THEN CAST(o_orderdate AS DATE) END",
            "contractEndDate": "CAST(CAST(o_orderdate AS DATE) + to_days(365) AS DATE)",
        }
        | _bronze("o_orderkey", "o_orderkey % 3"),
    ),
    "call": (
        "events",
        {
            "callId": "'CAL' || event_id",
            "accountId": "'ACC' || user_id",
            "leadId": "'LED' || (event_id % 50)",
            "direction": "CASE WHEN event_id % 2 = 0 THEN 'INBOUND' ELSE 'OUTBOUND' END",
            "outcome": "event_type",
            "durationSeconds": "CAST(floor(value) AS INTEGER)",
            "callStartTime": _second("ts"),
        }
        | _bronze("event_id", "event_id % 3"),
    ),
    "email": (
        "events",
        {
            "emailId": "'EML' || event_id",
            "accountId": "'ACC' || user_id",
            "leadId": "'LED' || (event_id % 50)",
            "subject": "'Follow-up ' || event_id",
            "emailStatus": "event_type",
            "sentTime": _second("ts"),
        }
        | _bronze("event_id", "event_id % 3"),
    ),
}


# What a change record must hold.
_REQUIRED = {
    "account": ["applicationId", "accountId", "clientId", "cdc_timestamp", "operationType"],
    "lead": ["applicationId", "leadId", "clientId", "cdc_timestamp", "operationType"],
    "opportunity": ["applicationId", "opportunityId", "clientId", "cdc_timestamp", "operationType"],
    "contract": ["applicationId", "contractId", "clientId", "cdc_timestamp", "operationType"],
    "call": ["applicationId", "callId", "clientId", "cdc_timestamp", "operationType"],
    "email": ["applicationId", "emailId", "clientId", "cdc_timestamp", "operationType"],
}


def _entity(name: str) -> str:
    """``entity`` holds the typed rows; ``is_invalid`` their required-field verdict."""
    source, fields = _ENTITY_SQL[name]
    required = _REQUIRED[name]
    blank = {c: f"{c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''" for c in required}
    invalid = " OR ".join(blank.values())
    missing = ", ".join(f"CASE WHEN {test} THEN '{c}' END" for c, test in blank.items())
    select = ", ".join(f"{v} AS {c}" for c, v in fields.items())
    return f"""WITH typed AS (SELECT {select} FROM {source}),
entity AS (SELECT *, ({invalid}) AS is_invalid, concat_ws(',', {missing}) AS missing_fields FROM typed) """


def _time_parts(ts: str, hour: bool = True) -> str:
    parts = {"year": "year", "month": "month", "day": "day"} | ({"hour": "hour"} if hour else {})
    return ", ".join(f"CAST({f}({ts}) AS INTEGER) AS {c}" for c, f in parts.items())


def _n(column: str) -> str:
    return f"CAST(split_part({column}, '_', 2) AS BIGINT)"


# Staged text rows that fail their declared type.
BAD_RECORD = f"({_n('record_id')} % 97 = 5 OR {_n('record_id')} % 89 = 3)"
_records_names = ", ".join(S.RECORDS.names)
_activity_names = ", ".join(S.ACTIVITY.names)
_record_values = _records_names.replace(
    "health_score", "CAST(CAST(CAST(health_score AS DECIMAL(18, 4)) AS VARCHAR) AS DOUBLE) AS health_score"
)
_kpi_values = ", ".join(S.KPI.names).replace(
    "pipeline_created_count", "pipeline_created_count + 1 AS pipeline_created_count"
)
_latest = "QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
_load_order = "loaded_at DESC, exported_at DESC, src_filename DESC"


# The rules as the data contract has them.
_NOT_NULL = {'raw_records': ['organization_id', 'module_key', 'record_id'],
 'raw_activity': ['organization_id', 'module_key', 'record_id'],
 'raw_kpi': ['organization_id', 'kpi_date'],
 'stg_records': ['organization_id',
                 'module_key',
                 'application_id',
                 'operation_type',
                 'cdc_timestamp',
                 'resolved_record_id',
                 'record_id'],
 'stg_activity': ['organization_id',
                  'module_key',
                  'activity_type',
                  'application_id',
                  'activity_date',
                  'operation_type',
                  'record_id'],
 'stg_kpi': ['organization_id', 'kpi_date', 'kpi_readiness_status'],
 'record_daily_activity': ['organization_id', 'record_id', 'record_date', 'module_key'],
 'daily_scorecard': ['organization_id', 'kpi_date', 'kpi_readiness_status'],
 'pipeline_health': ['organization_id', 'kpi_date', 'pipeline_health_status'],
 'module_snapshot': ['organization_id', 'module_key']}
_ACCEPTED = {'stg_records': {'module_key': ['ACCOUNTS', 'LEADS', 'OPPORTUNITIES'], 'operation_type': ['INSERT', 'UPDATE']},
 'stg_activity': {'module_key': ['CALLS', 'EMAILS', 'TASKS'],
                  'activity_type': ['CALL', 'EMAIL', 'TASK'],
                  'operation_type': ['INSERT', 'UPDATE']},
 'stg_kpi': {'kpi_readiness_status': ['READY', 'PARTIAL', 'BLOCKED']},
 'record_daily_activity': {'module_key': ['ACCOUNTS', 'LEADS', 'OPPORTUNITIES']},
 'daily_scorecard': {'kpi_readiness_status': ['READY', 'PARTIAL', 'BLOCKED']},
 'pipeline_health': {'pipeline_health_status': ['BLOCKED', 'HEALTHY', 'WATCH', 'AT_RISK']},
 'module_snapshot': {'module_key': ['ACCOUNTS', 'LEADS', 'OPPORTUNITIES']}}
_GRAIN = {'record_daily_activity': ['organization_id', 'record_id', 'record_date'],
 'daily_scorecard': ['organization_id', 'kpi_date'],
 'pipeline_health': ['organization_id', 'kpi_date'],
 'module_snapshot': ['organization_id', 'module_key']}


def _not_null_sql() -> str:
    parts = [
        f"SELECT '{m}' AS model, 'not_null' AS check_name, '{c}' AS column_name, CAST(NULL AS VARCHAR) AS value, "
        f"CAST(count(*) AS BIGINT) AS violations FROM {m} WHERE {c} IS NULL HAVING count(*) > 0"
        for m, columns in _NOT_NULL.items()
        for c in columns
    ]
    return " UNION ALL ".join(parts)


def _accepted_sql() -> str:
    parts = []
    for m, rules in _ACCEPTED.items():
        for c, allowed in rules.items():
            inside = ", ".join(f"'{v}'" for v in allowed)
            parts.append(
                f"SELECT '{m}' AS model, 'accepted_values' AS check_name, '{c}' AS column_name, "
                f"{c} AS value, CAST(count(*) AS BIGINT) AS violations FROM {m} WHERE {c} NOT IN ({inside}) GROUP BY {c}"
            )
    return " UNION ALL ".join(parts)


DIRTY = f"""WITH {RAW}, raw_records AS (
  SELECT * REPLACE (
    CASE WHEN {_n('record_id')} % 53 <> 1 THEN application_id END AS application_id,
    CASE WHEN {_n('record_id')} % 59 = 2 THEN 'DELETE' ELSE operation_type END AS operation_type,
    CASE WHEN {_n('record_id')} % 61 = 3 THEN 'contacts' ELSE module_key END AS module_key,
    CASE WHEN {_n('record_id')} % 67 <> 4 THEN organization_id END AS organization_id,
    CASE WHEN {_n('record_id')} % 71 = 8 THEN upper(tenant_name) ELSE tenant_name END AS tenant_name) FROM records_raw
), raw_activity AS (
  SELECT * REPLACE (
    CASE WHEN {_n('record_id')} % 43 = 5 THEN 'CHAT' ELSE activity_type END AS activity_type,
    CASE WHEN {_n('record_id')} % 47 <> 6 THEN activity_date END AS activity_date) FROM activity_raw
), kpi_flawed AS (
  SELECT * REPLACE (CASE day(kpi_date) WHEN 20 THEN 'UNKNOWN' WHEN 21 THEN NULL ELSE kpi_readiness_status END
    AS kpi_readiness_status) FROM kpi_raw
), raw_kpi AS (
  SELECT * FROM kpi_flawed UNION ALL
  SELECT * REPLACE (lower(tenant_name) AS tenant_name) FROM kpi_flawed WHERE day(kpi_date) = 18
), {_marts('raw_records', 'raw_activity', 'raw_kpi')} """


def _unique(model: str) -> str:
    keys = ", ".join(_GRAIN[model])
    return (
        DIRTY + f"SELECT {keys}, CAST(count(*) AS BIGINT) AS row_count FROM {model} GROUP BY {keys} HAVING count(*) > 1"
    )


def _grain_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{m}' AS model, 'unique_grain' AS check_name, '{','.join(keys)}' AS column_name, "
        f"concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}) AS value, "
        f"CAST(count(*) AS BIGINT) AS violations FROM {m} GROUP BY {', '.join(keys)} HAVING count(*) > 1"
        for m, keys in _GRAIN.items()
    )


_SNAPSHOT_DOC = "Grain (organization_id, module_key): distinct records, owners, teams and stages, all days."
_SNAPSHOT_COLUMN_DOCS = {'organization_id': 'Tenant boundary.',
 'module_key': 'CRM module within the tenant.',
 'latest_cdc_timestamp': 'Newest change seen in the module.'}


def _json_seq(column: str, key: str) -> str:
    return f"CAST(json_extract(TRY_CAST({column} AS JSON), '$.{key}') AS BIGINT) AS extras_json"


_JOINED = """SELECT organization_id, module_key, record_id, record_date, total_activities, call_count,
  email_count, task_count, total_duration_seconds FROM record_daily_activity"""
_DELIVERED = f"WITH {LEADS}, delivered AS (SELECT *, CAST(substr(src_filename, 6, 1) AS BIGINT) AS load FROM lead_scores) "
_last_load = f"SELECT {LEAD_PAYLOAD} {{extra}} FROM delivered " + _latest.format(keys=LEAD_KEY, order="{order}")
_CLEAN_LEADS = "lead_id, client_id, feature_date, lead_score, touchpoints_last_30d, exported_at"

ORACLE: dict[str, str] = {
    # Models
    "p7_stg_records": MODELS + f"SELECT * REPLACE ({_json_seq('extras_json', 'seq').replace(' AS extras_json', '')} AS extras_json) FROM stg_records",
    "p8_stg_activity": MODELS + f"SELECT * REPLACE ({_json_seq('extras_json', 'k').replace(' AS extras_json', '')} AS extras_json) FROM stg_activity",
    "p9_stg_kpi": MODELS + "SELECT * FROM stg_kpi",
    "p10_variant_get": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        json_extract_string(props, '$.k') AS k_text, CAST(NULL AS DOUBLE) AS missing FROM events""",
    "p14_extras_encode": """SELECT c_custkey, '{' || CASE WHEN c_custkey % 4 <> 1 THEN '"band":"b' || (c_custkey % 4) || '",' ELSE '' END
        || '"nation":"' || c_nationkey || '","segment":"' || c_mktsegment || '"}' AS extras_json FROM customer""",
    "p15_extras_schema": f"""WITH {RECORDS}, docs AS (
          SELECT organization_id, TRY_CAST(extras_json AS JSON) AS doc FROM records_raw),
        fields AS (
          SELECT DISTINCT organization_id, key,
                 CASE WHEN json_type(doc, '$.' || key) = 'VARCHAR' THEN 'STRING' ELSE 'BIGINT' END AS type
          FROM (SELECT organization_id, doc, unnest(json_keys(doc)) AS key FROM docs WHERE doc IS NOT NULL))
        SELECT organization_id, 'OBJECT<' || string_agg(key || ': ' || type, ', ' ORDER BY key) || '>' AS extras_schema
        FROM fields GROUP BY organization_id""",
    "j1_record_activity_or": MODELS + _JOINED,
    "j1_record_activity_equi": MODELS + _JOINED,
    "j2_kpi_records": MODELS + """SELECT k.organization_id, k.kpi_date, k.kpi_readiness_status, r.module_key,
        r.record_id, r.total_activities FROM stg_kpi k LEFT JOIN record_daily_activity r
        ON k.organization_id = r.organization_id AND k.kpi_date = r.record_date""",
    "j4_tenant_dim": f"""WITH {TENANTS} SELECT c_custkey, c_nationkey, organization_id, tenant_name, tenant_domain,
        tenant_company_size, application_id FROM customer JOIN tenants ON c_nationkey = n_nationkey""",
    "a1_activity_rollup": MODELS + "SELECT * FROM rollup_rows",
    "m1_record_daily_activity": MODELS + "SELECT * FROM record_daily_activity",
    "m1_record_daily_activity_dedup": MODELS + """SELECT organization_id, tenant_name, tenant_domain,
        tenant_company_size, application_id, module_key, record_id, record_name, resolved_owner_id,
        resolved_team_id, resolved_territory_id, resolved_stage_value, record_date,
        CAST(sum(total_activities) AS BIGINT) AS total_activities, CAST(sum(call_count) AS BIGINT) AS call_count,
        CAST(sum(email_count) AS BIGINT) AS email_count, CAST(sum(task_count) AS BIGINT) AS task_count,
        CAST(sum(total_duration_seconds) AS BIGINT) AS total_duration_seconds,
        health_score, lead_score_hint, amount_usd FROM record_daily_activity GROUP BY ALL""",
    "m2_scorecard": MODELS + "SELECT * FROM daily_scorecard",
    "m2_scorecard_plain": MODELS + "SELECT * FROM daily_scorecard",
    "m3_pipeline_health": MODELS + "SELECT * FROM pipeline_health",
    "m4_module_snapshot": MODELS + "SELECT * FROM module_snapshot",
    "q_not_null": DIRTY + f"SELECT * EXCLUDE (value) FROM ({_not_null_sql()})",
    "q_checks": DIRTY + " UNION ALL ".join([_not_null_sql(), _accepted_sql(), _grain_sql()]),
    "q_accepted_values": DIRTY + _accepted_sql(),
    "q_unique_record_day": _unique("record_daily_activity"),
    "q_unique_scorecard": _unique("daily_scorecard"),
    "q_unique_health": _unique("pipeline_health"),
    "q_unique_snapshot": _unique("module_snapshot"),
    # Latest per key and upsert
    "w1_latest_churn": f"WITH {CHURN} SELECT * FROM churn "
    + _latest.format(keys="client_id, account_id, feature_date", order=_load_order),
    "w1_latest_churn_max_by": f"WITH {CHURN} SELECT * FROM churn "
    + _latest.format(keys="client_id, account_id, feature_date", order=_load_order),
    "w2_latest_lead": f"WITH {LEADS} SELECT * FROM lead_scores " + _latest.format(keys=LEAD_KEY, order=_load_order),
    "w3_latest_cdc": _entity("opportunity")
    + "SELECT * EXCLUDE (is_invalid, missing_fields) FROM entity "
    + _latest.format(keys="opportunityId", order='cdc_timestamp DESC NULLS FIRST, "createdDate" DESC NULLS FIRST, amount DESC NULLS FIRST'),
    "k16_upsert": f"""WITH {LEADS}, target AS (
          SELECT * FROM lead_scores WHERE src_filename <> 'load_2.parquet' {_latest.format(keys=LEAD_KEY, order=_load_order)}),
        src AS (
          SELECT * FROM lead_scores WHERE src_filename = 'load_2.parquet' {_latest.format(keys=LEAD_KEY, order=_load_order)})
        SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.client_id = t.client_id
          AND s.lead_id = t.lead_id AND s.feature_date = t.feature_date)
        UNION ALL SELECT * FROM src""",
    "k16_replay_null_keys": f"""WITH {LEADS}, marked AS (
          SELECT * REPLACE (CASE WHEN touchpoints_last_30d % 5 <> 0 THEN client_id END AS client_id) FROM lead_scores
          WHERE src_filename IN ('load_0.parquet', 'load_1.parquet')),
        one AS (SELECT * FROM marked {_latest.format(keys=LEAD_KEY + ', src_filename', order=_load_order)})
        SELECT {_CLEAN_LEADS} FROM one o WHERE src_filename = 'load_1.parquet' OR NOT EXISTS (
          SELECT 1 FROM one n WHERE n.src_filename = 'load_1.parquet' AND n.client_id = o.client_id
          AND n.lead_id = o.lead_id AND n.feature_date = o.feature_date)""",
    # Small operators
    "p3_time_parts": f"SELECT event_id, ts, CAST(ts AS DATE) AS event_date, {_time_parts('ts')} FROM events",
    "p6_constants": "SELECT c_custkey, 'ALL' AS export_client_scope, '2024-01-05' AS export_snapshot_date FROM customer",
    "f3_tenant_scope": f"WITH {CHURN} SELECT client_id, account_id, feature_date, contract_id FROM churn WHERE client_id = 'client_1'",
    "f4_snapshot_scope": f"WITH {CHURN} SELECT client_id, account_id, feature_date, contract_id FROM churn WHERE feature_date = DATE '2024-01-05'",
    "u1_union_modules": f"""WITH {RECORDS} SELECT organization_id, module_key, record_id, employee_band, health_score,
        lead_source, lead_score_hint, amount_usd, forecast_category FROM records_raw""",
    "x14_calendar_spine": f"""WITH {ACTIVITY}, orgs AS (SELECT DISTINCT organization_id FROM activity_raw),
        last AS (SELECT max(activity_date) AS d FROM activity_raw)
        SELECT organization_id, CAST(d - to_days(CAST(i AS INT)) AS DATE) AS kpi_date
        FROM orgs, last, range(0, 14) t(i)""",
    "x_scalars": """SELECT event_id, upper(event_type) AS kind_upper, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        CAST(ts AS DATE) AS event_date, coalesce(CASE WHEN event_type = 'view' THEN value END, 0) AS view_value,
        CASE WHEN value >= 100 THEN 'HIGH' WHEN value >= 10 THEN 'MID' ELSE 'LOW' END AS band,
        event_type AS trimmed, event_type = 'error' AS is_missing, CAST(year(ts) AS INTEGER) AS y,
        CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS dd, CAST(hour(ts) AS INTEGER) AS h,
        CAST(ts AS DATE) AS parsed_date, CAST(date_trunc('second', ts) AS TIMESTAMP) AS parsed_ts,
        CAST(NULL AS BIGINT) AS not_a_number, CAST(date_trunc('month', ts) AS DATE) AS event_month,
        CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) AS money FROM events""",
    # Sources
    "s1_bronze_json_scan": """SELECT CASE WHEN c_custkey % 90 = 17 THEN '   ' ELSE 'app_crm' END AS "applicationId",
        CASE WHEN c_custkey % 40 = 7 THEN ' ' ELSE 'ACC' || c_custkey END AS "accountId",
        CASE WHEN c_custkey % 60 <> 11 THEN 'client_' || c_nationkey END AS "clientId",
        c_name AS "accountName", c_mktsegment AS industry, CAST(c_acctbal AS VARCHAR) AS "annualRevenue",
        CASE WHEN c_custkey % 30 = 4 THEN 'many' ELSE CAST(c_custkey % 900 AS VARCHAR) END AS "numberOfEmployees",
        CASE WHEN c_custkey % 2 = 0 THEN 'Customer' ELSE 'Prospect' END AS "accountType",
        CASE WHEN c_custkey % 70 <> 13 THEN strftime(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 30 AS INT))
          + to_hours(CAST(c_custkey % 24 AS INT)), '%Y-%m-%dT%H:%M:%S+00:00') ELSE 'soon' END AS cdc_timestamp,
        'UPSERT' AS "operationType" FROM customer""",
    "s2_partition_discovery": """SELECT 2024 AS year, 1 AS month, 31 AS day, CAST(count(*) AS BIGINT) AS row_count,
        CAST(2 AS BIGINT) AS load_hours FROM customer""",
    "s3_parquet_stage_scan": f"""WITH {RECORDS} SELECT organization_id, module_key, record_id,
        CASE WHEN {_n('record_id')} % 89 = 3 THEN 'yesterday' ELSE strftime(cdc_timestamp, '%Y-%m-%dT%H:%M:%S.%f') END AS cdc_timestamp,
        CASE WHEN {_n('record_id')} % 97 = 5 THEN 'n/a' ELSE CAST(annual_revenue_usd AS VARCHAR) END AS annual_revenue_usd,
        CAST(CAST(health_score AS DECIMAL(18, 4)) AS VARCHAR) AS health_score FROM records_raw""",
    "s4_file_pattern": f"WITH {ACTIVITY} SELECT record_id, module_key, duration_seconds FROM activity_raw",
    "s5_lineage": f"""WITH {RECORDS} SELECT 'organization_id=' || organization_id || '/module_key=' || module_key AS src_folder,
        CAST(count(*) AS BIGINT) AS row_count FROM records_raw GROUP BY 1""",
    "s6_load_stamp": f"""WITH {RECORDS} SELECT upper(module_key) AS module_key, CAST(count(*) AS BIGINT) AS stamped_rows,
        CAST(1 AS BIGINT) AS stamps FROM records_raw GROUP BY 1""",
    "s7_load_records": f"WITH {RECORDS} SELECT {_record_values} FROM records_raw WHERE NOT {BAD_RECORD}",
    "s8_load_activity": f"WITH {ACTIVITY} SELECT {_activity_names} FROM activity_raw WHERE {_n('record_id')} % 83 <> 2",
    "s9_load_kpi": f"WITH {KPI} SELECT {_kpi_values} FROM kpi_raw WHERE day(kpi_date) % 11 <> 4",
    "s10_load_churn": f"WITH {CHURN} SELECT * EXCLUDE (src_filename, loaded_at) FROM churn WHERE {_n('contract_id')} % 71 <> 9",
    "s11_load_lead_score": f"WITH {LEADS} SELECT {LEAD_PAYLOAD} FROM lead_scores WHERE touchpoints_last_30d <> 13",
    "s12_on_error_continue": f"""WITH {RECORDS} SELECT organization_id,
        CAST(count(*) FILTER (NOT {BAD_RECORD}) AS BIGINT) AS loaded_rows,
        CAST(count(*) FILTER ({BAD_RECORD}) AS BIGINT) AS skipped_rows FROM records_raw GROUP BY 1""",
    "s12_drifting_files": f"""WITH {RECORDS} SELECT organization_id, module_key, record_id, cdc_timestamp, annual_revenue_usd,
        CASE WHEN {_n('record_id')} % 3 <> 0 THEN amount_usd END AS amount_usd
        FROM records_raw WHERE NOT {BAD_RECORD} OR {_n('record_id')} % 3 = 2""",
    "s13_load_partitioned": f"""WITH {KPI} SELECT organization_id, kpi_date,
        pipeline_created_count + 1 AS pipeline_created_count, activity_volume FROM kpi_raw WHERE day(kpi_date) % 11 <> 4""",
    "s13_backfill": f"WITH {LEADS} SELECT {_CLEAN_LEADS} FROM lead_scores",
    "s13_load_once": f"WITH {LEADS} SELECT {_CLEAN_LEADS} FROM lead_scores WHERE touchpoints_last_30d <> 13",
    "s14_table_scan": f"""WITH {RECORDS} SELECT organization_id, module_key, record_id, health_score
        FROM records_raw WHERE upper(module_key) = 'ACCOUNTS'""",
    "s16_external_table": f"""WITH {KPI} SELECT organization_id, CAST(kpi_date AS VARCHAR) AS kpi_date,
        CASE WHEN day(kpi_date) % 11 = 4 THEN 'many' ELSE pipeline_created_count || '.5' END AS pipeline_created_count,
        activity_volume FROM kpi_raw""",
    "s17_msck": f"""WITH {KPI} SELECT organization_id, CAST(0 AS BIGINT) AS rows_before,
        CAST(count(*) AS BIGINT) AS rows_after FROM kpi_raw GROUP BY 1""",
    # Bronze job
    "p1_schema_cast": _entity("account")
    + 'SELECT "accountId", "annualRevenue", "numberOfEmployees", cdc_timestamp FROM entity',
    "f1_required_invalid": _entity("contract") + 'SELECT "contractId", is_invalid, missing_fields FROM entity',
    "f2_split_good": _entity("opportunity") + "SELECT * EXCLUDE (is_invalid, missing_fields) FROM entity WHERE NOT is_invalid",
    "f2_split_bad": _entity("opportunity")
    + "SELECT * EXCLUDE (is_invalid), 'missing_required_field' AS validation_reason FROM entity WHERE is_invalid",
    "q4_quarantine_report": _entity("call")
    + "SELECT 'missing_required_field' AS validation_reason, missing_fields, CAST(count(*) AS BIGINT) AS row_count FROM entity WHERE is_invalid GROUP BY ALL",
    "k1_append_partitioned": _entity("account")
    + f"SELECT * EXCLUDE (is_invalid, missing_fields), {_time_parts('cdc_timestamp')} FROM entity WHERE NOT is_invalid",
    "k2_quarantine": _entity("call")
    + """SELECT "callId", "clientId", cdc_timestamp, CAST(hour(cdc_timestamp) AS INTEGER) AS hour,
        'missing_required_field' AS validation_reason FROM entity WHERE is_invalid""",
    "t6_bronze_stream": _entity("email")
    + """SELECT "emailId", "clientId", cdc_timestamp, "emailStatus",
        CASE WHEN is_invalid THEN 'missing_required_field' END AS validation_reason FROM entity""",
    # Sinks and tables
    "k3_export_gold": f"""WITH {CHURN} SELECT client_id, account_id, feature_date, contract_id,
        'client_1' AS export_client_scope, '2024-01-05' AS export_snapshot_date FROM churn
        WHERE client_id = 'client_1' AND feature_date = DATE '2024-01-05'""",
    "k4_partitioned_write": f"""WITH {RECORDS} SELECT organization_id, module_key, {_time_parts('cdc_timestamp', False)},
        record_id, operation_type FROM records_raw""",
    "k5_json_write": f"""WITH {ACTIVITY} SELECT record_id, duration_seconds, {_time_parts('cdc_timestamp')}
        FROM activity_raw""",
    "k6_views": f"""WITH {RECORDS} SELECT organization_id, upper(module_key) AS module_key, record_id, amount_usd
        FROM records_raw""",
    "k7_materialize": MODELS + """SELECT organization_id, kpi_date, lead_records_seen, opportunity_records_seen,
        account_records_seen, crm_activities_joined, pipeline_amount_usd, pipeline_health_status FROM pipeline_health""",
    "k8_docs": MODELS
    + f"SELECT '{_SNAPSHOT_DOC}' AS table_comment, column_name, comment, filled_rows FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, "
        + (f"'{_SNAPSHOT_COLUMN_DOCS[c]}'" if c in _SNAPSHOT_COLUMN_DOCS else "CAST(NULL AS VARCHAR)")
        + f" AS comment, CAST(count({c}) AS BIGINT) AS filled_rows FROM module_snapshot"
        for c in """organization_id tenant_name tenant_domain tenant_company_size module_key record_count
        owner_count team_count stage_count avg_health_score avg_lead_score_hint total_amount_usd
        latest_cdc_timestamp""".split()
    )
    + ")",
    "k9_ddl": f"""WITH {ACTIVITY} SELECT upper(module_key) AS module_key, CAST(count(*) AS BIGINT) AS row_count,
        CAST(1 AS BIGINT) AS tables_left FROM activity_raw WHERE {_n('record_id')} % 83 <> 2 GROUP BY 1""",
    "k12_silver_records": f"""WITH {RECORDS} SELECT * EXCLUDE (src_filename, loaded_at)
        REPLACE (CAST(round(amount_usd) AS BIGINT) AS amount_usd), CAST(cdc_timestamp AS DATE) AS event_date,
        {_time_parts('cdc_timestamp', False)}, CAST(date_trunc('month', cdc_timestamp) AS DATE) AS cdc_month
        FROM records_raw""",
    "k13_silver_activity": f"""WITH {ACTIVITY} SELECT * EXCLUDE (src_filename, loaded_at),
        {_time_parts('cdc_timestamp', False)}, CAST(date_trunc('month', cdc_timestamp) AS DATE) AS cdc_month
        FROM activity_raw""",
    "k14_silver_kpi": f"""WITH {KPI} SELECT * EXCLUDE (src_filename, loaded_at),
        CAST(date_trunc('month', kpi_date) AS DATE) AS kpi_month FROM kpi_raw""",
    # Streams
    "t1_auto_ingest": f"""WITH {LEADS} SELECT {_CLEAN_LEADS}, lead_score_band, lead_source, lead_status
        FROM lead_scores WHERE touchpoints_last_30d <> 13""",
    "t2_change_feed": _DELIVERED + "SELECT load AS batch_id, lead_id, client_id, feature_date, exported_at FROM delivered",
    "t3_microbatch": f"WITH {LEADS} SELECT * FROM lead_scores " + _latest.format(keys=LEAD_KEY, order=_load_order),
    "t4_stream_upsert": _DELIVERED + _last_load.format(extra="", order="load DESC, exported_at DESC"),
    "t5_late_rows": _DELIVERED
    + "SELECT * FROM ("
    + _last_load.format(extra=", 'last_load' AS rule", order="(load + 1) % 3 DESC, exported_at DESC")
    + ") UNION ALL SELECT * FROM ("
    + _last_load.format(extra=", 'newest_export' AS rule", order="exported_at DESC")
    + ")",
} | {f"p2_bronze_{e}": _entity(e) + "SELECT * EXCLUDE (is_invalid, missing_fields) FROM entity" for e in _ENTITY_SQL}

# Other ways to the same rows.
ORACLE |= {
    "t1_drifting_ingest": ORACLE["s12_drifting_files"],
    "s13_batch_load_once": ORACLE["s12_drifting_files"],
    "s13_load_history": f"""SELECT CAST(0 AS BIGINT) AS stray_files, CAST(1 AS BIGINT) AS unreadable_files, count(*) AS rows_loaded
        FROM ({ORACLE['s12_drifting_files']})""",
    "k16_bucketed": ORACLE["k16_upsert"],
    "m3_incremental": ORACLE["m3_pipeline_health"],
    "a1_incremental": ORACLE["a1_activity_rollup"],
    "t5_stateful_latest": ORACLE["t5_late_rows"],
    "q_observed": ORACLE["q_checks"],
    "w3_history": _entity("opportunity")
    + """, c AS (SELECT "opportunityId", cdc_timestamp AS ts, max(stage) AS stage FROM entity
          WHERE cdc_timestamp IS NOT NULL GROUP BY 1, 2),
        s AS (SELECT *, CASE WHEN second(ts) % 4 <> 0 THEN 's' || coalesce(stage, '') END AS st FROM c),
        p AS (SELECT *, lag(st) OVER (PARTITION BY "opportunityId" ORDER BY ts) AS was FROM s),
        e AS (SELECT *, lead(ts) OVER (PARTITION BY "opportunityId" ORDER BY ts) AS valid_to FROM p WHERE st IS DISTINCT FROM was)
        SELECT "opportunityId", stage, ts AS valid_from, valid_to FROM e WHERE st IS NOT NULL""",
}
