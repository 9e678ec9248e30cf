"""Queries over the models, checks, joins and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.functions import columns as C
from crmtide.operators import joins, quality, rollups
from crmtide.operators.latest import latest_per_key
from crmtide.plans import incremental, marts, staging
from crmtide.plans.history import History
from crmtide.plans.incremental import Marts
from crmtide.session import ensure_utc
from crmtide.sinks.files import write_partitioned
from crmtide.sources.bronze import read_bronze, typed_bronze
from crmtide.workload import shapes, stages


@shapes.planned_once
def _records(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_records(shapes.records(spark, d))


@shapes.planned_once
def _activity(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_activity(shapes.activity(spark, d))


@shapes.planned_once
def _kpi(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_kpi(shapes.kpi(spark, d))


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _scorecard_out(df: DataFrame) -> DataFrame:
    return _rounded(df, avg_health_score=6, avg_lead_score_hint=6, pipeline_amount_usd=2)


def _variant_text(df: DataFrame) -> DataFrame:
    """VARIANT has no order or equality: show the one field every document has."""
    path = "$.seq" if "employee_band" in df.columns else "$.k"
    return df.withColumn("extras_json", F.try_variant_get("extras_json", path, "bigint"))


def p7_stg_records(spark: SparkSession, d: str) -> DataFrame:
    return _variant_text(_records(spark, d))


def p8_stg_activity(spark: SparkSession, d: str) -> DataFrame:
    return _variant_text(_activity(spark, d))


def p9_stg_kpi(spark: SparkSession, d: str) -> DataFrame:
    return _kpi(spark, d)


def p10_variant_get(spark: SparkSession, d: str) -> DataFrame:
    document = F.try_parse_json("props")
    return shapes.table(spark, d, "events").select(
        "event_id",
        C.extract(document, "$.k", "bigint").alias("k"),
        C.extract(document, "$.k", "string").alias("k_text"),
        C.extract(document, "$.missing", "double").alias("missing"),
    )


def p14_extras_encode(spark: SparkSession, d: str) -> DataFrame:
    fields = {
        "segment": F.col("c_mktsegment"),
        "band": F.when(F.col("c_custkey") % 4 != 1, F.concat(F.lit("b"), (F.col("c_custkey") % 4).cast("string"))),
        "nation": F.col("c_nationkey"),
    }
    return shapes.table(spark, d, "customer").select("c_custkey", C.encode_extras(fields).alias("extras_json"))


def p15_extras_schema(spark: SparkSession, d: str) -> DataFrame:
    """Which custom fields each tenant uses, and their types."""
    documents = shapes.records(spark, d).select("organization_id", F.try_parse_json("extras_json").alias("doc"))
    return documents.groupBy("organization_id").agg(F.schema_of_variant_agg("doc").alias("extras_schema"))


def _hot(spark: SparkSession, d: str) -> list[int]:
    return joins.hot_records(rollups.activity_rollup(_activity(spark, d)))


def j1_record_activity_equi(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d, by_module=False)


def j1_record_activity_or(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d, by_module=True)


def _joined(spark: SparkSession, d: str, by_module: bool) -> DataFrame:
    records, activity = _records(spark, d), _activity(spark, d)
    rows = marts.record_daily_activity(records, activity, by_module=by_module, hot=None if by_module else _hot(spark, d))
    return rows.select("organization_id", "module_key", "record_id", "record_date", *rollups.ROLLUP_MEASURES)


def j2_kpi_records(spark: SparkSession, d: str) -> DataFrame:
    records, activity, kpi = _records(spark, d), _activity(spark, d), _kpi(spark, d)
    daily = marts.record_daily_activity(records, activity, hot=_hot(spark, d)).select(
        "organization_id", "record_date", "module_key", "record_id", "total_activities"
    )
    kpi = kpi.select("organization_id", "kpi_date", "kpi_readiness_status")
    return joins.join_kpi_records(kpi, daily, marts.record_days(records))


def j4_tenant_dim(spark: SparkSession, d: str) -> DataFrame:
    customer = shapes.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return shapes.with_tenant(customer, "c_nationkey", shapes.tenants(spark, d)).drop("extra_key")


def a1_activity_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rollups.activity_rollup(_activity(spark, d))


def m1_record_daily_activity(spark: SparkSession, d: str) -> DataFrame:
    records, activity = _records(spark, d), _activity(spark, d)
    return marts.record_daily_activity(records, activity, hot=_hot(spark, d))


def m1_record_daily_activity_dedup(spark: SparkSession, d: str) -> DataFrame:
    records, activity = _records(spark, d), _activity(spark, d)
    return marts.record_daily_activity(records, activity, dedup_grain=True)


def m2_scorecard(spark: SparkSession, d: str) -> DataFrame:
    records, activity, kpi = _records(spark, d), _activity(spark, d), _kpi(spark, d)
    return _scorecard_out(marts.daily_scorecard_weighted(kpi, records, activity))


def m2_scorecard_plain(spark: SparkSession, d: str) -> DataFrame:
    records, activity, kpi = _records(spark, d), _activity(spark, d), _kpi(spark, d)
    daily = marts.record_daily_activity(records, activity, hot=_hot(spark, d))
    return _scorecard_out(marts.daily_scorecard(kpi, daily, marts.record_days(records)))


def m3_pipeline_health(spark: SparkSession, d: str) -> DataFrame:
    scorecard = marts.daily_scorecard_weighted(_kpi(spark, d), _records(spark, d), _activity(spark, d))
    return _scorecard_out(marts.pipeline_health(scorecard))


def _delivered(spark: SparkSession, d: str) -> Marts:
    """Sums after three deliveries: rows by number modulo 3, of which the first came with flaws that later ones correct."""
    frames = {"records": _records(spark, d), "activity": _activity(spark, d), "kpi": _kpi(spark, d)}

    def write(path: str) -> None:
        _deliver(Marts(spark, path, frames["kpi"].schema), frames)

    return Marts(spark, stages.once(spark, d, "incremental", write), frames["kpi"].schema)


def _deliver(kept: Marts, frames: dict[str, DataFrame]) -> None:
    part = {
        "records": F.pmod(F.xxhash64("record_id"), F.lit(3)),
        "activity": F.pmod(F.xxhash64("record_id"), F.lit(3)),
        "kpi": F.dayofmonth("kpi_date") % 3,
    }
    flaw = {
        "records": lambda df: df.withColumns({"amount_usd": F.col("amount_usd") + 5, "health_score": F.lit(1.0)}),
        "activity": lambda df: df.withColumn("account_id", F.lit("acct_1")),
        "kpi": lambda df: df.withColumn("pipeline_coverage_ratio", F.lit(9.0)),
    }
    for number in range(3):
        delivery = {n: incremental.signed(df.filter(part[n] == number)) for n, df in frames.items()}
        if number == 0:
            delivery = {n: flaw[n](df) for n, df in delivery.items()}
        if number == 1:
            for n, df in frames.items():
                right = df.filter(part[n] == 0)
                wrong = incremental.signed(flaw[n](right), -1)
                delivery[n] = delivery[n].unionByName(wrong).unionByName(incremental.signed(right))
        for _ in range(2 if number == 2 else 1):
            kept.deliver(number, **delivery)


def m3_incremental(spark: SparkSession, d: str) -> DataFrame:
    return _scorecard_out(_delivered(spark, d).mart("pipeline_health"))


def a1_incremental(spark: SparkSession, d: str) -> DataFrame:
    return _delivered(spark, d).activity_rollup()


def m4_module_snapshot(spark: SparkSession, d: str) -> DataFrame:
    snapshot = rollups.module_snapshot(_records(spark, d))
    return _rounded(snapshot, avg_health_score=6, avg_lead_score_hint=6, total_amount_usd=2)


def w1_latest_churn(spark: SparkSession, d: str, method: str = "window") -> DataFrame:
    latest = latest_per_key(shapes.churn(spark, d), S.CHURN_KEYS, method=method)
    return latest.withColumn("contract_value", F.col("contract_value").cast("double"))


def w1_latest_churn_max_by(spark: SparkSession, d: str) -> DataFrame:
    return w1_latest_churn(spark, d, method="aggregate")


def w2_latest_lead(spark: SparkSession, d: str) -> DataFrame:
    return latest_per_key(shapes.lead_scores(spark, d), S.LEAD_SCORE_KEYS)


def w3_latest_cdc(spark: SparkSession, d: str) -> DataFrame:
    """Newest version of every opportunity; an unreadable change time counts as the newest."""
    ensure_utc(spark)
    versions = typed_bronze(read_bronze(spark, "opportunity", stages.bronze_stage(spark, d, "opportunity")), "opportunity")
    latest = latest_per_key(versions, ["opportunityId"], order=["cdc_timestamp", "createdDate", "amount"])
    return latest.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("cdc_timestamp", "createdDate")})


def w3_history(spark: SparkSession, d: str) -> DataFrame:
    """Stages of every opportunity with their validity, from three deliveries out of order; some changes are deletes."""
    ensure_utc(spark)
    versions = typed_bronze(read_bronze(spark, "opportunity", stages.bronze_stage(spark, d, "opportunity")), "opportunity")
    at = F.col("cdc_timestamp").cast("timestamp_ntz")
    changes = versions.filter("cdc_timestamp is not null").groupBy("opportunityId", at.alias("cdc_timestamp")).agg(F.max("stage").alias("stage"))
    changes = changes.withColumn("operationType", F.when(F.second("cdc_timestamp") % 4 == 0, "DELETE").otherwise("UPDATE"))

    def write(path: str) -> None:
        kept = History(spark, path, changes.schema, ["opportunityId"], parts=4)
        for number, part in enumerate((2, 0, 1)):
            kept.deliver(number, changes.filter(F.second("cdc_timestamp") % 3 == part))

    kept = History(spark, stages.once(spark, d, "history", write), changes.schema, ["opportunityId"], parts=4)
    return kept.versions()


def u1_union_modules(spark: SparkSession, d: str) -> DataFrame:
    return C.union_modules(*shapes.record_modules(spark, d)).select(
        "organization_id", "module_key", "record_id", "employee_band", "health_score", "lead_source",
        "lead_score_hint", "amount_usd", "forecast_category",
    )


def x14_calendar_spine(spark: SparkSession, d: str) -> DataFrame:
    activity = shapes.activity(spark, d)
    last_day = activity.select(F.max("activity_date")).scalar()
    return C.calendar_spine(activity, "organization_id", last_day)


def x_scalars(spark: SparkSession, d: str) -> DataFrame:
    value, kind = F.col("value"), F.col("event_type")
    return shapes.table(spark, d, "events").select(
        "event_id",
        F.upper(kind).alias("kind_upper"),
        F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"),
        F.col("ts").cast("date").alias("event_date"),
        F.coalesce(F.when(kind == "view", value), F.lit(0.0)).alias("view_value"),
        F.when(value >= 100, "HIGH").when(value >= 10, "MID").otherwise("LOW").alias("band"),
        F.trim(F.concat(F.lit("  "), kind, F.lit(" "))).alias("trimmed"),
        F.when(kind == "error", F.lit(None)).otherwise(value).isNull().alias("is_missing"),
        F.year("ts").alias("y"),
        F.month("ts").alias("m"),
        F.dayofmonth("ts").alias("dd"),
        F.hour("ts").alias("h"),
        F.try_to_date(F.date_format("ts", "yyyy-MM-dd")).alias("parsed_date"),
        F.try_to_timestamp(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz").alias("parsed_ts"),
        kind.try_cast("bigint").alias("not_a_number"),
        F.trunc(F.col("ts").cast("date"), "MM").alias("event_month"),
        value.cast("decimal(18,2)").cast("double").alias("money"),
    )


def p3_time_parts(spark: SparkSession, d: str) -> DataFrame:
    events = shapes.table(spark, d, "events").select("event_id", "ts", F.col("ts").cast("date").alias("event_date"))
    return C.with_time_parts(events, "ts")


def p6_constants(spark: SparkSession, d: str) -> DataFrame:
    customer = shapes.table(spark, d, "customer").select("c_custkey")
    return C.with_constants(customer, {"export_client_scope": "ALL", "export_snapshot_date": "2024-01-05"})


def f3_tenant_scope(spark: SparkSession, d: str) -> DataFrame:
    return C.scoped(shapes.churn(spark, d), "client_1").select("client_id", "account_id", "feature_date", "contract_id")


def f4_snapshot_scope(spark: SparkSession, d: str) -> DataFrame:
    """Snapshot scope over a table partitioned by day: only its directory is read."""

    def write(path: str) -> None:
        write_partitioned(shapes.churn(spark, d), path, ["feature_date"])

    churn = spark.read.parquet(stages.once(spark, d, "churn-by-day", write))
    return C.scoped(churn, day="2024-01-05").select("client_id", "account_id", "feature_date", "contract_id")


@shapes.planned_once
def flawed_models(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The project built from rows that break its quality rules here and there."""

    def number(column: str):
        return F.split_part(F.col(column), F.lit("_"), F.lit(2)).cast("bigint")

    n = number("record_id")
    records = shapes.records(spark, d).withColumns(
        {
            "application_id": F.when(n % 53 != 1, F.col("application_id")),
            "operation_type": F.when(n % 59 == 2, "DELETE").otherwise(F.col("operation_type")),
            "module_key": F.when(n % 61 == 3, "contacts").otherwise(F.col("module_key")),
            "organization_id": F.when(n % 67 != 4, F.col("organization_id")),
            "tenant_name": F.when(n % 71 == 8, F.upper("tenant_name")).otherwise(F.col("tenant_name")),
        }
    )
    activity = shapes.activity(spark, d).withColumns(
        {
            "activity_type": F.when(n % 43 == 5, "CHAT").otherwise(F.col("activity_type")),
            "activity_date": F.when(n % 47 != 6, F.col("activity_date")),
        }
    )
    day = F.dayofmonth("kpi_date")
    kpi = shapes.kpi(spark, d).withColumn(
        "kpi_readiness_status",
        F.when(day == 20, "UNKNOWN").when(day != 21, F.col("kpi_readiness_status")),
    )
    again = kpi.filter(day == 18).withColumn("tenant_name", F.lower("tenant_name"))
    kpi = kpi.unionByName(again)
    models = {"raw_records": records, "raw_activity": activity, "raw_kpi": kpi}
    hot = joins.hot_records(rollups.activity_rollup(staging.stg_activity(activity)))
    return models | marts.build_marts(records, activity, kpi, hot)


def q_not_null(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_not_null(flawed_models(spark, d)).drop("value")


def q_accepted_values(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_accepted_values(flawed_models(spark, d))


def q_checks(spark: SparkSession, d: str) -> DataFrame:
    """Every rule of every model, grains included."""
    return quality.run_checks(flawed_models(spark, d))


def _duplicates(spark: SparkSession, d: str, model: str) -> DataFrame:
    return quality.unique_grain(flawed_models(spark, d)[model], S.UNIQUE_GRAIN[model])


def q_unique_record_day(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(spark, d, "record_daily_activity")


def q_unique_scorecard(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(spark, d, "daily_scorecard")


def q_unique_health(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(spark, d, "pipeline_health")


def q_unique_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(spark, d, "module_snapshot")


QUERIES = {
    f.__name__: f
    for f in (
        p3_time_parts, p6_constants, p7_stg_records, p8_stg_activity, p9_stg_kpi, p10_variant_get,
        p14_extras_encode, p15_extras_schema, f3_tenant_scope, f4_snapshot_scope, j1_record_activity_or,
        j1_record_activity_equi, j2_kpi_records, j4_tenant_dim, a1_activity_rollup,
        m1_record_daily_activity, m1_record_daily_activity_dedup, m2_scorecard, m2_scorecard_plain,
        m3_pipeline_health, m3_incremental, a1_incremental, m4_module_snapshot, w1_latest_churn, w1_latest_churn_max_by, w2_latest_lead,
        w3_latest_cdc, w3_history, u1_union_modules, x14_calendar_spine, x_scalars, q_not_null, q_accepted_values, q_checks,
        q_unique_record_day, q_unique_scorecard, q_unique_health, q_unique_snapshot,
    )
}
