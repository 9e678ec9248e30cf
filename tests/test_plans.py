"""The shape of the plans matters as much as their result."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.functions.columns import scoped
from crmtide.operators import upsert as U
from crmtide.operators.joins import fanout_left_join
from crmtide.operators.latest import latest_per_key
from crmtide.operators.skew import hot_keys
from crmtide.plans import jobs, marts, staging
from crmtide.sinks import files, tables
from crmtide.sources.stage import stage_relative


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def landed(spark, path, name, partitions):
    """A partitioned landing table on disk, so that plans show real scans."""
    schema = S.landing_table_schema(name)
    df = spark.createDataFrame([tuple("LEADS" if f.name in partitions else None for f in schema)], schema)
    df.write.partitionBy(*partitions).parquet(path(name))
    return spark.read.schema(df.schema).parquet(path(name))


@pytest.fixture
def frames(spark, path):
    return (
        staging.stg_records(landed(spark, path, "records", ["organization_id", "module_key"])),
        staging.stg_activity(landed(spark, path, "activity", ["organization_id", "module_key"])),
        staging.stg_kpi(landed(spark, path, "kpi", ["organization_id"])),
    )


def test_latest_cuts_partitions_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("loaded_at"))
    plan = physical(latest_per_key(df.repartition(4), ["k"], ["loaded_at"]))
    before_shuffle = plan[plan.rindex("Exchange hashpartitioning(k"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_snapshot_scope_prunes_directories(spark, path):
    df = spark.sql("select 1 v, date'2024-01-05' feature_date union all select 2, date'2024-01-06'")
    files.write_partitioned(df, path("t"), ["feature_date"])
    plan = physical(scoped(spark.read.parquet(path("t")), day="2024-01-05"))
    assert "PartitionFilters: [isnotnull(feature_date" in plan


def scans(plan: str, table: str) -> list[str]:
    """Scan lines of a table, told apart by a column only that table has."""
    column = {"records": "health_score", "activity": "account_id"}[table]
    return [line for line in plan.splitlines() if "FileScan" in line and column in line]


def test_record_join_prunes_modules_and_compares_no_pairs(frames):
    plan = physical(marts.record_daily_activity(frames[0], frames[1], hot=[]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    records = scans(plan, "records")
    assert len(records) == 2
    for scan in records:
        filters = scan.split("PartitionFilters: ")[1]
        assert "upper(module_key" in filters.split("PushedFilters")[0]
        assert "extras_json" not in scan


def test_scorecard_reads_only_its_columns(frames):
    plan = physical(marts.daily_scorecard_weighted(frames[2], frames[0], frames[1]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    for scan in scans(plan, "activity"):
        assert "ReadSchema: struct<activity_date:date,account_id:string,lead_id:string>" in scan
    for scan in scans(plan, "records"):
        assert "resolved_owner_id" not in scan and "extras_json" not in scan
    assert "Subquery" in scans(plan, "activity")[0].split("DataFilters")[1]


def test_upsert_reads_touched_partitions_only(spark, path):
    target = spark.sql("select 'a' k, explode(sequence(date'2024-01-01', date'2024-01-10')) d")
    target.write.partitionBy("d").parquet(path("t"))
    source = spark.createDataFrame([("a", dt.date(2024, 1, 3))], "k string, d date")
    touched = U.touched_partitions(U.read_curated(path("t"), source), source, "d")
    assert len(touched.inputFiles()) == 10 and "PartitionFilters: [" in physical(touched)
    assert rows(touched) == [("a", dt.date(2024, 1, 3))]


@pytest.mark.parametrize(
    "file, stage_path, want",
    [
        ("file:///lake/stage/a=1/x.parquet", "/lake/stage/", "a=1/x.parquet"),
        ("s3://bucket/gold/t/x.parquet", "s3://bucket/gold", "t/x.parquet"),
        ("s3://bucket/t/x.parquet", "s3://bucket", "t/x.parquet"),
        ("s3://other/x.parquet", "s3://bucket/gold", "s3://other/x.parquet"),
    ],
)
def test_stage_relative(spark, file, stage_path, want):
    df = spark.createDataFrame([(file,)], "f string")
    assert df.select(stage_relative(F.col("f"), stage_path)).first()[0] == want


def test_churn_batch_round_trip(spark, path):
    """Export, load, curate: the latest load of an account-day survives."""
    tables.ensure_database(spark, "churn_db", path("db"))
    gold = spark.sql(
        "select 'c' client_id, 'a' account_id, date'2024-01-05' feature_date, 0.5D churn_risk_score, 12.345BD contract_value"
    )
    jobs.export_gold(gold, path("gold"), "ALL", "2024-01-05")
    jobs.churn_batch(spark, path("gold"), "churn_db.raw", "churn_db.curated")
    jobs.export_gold(gold.withColumn("churn_risk_score", F.lit(0.9)), path("gold"), "ALL", "2024-01-05")
    jobs.churn_batch(spark, path("gold"), "churn_db.raw", "churn_db.curated", full_refresh=False)
    assert spark.table("churn_db.raw").count() == 2
    got = spark.table("churn_db.curated")
    assert rows(got, "client_id", "account_id", "churn_risk_score", "export_client_scope") == [("c", "a", 0.9, "ALL")]
    assert str(got.first()["contract_value"]) == "12.35"


def test_hot_key_on_the_right_is_split_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(50_000).selectExpr("concat('k', id) k", "id l")
        right = spark.range(0, 1_200_000, 1, 16).selectExpr(
            "if(id % 3 = 0, 'k0', concat('k', id % 100000)) rk", "id r", "concat('pad', hash(id)) pad"
        )
        results = {}
        for name, hot in (("plain", []), ("split", hot_keys(right, ["rk"], 200_000))):
            total = fanout_left_join(left, right, ["k"], ["rk"], hot).agg(
                F.count("*"), F.count("r"), F.sum("r"), F.max("pad")
            )
            results[name] = (total.collect(), physical(total).split("== Initial Plan ==")[0])
        assert results["plain"][0] == results["split"][0]
        assert "skew=true" in results["split"][1] and "skew=true" not in results["plain"][1]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
