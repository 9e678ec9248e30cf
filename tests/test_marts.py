from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.operators import rollups
from crmtide.operators.joins import fanout_left_join, hot_records
from crmtide.operators.skew import hot_keys, key_hash
from crmtide.plans import marts, staging

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
TS = {D1: dt.datetime(2024, 1, 1, 9), D2: dt.datetime(2024, 1, 2, 9)}


def landing(spark, name, data):
    """Landing rows from partial dictionaries."""
    schema = S.landing_table_schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in data], schema)


def record(org, module, record_id, day, **more):
    return {"organization_id": org, "module_key": module, "record_id": record_id, "cdc_timestamp": TS.get(day)} | more


def act(org, account, lead, day, kind="CALL", seconds=10):
    return {
        "organization_id": org, "account_id": account, "lead_id": lead, "activity_date": day,
        "activity_type": kind, "duration_seconds": seconds, "module_key": "calls", "record_id": "x",
    }


def kpi(org, day, **more):
    return {"organization_id": org, "kpi_date": day, "kpi_readiness_status": "READY"} | more


@pytest.fixture(scope="module")
def frames(spark):
    records = landing(
        spark, "records",
        [
            record("o", "accounts", "a1", D1, health_score=10.0),
            record("o", "ACCOUNTS", "a1", D2, health_score=30.0),
            record("o", "ACCOUNTS", "a2", D1),
            record("o", "LEADS", "l1", D1, lead_score_hint=5.0),
            record("o", "LEADS", "a1", D1),
            record("o", "OPPORTUNITIES", "a1", D1, amount_usd=100.0),
            record("p", "ACCOUNTS", "a1", D1, health_score=50.0),
            record(None, "ACCOUNTS", "a1", D1, health_score=70.0),
            record("o", None, "a1", D1),
            record("o", "ACCOUNTS", None, D1),
            record("o", "ACCOUNTS", "a1", None),
        ],
    )
    activity = landing(
        spark, "activity",
        [
            act("o", "a1", "l1", D1), act("o", "a1", "l1", D1, "EMAIL", 0), act("o", "a1", "l2", D1, "TASK", None),
            act("o", "a1", None, D1, "TASK"), act("o", None, "l1", D1), act(None, "a1", "l1", D1),
            act("o", "a1", "l1", None), act("p", "a9", "l1", D1),
        ],
    )
    kpis = landing(
        spark, "kpi",
        [kpi("o", D1), kpi("o", D1), kpi("o", D2), kpi("p", D1, activity_volume=1), kpi("p", D1, activity_volume=2),
         kpi("q", D1), kpi(None, D1), kpi(None, D1)],
    )
    return staging.stg_records(records), staging.stg_activity(activity), staging.stg_kpi(kpis)


def either_or(records, activity):
    """The join as the condition reads: brute force over all pairs of a tiny fixture."""
    days = records.withColumn("record_date", F.col("cdc_timestamp").cast("date")).alias("r")
    a = rollups.activity_rollup(activity).alias("a")
    match = (
        (F.col("r.organization_id") == F.col("a.organization_id"))
        & (F.col("r.record_date") == F.col("a.activity_date"))
        & (
            ((F.col("r.module_key") == "ACCOUNTS") & (F.col("r.record_id") == F.col("a.account_id")))
            | ((F.col("r.module_key") == "LEADS") & (F.col("r.record_id") == F.col("a.lead_id")))
        )
    )
    return days.join(a, match, "left").select(
        "r.organization_id", "module_key", "record_id", "record_date",
        *[F.coalesce(m, F.lit(0)).alias(m) for m in rollups.ROLLUP_MEASURES], "health_score",
    )


def test_staging_shape_and_case(spark, frames):
    records, activity, kpis = frames
    assert (len(records.columns), len(activity.columns), len(kpis.columns)) == (28, 25, 17)
    assert dict(records.dtypes)["extras_json"] == "variant"
    assert {r[0] for r in activity.select("module_key").collect()} == {"CALLS"}


def test_rollup_groups_null_keys(frames):
    got = rows(rollups.activity_rollup(frames[1]).filter("organization_id = 'o' and activity_date = '2024-01-01'"),
               "account_id", "lead_id", "total_activities", "call_count", "email_count", "task_count", "total_duration_seconds")
    assert got == [
        (None, "l1", 1, 1, 0, 0, 10), ("a1", None, 1, 0, 0, 1, 10), ("a1", "l1", 2, 1, 1, 0, 10), ("a1", "l2", 1, 0, 0, 1, None),
    ]


@pytest.mark.parametrize("by_module", [False, True])
@pytest.mark.parametrize("min_rows", [None, 1, 2, 10**9])
def test_record_join_equals_either_or_condition(frames, by_module, min_rows):
    records, activity, _ = frames
    hot = None if min_rows is None else hot_records(rollups.activity_rollup(activity), min_rows)
    assert not hot if min_rows in (None, 10**9) else len(hot) > 0
    columns = ["organization_id", "module_key", "record_id", "record_date", *rollups.ROLLUP_MEASURES, "health_score"]
    got = marts.record_daily_activity(records, activity, by_module=by_module, hot=hot).select(*columns)
    want = either_or(records, activity).select(*columns)
    assert rows(got) == rows(want)
    assert got.filter("module_key = 'ACCOUNTS' and record_id = 'a1' and organization_id = 'o' and record_date = '2024-01-01'").count() == 3


def test_dedup_grain_adds_pairs_up(frames):
    records, activity, _ = frames
    got = marts.record_daily_activity(records, activity, dedup_grain=True)
    assert got.count() == records.count()
    hit = got.filter("organization_id = 'o' and module_key = 'ACCOUNTS' and record_id = 'a1' and record_date = '2024-01-01'")
    assert rows(hit, "total_activities", "total_duration_seconds") == [(4, 20)]


@pytest.mark.parametrize("hot_value", [None, "none", 1, 2])
def test_fanout_join_with_duplicates_and_nulls(spark, hot_value):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (3, "w")], "rk int, r string")
    hot = hot_value
    if hot_value is not None:
        hot = [r[0] for r in left.filter(F.col("k").cast("string") == str(hot_value)).select(key_hash(["k"])).collect()]
    got = fanout_left_join(left, right, ["k"], ["rk"], hot)
    want = left.join(right, F.col("k") == F.col("rk"), "left").drop("rk")
    assert rows(got, "k", "l", "r") == rows(want, "k", "l", "r")


def test_hot_keys_finds_the_heavy_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    heavy = spark.range(1).select(F.lit(0).cast("bigint").alias("k")).select(key_hash(["k"])).first()[0]
    assert hot_keys(df, ["k"], 9_000) == [heavy]
    assert hot_keys(df, ["k"], 11_000) == []
    assert hot_keys(df.withColumn("k", F.nullif("k", F.lit(0))), ["k"], 9_000) == []
    assert len(hot_keys(spark.range(40_000).select((F.col("id") % 20_000).alias("k")), ["k"], 2)) == 20_000


def test_weighted_scorecard_equals_plain(frames):
    records, activity, kpis = frames
    plain = marts.daily_scorecard(kpis, marts.record_daily_activity(records, activity))
    weighted = marts.daily_scorecard_weighted(kpis, records, activity)
    assert plain.columns == weighted.columns and plain.dtypes == weighted.dtypes
    assert rows(plain) == rows(weighted)
    by_day = {(r["organization_id"], r["kpi_date"], r["activity_volume"]): r for r in weighted.collect()}
    assert len(by_day) == weighted.count() == 6
    twice = by_day[("o", D1, None)]
    assert twice["opportunity_records_seen"] == 2 and twice["pipeline_amount_usd"] == 200.0
    assert by_day[("q", D1, None)]["avg_health_score"] == 0.0 and by_day[("q", D1, None)]["account_records_seen"] == 0
    assert by_day[(None, D1, None)]["account_records_seen"] == 0


@pytest.mark.parametrize(
    "ready, coverage, conversion, want",
    [
        ("BLOCKED", 2.0, 0.9, "BLOCKED"), ("READY", 1.10, 0.45, "HEALTHY"), ("READY", 1.10, 0.44, "WATCH"),
        ("READY", 1.09, 0.9, "WATCH"), ("PARTIAL", 0.85, None, "WATCH"), ("READY", 0.84, 0.9, "AT_RISK"),
        ("READY", None, 0.9, "AT_RISK"), (None, 1.2, 0.5, "HEALTHY"), (None, None, None, "AT_RISK"),
    ],
)
def test_health_status(spark, ready, coverage, conversion, want):
    df = spark.createDataFrame(
        [(ready, coverage, conversion)],
        "kpi_readiness_status string, pipeline_coverage_ratio double, stage_conversion_rate double",
    )
    assert marts.pipeline_health(df).first()["pipeline_health_status"] == want


def test_module_snapshot_equals_direct_aggregation(spark):
    data = [
        record("o", "LEADS", str(i), D1, resolved_owner_id=f"u{i % 3}" if i % 4 else None, resolved_team_id=f"t{i % 2}",
               resolved_stage_value=None, lead_score_hint=float(i) if i % 5 else None)
        for i in range(40)
    ] + [record("o", "ACCOUNTS", "a", D2)]
    records = staging.stg_records(landing(spark, "records", data))
    want = records.groupBy(*rollups.SNAPSHOT_KEYS).agg(
        F.count("*"), F.count_distinct("resolved_owner_id"), F.count_distinct("resolved_team_id"),
        F.count_distinct("resolved_stage_value"), F.avg("health_score"), F.avg("lead_score_hint"),
        F.sum("amount_usd"), F.max("cdc_timestamp"),
    )
    got = rollups.module_snapshot(records)
    assert rows(got) == rows(want)
    assert got.columns[5:] == [
        "record_count", "owner_count", "team_count", "stage_count", "avg_health_score", "avg_lead_score_hint",
        "total_amount_usd", "latest_cdc_timestamp",
    ]


def test_opportunities_skip_the_join(spark, frames):
    """Records of other modules reach the result without being shuffled."""
    records, activity, _ = frames
    plan = marts.record_daily_activity(records, activity)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
