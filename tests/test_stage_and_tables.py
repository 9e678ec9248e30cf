from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.operators import quality
from crmtide.plans import jobs
from crmtide.sinks import files, tables
from crmtide.sources import stage
from crmtide.sources import tables as table_source
from crmtide.sources.stage import file_schemas, load_landing, stage_schema

KPI_FILE = (
    "organization_id string, kpi_date string, tenant_name string, pipeline_created_count string, "
    "activity_volume double, stage_conversion_rate string, resolved int"
)
KPI_ROWS = [
    ("007", "2024-01-01", "t", "3", 2.5, "0.5", None),
    ("007", "2024-01-02", "t", "many", 1.0, "0.5", None),
    ("o", "2024-01-02", "t", None, None, None, None),
    ("o", "2024-01-03", "t", "4", 1.0, "high", None),
]


@pytest.fixture
def kpi_stage(spark, path):
    root = path("stage")
    files.write_partitioned(spark.createDataFrame(KPI_ROWS, KPI_FILE), root, S.SILVER_PARTITIONS["kpi"])
    return root


def test_partition_values_stay_text_and_conf_is_restored(spark, kpi_stage):
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    df = stage.read_stage(spark, kpi_stage)
    assert {r[0] for r in df.select("organization_id").collect()} == {"007", "o"}
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == before


def test_tolerant_load_skips_misfits_and_recovers_partition_columns(spark, kpi_stage):
    loaded = jobs.load_landing(spark, "kpi", kpi_stage)
    assert loaded.schema.names == S.landing_table_schema("kpi").names
    assert [f.dataType for f in loaded.schema] == [f.dataType for f in S.landing_table_schema("kpi")]
    assert rows(loaded, "organization_id", "kpi_date", "pipeline_created_count", "activity_volume") == [
        ("007", dt.date(2024, 1, 1), 3, 3), ("o", dt.date(2024, 1, 2), None, None),
    ]
    assert loaded.select("loaded_at").distinct().count() == 1
    sources = {r[0].rsplit("/", 1)[0] for r in loaded.select("src_filename").collect()}
    assert sources == {"organization_id=007/kpi_date=2024-01-01", "organization_id=o/kpi_date=2024-01-02"}
    staged = stage.with_lineage(stage.read_stage(spark, kpi_stage), kpi_stage)
    assert rows(stage.rejected_rows(staged, "kpi"), "kpi_date") == [("2024-01-02",), ("2024-01-03",)]
    checks = quality.check_not_null({"raw_kpi": loaded})
    assert checks.count() == 0


def test_fail_mode_stops_at_a_misfit(spark, kpi_stage):
    with pytest.raises(PySparkException, match="does not fit"):
        jobs.load_landing(spark, "kpi", kpi_stage, on_error="fail").collect()
    one = f"{kpi_stage}/organization_id=007/kpi_date=2024-01-01"
    assert jobs.load_landing(spark, "kpi", one, on_error="fail").count() == 1
    with pytest.raises(ValueError):
        jobs.load_landing(spark, "kpi", kpi_stage, on_error="ignore")


def test_pattern_regex_and_corrupt_files(spark, kpi_stage):
    (Path(kpi_stage) / "organization_id=o" / "kpi_date=2024-01-02" / "notes.txt").write_text("not data")
    assert stage.read_stage(spark, kpi_stage).count() == 4
    assert stage.read_stage(spark, kpi_stage, path_regex="kpi_date=2024-01-02/.*[.]parquet").count() == 2
    (Path(kpi_stage) / "organization_id=o" / "kpi_date=2024-01-03" / "broken.parquet").write_text("junk")
    schema = spark.createDataFrame([], KPI_FILE).schema
    assert stage.read_stage(spark, kpi_stage, schema=schema, ignore_corrupt_files=True).count() == 4
    with pytest.raises(ValueError):
        stage.read_stage(spark, kpi_stage, ignore_corrupt_files=True)


def test_all_null_column_of_another_type_loads_as_declared(spark, path):
    df = spark.createDataFrame([("o", "calls", None)], "organization_id string, module_key string, resolved_stage_value int")
    df.write.parquet(path("s"))
    loaded = jobs.load_landing(spark, "activity", path("s"))
    assert loaded.schema["resolved_stage_value"].dataType.simpleString() == "string"
    assert loaded.first()["resolved_stage_value"] is None


def test_landing_modes(spark, kpi_stage, path):
    tables.ensure_database(spark, "land", path("land"))
    tables.ensure_database(spark, "land", path("land"))
    rows_in = jobs.load_landing(spark, "kpi", kpi_stage)
    tables.create_landing(spark, "land.kpi", "kpi")
    assert spark.table("land.kpi").count() == 0
    assert spark.table("land.kpi").dtypes == rows_in.dtypes
    tables.append_landing(rows_in, "land.kpi")
    tables.append_landing(rows_in, "land.kpi")
    assert spark.table("land.kpi").count() == 4
    tables.append_landing(rows_in, "land.kpi", full_refresh=True)
    assert spark.table("land.kpi").count() == 2
    tables.create_landing(spark, "land.kpi", "kpi")
    assert spark.table("land.kpi").count() == 0
    tables.drop_table(spark, "land.kpi")
    tables.drop_table(spark, "land.kpi")
    assert not spark.catalog.tableExists("land.kpi")


def test_external_table_needs_recovery(spark, kpi_stage):
    schema = spark.createDataFrame([], KPI_FILE).schema
    tables.drop_table(spark, "kpi_ext")
    table_source.register_external(spark, "kpi_ext", schema, S.SILVER_PARTITIONS["kpi"], kpi_stage)
    assert table_source.read_table(spark, "kpi_ext").count() == 0
    table_source.recover_partitions(spark, "kpi_ext")
    assert table_source.read_table(spark, "kpi_ext").count() == 4
    plan = spark.table("kpi_ext").filter("organization_id = 'o'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(organization_id" in plan


def test_project_build_end_to_end(spark, path):
    """Stage folders to landing tables, views and documented marts."""
    root = path("stage")
    record = {"organization_id": "o", "module_key": "leads", "record_id": "l1", "cdc_timestamp": "2024-01-01T05:00:00",
              "lead_score_hint": 5.0, "extras_json": '{"a":"b"}'}
    act = {"organization_id": "o", "module_key": "CALLS", "record_id": "c1", "lead_id": "l1", "account_id": "a1",
           "activity_date": "2024-01-01", "activity_type": "CALL", "duration_seconds": 30}
    kpi = {"organization_id": "o", "kpi_date": "2024-01-01", "kpi_readiness_status": "READY",
           "pipeline_coverage_ratio": 1.2, "stage_conversion_rate": 0.5}
    for prefix, row, by in (
        ("silver_records_resolved", record, ["organization_id", "module_key"]),
        ("silver_activity_resolved", act, ["organization_id", "module_key"]),
        ("silver_kpi_daily_summary", kpi, ["organization_id", "kpi_date"]),
    ):
        files.write_partitioned(spark.createDataFrame([row]), f"{root}/{prefix}", by)
    tables.ensure_database(spark, "proj", path("proj"))
    for _ in range(2):
        landing = jobs.load_silver_landing(spark, root, "proj")
        models = jobs.build_project(spark, landing, "proj")
    health = spark.table("proj.pipeline_health")
    assert rows(health, "organization_id", "lead_records_seen", "crm_activities_joined", "pipeline_health_status") == [
        ("o", 1, 1, "HEALTHY")
    ]
    assert spark.table("proj.daily_scorecard").count() == 1 and models["module_snapshot"].count() == 1
    for name, comment in S.MODEL_DOCS.items():
        assert spark.catalog.getTable(f"proj.{name}").description == comment
    assert spark.catalog.getTable("proj.stg_records").tableType == "VIEW"
    broken = jobs.check_project(spark, landing, "proj")
    assert rows(broken.filter("model = 'stg_records'"), "check_name", "column_name") == [
        ("not_null", "application_id"), ("not_null", "operation_type"), ("not_null", "resolved_record_id")
    ]
    silver = jobs.build_silver(spark, root, "proj")
    got = spark.table(silver["records"])
    assert rows(got, "record_id", "lead_score_hint", "cdc_month") == [("l1", 5.0, dt.date(2024, 1, 1))]
    assert got.columns[-3:] == ["organization_id", "module_key", "cdc_month"]
    assert spark.catalog.getTable("proj.pipeline_health").description == S.MODEL_DOCS["pipeline_health"]
    comments = {c.name: c.description for c in spark.catalog.listColumns("proj.pipeline_health")}
    assert comments["kpi_date"] == S.COLUMN_DOCS["kpi_date"] and comments["tenant_name"] is None


def test_rebalanced_write_keeps_all_rows(spark, path):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 5).otherwise(0).alias("p"), F.col("id")
    )
    files.write_partitioned(df, path("out"), ["p"])
    assert spark.read.parquet(path("out")).agg(F.count("*"), F.sum("id")).first()[:] == (2000, 1999000)


def _records_file(spark, path, **columns):
    row = {"organization_id": "'o1'", "record_id": "'r'", **columns}
    spark.sql("select " + ", ".join(f"{v} as {c}" for c, v in row.items())).coalesce(1).write.mode("append").parquet(path)


def test_files_with_other_columns_or_types_all_load(spark, path):
    _records_file(spark, path("s") + "/module_key=007", record_id="'a'", amount_usd="5.0D", annual_revenue_usd="'12.5'")
    _records_file(spark, path("s") + "/module_key=007", record_id="'b'", annual_revenue_usd="99L")
    _records_file(spark, path("s") + "/module_key=X", record_id="'c'", annual_revenue_usd="'many'", note="'undeclared'")
    (Path(path("s")) / "broken.parquet").write_bytes(b"no footer")
    got = load_landing(spark, "records", path("s"))
    assert rows(got, "record_id", "module_key", "amount_usd", "annual_revenue_usd") == [("a", "007", 5.0, 13), ("b", "007", None, 99)]
    assert got.filter("src_filename like 'module_key=007/%'").count() == 2
    problems = file_schemas(spark, path("s")).filter("problem is not null")
    assert [r["file"].rpartition("/")[2] for r in problems.collect()] == ["broken.parquet"]
    with pytest.raises(ValueError, match="broken.parquet"):
        load_landing(spark, "records", path("s"), on_error="fail")


def test_a_stage_without_files_loads_nothing(spark, path):
    Path(path("none")).mkdir()
    assert load_landing(spark, "kpi", path("none")).count() == 0


def test_a_stream_refuses_a_column_of_two_types(spark, path):
    _records_file(spark, path("s"), annual_revenue_usd="'1'")
    assert stage_schema(spark, "records", path("s"), False)["annual_revenue_usd"].dataType.simpleString() == "string"
    _records_file(spark, path("s"), annual_revenue_usd="1L")
    with pytest.raises(ValueError, match="annual_revenue_usd"):
        stage_schema(spark, "records", path("s"), False)
