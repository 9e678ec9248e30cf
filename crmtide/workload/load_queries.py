"""Queries over sources, sinks, table lifecycle and streams."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmtide import schemas as S
from crmtide.functions.columns import missing_fields, required_invalid, with_time_parts
from crmtide.operators.latest import latest_per_key
from crmtide.operators.upsert import upsert
from crmtide.operators.validate import quarantine_report, split_valid
from crmtide.plans import jobs, marts, staging
from crmtide.session import ensure_utc, shared_dir
from crmtide.sinks import files, tables
from crmtide.sources import stage as stage_source
from crmtide.sources import tables as table_source
from crmtide.sources.bronze import read_bronze, typed_bronze
from crmtide.streaming import ingest
from crmtide.workload import model_queries, shapes, stages


def _plain(df: DataFrame) -> DataFrame:
    """Instants as wall clock in UTC, exact decimals as doubles: comparable anywhere."""
    convert = {}
    for f in df.schema:
        if isinstance(f.dataType, T.TimestampType):
            convert[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            convert[f.name] = F.col(f.name).cast("double")
    return df.withColumns(convert) if convert else df


def _database(spark: SparkSession, purpose: str) -> str:
    """A new database in the shared folder."""
    name = f"crm_{purpose}_{uuid.uuid4().hex[:12]}"
    tables.ensure_database(spark, name, shared_dir(spark, name))
    return name


def _folder(column: str):
    return F.regexp_extract(column, "^(.*)/[^/]*$", 1)


def _bronze(spark: SparkSession, d: str, entity: str, **options) -> DataFrame:
    ensure_utc(spark)
    return read_bronze(spark, entity, stages.bronze_stage(spark, d, entity), **options)


# Sources -----------------------------------------------------------------


def s1_bronze_json_scan(spark: SparkSession, d: str) -> DataFrame:
    return _bronze(spark, d, "account")


def s2_partition_discovery(spark: SparkSession, d: str) -> DataFrame:
    scan = _bronze(spark, d, "account", with_path_cols=True)
    return scan.groupBy("year", "month", "day").agg(
        F.count("*").alias("row_count"), F.count_distinct("hour").alias("load_hours")
    )


def s3_parquet_stage_scan(spark: SparkSession, d: str) -> DataFrame:
    return stage_source.read_stage(spark, stages.records_stage(spark, d)).select(
        "organization_id", "module_key", "record_id", "cdc_timestamp", "annual_revenue_usd", "health_score"
    )


def s4_file_pattern(spark: SparkSession, d: str) -> DataFrame:
    """Only the Parquet files of a folder that also holds JSON files."""

    def write(path: str) -> None:
        activity = shapes.activity(spark, d).select("record_id", "module_key", "duration_seconds")
        activity.write.parquet(path)
        activity.write.mode("append").json(path)

    return stage_source.read_stage(
        spark, stages.once(spark, d, "stage-mixed", write), path_regex=r".*[.]parquet"
    )


def s5_lineage(spark: SparkSession, d: str) -> DataFrame:
    path = stages.records_stage(spark, d)
    scan = stage_source.with_lineage(stage_source.read_stage(spark, path), path)
    return scan.groupBy(_folder("src_filename").alias("src_folder")).agg(F.count("*").alias("row_count"))


def s6_load_stamp(spark: SparkSession, d: str) -> DataFrame:
    path = stages.records_stage(spark, d)
    scan = stage_source.with_lineage(stage_source.read_stage(spark, path), path)
    return scan.groupBy(F.upper("module_key").alias("module_key")).agg(
        F.count("loaded_at").alias("stamped_rows"),
        F.count_distinct("loaded_at").alias("stamps"),
    )


def _landed(spark: SparkSession, name: str, path: str) -> DataFrame:
    return _plain(jobs.load_landing(spark, name, path).drop("src_filename", "loaded_at"))


def s7_load_records(spark: SparkSession, d: str) -> DataFrame:
    return _landed(spark, "records", stages.records_stage(spark, d))


def s8_load_activity(spark: SparkSession, d: str) -> DataFrame:
    return _landed(spark, "activity", stages.activity_stage(spark, d))


def s9_load_kpi(spark: SparkSession, d: str) -> DataFrame:
    return _landed(spark, "kpi", stages.kpi_stage(spark, d))


def s10_load_churn(spark: SparkSession, d: str) -> DataFrame:
    return _landed(spark, "churn", stages.churn_stage(spark, d))


def s11_load_lead_score(spark: SparkSession, d: str) -> DataFrame:
    return _landed(spark, "lead_score", stages.lead_score_stage(spark, d))


def s12_on_error_continue(spark: SparkSession, d: str) -> DataFrame:
    """Rows loaded and rows skipped, by tenant."""
    path = stages.records_stage(spark, d)
    staged = stage_source.with_lineage(stage_source.read_stage(spark, path), path)
    loaded = stage_source.type_landing(staged, "records").groupBy("organization_id")
    skipped = stage_source.rejected_rows(staged, "records").groupBy("organization_id")
    return loaded.agg(F.count("*").alias("loaded_rows")).join(
        skipped.agg(F.count("*").alias("skipped_rows")), "organization_id", "full"
    )


LEAD_OUT = ["lead_id", "client_id", "feature_date", "lead_score", "touchpoints_last_30d", "exported_at"]


def s13_load_once(spark: SparkSession, d: str) -> DataFrame:
    """The second run finds no new file and adds nothing."""
    source, root = stages.lead_score_stage(spark, d), shared_dir(spark, "load-once")
    for _ in range(2):
        ingest.load_incremental(spark, "lead_score", source, f"{root}/raw", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/raw").select(*LEAD_OUT)


def s12_drifting_files(spark: SparkSession, d: str) -> DataFrame:
    """One stage whose files lack a column, hold text or numbers for the same field, or are no Parquet at all."""
    path = stages.drifting_stage(spark, d)
    return jobs.load_landing(spark, "records", path).select(
        "organization_id", "module_key", "record_id", "cdc_timestamp", "annual_revenue_usd", "amount_usd"
    )


def s13_load_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """Tenant and day, which only the folder names hold, of a stage that is loaded file by file."""
    source, root = stages.kpi_stage(spark, d), shared_dir(spark, "load-partitioned")
    for _ in range(2):
        ingest.load_incremental(spark, "kpi", source, f"{root}/raw", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/raw").select("organization_id", "kpi_date", "pipeline_created_count", "activity_volume")


DRIFT_OUT = ["organization_id", "module_key", "record_id", "cdc_timestamp", "annual_revenue_usd", "amount_usd"]


def t1_drifting_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The stage whose files differ, loaded continuously a few files at a time, then asked for again."""
    source, root = stages.drifting_stage(spark, d), shared_dir(spark, "drifting-ingest")
    for _ in range(2):
        ingest.load_incremental(
            spark, "records", source, f"{root}/raw", f"{root}/checkpoint", drifting=True, max_files_per_trigger=8
        )
    return spark.read.parquet(f"{root}/raw").select(*DRIFT_OUT)


def s13_load_history(spark: SparkSession, d: str) -> DataFrame:
    """Files met by a continuous load: how many were loaded, how many are no Parquet."""
    source, root = stages.drifting_stage(spark, d), shared_dir(spark, "load-history")
    for _ in range(2):
        ingest.load_incremental(spark, "records", source, f"{root}/raw", f"{root}/checkpoint", drifting=True)
    loaded = spark.read.parquet(f"{root}/raw").count()
    return ingest.loaded_files(spark, f"{root}/raw").agg(
        F.count_if(F.col("problem").isNull() & ~F.col("file").like("%/module_key=%")).alias("stray_files"),
        F.count_if(F.col("problem").isNotNull()).alias("unreadable_files"),
        F.lit(loaded).cast("bigint").alias("rows_loaded"),
    )


def s13_batch_load_once(spark: SparkSession, d: str) -> DataFrame:
    """The batch load into a catalog table, run twice: the second run skips the files of the first."""
    name = f"{_database(spark, 'once')}.records_raw"
    for _ in range(2):
        jobs.load_once(spark, "records", stages.drifting_stage(spark, d), name)
    return spark.table(name).select(*DRIFT_OUT)


def k16_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Curated lead scores whose days are split into parts by key."""
    leads = shapes.lead_scores(spark, d)
    path = shared_dir(spark, "bucketed")
    for numbers in ((0, 1), (2,)):
        latest = latest_per_key(_load(leads, *numbers), S.LEAD_SCORE_KEYS)
        upsert(path, latest, S.LEAD_SCORE_KEYS, "feature_date", buckets=4)
    return spark.read.schema(leads.schema).parquet(path).select(*leads.columns)


def s13_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Files dated long before those loaded first are loaded by the next run."""
    leads, root = shapes.lead_scores(spark, d), shared_dir(spark, "backfill")
    for number in range(3):
        _deliver(leads, f"{root}/stage", number)
        if number:
            stages.date_back(spark, f"{root}/stage", days=400 * number)
        ingest.load_incremental(spark, "lead_score", f"{root}/stage", f"{root}/raw", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/raw").select(*LEAD_OUT)


def s14_table_scan(spark: SparkSession, d: str) -> DataFrame:
    name = f"{_database(spark, 'scan')}.accounts"
    tables.materialize(shapes.record_modules(spark, d)[0], name)
    return table_source.read_table(spark, name).select("organization_id", "module_key", "record_id", "health_score")


def _external(spark: SparkSession, d: str) -> tuple[str, int]:
    name = f"{_database(spark, 'ext')}.kpi_ext"
    text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in ("kpi_date", "pipeline_created_count") else f.dataType) for f in S.KPI]
    )
    table_source.register_external(
        spark, name, text, S.SILVER_PARTITIONS["kpi"], stages.kpi_stage(spark, d)
    )
    before = spark.table(name).count()
    table_source.recover_partitions(spark, name)
    return name, before


def s16_external_table(spark: SparkSession, d: str) -> DataFrame:
    name, _ = _external(spark, d)
    return spark.table(name).select("organization_id", "kpi_date", "pipeline_created_count", "activity_volume")


def s17_msck(spark: SparkSession, d: str) -> DataFrame:
    """Rows per tenant before and after partition recovery."""
    name, before = _external(spark, d)
    return spark.table(name).groupBy("organization_id").agg(
        F.lit(before).cast("bigint").alias("rows_before"), F.count("*").alias("rows_after")
    )


# Bronze job --------------------------------------------------------------


def _typed(spark: SparkSession, d: str, entity: str) -> DataFrame:
    return typed_bronze(_bronze(spark, d, entity), entity)


def p1_schema_cast(spark: SparkSession, d: str) -> DataFrame:
    """Which values of each account did not fit their declared type."""
    raw = _bronze(spark, d, "account")
    typed = typed_bronze(raw, "account")
    return _plain(typed.select("accountId", "annualRevenue", "numberOfEmployees", "cdc_timestamp"))


def p2_bronze(spark: SparkSession, d: str, entity: str) -> DataFrame:
    return _plain(_typed(spark, d, entity))


def f1_required_invalid(spark: SparkSession, d: str) -> DataFrame:
    required = S.required_fields(S.ENTITY_SCHEMAS["contract"])
    return _typed(spark, d, "contract").select(
        "contractId",
        required_invalid(required).alias("is_invalid"),
        F.array_join(missing_fields(required), ",").alias("missing_fields"),
    )


def _split(spark: SparkSession, d: str, entity: str) -> tuple[DataFrame, DataFrame]:
    return split_valid(_typed(spark, d, entity), S.required_fields(S.ENTITY_SCHEMAS[entity]))


def f2_split_good(spark: SparkSession, d: str) -> DataFrame:
    return _plain(_split(spark, d, "opportunity")[0])


def f2_split_bad(spark: SparkSession, d: str) -> DataFrame:
    return _plain(_split(spark, d, "opportunity")[1])


def q4_quarantine_report(spark: SparkSession, d: str) -> DataFrame:
    return quarantine_report(_split(spark, d, "call")[1])


def _bronze_job(spark: SparkSession, d: str, entity: str) -> tuple[str, str]:
    name = f"{_database(spark, 'silver')}.{entity}"
    quarantine = shared_dir(spark, "quarantine")
    jobs.bronze_to_silver(spark, entity, stages.bronze_stage(spark, d, entity), name, quarantine)
    return name, f"{quarantine}/{entity}"


def k1_append_partitioned(spark: SparkSession, d: str) -> DataFrame:
    name, _ = _bronze_job(spark, d, "account")
    return _plain(spark.table(name).drop("ingested_at"))


def k2_quarantine(spark: SparkSession, d: str) -> DataFrame:
    _, path = _bronze_job(spark, d, "call")
    return _plain(spark.read.parquet(path).select("callId", "clientId", "cdc_timestamp", "hour", "validation_reason"))


def k3_export_gold(spark: SparkSession, d: str) -> DataFrame:
    churn = shapes.churn(spark, d)
    leaf = jobs.export_gold(churn, shared_dir(spark, "export"), "client_1", "2024-01-05")
    exported = stage_source.read_stage(spark, leaf, leaf_columns_only=True)
    return exported.select(
        "client_id", "account_id", "feature_date", "contract_id", "export_client_scope", "export_snapshot_date"
    )


def k4_partitioned_write(spark: SparkSession, d: str) -> DataFrame:
    records = with_time_parts(shapes.records(spark, d), "cdc_timestamp", hour=False)
    root = shared_dir(spark, "records")
    files.write_partitioned(records, root, S.SILVER_PARTITIONS["records"])
    return spark.read.parquet(root).select(*S.SILVER_PARTITIONS["records"], "record_id", "operation_type")


def k5_json_write(spark: SparkSession, d: str) -> DataFrame:
    """Rows written as JSON lines by hour and read back, keys and folders included."""
    rows = shapes.activity(spark, d).select("record_id", "duration_seconds", "cdc_timestamp")
    root = shared_dir(spark, "json")
    files.write_bronze(with_time_parts(rows.withColumn("cdc_timestamp", F.col("cdc_timestamp").cast("string")), "cdc_timestamp"), root, "activity")
    scan = spark.read.schema("record_id string, duration_seconds bigint, cdc_timestamp string").json(f"{root}/activity")
    return scan.select("record_id", "duration_seconds", *S.EVENT_HOUR)


def _models(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return marts.build_marts(shapes.records(spark, d), shapes.activity(spark, d), shapes.kpi(spark, d))


def k6_views(spark: SparkSession, d: str) -> DataFrame:
    """A view kept in the database sees rows that reach its table after it was made."""
    database = _database(spark, "views")
    tables.create_landing(spark, f"{database}.records_raw", "records")
    view = f"{database}.stg_records"
    tables.create_view(spark, view, staging.columns("records"), f"{database}.records_raw", S.MODEL_DOCS["stg_records"])
    tables.append_landing(shapes.records(spark, d), f"{database}.records_raw")
    return spark.table(view).select("organization_id", "module_key", "record_id", "amount_usd")


def k7_materialize(spark: SparkSession, d: str) -> DataFrame:
    name = f"{_database(spark, 'mart')}.pipeline_health"
    tables.materialize(_models(spark, d)["pipeline_health"], name, S.MODEL_DOCS["pipeline_health"])
    return spark.table(name).select(
        "organization_id", "kpi_date", "lead_records_seen", "opportunity_records_seen", "account_records_seen",
        "crm_activities_joined", F.round("pipeline_amount_usd", 2).alias("pipeline_amount_usd"),
        "pipeline_health_status",
    )


def k8_docs(spark: SparkSession, d: str) -> DataFrame:
    """Stored comments of a mart, next to how many rows carry each column."""
    name = f"{_database(spark, 'docs')}.module_snapshot"
    tables.materialize(_models(spark, d)["module_snapshot"], name, S.MODEL_DOCS["module_snapshot"])
    table = spark.table(name)
    comments = {c.name: c.description for c in spark.catalog.listColumns(name)}
    columns = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(comments[c]).alias("comment"), F.col(c).alias("filled_rows"))
            for c in table.columns
        ]
    )
    return table.agg(*[F.count(c).alias(c) for c in table.columns]).select(
        F.lit(spark.catalog.getTable(name).description).alias("table_comment"), F.inline(columns)
    )


def k9_ddl(spark: SparkSession, d: str) -> DataFrame:
    """Landing tables created empty, loaded once, replaced on the second full refresh."""
    database = _database(spark, "landing")
    name = f"{database}.activity_raw"
    rows = jobs.load_landing(spark, "activity", stages.activity_stage(spark, d))
    for _ in range(2):
        tables.create_landing(spark, name, "activity")
        tables.append_landing(rows, name)
    tables.create_landing(spark, f"{database}.unused", "kpi")
    tables.drop_table(spark, f"{database}.unused")
    left = spark.catalog.listTables(database)
    return spark.table(name).groupBy(F.upper("module_key").alias("module_key")).agg(
        F.count("*").alias("row_count"), F.lit(len(left)).cast("bigint").alias("tables_left")
    )


def _silver(spark: SparkSession, d: str, name: str, stage: DataFrame) -> DataFrame:
    ensure_utc(spark)
    table = f"{_database(spark, 'silver')}.{name}"
    jobs.build_silver_table(name, [stage], table)
    return _plain(spark.table(table))


def k12_silver_records(spark: SparkSession, d: str) -> DataFrame:
    timed = with_time_parts(shapes.records(spark, d), "cdc_timestamp", hour=False).withColumns(
        {
            "event_date": F.date_format("cdc_timestamp", "yyyy-MM-dd"),
            "cdc_timestamp": F.date_format("cdc_timestamp", "yyyy-MM-dd'T'HH:mm:ss"),
        }
    )
    return _silver(spark, d, "records", timed)


def k13_silver_activity(spark: SparkSession, d: str) -> DataFrame:
    timed = with_time_parts(shapes.activity(spark, d), "cdc_timestamp", hour=False).withColumns(
        {
            "activity_date": F.col("activity_date").cast("string"),
            "cdc_timestamp": F.date_format("cdc_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        }
    )
    return _silver(spark, d, "activity", timed)


def k14_silver_kpi(spark: SparkSession, d: str) -> DataFrame:
    return _silver(spark, d, "kpi", shapes.kpi(spark, d).withColumn("kpi_date", F.col("kpi_date").cast("string")))


def _load(leads: DataFrame, *numbers: int) -> DataFrame:
    return leads.filter(F.col("src_filename").isin([f"load_{n}.parquet" for n in numbers]))


def k16_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Curated lead scores of two loads, with the third merged in."""
    leads = shapes.lead_scores(spark, d)
    path = shared_dir(spark, "curated")
    for numbers in ((0, 1), (2,)):
        upsert(path, latest_per_key(_load(leads, *numbers), S.LEAD_SCORE_KEYS), S.LEAD_SCORE_KEYS, "feature_date")
    return spark.read.schema(leads.schema).parquet(path).select(*leads.columns)


def k16_replay_null_keys(spark: SparkSession, d: str) -> DataFrame:
    """Two deliveries, each coming twice; leads without a client match nothing and are still there once."""
    leads = shapes.lead_scores(spark, d).withColumn("client_id", F.when(F.col("touchpoints_last_30d") % 5 != 0, F.col("client_id")))
    path = shared_dir(spark, "replayed")
    for number in (0, 0, 1, 1):
        latest = latest_per_key(_load(leads, number), S.LEAD_SCORE_KEYS)
        upsert(path, latest, S.LEAD_SCORE_KEYS, "feature_date", batch=("leads", number))
    return spark.read.schema(leads.schema).parquet(path).select(*LEAD_OUT)


def q_observed(spark: SparkSession, d: str) -> DataFrame:
    """Every rule of every model, counted while the marts are written."""
    return jobs.write_checked(spark, model_queries.flawed_models(spark, d), _database(spark, "checked"))


# Streams -----------------------------------------------------------------


def _deliver(leads: DataFrame, stage: str, number: int) -> None:
    _load(leads, number).drop("src_filename", "loaded_at").write.mode("append").parquet(stage)


def t1_auto_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Tolerant typed ingest of the lead-score stage."""
    source, root = stages.lead_score_stage(spark, d), shared_dir(spark, "auto-ingest")
    query = ingest.auto_ingest(
        spark, "lead_score", source, f"{root}/raw", f"{root}/checkpoint",
        trigger=ingest.ALL_AVAILABLE, max_files_per_trigger=1,
    )
    ingest.run_to_end(query)
    return spark.read.parquet(f"{root}/raw").select(*LEAD_OUT, "lead_score_band", "lead_source", "lead_status")


def t2_change_feed(spark: SparkSession, d: str) -> DataFrame:
    """Each delivery shows up in exactly one batch of the feed's consumer."""
    leads, root = shapes.lead_scores(spark, d), shared_dir(spark, "feed")

    def consume(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch_id", F.lit(batch_id))
        numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(
            f"{root}/seen"
        )

    for number in range(3):
        _deliver(leads, f"{root}/stage", number)
        ingest.load_incremental(spark, "lead_score", f"{root}/stage", f"{root}/raw", f"{root}/ingest")
        feed = ingest.change_feed(spark, f"{root}/raw", "lead_score")
        consumer = feed.writeStream.option("checkpointLocation", f"{root}/consumer").foreachBatch(consume)
        ingest.run_to_end(consumer.trigger(availableNow=True).start())
    return spark.read.parquet(f"{root}/seen").select(
        F.col("batch_id").cast("bigint").alias("batch_id"), "lead_id", "client_id", "feature_date", "exported_at"
    )


def _curated(spark: SparkSession, d: str, order: tuple[int, ...], guard: str | None = None) -> DataFrame:
    leads, root = shapes.lead_scores(spark, d), shared_dir(spark, "curate")
    for number in order:
        _deliver(leads, f"{root}/stage", number)
        ingest.load_incremental(spark, "lead_score", f"{root}/stage", f"{root}/raw", f"{root}/ingest")
        feed = ingest.change_feed(spark, f"{root}/raw", "lead_score")
        ingest.run_to_end(
            ingest.curate(feed, f"{root}/curated", f"{root}/curate", guard=guard, trigger=ingest.ALL_AVAILABLE)
        )
    return (
        spark.read.schema(S.landing_table_schema("lead_score"))
        .parquet(f"{root}/curated")
        .select(*S.LEAD_SCORE.names)
    )


def t3_microbatch(spark: SparkSession, d: str) -> DataFrame:
    """Interval trigger: a started query picks the stage up at its next tick."""
    leads, root = shapes.lead_scores(spark, d), shared_dir(spark, "tick")
    leads.write.parquet(f"{root}/raw")
    feed = ingest.change_feed(spark, f"{root}/raw", "lead_score")
    query = ingest.curate(feed, f"{root}/curated", f"{root}/curate", trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(leads.schema).parquet(f"{root}/curated").select(*leads.columns)


def t4_stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    return _curated(spark, d, (0, 1, 2))


def t5_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries out of order: the last load wins, or with a guard the newest export."""
    last_load = _curated(spark, d, (2, 0, 1)).withColumn("rule", F.lit("last_load"))
    newest = _curated(spark, d, (2, 0, 1), guard="exported_at").withColumn("rule", F.lit("newest_export"))
    return last_load.unionByName(newest)


def t5_stateful_latest(spark: SparkSession, d: str) -> DataFrame:
    """The same deliveries, each taken by a query that starts again from its checkpoint and holds the best rows as state."""

    def curated(rule: str, order: tuple[str, ...]) -> DataFrame:
        leads, root = shapes.lead_scores(spark, d), shared_dir(spark, "stateful")
        for number in (2, 0, 1):
            _deliver(leads, f"{root}/stage", number)
            ingest.load_incremental(spark, "lead_score", f"{root}/stage", f"{root}/raw", f"{root}/ingest")
            feed = ingest.change_feed(spark, f"{root}/raw", "lead_score")
            query = ingest.curate_stateful(
                feed, f"{root}/curated", f"{root}/state", order=order, trigger=ingest.ALL_AVAILABLE
            )
            ingest.run_to_end(query)
        rows = spark.read.schema(S.landing_table_schema("lead_score")).parquet(f"{root}/curated")
        return rows.select(*S.LEAD_SCORE.names, F.lit(rule).alias("rule"))

    newest = ("exported_at", "loaded_at", "src_filename")
    return curated("last_load", ("loaded_at", "exported_at", "src_filename")).unionByName(curated("newest_export", newest))


def t6_bronze_stream(spark: SparkSession, d: str) -> DataFrame:
    ensure_utc(spark)
    root = shared_dir(spark, "bronze-stream")
    for query in ingest.bronze_stream(
        spark, "email", stages.bronze_stage(spark, d, "email"), f"{root}/silver", f"{root}/quarantine",
        f"{root}/checkpoint", trigger=ingest.ALL_AVAILABLE,
    ):
        ingest.run_to_end(query)
    good = spark.read.parquet(f"{root}/silver")
    bad = spark.read.parquet(f"{root}/quarantine")
    rows = good.unionByName(bad, allowMissingColumns=True)
    return _plain(rows.select("emailId", "clientId", "cdc_timestamp", "emailStatus", "validation_reason"))


QUERIES = {
    f.__name__: f
    for f in (
        s1_bronze_json_scan, s2_partition_discovery, s3_parquet_stage_scan, s4_file_pattern, s5_lineage,
        s6_load_stamp, s7_load_records, s8_load_activity, s9_load_kpi, s10_load_churn, s11_load_lead_score,
        s12_on_error_continue, s12_drifting_files, s13_load_once, s13_load_partitioned, s13_backfill, t1_drifting_ingest, s13_load_history,
        s13_batch_load_once, s14_table_scan, s16_external_table, s17_msck, p1_schema_cast,
        f1_required_invalid, f2_split_good, f2_split_bad, q4_quarantine_report, k1_append_partitioned,
        k2_quarantine, k3_export_gold, k4_partitioned_write, k5_json_write, k6_views, k7_materialize, k8_docs, k9_ddl,
        k12_silver_records, k13_silver_activity, k14_silver_kpi, k16_upsert, k16_bucketed, q_observed, k16_replay_null_keys, t1_auto_ingest, t2_change_feed,
        t3_microbatch, t4_stream_upsert, t5_late_rows, t5_stateful_latest, t6_bronze_stream,
    )
} | {f"p2_bronze_{e}": partial(p2_bronze, entity=e) for e in S.ENTITY_SCHEMAS}
