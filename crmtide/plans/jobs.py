"""The batch jobs end to end."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.functions.columns import (
    required_invalid,
    scoped,
    with_constants,
    with_stamp,
    with_time_parts,
)
from crmtide.operators.latest import latest_per_key
from crmtide.operators.validate import split_valid
from crmtide.operators.observed import Watched, unique_grain_by_print
from crmtide.operators.quality import check_unique_grain, run_checks
from crmtide.plans import silver, staging
from crmtide.plans.marts import build_marts, pipeline_health
from crmtide.session import ensure_utc
from crmtide.sinks import files, tables
from crmtide.sources.bronze import read_bronze, typed_bronze
from crmtide.sources.stage import load_landing, read_groups
from crmtide.streaming import ingest


def bronze_to_silver(
    spark: SparkSession,
    entity: str,
    input_path: str,
    table: str,
    quarantine_path: str,
    fmt: str = "parquet",
    table_path: str | None = None,
) -> dict[str, int]:
    """Load one entity: valid rows to the silver table, the others to quarantine.

    Both row counts are observed during the first write; the input is read a
    second time only when that pass met invalid rows.
    """
    ensure_utc(spark)
    required = S.required_fields(S.ENTITY_SCHEMAS[entity])
    typed = typed_bronze(read_bronze(spark, entity, input_path), entity)
    rows = with_stamp(with_time_parts(typed, "cdc_timestamp"), "ingested_at")
    seen = Observation()
    observed = rows.observe(
        seen, F.count("*").alias("rows"), F.count_if(required_invalid(required)).alias("quarantined")
    )
    if "." in table:
        tables.ensure_database(spark, table.rsplit(".", 1)[0])
    files.write_silver(split_valid(observed, required)[0], table, fmt, table_path)
    counts = seen.get
    if counts["quarantined"]:
        files.write_quarantine(split_valid(rows, required)[1], quarantine_path, entity)
    return {"loaded": counts["rows"] - counts["quarantined"], "quarantined": counts["quarantined"]}


def export_gold(
    source: DataFrame, path: str, client_id: str, snapshot_date: datetime.date | str, single_file: bool = False
) -> str:
    """Write one tenant scope and snapshot of a gold table; returns its leaf folder.

    The leaf's ``client_id=`` names the export scope, not the rows' tenant: read
    it back with ``read_stage(leaf, leaf_columns_only=True)``.
    """
    day = datetime.date.fromisoformat(str(snapshot_date)).isoformat()
    stamped = with_constants(
        with_stamp(scoped(source, client_id, day), "exported_at"),
        {"export_client_scope": client_id, "export_snapshot_date": day},
    )
    leaf = f"{path.rstrip('/')}/client_id={client_id}/feature_date={day}"
    files.write_export(stamped, leaf, single_file)
    return leaf


def curate_churn(raw: DataFrame) -> DataFrame:
    """Latest loaded churn row per tenant, account and day."""
    return latest_per_key(raw, S.CHURN_KEYS)


def load_once(spark: SparkSession, name: str, stage_path: str, table: str, full_refresh: bool = False) -> None:
    """Add the stage files that the landing table does not hold yet, whatever their columns and types.

    Which files were loaded is kept beside the table's own files and goes with
    them: ``full_refresh`` starts with an empty table and loads all.
    """
    if full_refresh or not spark.catalog.tableExists(table):
        tables.create_landing(spark, table, name)
    root = tables.location(spark, table)
    ingest.load_incremental(spark, name, stage_path, root, f"{root}/_loads", drifting=True)
    spark.catalog.refreshTable(table)


def churn_batch(
    spark: SparkSession, stage_path: str, raw_table: str, curated_table: str, full_refresh: bool = True
) -> None:
    """Load the churn export into its raw table and rebuild the curated one from it.

    ``full_refresh`` replaces the raw rows; otherwise files that were loaded
    before are skipped.
    """
    load_once(spark, "churn", stage_path, raw_table, full_refresh)
    tables.materialize(curate_churn(spark.table(raw_table)), curated_table)


STAGE_PREFIXES = {
    "records": "silver_records_resolved",
    "activity": "silver_activity_resolved",
    "kpi": "silver_kpi_daily_summary",
}


def load_silver_landing(
    spark: SparkSession, stage_root: str, database: str, full_refresh: bool = True
) -> dict[str, str]:
    """The three landing tables with the files of their stage prefixes, each loaded once unless refreshed."""
    loaded = {}
    for name, prefix in STAGE_PREFIXES.items():
        loaded[name] = f"{database}.{prefix}_raw"
        load_once(spark, name, f"{stage_root.rstrip('/')}/{prefix}", loaded[name], full_refresh)
    return loaded


def build_silver_table(name: str, frames: Sequence[DataFrame], table: str, fmt: str = "parquet") -> None:
    """One typed table, partitioned by tenant (and module) and month, from a stage's frames, whatever their types."""
    typed = [silver.silver_ctas(name, silver.aligned(name, df)) for df in frames]
    rows = reduce(DataFrame.unionByName, typed)
    tables.materialize(rows, table, f"Typed {name} of all tenants.", fmt=fmt, partitions=silver.silver_partitions(name))


def build_silver(spark: SparkSession, stage_root: str, database: str, fmt: str = "parquet") -> dict[str, str]:
    """The three typed silver tables from their stage prefixes; files that can't be read are left out."""
    ensure_utc(spark)
    tables.ensure_database(spark, database)
    built = {}
    for name, prefix in STAGE_PREFIXES.items():
        frames = read_groups(spark, f"{stage_root.rstrip('/')}/{prefix}", "continue")
        built[name] = f"{database}.{prefix}"
        build_silver_table(name, frames, built[name], fmt)
    return built


def build_project(spark: SparkSession, landing: Mapping[str, str], database: str) -> dict[str, DataFrame]:
    """Staging models as views of the database, the others as tables, all documented.

    A model joined from others is a table: a view of the catalog is SQL text, and
    these are composed of frames. The scorecard is built once and its mart from it.
    """
    for name, source in landing.items():
        tables.create_view(spark, f"{database}.stg_{name}", staging.columns(name), source, S.MODEL_DOCS[f"stg_{name}"])
    records, activity, kpi = (spark.table(landing[n]) for n in ("records", "activity", "kpi"))
    models = build_marts(records, activity, kpi)
    for name, df in models.items():
        if not name.startswith("stg_"):
            df = pipeline_health(spark.table(f"{database}.daily_scorecard")) if name == "pipeline_health" else df
            tables.materialize(df, f"{database}.{name}", S.MODEL_DOCS[name])
        models[name] = spark.table(f"{database}.{name}")
    return models


def write_checked(spark: SparkSession, models: Mapping[str, DataFrame], database: str) -> DataFrame:
    """Write the marts among ``models`` as tables of the database; violations of every declared rule of all models.

    Null and value rules of a mart are counted by its write. Its grain is looked
    for in the written table, by prints of the keys. Landing and staging models are
    not written; their rules are read off them.
    """
    marts = {m: df for m, df in models.items() if not m.startswith(("raw_", "stg_"))}
    found = run_checks({m: df for m, df in models.items() if m not in marts})
    written = {}
    for m, df in marts.items():
        watched = Watched(df, S.NOT_NULL.get(m, ()), S.ACCEPTED_VALUES.get(m))
        tables.materialize(watched.df, f"{database}.{m}", S.MODEL_DOCS[m])
        written[m] = spark.table(f"{database}.{m}")
        found = found.unionByName(watched.findings(written[m]).select(F.lit(m).alias("model"), "*"))
    return found.unionByName(check_unique_grain(written, unique_grain_by_print))


def check_project(spark: SparkSession, landing: Mapping[str, str], database: str) -> DataFrame:
    """Violations of every declared rule in the landing tables and the built models."""
    models = {f"raw_{name}": spark.table(table) for name, table in landing.items()}
    return run_checks(models | {name: spark.table(f"{database}.{name}") for name in S.MODEL_DOCS})
