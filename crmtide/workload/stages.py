"""Stage folders written from the derived shapes, once per session and scale."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.session import shared_dir
from crmtide.sinks.files import write_bronze, write_partitioned
from crmtide.workload import bronze_shapes, shapes

_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = shared_dir(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def _number(column: str) -> Column:
    return F.split_part(F.col(column), F.lit("_"), F.lit(2)).cast("bigint")


def _iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def text_records(df: DataFrame) -> DataFrame:
    n = _number("record_id")
    return df.withColumns(
        {
            "annual_revenue_usd": F.when(n % 97 == 5, "n/a").otherwise(F.col("annual_revenue_usd").cast("string")),
            "cdc_timestamp": F.when(n % 89 == 3, "yesterday").otherwise(_iso("cdc_timestamp")),
            "health_score": F.col("health_score").cast("decimal(18,4)").cast("string"),
        }
    ).drop("src_filename", "loaded_at")


def text_activity(df: DataFrame) -> DataFrame:
    n = _number("record_id")
    return df.withColumns(
        {
            "duration_seconds": F.when(n % 83 == 2, "long").otherwise(F.col("duration_seconds").cast("string")),
            "cdc_timestamp": _iso("cdc_timestamp"),
            "activity_date": F.col("activity_date").cast("string"),
        }
    ).drop("src_filename", "loaded_at")


def text_kpi(df: DataFrame) -> DataFrame:
    created = F.col("pipeline_created_count")
    text = F.when(F.dayofmonth("kpi_date") % 11 == 4, "many").otherwise(F.concat(created.cast("string"), F.lit(".5")))
    return df.withColumn("pipeline_created_count", text).drop("src_filename", "loaded_at")


def text_churn(df: DataFrame) -> DataFrame:
    n = _number("contract_id")
    return df.withColumns(
        {
            "contract_value": F.when(n % 71 == 9, "n.a.").otherwise(F.col("contract_value").cast("string")),
            "contract_start_date": F.col("contract_start_date").cast("string"),
            "is_churned": F.col("is_churned").cast("string"),
        }
    ).drop("src_filename", "loaded_at")


def text_lead_scores(df: DataFrame) -> DataFrame:
    touches = F.col("touchpoints_last_30d")
    return df.withColumn(
        "touchpoints_last_30d", F.when(touches == 13, "thirteen").otherwise(touches.cast("string"))
    ).drop("src_filename", "loaded_at")


def records_stage(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        write_partitioned(text_records(shapes.records(spark, sf_dir)), path, ["organization_id", "module_key"])

    return once(spark, sf_dir, "stage-records", write)


def drifting_stage(spark: SparkSession, sf_dir: str) -> str:
    """Records by number modulo 3: without amounts, all as text, numbers and times typed; and a junk file."""

    def write(path: str) -> None:
        records = shapes.records(spark, sf_dir).drop("src_filename", "loaded_at")
        n, folders = _number("record_id") % 3, ["organization_id", "module_key"]
        for k, df in enumerate((text_records(records).drop("amount_usd"), text_records(records), records)):
            write_partitioned(df.filter(n == k), path, folders, mode="append")
        put_file(spark, f"{path}/broken.parquet", b"no footer here")

    return once(spark, sf_dir, "stage-drifting", write)


def put_file(spark: SparkSession, path: str, content: bytes) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(content))
    out.close()


def date_back(spark: SparkSession, folder: str, days: int) -> None:
    """Set the modification time of a folder's files so many days back."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(at):
        then = status.getModificationTime() - days * 86_400_000
        fs.setTimes(status.getPath(), then, -1)


def activity_stage(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        write_partitioned(text_activity(shapes.activity(spark, sf_dir)), path, ["organization_id", "module_key"])

    return once(spark, sf_dir, "stage-activity", write)


def kpi_stage(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        write_partitioned(text_kpi(shapes.kpi(spark, sf_dir)), path, ["organization_id", "kpi_date"])

    return once(spark, sf_dir, "stage-kpi", write)


def churn_stage(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        text_churn(shapes.churn(spark, sf_dir)).write.parquet(path)

    return once(spark, sf_dir, "stage-churn", write)


def lead_score_stage(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        text_lead_scores(shapes.lead_scores(spark, sf_dir)).write.parquet(path)

    return once(spark, sf_dir, "stage-lead-score", write)


def bronze_stage(spark: SparkSession, sf_dir: str, entity: str) -> str:
    """JSON lines in folders of load time, two load hours."""

    def write(path: str) -> None:
        rows = bronze_shapes.ENTITIES[entity](spark, sf_dir)
        hour = F.when(F.pmod(F.crc32(F.coalesce("cdc_timestamp", F.lit(""))), F.lit(2)) == 0, "08").otherwise("19")
        load_time = {"year": F.lit("2024"), "month": F.lit("01"), "day": F.lit("31"), "hour": hour}
        write_bronze(rows.withColumns(load_time), path, entity)

    return f"{once(spark, sf_dir, f'bronze-{entity}', write)}/{entity}"
