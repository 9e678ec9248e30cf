"""Change-record entities derived from the supplied tables, as they arrive in JSON.

Some rows break the contract on purpose: blank or missing required fields,
unreadable timestamps, text in number fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.workload.shapes import _text, table


def _iso(expr: str) -> Column:
    return F.date_format(F.expr(expr), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def _common(k: Column, client: Column) -> dict[str, Column]:
    return {
        "applicationId": F.when(k % 90 == 17, F.lit("   ")).otherwise("app_crm"),
        "clientId": F.when(k % 60 != 11, _text("client_", client)),
        "operationType": F.lit("UPSERT"),
        "run_date": F.lit("2024-01-31"),
    }


def _cdc(k: str, unit: str = "0, 0, 0, cast({k} as int)") -> Column:
    """Event time from the row number, unreadable for some rows."""
    step = unit.format(k=k)
    return F.when(F.col(k) % 70 != 13, _iso(f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval({step})")).otherwise("soon")


def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(k % 40 == 7, F.lit(" ")).otherwise(_text("ACC", k)).alias("accountId"),
        F.col("c_name").alias("accountName"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_acctbal").alias("annualRevenue"),
        F.when(k % 30 == 4, "many").otherwise((k % 900).cast("string")).alias("numberOfEmployees"),
        F.when(k % 2 == 0, "Customer").otherwise("Prospect").alias("accountType"),
        _cdc("c_custkey", "cast({k} % 30 as int), cast({k} % 24 as int)").alias("cdc_timestamp"),
        *[c.alias(n) for n, c in _common(k, F.col("c_nationkey")).items()],
    )


def lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        _text("LED", k).alias("leadId"),
        F.when(k % 3 != 0, _text("ACC", k)).alias("accountId"),
        F.col("s_name").alias("firstName"),
        F.lit("User").alias("lastName"),
        _text("lead", k, "@example.test").alias("email"),
        _text("Company ", k).alias("company"),
        _text("source_", k % 4).alias("leadSource"),
        F.when(k % 2 == 0, "OPEN").otherwise("WORKING").alias("leadStatus"),
        F.when(k % 10 == 3, F.lit("n/a")).otherwise(_iso("timestamp_ntz'2023-12-01 00:00:00' + make_dt_interval(0, cast(s_suppkey % 100 as int))")).alias("createdDate"),
        _cdc("s_suppkey").alias("cdc_timestamp"),
        *[c.alias(n) for n, c in _common(k, F.col("s_nationkey")).items()],
    )


def opportunity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several versions per opportunity, one per order of the customer."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        _text("OPP", F.col("o_custkey")).alias("opportunityId"),
        _text("LED", k % 50).alias("leadId"),
        _text("ACC", F.col("o_custkey")).alias("accountId"),
        F.col("o_orderpriority").alias("stage"),
        F.when(k % 45 == 8, "20.5").otherwise((k % 101).cast("string")).alias("probability"),
        F.col("o_totalprice").alias("amount"),
        _iso("o_orderdate").alias("createdDate"),
        _cdc("o_orderkey").alias("cdc_timestamp"),
        *[c.alias(n) for n, c in _common(k, k % 3).items()],
    )


def contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        _text("CON", k).alias("contractId"),
        _text("ACC", F.col("o_custkey")).alias("accountId"),
        F.col("o_totalprice").alias("contractValue"),
        F.when(k % 2 == 0, "ACTIVE").otherwise("EXPIRED").alias("contractStatus"),
        F.when(k % 33 == 9, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("contractStartDate"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 365), "yyyy-MM-dd").alias("contractEndDate"),
        _cdc("o_orderkey").alias("cdc_timestamp"),
        *[c.alias(n) for n, c in _common(k, k % 3).items()],
    )


def _touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("at", _iso("ts"))


def call(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    return _touch(spark, sf_dir).select(
        _text("CAL", k).alias("callId"),
        _text("ACC", F.col("user_id")).alias("accountId"),
        _text("LED", k % 50).alias("leadId"),
        F.when(k % 2 == 0, "INBOUND").otherwise("OUTBOUND").alias("direction"),
        F.col("event_type").alias("outcome"),
        F.floor("value").cast("bigint").alias("durationSeconds"),
        F.col("at").alias("callStartTime"),
        _cdc("event_id").alias("cdc_timestamp"),
        *[c.alias(n) for n, c in _common(k, k % 3).items()],
    )


def email(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    return _touch(spark, sf_dir).select(
        _text("EML", k).alias("emailId"),
        _text("ACC", F.col("user_id")).alias("accountId"),
        _text("LED", k % 50).alias("leadId"),
        _text("Follow-up ", k).alias("subject"),
        F.col("event_type").alias("emailStatus"),
        F.col("at").alias("sentTime"),
        _cdc("event_id").alias("cdc_timestamp"),
        *[c.alias(n) for n, c in _common(k, k % 3).items()],
    )


ENTITIES = {
    "account": account,
    "lead": lead,
    "opportunity": opportunity,
    "contract": contract,
    "call": call,
    "email": email,
}
