"""Marts kept up to date from deliveries, by signed changes to their sums.

A delivery holds rows that came (+1) and rows that went (-1); a corrected row is
both. Everything below a mart is a sum, so changes are added to what is stored:

* ``rollup``: activity volume per tenant, account, lead and day;
* ``records``: per tenant, module, record and day how many rows there are and
  the sums of their measures, and how much activity they match;
* ``totals``: the scorecard's sums and counts per tenant and day;
* ``kpi``: how often each KPI row is there.

All are partitioned by day; rows without a day have no part in them. A delivery reads the days it touches only, and of
them the keys it touches; averages are carried as sum and count, sums are exact
decimals, so that what went leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.operators.joins import MATCHED_MODULES, by_record
from crmtide.operators.rollups import ROLLUP_KEYS
from crmtide.operators.upsert import upsert
from crmtide.plans.marts import KPI_COLUMNS, pipeline_health
from crmtide.sinks.deliveries import Folder
from crmtide.sinks.files import clustered

CHANGE = "_change"
MEASURES = {"health": "health_score", "hint": "lead_score_hint", "amount": "amount_usd"}
_SUM, _WEIGHT = "decimal(30,14)", "decimal(7,0)"

_OF_RECORD = ["n", *[f"{m}_{k}" for m in MEASURES for k in ("sum", "rows")], "copies", "volume"]
_OF_DAY = ["lead_rows", "opportunity_rows", "account_rows", "volume", *[f"{m}_{k}" for m in MEASURES for k in ("sum", "rows")]]
_OF_GROUP = ["total_activities", "call_count", "email_count", "task_count", "duration_sum", "duration_rows"]
KEYS = {
    "rollup": ["organization_id", "account_id", "lead_id"],
    "records": ["organization_id", "module_key", "record_id"],
    "totals": ["organization_id"],
    "kpi": [c for c in KPI_COLUMNS if c != "kpi_date"],
}
SUMS = {"rollup": _OF_GROUP, "records": _OF_RECORD, "totals": _OF_DAY, "kpi": ["kpi_copies"]}


def _type(name: str) -> str:
    return "bigint" if not name.endswith("_sum") or name == "duration_sum" else _SUM


def signed(df: DataFrame, change: int = 1) -> DataFrame:
    """Rows that came, or with -1 went."""
    return df.withColumn(CHANGE, F.lit(change))


def _changes(df: DataFrame) -> DataFrame:
    return df if CHANGE in df.columns else signed(df)


def _added(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sums by key; NULL keys form groups."""
    return df.groupBy(*keys, "day").agg(*[F.sum(c).cast(_type(c)).alias(c) for c in sums])


def _if(test: Column, value: Column) -> Column:
    return F.when(test, value).otherwise(F.lit(0))


def rollup_changes(activity: DataFrame) -> DataFrame:
    """Signed volume per (tenant, account, lead, day) of activities; rows without a day have no part in a mart."""
    change, kind = F.col(CHANGE), F.col("activity_type")
    seconds = F.col("duration_seconds")
    rows = _changes(activity).filter("activity_date is not null").select(
        *KEYS["rollup"],
        F.col("activity_date").alias("day"),
        change.alias("total_activities"),
        *[_if(kind == k.upper(), change).alias(f"{k}_count") for k in ("call", "email", "task")],
        (F.coalesce(seconds, F.lit(0)) * change).alias("duration_sum"),
        _if(seconds.isNotNull(), change).alias("duration_rows"),
    )
    return _added(rows, KEYS["rollup"], _OF_GROUP)


def record_changes(records: DataFrame) -> DataFrame:
    """Signed rows and measure sums per (tenant, module, record, day)."""
    change = F.col(CHANGE)
    rows = _changes(records).withColumn("day", F.col("cdc_timestamp").cast("date")).filter("day is not null")
    measured = []
    for m, c in MEASURES.items():
        measured.append((F.coalesce(F.col(c).cast(_SUM), F.lit(0).cast(_SUM)) * change.cast("decimal(1,0)")).cast(_SUM).alias(f"{m}_sum"))
        measured.append(_if(F.col(c).isNotNull(), change).alias(f"{m}_rows"))
    zero = [F.lit(0).alias(c) for c in ("copies", "volume")]
    rows = rows.select(*KEYS["records"], "day", change.alias("n"), *measured, *zero)
    return _added(rows, KEYS["records"], _OF_RECORD)


def kpi_changes(kpi: DataFrame) -> DataFrame:
    rows = _changes(kpi).filter("kpi_date is not null").select(*KEYS["kpi"], F.col("kpi_date").alias("day"), F.col(CHANGE).alias("kpi_copies"))
    return _added(rows, KEYS["kpi"], ["kpi_copies"])


def _before_and_after(old: DataFrame, delta: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """(keys, day, was, now): the stored sums of every key of ``delta`` and what they become."""
    was = [F.struct(*[F.col(c) for c in sums]).alias("row")]
    same = reduce(Column.__and__, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in [*keys, "day"]])
    old = old.alias("old").join(delta.select(*keys, "day").alias("new"), same, "left_semi")
    both = old.select(*keys, "day", *was, F.lit(True).alias("stored")).unionByName(
        delta.select(*keys, "day", *was, F.lit(False).alias("stored"))
    )
    zero = lambda c: F.lit(0).cast(_type(c))
    one = both.groupBy(*keys, "day").agg(
        *[F.sum(F.when(F.col("stored"), F.col(f"row.{c}")).otherwise(zero(c))).cast(_type(c)).alias(f"was_{c}") for c in sums],
        *[F.sum(f"row.{c}").cast(_type(c)).alias(f"now_{c}") for c in sums],
    )
    return one.select(*keys, "day", *[F.struct(*[F.col(f"{x}_{c}").alias(c) for c in sums]).alias(x) for x in ("was", "now")])


def matched_changes(groups: DataFrame) -> DataFrame:
    """How the rollup rows and the volume that a record matches on a day change with these groups."""
    there = lambda x: (F.col(f"{x}.total_activities") > 0).cast("bigint")
    rows = groups.select(
        *KEYS["rollup"],
        "day",
        (there("now") - there("was")).alias("copies"),
        (F.col("now.total_activities") - F.col("was.total_activities")).alias("volume"),
    )
    none = [F.lit(0).cast(_type(c)).alias(c) for c in _OF_RECORD if c not in ("copies", "volume")]
    matched = by_record(rows).filter("organization_id is not null and record_id is not null")
    return _added(matched.select("*", *none), KEYS["records"], _OF_RECORD)


def _of_day(x: str) -> dict[str, Column]:
    """What a record's rows add to the sums of its tenant and day; each counts once per rollup row it matches."""
    row = F.col(x)
    module = F.col("module_key")
    matched = F.coalesce(module.isin(list(MATCHED_MODULES)), F.lit(False))
    weight = F.when(matched & (row["copies"] > 1), row["copies"]).otherwise(F.lit(1))
    rows = row["n"] * weight
    out = {
        "lead_rows": _if(module == "LEADS", rows),
        "opportunity_rows": _if(module == "OPPORTUNITIES", rows),
        "account_rows": _if(module == "ACCOUNTS", rows),
        "volume": _if(matched, row["n"] * row["volume"]),
    }
    for m in MEASURES:
        out[f"{m}_sum"] = row[f"{m}_sum"] * weight.cast(_WEIGHT)
        out[f"{m}_rows"] = row[f"{m}_rows"] * weight
    return out


def day_changes(records: DataFrame) -> DataFrame:
    """Changes of the sums per tenant and day that follow from changed records."""
    was, now = _of_day("was"), _of_day("now")
    rows = records.select("organization_id", "day", *[(now[c] - was[c]).alias(c) for c in _OF_DAY])
    return _added(rows.filter("organization_id is not null"), KEYS["totals"], _OF_DAY)


def scorecard(kpi: DataFrame, totals: DataFrame) -> DataFrame:
    """Tenant-day scorecard from the stored sums."""
    days = kpi.filter("kpi_copies > 0").withColumnRenamed("day", "kpi_date")
    totals = totals.withColumnRenamed("day", "kpi_date")

    def scaled(column: str, zero) -> Column:
        return F.coalesce(F.col(column) * F.col("kpi_copies"), F.lit(zero))

    def mean(m: str) -> Column:
        part = F.try_divide(F.col(f"{m}_sum").cast("double"), F.col(f"{m}_rows"))
        return F.coalesce(part, F.lit(0.0))

    amount = F.col("amount_sum").cast("double") * F.col("kpi_copies")
    return days.join(totals, ["organization_id", "kpi_date"], "left").select(
        *KPI_COLUMNS,
        scaled("lead_rows", 0).alias("lead_records_seen"),
        scaled("opportunity_rows", 0).alias("opportunity_records_seen"),
        scaled("account_rows", 0).alias("account_records_seen"),
        scaled("volume", 0).alias("crm_activities_joined"),
        mean("health").alias("avg_health_score"),
        mean("hint").alias("avg_lead_score_hint"),
        F.coalesce(amount, F.lit(0.0)).alias("pipeline_amount_usd"),
    )


class Marts:
    """The stored sums and the marts made of them, below one folder. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, kpi_schema) -> None:
        self.spark, self.root, self.folder = spark, root.rstrip("/"), Folder(spark, root)
        kinds = {f.name: f.dataType.simpleString() for f in kpi_schema}
        self.schemas = {
            name: ", ".join([f"{k} {kinds.get(k, 'string')}" for k in KEYS[name]] + [f"{c} {_type(c)}" for c in SUMS[name]] + ["key string", "day date"])
            for name in KEYS
        }

    def state(self, name: str, days: Sequence | None = None) -> DataFrame:
        """Stored sums, of some days or all; sums that came to nothing are kept as zeros."""
        if not self.folder.exists(f"state/{name}"):
            return self.spark.createDataFrame([], self.schemas[name]).drop("key")
        df = self.spark.read.schema(self.schemas[name]).parquet(f"{self.root}/state/{name}").drop("key")
        return df if days is None else df.filter(F.col("day").isin(list(days)))

    def deliver(
        self,
        number: int,
        records: DataFrame | None = None,
        activity: DataFrame | None = None,
        kpi: DataFrame | None = None,
        source: str = "deliveries",
    ) -> None:
        """Take a delivery into the sums and rebuild the marts of the days it touches.

        Rows carry their sign in ``_change``; without it they came. What the sums
        become is written down before any of them is replaced, so a delivery
        that comes again, whole or after a crash anywhere, changes nothing more.
        """
        if self.folder.reached(f"_done/{source}") >= number:
            return
        step = f"_steps/{source}.{number}"
        if not self.folder.exists(f"{step}/_written"):
            self._write_down(f"{self.root}/{step}", records, activity, kpi)
            self.folder._touch(f"{step}/_written")
        days: set = set()
        for name in KEYS:
            rows = self.spark.read.parquet(f"{self.root}/{step}/{name}").select(*KEYS[name], "now.*", "key", "day")
            found = [r["day"] for r in rows.select("day").distinct().collect()]
            if found:
                upsert(f"{self.root}/state/{name}", rows, ["key", "day"], "day", batch=(source, number))
            if name in ("kpi", "totals"):
                days.update(found)
        if days:
            self._rebuild(sorted(days))
        self.folder.note(f"_done/{source}", number)
        self.folder.fs.delete(self.folder._at(step), True)

    def _write_down(self, step: str, records: DataFrame | None, activity: DataFrame | None, kpi: DataFrame | None) -> None:
        empty = {n: self.spark.createDataFrame([], self.schemas[n]).drop("key") for n in KEYS}

        def once(name: str, df: DataFrame) -> DataFrame:
            """Written, as what follows reads it several times; a delivery's rows may come out of a long job."""
            df.write.mode("overwrite").parquet(f"{step}/delta-{name}")
            return self.spark.read.schema(df.schema).parquet(f"{step}/delta-{name}")

        delta = {
            "rollup": once("rollup", rollup_changes(activity)) if activity is not None else empty["rollup"],
            "records": once("records", record_changes(records)) if records is not None else empty["records"],
            "kpi": once("kpi", kpi_changes(kpi)) if kpi is not None else empty["kpi"],
        }
        days = {r["day"] for df in delta.values() for r in df.select("day").distinct().collect()}

        def changed(name: str, of: DataFrame) -> DataFrame:
            rows = _before_and_after(self.state(name, days), of, KEYS[name], SUMS[name])
            key = F.sha2(F.to_json(F.struct(*KEYS[name])), 256).alias("key")
            rows = rows.select(*KEYS[name], "day", "was", "now", key)
            rows.write.mode("overwrite").parquet(f"{step}/{name}")
            return self.spark.read.schema(rows.schema).parquet(f"{step}/{name}")

        groups = changed("rollup", delta["rollup"])
        touched = _added(delta["records"].unionByName(matched_changes(groups)), KEYS["records"], _OF_RECORD)
        of_records = changed("records", once("touched", touched))
        changed("totals", once("totals", day_changes(of_records)))
        changed("kpi", delta["kpi"])

    def _rebuild(self, days: Sequence) -> None:
        """The touched days of the scorecard and of the health mart, from the sums of these days."""
        card = scorecard(self.state("kpi", days), self.state("totals", days))
        kept = {r["kpi_date"] for r in card.select("kpi_date").distinct().collect()}
        for name, df in (("daily_scorecard", card), ("pipeline_health", pipeline_health(card))):
            out = clustered(df, ["kpi_date"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            out.partitionBy("kpi_date").parquet(f"{self.root}/marts/{name}")
            for day in set(days) - kept:
                self.folder.fs.delete(self.folder._at(f"marts/{name}/kpi_date={day}"), True)

    def mart(self, name: str) -> DataFrame:
        """``daily_scorecard`` or ``pipeline_health``."""
        like = scorecard(self.state("kpi", []), self.state("totals", []))
        schema = (pipeline_health(like) if name == "pipeline_health" else like).schema
        return self.spark.read.schema(schema).parquet(f"{self.root}/marts/{name}").select(*schema.names)

    def activity_rollup(self) -> DataFrame:
        """Activity volume per tenant, account, lead and day, as ``rollups.activity_rollup`` gives it."""
        seconds = F.when(F.col("duration_rows") > 0, F.col("duration_sum"))
        rows = self.state("rollup").filter("total_activities > 0").withColumnRenamed("day", "activity_date")
        return rows.select(*ROLLUP_KEYS, *_OF_GROUP[:4], seconds.alias("total_duration_seconds"))
