"""Marts kept from signed deliveries equal those built at once, and a delivery reads only what it touches."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from crmtide.operators import rollups
from crmtide.plans import incremental, marts
from crmtide.plans.incremental import Marts

DAYS = [dt.date(2024, 1, d) for d in range(1, 5)]
RECORD = ", ".join([*[f"{c} string" for c in marts.RECORD_COLUMNS], "cdc_timestamp timestamp_ntz", *[f"{c} double" for c in marts.RECORD_MEASURES]])
ACTIVITY = "organization_id string, account_id string, lead_id string, activity_date date, activity_type string, duration_seconds bigint"
KPI_TYPES = {"kpi_date": "date", "stage_conversion_rate": "double", "pipeline_coverage_ratio": "double", "activity_volume": "bigint"}
KPI = ", ".join(f"{c} {KPI_TYPES.get(c, 'string')}" for c in marts.KPI_COLUMNS)


def data(spark, seed, n=60):
    r = random.Random(seed)
    org = lambda: r.choice(["a", "b", None])
    record, activity, kpi = [], [], []
    for _ in range(n):
        module = r.choice(["ACCOUNTS", "LEADS", "OPPORTUNITIES", None])
        row = {"organization_id": org(), "module_key": module, "record_id": r.choice(["1", "2", "3", None])}
        at = r.choice([None, *DAYS])
        measures = [r.choice([None, 0.5, 1.25, 3.0]) for _ in marts.RECORD_MEASURES]
        record.append((*[row.get(c, "x") for c in marts.RECORD_COLUMNS], at and dt.datetime.combine(at, dt.time(r.randrange(24))), *measures))
        activity.append((org(), r.choice(["1", "2", None]), r.choice(["1", "3", None]), r.choice([None, *DAYS]), r.choice(["CALL", "EMAIL", None]), r.choice([None, 5])))
    for _ in range(n // 4):
        row = {"organization_id": org(), "kpi_date": r.choice(DAYS), "stage_conversion_rate": r.choice([None, 0.5]), "activity_volume": 3}
        row |= {"pipeline_coverage_ratio": r.choice([None, 0.9, 1.2])}
        kpi.append(tuple(row.get(c, "k") for c in marts.KPI_COLUMNS))
    frame = lambda found, schema: spark.createDataFrame(found, schema).coalesce(2)
    return {"records": frame(record, RECORD), "activity": frame(activity, ACTIVITY), "kpi": frame(kpi, KPI)}


def whole(parts):
    out = parts[0]
    for p in parts[1:]:
        out = {n: out[n].unionByName(p[n]) for n in out}
    return out


def plain(df):
    out = []
    for r in rows(df):
        out.append(tuple(round(float(v), 9) if isinstance(v, (float, Decimal)) else v for v in r))
    return out


def expected(frames):
    return marts.pipeline_health(marts.daily_scorecard_weighted(frames["kpi"], frames["records"], frames["activity"]))


def test_deliveries_with_corrections_equal_one_build(spark, path):
    a, b, c = (data(spark, k) for k in range(3))
    kept = Marts(spark, path("m"), a["kpi"].schema)
    kept.deliver(0, **a)
    assert plain(kept.mart("pipeline_health")) == plain(expected(a))
    kept.deliver(1, **{n: incremental.signed(a[n], -1).unionByName(incremental.signed(b[n])) for n in a})
    assert plain(kept.mart("pipeline_health")) == plain(expected(b))
    assert rows(kept.activity_rollup()) == rows(rollups.activity_rollup(b["activity"].filter("activity_date is not null")))
    for _ in range(2):
        kept.deliver(2, **c)
    both = whole([b, c])
    assert plain(kept.mart("pipeline_health")) == plain(expected(both))
    kept.deliver(3, **{n: incremental.signed(df, -1) for n, df in both.items()})
    assert kept.mart("pipeline_health").count() == 0 and kept.activity_rollup().count() == 0
    assert kept.state("totals").filter("lead_rows <> 0 or health_sum <> 0 or volume <> 0").count() == 0


def test_a_delivery_that_dies_anywhere_counts_once(spark, path, monkeypatch):
    a, b = data(spark, 5, 20), data(spark, 6, 20)
    for number, point in enumerate(("before", "sums", "rebuild")):
        kept = Marts(spark, path(f"m{number}"), a["kpi"].schema)
        kept.deliver(0, **a)
        with monkeypatch.context() as m:
            if point == "before":
                m.setattr(incremental.Folder, "_touch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            elif point == "sums":
                calls, real = [], incremental.upsert
                m.setattr(incremental, "upsert", lambda *x, **k: real(*x, **k) if not calls and not calls.append(1) else 1 / 0)
            else:
                m.setattr(Marts, "_rebuild", lambda *_: 1 / 0)
            with pytest.raises((RuntimeError, ZeroDivisionError)):
                kept.deliver(1, **b)
        kept.deliver(1, **b)
        kept.deliver(1, **b)
        assert plain(kept.mart("pipeline_health")) == plain(expected(whole([a, b])))


def test_a_delivery_reads_touched_days_only(spark, path):
    a = data(spark, 1)
    kept = Marts(spark, path("m"), a["kpi"].schema)
    kept.deliver(0, **a)
    plan = kept.state("records", [DAYS[0]])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    untouched = {f: f.stat().st_mtime_ns for f in Path(path("m")).rglob("*.parquet") if f"={DAYS[1]}" in str(f)}
    one = {n: df.filter(F.coalesce(F.to_date(c), F.lit(DAYS[0])) == F.lit(DAYS[0])) for (n, df), c in zip(data(spark, 2).items(), ("cdc_timestamp", "activity_date", "kpi_date"))}
    kept.deliver(1, **one)
    assert untouched and all(f.exists() and f.stat().st_mtime_ns == t for f, t in untouched.items())
    assert plain(kept.mart("pipeline_health")) == plain(expected(whole([a, one])))


def test_a_delivery_is_computed_once(spark, path):
    frames, read = data(spark, 4), spark.sparkContext.accumulator(0)

    def counted(df):
        return spark.createDataFrame(spark.sparkContext.parallelize(df.collect(), 2).map(lambda r: read.add(1) or r), df.schema)

    kept = Marts(spark, path("m"), frames["kpi"].schema)
    kept.deliver(0, **{n: counted(df) for n, df in frames.items()})
    assert read.value == sum(df.count() for df in frames.values())
    assert plain(kept.mart("pipeline_health")) == plain(expected(frames))
