"""Loads of files that differ, each once, on any cluster."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.operators import upsert as U
from crmtide.plans import jobs
from crmtide.sinks.deliveries import Deliveries
from crmtide.sources import stage
from crmtide.streaming import ingest

REPO = Path(__file__).resolve().parent.parent
KPI = "organization_id string, kpi_date string, pipeline_created_count {count}, activity_volume {volume}"


def put(spark, root, org, day, created, active, count="string", volume="double"):
    df = spark.createDataFrame([(org, day, created, active)], KPI.format(count=count, volume=volume)).coalesce(1)
    df.drop("organization_id", "kpi_date").write.mode("append").parquet(f"{root}/organization_id={org}/kpi_date={day}")


def drift(spark, root):
    """Three kinds of files, folder names that read as numbers, and a file that is no Parquet."""
    put(spark, root, "007", "2024-01-01", "3", 2.0)
    put(spark, root, "o", "2024-01-01", 4, "5", count="bigint", volume="string")
    put(spark, root, "o", "2024-01-02", "many", 1.0)
    put(spark, root, "a b", "2024-01-02", 6.4, 1, count="double", volume="int")
    (Path(root) / "broken.parquet").write_bytes(b"no footer here")


WANT = [("007", 3, 2), ("a b", 6, 1), ("o", 4, 5)]


def loaded(spark, path):
    return rows(spark.read.parquet(path), "organization_id", "pipeline_created_count", "activity_volume")


def test_drifting_files_are_loaded_once(spark, path):
    drift(spark, path("stage"))
    for _ in range(2):
        ingest.load_incremental(spark, "kpi", path("stage"), path("raw"), path("cp"), drifting=True, max_files_per_trigger=1)
        assert loaded(spark, path("raw")) == WANT
    put(spark, path("stage"), "z", "2024-01-03", True, 9.5, count="boolean", volume="double")
    ingest.load_incremental(spark, "kpi", path("stage"), path("raw"), path("cp"), drifting=True)
    assert loaded(spark, path("raw")) == [*WANT, ("z", 1, 10)]
    files = ingest.loaded_files(spark, path("raw"))
    assert files.count() == 6 and rows(files.filter("problem is not null").select(F.substring_index("file", "/", -1))) == [("broken.parquet",)]


def test_a_batch_that_comes_again_adds_nothing(spark, path, monkeypatch):
    """Once after its rows were written, once while its files were moved, once before either."""
    drift(spark, path("stage"))
    written = Deliveries.write
    for point in ("before", "moving", "after"):
        raw, cp = path(f"raw-{point}"), path(f"cp-{point}")
        moves = []

        def end(self, source, number, moves=moves, whole=Deliveries._end):
            rename = self.fs.rename

            class Fs:
                def __getattr__(self, name, fs=self.fs):
                    return getattr(fs, name)

                def rename(self, a, b):
                    moves.append(a)
                    if len(moves) > 1:
                        raise RuntimeError("lost")
                    return rename(a, b)

            self.fs = Fs()
            whole(self, source, number)

        def write(self, source, number, frames, point=point):
            if point == "before":
                raise RuntimeError("lost")
            written(self, source, number, frames)
            if point == "after":
                raise RuntimeError("lost")

        with monkeypatch.context() as m:
            m.setattr(Deliveries, "write", write)
            if point == "moving":
                m.setattr(Deliveries, "_end", end)
            with pytest.raises(Exception, match="lost"):
                ingest.load_incremental(spark, "kpi", path("stage"), raw, cp, drifting=True)
        ingest.load_incremental(spark, "kpi", path("stage"), raw, cp, drifting=True)
        assert loaded(spark, raw) == WANT
        assert ingest.loaded_files(spark, raw).count() == 5


def test_a_feed_over_a_drifting_load_sees_each_row_once(spark, path):
    seen = []
    for day in ("2024-01-01", "2024-01-02"):
        put(spark, path("stage"), "o", day, "3" if day.endswith("1") else 4, 1.0, count="string" if day.endswith("1") else "int")
        ingest.load_incremental(spark, "kpi", path("stage"), path("raw"), path("cp"), drifting=True)
        feed = ingest.change_feed(spark, path("raw"), "kpi")
        take = lambda batch, _: seen.extend(r[0] for r in batch.select("pipeline_created_count").collect())
        ingest.run_to_end(feed.writeStream.option("checkpointLocation", path("c2")).foreachBatch(take).trigger(availableNow=True).start())
    assert seen == [3, 4]


def test_batch_loads_skip_loaded_files(spark, path):
    spark.sql(f"CREATE DATABASE loads LOCATION '{path('db')}'")
    drift(spark, path("stage"))
    for _ in range(2):
        jobs.load_once(spark, "kpi", path("stage"), "loads.kpi_raw")
        assert rows(spark.table("loads.kpi_raw"), "organization_id", "pipeline_created_count", "activity_volume") == WANT
    put(spark, path("stage"), "z", "2024-01-03", "1", 1.0)
    jobs.load_once(spark, "kpi", path("stage"), "loads.kpi_raw")
    assert spark.table("loads.kpi_raw").count() == 4
    jobs.load_once(spark, "kpi", path("stage"), "loads.kpi_raw", full_refresh=True)
    assert spark.table("loads.kpi_raw").count() == 4
    spark.sql("DROP DATABASE loads CASCADE")


def test_schemas_are_compared_in_tasks(spark, path, monkeypatch):
    """The driver gets a schema for each kind of file, not for each file."""
    for k in range(12):
        put(spark, path("stage"), f"o{k}", "2024-01-01", "3", 2.0)
        put(spark, path("stage"), f"p{k}", "2024-01-01", 4, 2.0, count="int")
    groups = stage.schema_groups(stage.file_schemas(spark, path("stage")), path("stage"))
    assert groups.count() == 24 and groups.select("kind").distinct().count() == 2
    got = []
    frame = type(groups)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: got.append((self.columns, found := collect(self))) or found)
    frames = stage.frames_by_schema(spark, groups, path("stage"), "continue")
    assert len(frames) == 2 and sum(f.count() for f in frames) == 24
    with_schema = [len(r) for columns, r in got if columns not in (["kind", "file"], ["count"])]
    assert with_schema == [2]
    assert {tuple(r["names"]) for r in groups.select("names").collect()} == {("organization_id", "kpi_date")}


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="supplied tables not present")
def test_tasks_find_the_package_wherever_the_driver_started(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {str(REPO)!r}); import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', {str(tmp_path / 'shared')!r}).getOrCreate()\n"
        "print('rows', e.queries()['s7_load_records'](s, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-2000:]


KEYS = ["client", "id", "day"]
SCHEMA = "client string, id string, day date, v int, at timestamp_ntz"


def test_a_changed_row_rewrites_its_part_only(spark, path):
    p, day = path("t"), dt.date(2024, 1, 1)
    first = spark.range(200).select(
        F.lit("c").alias("client"), F.col("id").cast("string").alias("id"), F.lit(day).alias("day"), F.lit(1).alias("v"),
        F.lit(None).cast("timestamp_ntz").alias("at"),
    )
    U.upsert(p, first, KEYS, "day", buckets=8)
    before = {f.relative_to(p) for f in Path(p).rglob("*.parquet")}
    assert len({f.parent for f in before}) == 8
    for _ in range(2):
        U.upsert(p, first.filter("id = '17'").withColumn("v", F.lit(2)), KEYS, "day", buckets=8)
        after = {f.relative_to(p) for f in Path(p).rglob("*.parquet")}
        assert len({f.parent for f in before - after}) == 1 and len(before & after) == len(before) - 1
        assert len({f.parent for f in after}) == 8
    got = spark.read.schema(SCHEMA).parquet(p)
    assert got.count() == 200 and rows(got.filter("v = 2"), "id") == [("17",)]
    target = U.read_curated(p, U.with_bucket(first, KEYS, 8))
    touched = U.touched_partitions(target, U.with_bucket(first.filter("id = '17'"), KEYS, 8), ["day", U.BUCKET])
    assert "PartitionFilters: [(concat_ws" in touched._jdf.queryExecution().executedPlan().toString()
    assert 0 < touched.count() < 60


def test_parts_survive_many_partitions_and_a_crash(spark, path, monkeypatch):
    p = path("t")
    days = [dt.date(2024, 1, d) for d in range(1, 5)]
    frame = lambda v, ids: spark.createDataFrame([("c", i, d, v, None) for i in ids for d in days], SCHEMA)
    U.upsert(p, frame(1, "abc"), KEYS, "day", buckets=2)
    move = U._Journal.move
    moved = []

    def die(self, *args):
        if len(moved) == 2:
            raise RuntimeError("lost")
        moved.append(args)
        move(self, *args)

    with monkeypatch.context() as m:
        m.setattr(U, "MAX_LITERAL_PARTITIONS", 1)
        m.setattr(U._Journal, "move", die)
        with pytest.raises(RuntimeError):
            U.upsert(p, frame(2, "ad"), KEYS, "day", batch=("s", 1), buckets=2)
    U.upsert(p, frame(2, "ad"), KEYS, "day", batch=("s", 1), buckets=2)
    got = rows(spark.read.schema(SCHEMA).parquet(p).groupBy("id", "v").count())
    assert got == [("a", 2, 4), ("b", 1, 4), ("c", 1, 4), ("d", 2, 4)]
