from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.operators import upsert as U
from crmtide.operators.latest import latest_per_key
from crmtide.streaming import ingest

KEYS = ["client", "id", "day"]
SCHEMA = "client string, id string, day date, v int, at timestamp_ntz"
D = [dt.date(2024, 1, d) for d in range(1, 6)]
T = [dt.datetime(2024, 1, d) for d in range(1, 6)]


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def stored(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path), "client", "id", "day", "v")


def test_upsert_updates_inserts_and_leaves_other_partitions(spark, path):
    p = path("t")
    U.upsert(p, frame(spark, ("c", "1", D[0], 1, T[0]), ("c", "2", D[0], 1, T[0]), ("c", "1", D[1], 1, T[0])), KEYS, "day")
    untouched = {f.name for f in (Path(p) / f"day={D[1]}").glob("*.parquet")}
    batch = frame(spark, ("c", "1", D[0], 2, T[1]), ("c", "3", D[2], 2, T[1]))
    for _ in range(2):
        U.upsert(p, batch, KEYS, "day")
        assert stored(spark, p) == [("c", "1", D[0], 2), ("c", "1", D[1], 1), ("c", "2", D[0], 1), ("c", "3", D[2], 2)]
    assert {f.name for f in (Path(p) / f"day={D[1]}").glob("*.parquet")} == untouched


def test_null_keys_match_nothing(spark, path):
    p = path("t")
    batch = frame(spark, (None, "1", D[0], 1, T[0]), ("c", "1", None, 1, T[0]), ("c", "2", D[0], 1, T[0]))
    U.upsert(p, batch, KEYS, "day")
    U.upsert(p, batch.withColumn("v", F.lit(2)), KEYS, "day")
    assert stored(spark, p) == [
        (None, "1", D[0], 1), (None, "1", D[0], 2), ("c", "1", None, 1), ("c", "1", None, 2), ("c", "2", D[0], 2)
    ]


def test_a_crash_while_partitions_are_swapped_loses_nothing(spark, path, monkeypatch):
    p = path("t")
    U.upsert(p, frame(spark, ("c", "1", D[0], 1, T[0]), ("c", "2", D[0], 1, T[0]), ("c", "1", D[1], 1, T[0])), KEYS, "day")
    batch = frame(spark, ("c", "1", D[0], 2, T[1]), (None, "9", D[0], 2, T[1]))
    swap = U._swap_in

    def die(*args):
        for f in (Path(p) / f"day={D[0]}").glob("*"):
            f.unlink()
        raise RuntimeError("lost")

    monkeypatch.setattr(U, "_swap_in", die)
    with pytest.raises(RuntimeError):
        U.upsert(p, batch, KEYS, "day", batch=("s", 4))
    monkeypatch.setattr(U, "_swap_in", swap)
    want = [(None, "9", D[0], 2), ("c", "1", D[0], 2), ("c", "1", D[1], 1), ("c", "2", D[0], 1)]
    for _ in range(2):
        U.upsert(p, batch, KEYS, "day", batch=("s", 4))
        assert stored(spark, p) == want
    U.upsert(p, batch, KEYS, "day", batch=("s", 3))
    assert stored(spark, p) == want
    U.upsert(p, frame(spark, ("c", "2", D[0], 5, T[2])), KEYS, "day", batch=("s", 5))
    assert ("c", "2", D[0], 5) in stored(spark, p)
    assert sorted(f.name for f in (Path(p) / "_upserts").rglob("*") if f.is_file() and not f.name.endswith(".crc")) == ["5"]


def test_many_partitions_use_the_join(spark, path, monkeypatch):
    p = path("t")
    U.upsert(p, frame(spark, *[("c", "1", d, 1, T[0]) for d in [*D, None]]), KEYS, "day")
    monkeypatch.setattr(U, "MAX_LITERAL_PARTITIONS", 1)
    U.upsert(p, frame(spark, *[("c", "2", d, 2, T[1]) for d in [D[0], D[1], None]]), KEYS, "day")
    assert len(stored(spark, p)) == 9


def test_guard_keeps_the_newer_row(spark):
    target = frame(spark, ("c", "1", D[0], 1, T[3]), ("c", "2", D[0], 1, T[0]), ("c", "3", D[0], 1, None), ("c", "4", D[0], 1, T[0]))
    source = frame(spark, ("c", "1", D[0], 2, T[1]), ("c", "2", D[0], 2, T[1]), ("c", "3", D[0], 2, T[1]), ("c", "5", D[0], 2, T[1]))
    assert rows(U.merge_rows(target, source, KEYS, "at"), "id", "v") == [("1", 1), ("2", 2), ("3", 2), ("4", 1), ("5", 2)]
    assert rows(U.merge_rows(target, source, KEYS), "id", "v") == [("1", 2), ("2", 2), ("3", 2), ("4", 1), ("5", 2)]


def test_partition_column_must_be_a_key(spark, path):
    with pytest.raises(ValueError):
        U.upsert(path("t"), frame(spark, ("c", "1", D[0], 1, T[0])), ["client", "id"], "day")


def scores(spark, data):
    """Lead-score export rows: (lead, day, score, exported_at)."""
    full = []
    for lead, day, score, at in data:
        row = {"lead_id": lead, "client_id": "c", "feature_date": day, "lead_score": score, "exported_at": at}
        full.append(tuple(row.get(f.name) for f in S.LEAD_SCORE))
    return spark.createDataFrame(full, S.LEAD_SCORE)


def run_round(spark, root, data=None, guard=None):
    if data is not None:
        scores(spark, data).write.mode("append").parquet(f"{root}/stage")
    ingest.load_incremental(spark, "lead_score", f"{root}/stage", f"{root}/raw", f"{root}/in")
    feed = ingest.change_feed(spark, f"{root}/raw", "lead_score")
    ingest.run_to_end(ingest.curate(feed, f"{root}/curated", f"{root}/cur", guard=guard, trigger=ingest.ALL_AVAILABLE))
    raw = spark.read.parquet(f"{root}/raw")
    curated = spark.read.schema(S.landing_table_schema("lead_score")).parquet(f"{root}/curated")
    return raw, curated


@pytest.mark.parametrize("guard", [None, "exported_at"])
def test_stream_upsert(spark, path, guard):
    root = path("s")
    run_round(spark, root, [("l1", D[0], 1.0, T[2]), ("l1", D[0], 2.0, T[3]), ("l2", D[0], 3.0, T[0])], guard)
    raw, curated = run_round(spark, root, [("l1", D[0], 9.0, T[1]), ("l3", D[1], 4.0, T[0])], guard)
    assert raw.count() == 5
    late = 9.0 if guard is None else 2.0
    assert rows(curated, "lead_id", "lead_score") == [("l1", late), ("l2", 3.0), ("l3", 4.0)]
    raw, again = run_round(spark, root, None, guard)
    assert raw.count() == 5 and rows(again) == rows(curated)
    names = [r[0] for r in curated.select("src_filename").collect()]
    assert all(n.endswith(".parquet") and "/" not in n for n in names)


def test_stream_equals_batch_and_replay_changes_nothing(spark, path):
    data = [(f"l{i % 7}", D[i % 3], float(i), T[i % 5] + dt.timedelta(seconds=i)) for i in range(60)]
    _, curated = run_round(spark, path("s"), data)
    raw = spark.read.parquet(path("s") + "/raw")
    U.upsert(path("batch"), latest_per_key(raw, S.LEAD_SCORE_KEYS), S.LEAD_SCORE_KEYS, "feature_date")
    batch = spark.read.schema(curated.schema).parquet(path("batch"))
    assert rows(batch, *curated.columns) == rows(curated)
    ingest.upsert_batch(raw, path("batch"), S.LEAD_SCORE_KEYS, "feature_date")
    again = spark.read.schema(curated.schema).parquet(path("batch"))
    assert rows(again, *curated.columns) == rows(curated)


def test_lost_ingest_checkpoint_is_the_only_way_to_load_twice(spark, path):
    root = path("s")
    scores(spark, [("l1", D[0], 1.0, T[0])]).write.parquet(f"{root}/stage")
    for _ in range(3):
        ingest.load_incremental(spark, "lead_score", f"{root}/stage", f"{root}/raw", f"{root}/in")
    assert spark.read.parquet(f"{root}/raw").count() == 1


def test_bronze_stream_matches_the_batch_job(spark, path):
    from test_bronze import fixture_lines, write_lines

    lines = fixture_lines()["lead"]
    source = write_lines(path("b"), "lead", [*lines, lines[0] | {"leadId": ""}, "{broken"])
    for _ in range(2):
        for q in ingest.bronze_stream(
            spark, "lead", source, path("silver"), path("quarantine"), path("cp"), trigger=ingest.ALL_AVAILABLE
        ):
            ingest.run_to_end(q)
    assert rows(spark.read.parquet(path("silver")), "leadId") == [(f"leadId-{i}",) for i in range(4)]
    assert rows(spark.read.parquet(path("quarantine")), "leadId") == [(None,), ("",)]


def test_time_limit_stops_a_query(spark, path):
    scores(spark, [("l1", D[0], 1.0, T[0])]).write.parquet(path("stage"))
    query = ingest.auto_ingest(spark, "lead_score", path("stage"), path("raw"), path("cp"), trigger=ingest.EVERY_MINUTE)
    with pytest.raises(TimeoutError):
        ingest.run_to_end(query, seconds=1)
    assert not query.isActive


def stateful_round(spark, root, data, order):
    rows_ = [(lead, client, day, score, at) for lead, client, day, score, at in data]
    full = []
    for lead, client, day, score, at in rows_:
        row = {"lead_id": lead, "client_id": client, "feature_date": day, "lead_score": score, "exported_at": at}
        full.append(tuple(row.get(f.name) for f in S.LEAD_SCORE))
    if full:
        spark.createDataFrame(full, S.LEAD_SCORE).write.mode("append").parquet(f"{root}/stage")
    ingest.load_incremental(spark, "lead_score", f"{root}/stage", f"{root}/raw", f"{root}/in")
    feed = ingest.change_feed(spark, f"{root}/raw", "lead_score")
    ingest.run_to_end(ingest.curate_stateful(feed, f"{root}/curated", f"{root}/state", order=order, trigger=ingest.ALL_AVAILABLE))
    return spark.read.schema(S.landing_table_schema("lead_score")).parquet(f"{root}/curated")


def test_stateful_latest_goes_on_after_a_restart(spark, path):
    """The newest export wins whenever it comes; rows without a key part stay once."""
    root, newest = path("s"), ("exported_at", "loaded_at")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stateful_round(spark, root, [("l1", "c", D[0], 1.0, T[2]), ("l2", "c", D[1], 2.0, T[0]), ("l3", None, D[0], 3.0, T[0])], newest)
    late = [("l1", "c", D[0], 9.0, T[1]), ("l2", "c", D[1], 8.0, dt.datetime(2023, 1, 1)), ("l4", "c", D[0], 4.0, T[0])]
    got = stateful_round(spark, root, late, newest)
    assert rows(got, "lead_id", "lead_score") == [("l1", 1.0), ("l2", 2.0), ("l3", 3.0), ("l4", 4.0)]
    got = stateful_round(spark, root, [("l1", "c", D[0], 7.0, T[3])], newest)
    assert rows(got, "lead_id", "lead_score") == [("l1", 7.0), ("l2", 2.0), ("l3", 3.0), ("l4", 4.0)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_stateful_latest_writes_a_partition_once(spark, path):
    """Each touched day is one small file, not one from every task of the state."""
    root = path("s")
    for k in range(2):
        data = [(f"l{i}", "c", D[i % 2], float(i), T[k] + dt.timedelta(seconds=i)) for i in range(40)]
        got = stateful_round(spark, root, data, ("exported_at", "loaded_at"))
        assert got.count() == 40
        for day in D[:2]:
            assert len(list((Path(root) / "curated" / f"feature_date={day}").glob("*.parquet"))) == 1
