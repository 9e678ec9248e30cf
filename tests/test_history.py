"""Validity intervals against a plain replay, whatever order the records come in."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmtide.operators.history import as_of, change_history
from crmtide.plans.history import History

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("cdc_timestamp", T.TimestampNTZType()),
        T.StructField("operationType", T.StringType()),
        T.StructField("run", T.StringType()),
    ]
)
START = dt.datetime(2024, 1, 1)
HOW = {"keys": ["id"], "ignored": ["run"]}


def records(seed, n=120):
    r = random.Random(seed)
    out = []
    for k in range(n):
        at = r.choice([None, *[START + dt.timedelta(hours=h) for h in range(0, 90)]])
        out.append((r.choice(["a", "b", "c", None]), r.choice(["x", "y", None]), r.choice([1, 2]), at, r.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), f"run{k}"))
    # One record per key and time, so that what is true at a time is told.
    first = {}
    for row in out:
        first.setdefault((row[0], row[3]), row)
    return list(first.values())


def replayed(data):
    out = []
    for key in {r[0] for r in data}:
        now = None
        for r in sorted((r for r in data if r[0] == key and r[3]), key=lambda r: r[3]):
            state = None if r[4] == "DELETE" else (r[1], r[2])
            if state == (now and now[0]):
                continue
            if now:
                out.append((key, *now[0], now[1], r[3]))
            now = state and (state, r[3])
        if now:
            out.append((key, *now[0], now[1], None))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("id", "stage", "amount", "valid_from", "valid_to").collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_history_equals_a_replay(spark, seed):
    data = records(seed)
    df = spark.createDataFrame([*data, *data[:20]], SCHEMA).repartition(3)
    history = change_history(df, **HOW)
    assert found(history) == replayed(data)
    when = START + dt.timedelta(hours=40)
    valid = [r[:3] for r in replayed(data) if r[3] <= when and (r[4] is None or r[4] > when)]
    assert sorted(map(tuple, as_of(history, F.lit(when)).select("id", "stage", "amount").collect()), key=str) == sorted(valid, key=str)
    assert change_history(df.limit(0), **HOW).count() == 0


def test_any_order_of_deliveries_gives_the_same_history(spark, path):
    data = records(7)
    want = replayed(data)
    for seed in range(2):
        r = random.Random(seed)
        mixed = r.sample(data, len(data))
        kept = History(spark, path(f"h{seed}"), SCHEMA, parts=4, **HOW)
        cuts = [0, *sorted(r.sample(range(1, len(mixed)), 2)), len(mixed)]
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            again = r.sample(mixed[:b], min(b, 10))
            kept.deliver(number, spark.createDataFrame([*mixed[a:b], *again], SCHEMA))
        kept.deliver(0, spark.createDataFrame([("z", "x", 1, START, "INSERT", "late")], SCHEMA))
        assert found(kept.versions()) == want


def test_changes_at_one_time_do_not_depend_on_their_order(spark):
    one = [("a", s, k, START, op, "r") for k, (s, op) in enumerate([("x", "INSERT"), ("y", "UPDATE"), ("z", "UPDATE")])]
    results = {tuple(found(change_history(spark.createDataFrame(p, SCHEMA), **HOW))) for p in (one, one[::-1], one[1:] + one[:1])}
    assert len(results) == 1 and len(results.pop()) == 1
    gone = [*one, ("a", "x", 1, START, "DELETE", "r")]
    assert found(change_history(spark.createDataFrame(gone, SCHEMA), **HOW)) == []


def test_hot_key_windows_are_days(spark):
    df = spark.createDataFrame(records(1), SCHEMA)
    plan = change_history(df, **HOW)._jdf.queryExecution().executedPlan().toString()
    assert "_day" in plan.split("Window", 1)[1].splitlines()[0]


def test_a_delivery_is_computed_once(spark, path):
    read = spark.sparkContext.accumulator(0)
    found = records(7, 40)
    changes = spark.createDataFrame(spark.sparkContext.parallelize(found, 2).map(lambda r: read.add(1) or r), SCHEMA)
    kept = History(spark, path("h"), SCHEMA, **HOW, parts=2)
    kept.deliver(0, changes)
    assert read.value == len(found)
    assert kept.versions().count() == change_history(changes, **HOW).count()
