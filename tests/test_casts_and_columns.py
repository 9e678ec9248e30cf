from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmtide.functions import casts
from crmtide.functions import columns as C


def test_number_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([("12.5",), ("-12.5",), ("7",), ("x",), (None,), ("1e3",)], "v string")
    got = [r[0] for r in df.select(casts.try_number(F.col("v"))).collect()]
    assert got == [13, -13, 7, None, None, 1000]


def test_project_casts_and_fills_absent_columns(spark):
    schema = T.StructType(
        [
            T.StructField("n", T.LongType()),
            T.StructField("day", T.DateType()),
            T.StructField("at", T.TimestampNTZType()),
            T.StructField("money", T.DecimalType(18, 2)),
            T.StructField("flag", T.BooleanType()),
            T.StructField("absent", T.StringType()),
        ]
    )
    df = spark.createDataFrame(
        [(2.5, "2024-01-02", "2024-01-02T03:04:05+02:00", "1.005", "true"), (None, "nope", "nope", "nope", "nope")],
        "n double, day string, at string, money string, flag string",
    )
    typed = casts.project(df, schema)
    assert typed.dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
    first, second = typed.collect()
    assert first["n"] == 3 and first["day"] == dt.date(2024, 1, 2) and str(first["money"]) == "1.01"
    assert first["at"] == dt.datetime(2024, 1, 2, 3, 4, 5) and first["flag"] is True and first["absent"] is None
    assert all(v is None for v in second)


def test_cast_failed_tells_null_from_misfit(spark):
    schema = T.StructType([T.StructField("n", T.LongType())])
    df = spark.createDataFrame([("1",), (None,), ("x",)], "n string")
    assert [r[0] for r in df.select(casts.cast_failed(df, schema)).collect()] == [False, False, True]


def test_bronze_cast_truncates_like_a_json_number(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("t", T.TimestampType())])
    df = spark.createDataFrame([("20.5", "2026-08-12T00:09:41+00:00"), ("many", "soon")], "n string, t string")
    got = casts.cast_to(df, schema).withColumn("t", F.col("t").cast("timestamp_ntz")).collect()
    assert tuple(got[0]) == (20, dt.datetime(2026, 8, 12, 0, 9, 41))
    assert tuple(got[1]) == (None, None)


def test_required_invalid_blank_null_tab(spark):
    df = spark.createDataFrame([("a", "b"), ("  ", "b"), (None, "b"), ("\t", "b"), ("a", None)], "x string, y string")
    got = [r[0] for r in df.select(C.required_invalid(["x", "y"])).collect()]
    assert got == [False, True, True, False, True]
    assert [r[0] for r in df.select(C.missing_fields(["x", "y"])).collect()] == [
        [n for n, v in zip("xy", r) if v is None or not str(v).strip(" ")] for r in df.collect()
    ]
    assert df.select(C.required_invalid([])).distinct().collect()[0][0] is False


def test_extras_are_encoded_with_sorted_keys(spark):
    df = spark.sql("select map('b', '2', 'a', '1') m, 'x' v, cast(null as string) w")
    assert df.select(C.encode_extras_map(F.col("m"))).collect()[0][0] == '{"a":"1","b":"2"}'
    encoded = df.select(C.encode_extras({"z": F.col("v"), "k": F.lit("y"), "n": F.col("w")}))
    assert encoded.collect()[0][0] == '{"k":"y","z":"x"}'


def test_calendar_spine_covers_fourteen_days(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "organization_id string")
    spine = C.calendar_spine(df, "organization_id", F.lit(dt.date(2024, 1, 31)))
    assert spine.count() == 28
    assert spine.agg(F.min("kpi_date"), F.max("kpi_date")).first()[:] == (dt.date(2024, 1, 18), dt.date(2024, 1, 31))


def test_scopes(spark):
    df = spark.sql("select 'a' client_id, date'2024-01-05' feature_date union all select 'b', date'2024-01-06'")
    assert C.scoped(df).count() == 2
    assert rows(C.scoped(df, "a"), "client_id") == [("a",)]
    assert rows(C.scoped(df, day="2024-01-06"), "client_id") == [("b",)]
    assert C.scoped(df, "a", "2024-01-06").count() == 0
    assert C.scoped(df.drop("feature_date"), day="2024-01-06").count() == 2
    for wrong in ({"client_id": ""}, {"day": ""}, {"day": "2024-13-01"}):
        with pytest.raises(ValueError):
            C.scoped(df, **wrong)


def test_union_keeps_duplicates_and_fills(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    assert rows(C.union_modules(a, b), "id", "a", "b") == [(1, "x", None), (1, "x", None), (2, None, "y")]


@pytest.mark.parametrize("text, key, want", [('{"k": 3}', "$.k", 3), ("{broken", "$.k", None), ('{"k": "x"}', "$.k", None)])
def test_extract(spark, text, key, want):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(C.extract(F.try_parse_json("v"), key, "bigint")).collect()[0][0] == want


def test_stamp_is_the_time_of_the_run(spark):
    """One time for all rows of a run, between its start and its end."""
    import datetime as dt

    from crmtide.functions.columns import with_stamp

    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    for _ in range(2):
        stamped = with_stamp(spark.range(100).repartition(4), "ingested_at")
        found = {r[0] for r in stamped.select(stamped["ingested_at"].cast("timestamp_ntz")).collect()}
        ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        assert len(found) == 1 and started <= found.pop() <= ended
