from __future__ import annotations

import datetime as dt

from conftest import rows

from crmtide import schemas as S
from crmtide.operators import quality


def test_not_null_reports_only_violations(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("b", 1)], "x string, y int")
    assert rows(quality.not_null(df, ["x", "y"])) == [("x", 1), ("y", 2)]
    assert quality.not_null(df.filter("x = 'b'"), ["x", "y"]).count() == 0


def test_accepted_values_lets_null_pass(spark):
    df = spark.createDataFrame([("A", "u"), ("B", None), (None, "v"), ("B", "u")], "x string, y string")
    got = quality.accepted_values(df, {"x": ["A"], "y": ["u"]})
    assert rows(got, "column_name", "value", "violations") == [("x", "B", 2), ("y", "v", 1)]


def test_unique_grain_counts_null_keys_as_equal(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "x string, y int")
    assert rows(quality.unique_grain(df, ["x", "y"])) == [(None, 1, 2), ("a", 1, 2)]


def test_rule_inventory():
    assert sum(map(len, S.NOT_NULL.values())) == 37
    assert sum(map(len, S.ACCEPTED_VALUES.values())) == 10
    assert len(S.UNIQUE_GRAIN) == 4


def test_checks_run_for_the_given_models_only(spark):
    kpi = spark.createDataFrame(
        [("o", dt.date(2024, 1, 1), "READY"), (None, dt.date(2024, 1, 1), "LATE")],
        "organization_id string, kpi_date date, kpi_readiness_status string",
    )
    models = {"stg_kpi": kpi}
    assert rows(quality.check_not_null(models), "model", "column_name", "violations") == [("stg_kpi", "organization_id", 1)]
    assert rows(quality.check_accepted_values(models), "column_name", "value") == [("kpi_readiness_status", "LATE")]


def test_all_rules_of_a_model_take_one_pass(spark, path):
    kpi = spark.createDataFrame(
        [("o", dt.date(2024, 1, 1), "READY"), (None, dt.date(2024, 1, 1), "LATE"), ("o", dt.date(2024, 1, 1), "READY")],
        "organization_id string, kpi_date date, kpi_readiness_status string",
    )
    kpi.write.parquet(path("k"))
    table = spark.read.parquet(path("k"))
    found = quality.violations(table, S.NOT_NULL["daily_scorecard"], S.ACCEPTED_VALUES["daily_scorecard"])
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = quality.run_checks({"daily_scorecard": table})
    assert rows(got, "check_name", "column_name", "value", "violations") == [
        ("accepted_values", "kpi_readiness_status", "LATE", 1),
        ("not_null", "organization_id", None, 1),
        ("unique_grain", "organization_id,kpi_date", "o|2024-01-01", 2),
    ]


def test_rules_are_counted_by_the_write(spark, path):
    from crmtide.operators.observed import Watched, unique_grain_by_print

    rules = {"k": ["a", "b"], "v": ["x"]}
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("c", None, 2), (None, "y", 2), ("c", "x", None)], "k string, v string, n int")
    watched = Watched(df, ["k", "n"], rules)
    watched.df.write.parquet(path("t"))
    got = {tuple(r) for r in watched.findings(spark.read.parquet(path("t"))).collect()}
    assert got == {tuple(r) for r in quality.violations(df, ["k", "n"], rules).collect()} and len(got) == 4
    clean = Watched(df.filter("k = 'a'"), ["k", "n"], rules)
    clean.df.write.parquet(path("clean"))
    # Nothing is broken, so what was written is not read.
    assert clean.findings(spark.createDataFrame([], "nothing int")).count() == 0
    for keys in (["k"], ["k", "v"], ["n"]):
        assert {tuple(r) for r in unique_grain_by_print(df, keys).collect()} == {tuple(r) for r in quality.unique_grain(df, keys).collect()}
    plan = unique_grain_by_print(df, ["k", "v"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_print" in plan
