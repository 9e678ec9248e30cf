from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from crmtide import schemas as S
from crmtide.plans import jobs
from crmtide.sources.bronze import CORRUPT, read_bronze, typed_bronze

START = dt.datetime(2025, 3, 2, 22, 50)
COUNTS = {"account": 2, "lead": 4, "opportunity": 3, "contract": 2, "call": 5, "email": 11}
VALUES = {"string": lambda f, i: f"{f}-{i}", "double": lambda f, i: i * 1.25, "int": lambda f, i: 7 * i, "date": lambda f, i: f"2025-04-{1 + i:02d}"}


def line(minutes, **fields):
    at = (START + dt.timedelta(minutes=minutes)).isoformat() + "+00:00"
    return {"cdc_timestamp": at, "operationType": "UPSERT", "undeclared": "dropped"} | fields, at


def fixture_lines():
    """27 change records, the fields of each made up from its schema."""
    out = {}
    for e, n in COUNTS.items():
        out[e] = []
        for i in range(n):
            row, at = line(37 * i)
            for f in S.ENTITY_SCHEMAS[e]:
                kind = f.dataType.simpleString()
                row.setdefault(f.name, at if kind == "timestamp" else VALUES[kind](f.name, i))
            out[e].append(row)
    return out


def write_lines(root: str, entity: str, lines, hour: str = "04") -> str:
    folder = Path(root) / entity / "year=2025" / "month=03" / "day=03" / f"hour={hour}"
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines)
    (folder / f"{entity}.json").write_text(text + "\n")
    return str(Path(root) / entity)


@pytest.mark.parametrize("entity", list(S.ENTITY_SCHEMAS))
def test_every_entity_loads_completely(spark, path, entity):
    lines = fixture_lines()
    assert sum(map(len, lines.values())) == 27
    source = write_lines(path("bronze"), entity, lines[entity])
    table = f"b_{entity}"
    counts = jobs.bronze_to_silver(spark, entity, source, table, path("quarantine"), table_path=path(table))
    assert counts == {"loaded": len(lines[entity]), "quarantined": 0}
    loaded = spark.table(table)
    assert set(loaded.columns) == {*S.ENTITY_SCHEMAS[entity].names, "ingested_at", *S.EVENT_HOUR}
    assert not Path(path("quarantine")).exists()
    for f in S.ENTITY_SCHEMAS[entity]:
        assert loaded.schema[f.name].dataType == f.dataType
        assert loaded.filter(F.col(f.name).isNull()).count() == 0


def test_partitions_follow_event_time_not_folder(spark, path):
    source = write_lines(path("bronze"), "contract", fixture_lines()["contract"])
    jobs.bronze_to_silver(spark, "contract", source, "b_hours", path("q"), table_path=path("t"))
    assert rows(spark.table("b_hours").select(*S.EVENT_HOUR).distinct()) == [(2025, 3, 2, 22), (2025, 3, 2, 23)]
    scan = read_bronze(spark, "contract", source, with_path_cols=True)
    assert rows(scan.select(*S.EVENT_HOUR).distinct()) == [(2025, 3, 3, 4)]


def test_invalid_rows_are_quarantined_and_reruns_append(spark, path):
    good = fixture_lines()["call"][:2]
    bad = [
        good[0] | {"clientId": None}, good[0] | {"callId": "  "}, good[0] | {"cdc_timestamp": "soon"},
        "{not json", {k: v for k, v in good[0].items() if k != "applicationId"},
    ]
    kept = [good[0] | {"callId": "\t"}, good[1] | {"durationSeconds": "long"}, good[1] | {"durationSeconds": 12.9}]
    source = write_lines(path("bronze"), "call", [*good, *bad, *kept])
    for n in (1, 2):
        counts = jobs.bronze_to_silver(spark, "call", source, "b_calls", path("q"), table_path=path("calls"))
        assert counts == {"loaded": 5, "quarantined": 5}
        assert spark.table("b_calls").count() == 5 * n
    seconds = [r[0] for r in spark.table("b_calls").select("durationSeconds").collect()]
    assert sorted(s for s in seconds if s is not None) == [0, 0, 0, 0, 7, 7, 12, 12]
    quarantine = spark.read.parquet(path("q") + "/call")
    assert quarantine.count() == 10
    assert quarantine.filter("hour is null").count() == 4
    assert {r[0] for r in quarantine.select("validation_reason").collect()} == {"missing_required_field"}
    every = "applicationId,callId,clientId,cdc_timestamp,operationType"
    assert sorted(r[0] for r in quarantine.select("missing_fields").distinct().collect()) == sorted(
        ["clientId", "callId", "cdc_timestamp", every, "applicationId"]
    )


def test_corrupt_line_is_kept_on_request(spark, path):
    source = write_lines(path("bronze"), "email", ["{not json", *fixture_lines()["email"]])
    scan = read_bronze(spark, "email", source, keep_corrupt=True)
    assert [r[CORRUPT] for r in scan.collect() if r[CORRUPT]] == ["{not json"]
    assert typed_bronze(read_bronze(spark, "email", source), "email").filter("emailId is null").count() == 1


def test_export_scope_does_not_hide_tenants(spark, path):
    gold = spark.sql(
        "select 'a' client_id, 'x' account_id, date'2024-01-05' feature_date union all "
        "select 'b', 'y', date'2024-01-05' union all select 'a', 'z', date'2024-01-06'"
    )
    for single in (False, True, True):
        leaf = jobs.export_gold(gold, path("gold"), "ALL", "2024-01-05", single_file=single)
    assert leaf.endswith("client_id=ALL/feature_date=2024-01-05")
    from crmtide.sources.stage import read_stage

    back = read_stage(spark, path("gold"), leaf_columns_only=True)
    assert rows(back, "client_id", "account_id", "export_client_scope", "export_snapshot_date") == [
        ("a", "x", "ALL", "2024-01-05"), ("b", "y", "ALL", "2024-01-05"),
    ]
    assert len(list(Path(leaf).glob("*.snappy.parquet"))) == 1
    one = jobs.export_gold(gold, path("gold"), "a", "2024-01-06")
    assert rows(read_stage(spark, one, leaf_columns_only=True), "account_id") == [("z",)]
