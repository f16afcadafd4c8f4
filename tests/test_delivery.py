from __future__ import annotations

import datetime
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from mapflow.functions import calendar
from mapflow.functions.columns import entity_code, is_entity_code, month_end
from mapflow.plans import delivery, evolve
from mapflow.sources.landing import TRIGGER_COLUMNS

TRIGGER = ", ".join(f"{c} string" for c in TRIGGER_COLUMNS)


@pytest.fixture(scope="module")
def matched(frame):
    triggers = frame(
        [("to", "sys", f"V{i}", "202503" if i < 4 else "202504", None if i == 3 else "t", f"p{i}", "5") for i in range(2, 6)],
        TRIGGER,
    )
    meta = frame(
        [("V2", "202503", 0, "a"), ("V3", "202503", 8, "b"), ("V4", "202503", 0, "c"), ("V5", "202504", 7, "d")],
        "SourceFileName string, SnapshotDate string, FileDeliveryStep int, StgTableName string",
    )
    return delivery.match_triggers(triggers, meta)


def test_triggers_match_open_deliveries_only(matched):
    found = matched.select("dial_source_file_name", "StgTableName", "trigger_file_name")
    assert rows(found) == [
        ("V2", "a", "to_sys_V2_202503_t"),
        ("V3", "b", "to_sys_V3_202503"),
        ("V4", None, "to_sys_V4_202504_t"),
        ("V5", None, "to_sys_V5_202504_t"),
    ]


def test_triggers_by_target_in_one_pass_with_bounded_tasks(frame, monkeypatch):
    monkeypatch.setattr(delivery, "ROWS_PER_TASK", 10)
    data = [("to" if i % 3 else None, "sys", f"V{i % 20}", "202503", str(i % 100), "p", "5") for i in range(200)]
    triggers = frame(data, TRIGGER)
    meta = frame(
        [(f"V{i}", "202503", i % 9, "a") for i in range(10)] + [("V8", "202503", 0, "b"), ("V8", "202503", 8, "c")],
        "SourceFileName string, SnapshotDate string, FileDeliveryStep int, StgTableName string",
    )
    got = delivery.triggers_by_target(triggers, meta)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and re.search(r"RepartitionByExpression \[dial_source_file_name.*\], 20", plan)
    load, archive = delivery.split_triggers(delivery.match_triggers(triggers, meta))
    expected = [(*r, "load") for r in load.collect()] + [(*r, "archive") for r in archive.collect()]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, expected))
    assert {r[-1] for r in expected} == {"load", "archive"}


def test_split(matched):
    load, archive = delivery.split_triggers(matched)
    assert [r[2] for r in rows(load)] == ["V2", "V3"]
    assert [r[2] for r in rows(archive)] == ["V4", "V5"]


def test_row_counts(frame):
    data = frame([("a",), ("a",), ("b",)], "s string")
    announced = frame([("a", 2), ("b", 3), ("c", 0)], "source string, expected_rows bigint")
    got = delivery.row_count_check(data, "s", announced)
    assert rows(got.select("source", "result", "comment")) == [
        ("a", "SUCCESS", "Expected and received 2 records"),
        ("b", "FAILED", "Expected 3, received 1 records"),
        ("c", "SUCCESS", "Expected and received 0 records"),
    ]


def test_deadlines(frame):
    expected = frame(
        [("Ledger", "l_due", "2024-01-01"), ("rates", "r_later", "2999-01-01"), ("archive", "a_due", "2024-01-01"),
         ("archive", "a_new", "2023-12-31"), ("ledger", "l_none", None), ("ledger", "l_here", "2024-01-01")],
        "SourceSystem string, SourceFileName string, Deadline string",
    )
    got = frame([("LEDGER", "l_here"), ("rates", "a_due")], "SourceSystem string, SourceFileName string")
    missing = delivery.missing_after_deadline(expected, got, "2024-01-01", critical=["LEDGER", "Rates"])
    assert rows(missing.select("SourceFileName", "is_critical")) == [("a_due", 0), ("a_new", 0), ("l_due", 1)]
    processed = frame(
        [("a_due", "p/202312"), ("a_due_20240102.txt", "p/202401"), ("a_due_more", "p/9"), ("x", "p/9")],
        "SourceFileName string, path string",
    )
    carried = delivery.carry_forward(missing.where("is_critical = 0"), processed)
    assert rows(carried.select("SourceFileName", "carried_path", "carry_status")) == [
        ("a_due", "p/202401", "carried"), ("a_new", None, "no processed version"),
    ]


def test_delay_is_more_than_36_hours(frame):
    meta = frame([("2024-01-01", "a", 1), ("2024-01-02", "b", 1), ("2024-01-01", "c", 7)], "SnapshotDate string, SourceFileName string, FileDeliveryStep int")
    assert rows(delivery.delayed(meta, "2024-01-02 12:00:01")) == [("2024-01-01", "a")]
    assert rows(delivery.delayed(meta, "2024-01-02 12:00:00")) == []


def test_status_and_numbers(frame):
    events = frame([("f", 0, 1), ("f", 7, 3), ("f", 5, 2), ("g", 8, 1)], "file string, step int, seq int")
    assert rows(delivery.current_status(events, ["file"], ["seq"]).select("file", "step")) == [("f", 7), ("g", 8)]
    log = frame([("f", 2), ("f", 4)], "file string, DeliveryNumber int")
    assert rows(delivery.delivery_number(frame([("f",), ("g",)], "file string"), log, ["file"])) == [("f", 4), ("g", 0)]


def test_status_dimension(spark):
    names = {(r["flow"], r["step"]): r["description"] for r in delivery.status_dimension(spark).collect()}
    assert len(names) == 27
    assert names["flat", 3] == "Converted to Parquet"
    assert names["view", 8] == "Redelivery expected"


def test_runs_and_missing_tables(frame):
    runs = frame(
        [(1, "A", "col", "2024-03-31"), (4, "A", "col", "2024-03-31"), (4, "A", "col", "2024-03-31"), (9, "A", "col", "2024-04-30")],
        "RunID int, DeliveryEntity string, SSFTableName string, FileReportingDate string",
    )
    assert [r[0] for r in rows(delivery.latest_runs(runs, "2024-03-31"))] == [4, 4]
    pairs = frame([("A", "col"), ("A", "cf"), ("B", "cf")], "entity string, table_name string")
    assert rows(delivery.missing_tables(pairs)) == [("B", "col")]


def test_run_summary(frame):
    ts = datetime.datetime(2024, 1, 1)
    events = frame(
        [(1, "a", "Started", ts, 1), (1, "a", "Failed", ts, 2), (1, "b", "Completed", ts, 3), (2, "a", "Completed", ts, 4),
         (3, "a", "Completed", ts, 5), (3, "b", "Started", ts, 6)],
        "run_id int, component string, status string, ts timestamp, event_id int",
    )
    assert rows(delivery.run_summary(events)) == [
        (1, "a", "Failed", "Failed"), (1, "b", "Completed", "Failed"), (2, "a", "Completed", "Completed"),
        (3, "a", "Completed", "Running"), (3, "b", "Started", "Running"),
    ]


@pytest.fixture()
def stock(frame):
    """A shelf table, and a supplier table that names some suppliers twice."""
    return {
        "shelf": frame([(7, "Acme", 3), (8, "BOLT", 4)], "slot int, maker string, pieces int"),
        "maker": frame([("acme", "Ghent"), ("acme", "Bruges"), ("bolt", "Turin")], "code string, town string"),
    }


def change(kind, entity, old=None, new=None, **more):
    return {"ChangeType": kind, "NewEntityName": entity, "OldAttributeName": old, "NewAttributeName": new, **more}


def test_changes_of_one_table(stock):
    steps = [change("Rename", "shelf", "PIECES", "amount"), change("Add", "shelf", new="grade"), change("Remove", "shelf", "slot")]
    done, texts = evolve.evolve_tables(stock, steps)
    assert done["shelf"].dtypes == [("maker", "string"), ("amount", "int"), ("grade", "string")]
    assert texts == {"shelf": ["Renamed PIECES to amount", "Added grade", "Removed slot"], "maker": ["No changes done"]}


def test_moved_column_multiplies_nothing(stock):
    move = change("Move", "shelf", "town", "origin", OldEntityName="maker", NewEntityKey="maker", OldEntityKey="code")
    done, texts = evolve.evolve_tables(stock, [move])
    assert rows(done["shelf"]) == [(7, "Acme", 3, "Bruges"), (8, "BOLT", 4, "Turin")]
    assert done["maker"].columns == ["code"]
    assert texts["maker"] == texts["shelf"] == ["Moved maker.town to shelf.origin"]


def test_changes_without_their_columns_are_skipped(stock):
    key = {"OldEntityName": "maker", "NewEntityKey": "maker", "OldEntityKey": "number"}
    steps = [change("Remove", "shelf", "depth"), change("Move", "shelf", "town", "origin", **key), change("Add", "cellar", new="x")]
    done, texts = evolve.evolve_tables(stock, steps)
    assert done["shelf"].columns == ["slot", "maker", "pieces"]
    assert texts["shelf"] == ["Skipped: no column depth", "Skipped: nothing to move for origin, no number"]


def test_renaming_onto_another_column_is_refused(stock):
    with pytest.raises(evolve.SchemaChangeError, match="Maker"):
        evolve.evolve_tables(stock, [change("Rename", "shelf", "slot", "Maker")])


def test_changes_are_chosen_by_delivered_version(frame):
    listed = frame([("v1", "a"), ("v2", "b"), ("v3", "c")], "OldXSDVersion string, x string")
    files = frame([("v2",), ("v2",), ("v9",)], "XSDVersion string")
    assert rows(evolve.changes_since(listed, files).select("x")) == [("b",)]


def test_latest_version(frame):
    listed = frame(
        [("cf", "old", "2024Q2V1"), ("cf", "new", "2025Q2V1"), ("col", "x", "2024Q2V1")],
        "SSFTableName string, AttributeName string, XSDVersion string",
    )
    newest = evolve.latest_version(listed)
    assert rows(newest.select("SSFTableName", "AttributeName")) == [("cf", "new"), ("col", "x")]


@pytest.mark.parametrize(
    ("month", "schedule", "expected"),
    [
        ("2024-08-01", "M-1", "2024-08-30"),
        ("2024-08-01", "M+1", "2024-09-02"),
        ("2024-08-01", "M-F", "2024-08-30"),
        ("2024-08-01", "M-T", "2024-08-27"),
        ("2024-12-01", "M+1", "2025-01-02"),
        ("2024-12-01", "M+2", ""),
    ],
)
def test_snapshot_dates(spark, frame, month, schedule, expected):
    asked = frame([(month, schedule)], "month string, schedule string").withColumn("month", F.col("month").cast("date"))
    got = calendar.snapshot_dates(asked, calendar.holidays_between(spark, 2024, 2025))
    assert got.first()["SnapshotDate"] == expected


def test_holidays(spark):
    days = {str(r[0]) for r in calendar.holidays_between(spark, 2013, 2026).collect()}
    for day in ("2024-03-29", "2024-04-01", "2024-05-09", "2024-05-20", "2025-04-26", "2026-04-27", "2013-04-30", "2025-12-26"):
        assert day in days
    assert "2025-04-27" not in days and "2024-04-30" not in days


@pytest.mark.parametrize(
    ("code", "normal", "standard"),
    [("Branch-7B", "branch7b", False), ("branch7b", "branch7b", True), ("A B\\C", "abc", False), ("x.Y.z9", "xyz9", False),
     ("p$q%", "pq", False), ("", "", True), (None, None, True), ("55-1", "551", False)],
)
def test_entity_codes(frame, code, normal, standard):
    df = frame([(code,)], "c string")
    assert df.select(entity_code(F.col("c")), is_entity_code(F.col("c"))).first() == (normal, standard)


def test_month_end(frame):
    assert str(frame([("202402",)], "m string").select(month_end(F.col("m"))).first()[0]) == "2024-02-29"
