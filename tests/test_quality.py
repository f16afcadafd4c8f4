"""Checks against counting in Python, on drawn tables of parcels."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows

from mapflow.plans import quality
from mapflow.sources.tables import frame_tables

PARCELS = "route int, stop smallint, weight double, depot string, zone decimal(6,2)"
NAMES = ["route", "stop", "weight", "depot", "zone"]


def parcels(seed, n):
    draw = random.Random(seed)
    return [
        (
            draw.choice([None, *range(n)]),
            draw.randrange(4),
            draw.choice([0.0, -0.0, 1.5, None, float(draw.randrange(50))]),
            draw.choice(["Gent", "Oslo", "Graz", "", None, "1:1", "1"]),
            draw.choice([None, 1, 2, 3]),
        )
        for _ in range(n)
    ]


DEPOTS = [("Gent", 1), ("Graz", 2), ("Graz", 2), (None, None), ("", 7)]


def violations(data, kind, columns, condition=lambda row: True, known=()):
    """What a check of one kind finds in rows."""
    taken = [tuple(row[NAMES.index(c)] for c in columns) for row in data if condition(row)]
    counts = Counter(taken)
    return {
        "primary_key": sum(n > 1 or None in key for key, n in counts.items()),
        "unique": sum(n > 1 for n in counts.values()),
        "not_null": sum(None in key for key in taken),
        "referential": sum(key[0] is None or key[0] not in known for key in counts),
    }[kind]


@pytest.fixture(scope="module")
def depots(frame):
    return frame_tables({"geo.depots": frame(DEPOTS, "city string, area bigint")})


def reference(column, other, condition=None):
    check = {"column": column, "reference_schema": "geo", "reference_table": "depots", "reference_column": other}
    return check | ({"filter": condition} if condition else {})


@pytest.mark.parametrize(("seed", "n"), [(1, 60), (2, 4), (3, 0)])
def test_every_check_agrees_with_counting(frame, depots, seed, n):
    data = parcels(seed, n)
    expectations = {
        "PK": ["route", "stop"],
        "unique": ["weight", "depot", "zone"],
        "not_null": ["route", "depot", "stop"],
        "referential_checks": [
            reference("depot", "city"),
            reference("depot", "city", "depot is not null and stop > 1"),
            reference("zone", "area"),
        ],
    }
    got = quality.run_checks(frame(data, PARCELS), expectations, depots, functional=True)
    cities, areas = {d[0] for d in DEPOTS}, {d[1] for d in DEPOTS}
    expected = [
        ("primary_key", "route,stop", violations(data, "primary_key", ["route", "stop"])),
        *[("unique", c, violations(data, "unique", [c])) for c in ("weight", "depot", "zone")],
        *[("not_null", c, violations(data, "not_null", [c])) for c in ("route", "depot", "stop")],
        ("referential", "depot in depots.city", violations(data, "referential", ["depot"], known=cities - {None})),
        ("referential", "depot in depots.city",
         violations(data, "referential", ["depot"], lambda r: r[3] is not None and r[1] > 1, cities)),
        ("referential", "zone in depots.area", violations(data, "referential", ["zone"], known=areas - {None})),
    ]
    found = [(r["check_type"], r["check_details"], r["violations"], r["result"], r["error"]) for r in got.collect()]
    assert sorted(f[:3] for f in found) == sorted(expected)
    assert all((v == 0) == (result == "PASS") == (error == "") for _, _, v, result, error in found)


def test_one_pass_over_the_table_and_one_over_each_reference(spark, tmp_path, frame):
    frame(parcels(5, 30), PARCELS).write.parquet(f"{tmp_path}/parcels")
    frame(DEPOTS, "city string, area bigint").write.parquet(f"{tmp_path}/depots")
    expectations = {
        "PK": ["route"], "unique": ["weight", "depot"], "not_null": ["stop", "zone"],
        "referential_checks": [reference("depot", "city")],
    }
    tables = frame_tables({"geo.depots": spark.read.parquet(f"{tmp_path}/depots")})
    results = quality.run_checks(spark.read.parquet(f"{tmp_path}/parcels"), expectations, tables, functional=True)
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" Relation [") == 2 and results.count() == 6


def test_columns_by_number_and_by_type(frame):
    df = frame([(1, "x")], "width int, label string")
    results = {(r["check_type"], r["check_details"]): r for r in quality.run_checks(df, {"columns": {"label": "string", "width": "bigint", "lid": "int"}}).collect()}
    assert results["column_count", "3"]["violations"] == 1
    assert results["columns_datatypes", "label,width,lid"]["violations"] == 3
    assert quality.passed(quality.run_checks(df, {"columns": 2})) is True
    assert quality.passed(quality.run_checks(df, {"columns": {"label": "string", "width": "int"}})) is True


def test_nothing_to_check_is_no_verdict(frame, depots):
    df = frame(parcels(4, 5), PARCELS)
    assert quality.passed(quality.run_checks(df, {})) is None
    referential_only = {"referential_checks": [reference("depot", "area")]}
    assert quality.passed(quality.run_checks(df, referential_only, depots)) is None


def test_violations_are_rows(frame):
    data = [(7, 1, "k"), (7, 2, "k"), (8, None, None), (8, None, "m")]
    df = frame(data, "crate int, slot int, mark string")
    assert rows(quality.duplicate_keys(df, ["crate", "slot"])) == [(8, None, 2)]
    assert rows(quality.duplicate_values(df, ["crate", "mark"])) == [("crate", "7", 2), ("crate", "8", 2), ("mark", "k", 2)]
    assert rows(quality.null_counts(df, ["mark", "slot"])) == [("mark", 1), ("slot", 2)]
    assert rows(quality.missing_values(df, "mark", frame([("m",), ("m",)], "known string"), "known", "crate > 7")) == [(None, 1)]


def test_merge():
    common = {"columns": 4, "PK": ["crate"], "not_null": ["slot"]}
    own = {"columns": {"crate": "int"}, "not_null": ["mark", "slot"], "unique": ["mark"]}
    assert quality.merge_expectations(common, own) == {
        "columns": {"crate": "int"}, "PK": ["crate"], "not_null": ["slot", "mark"], "unique": ["mark"],
    }
    assert quality.merge_expectations(None, own)["unique"] == ["mark"]


def test_log_and_gate(frame):
    df = frame([(7, 1), (7, 2), (9, 3)], "crate int, slot int")
    results = quality.run_checks(df, {"PK": ["crate"], "not_null": ["slot"]})
    assert rows(quality.dq_log(results, "202406", "crates").select("check_type", "result", "error")) == [
        ("not_null", "PASS", ""), ("primary_key", "FAIL", "1 keys repeated or with nulls"),
    ]
    none = quality.run_checks(df, {})
    assert rows(quality.dq_log(none, "202406", "crates").select("check_type", "result")) == [("none", "NA")]
    assert quality.gate(df, none, "crates") is df
    with pytest.raises(quality.QualityError, match="crates.*primary_key"):
        quality.gate(df, results, "crates")
    clean = df.dropDuplicates(["crate"])
    assert quality.gate(clean, quality.run_checks(clean, {"PK": ["crate"]}), "crates") is clean


def test_long_errors_are_cut_in_the_log_only(frame):
    wide = frame([(1,)], "x int")
    results = quality.run_checks(wide, {"columns": {f"column_{i}": "int" for i in range(60)}})
    (row,) = results.where("check_type = 'columns_datatypes'").collect()
    assert all(f"'column_{i}'" in row["error"] for i in range(60))
    (logged,) = quality.dq_log(results, "202406", "t").where("check_type = 'columns_datatypes'").collect()
    assert logged["error"] == row["error"][: quality.MAX_ERROR_TEXT]


def test_expectations_are_found_by_name():
    files = {"landing/[]_crates": {"columns": 3, "not_null": ["crate"]}, "landing/quay_crates": {"columns": 4, "not_null": ["slot"]}}
    assert quality.find_expectations(files, "landing", "quay_crates", "quay") == {"columns": 4, "not_null": ["crate", "slot"]}
    assert quality.find_expectations(files, "landing", "rail_crates", "rail") == {"columns": 3, "not_null": ["crate"]}
    assert quality.find_expectations(files, "landing", "quay_crates") == {"columns": 4, "not_null": ["slot"]}
    assert quality.find_expectations(files, "other", "quay_crates", "quay") == {}
