from __future__ import annotations

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from mapflow.operators.joins import CrossJoinError
from mapflow.plans.mapping import (
    MappingError,
    bind_parameters,
    filter_impact,
    integrate,
    run_chain,
    run_mapping,
)
from mapflow.sources.mapping_files import load_mapping
from mapflow.sources.tables import frame_tables, underscore_hyphens


@pytest.fixture(scope="module")
def parcels(frame):
    """Parcels on their way: a depot each, several scans, and a calendar of days with two roles."""
    return frame_tables(
        {
            "parcel": frame([(70, "N", 12.5, 3), (71, "S", 2.0, 5)], "parcel int, depot string, kilos double, left_on int"),
            "depot": frame([("N", "Northgate"), ("W", "Westhill")], "depot string, town string"),
            "scan": frame([(70, "belt"), (70, "van"), (72, "belt")], "parcel_no int, place string"),
            "day": frame([(3, "Wed"), (4, "Thu"), (5, "Fri"), (6, "Sat")], "day int, name string"),
        }
    )


def sources(**named):
    return [{"alias": alias, "source": source} for alias, source in named.items()]


def test_joins_in_a_row_multiply_by_matches_only(parcels):
    mapping = {
        "sources": sources(P="parcel", D="depot", S="scan"),
        "transformations": [
            {"join": {"left_source": "P", "right_source": "D", "condition": ["D.depot = P.depot"]}},
            {"join": {"right_source": "S", "condition": "S.parcel_no = P.parcel", "how": "left"}},
        ],
    }
    df = integrate(parcels, mapping)
    assert rows(df.select("P.parcel", "D.town", "S.place")) == [
        (70, "Northgate", "belt"), (70, "Northgate", "van"), (71, None, None),
    ]


def test_without_steps_the_first_source_is_taken(parcels):
    assert rows(integrate(parcels, {"sources": sources(D="depot", S="scan")})) == [("N", "Northgate"), ("W", "Westhill")]


def test_one_table_in_two_roles_with_a_computed_key(parcels):
    mapping = {
        "sources": sources(P="parcel", OUT="day", DUE="day"),
        "transformations": [
            {"join": {"left_source": "P", "right_source": "OUT", "condition": ["OUT.day = P.left_on"]}},
            {"join": {"right_source": "DUE", "condition": ["DUE.day = P.left_on + if(P.kilos > 10, 3, 1)"]}},
        ],
        "expressions": {"parcel": "P.parcel", "out": "OUT.name", "due": "DUE.name"},
    }
    assert rows(run_mapping(parcels, mapping)) == [(70, "Wed", "Sat"), (71, "Fri", "Sat")]


def test_union_with_maps(frame):
    tables = frame_tables(
        {
            "metric": frame([("a", 1500)], "crate string, grams int"),
            "imperial": frame([(9, 2.0, 4.0)], "box int, pounds double, per_pound double"),
        }
    )
    branches = {
        "M": {"label": "upper(crate)", "kilos": "grams / 1000"},
        "I": {"label": "concat('#', box)", "kilos": "pounds / per_pound"},
    }
    for spelling in (branches, [{k: v} for k, v in branches.items()]):
        mapping = {
            "sources": sources(M="metric", I="imperial"),
            "transformations": [{"union": {"alias": "U", "column_mapping": spelling}}],
        }
        assert rows(integrate(tables, mapping)) == [("#9", 0.5), ("A", 1.5)]


def test_union_is_strict_unless_told(frame):
    tables = frame_tables({"b": frame([(1, 2)], "x int, y int"), "c": frame([(3,)], "x int")})
    step = {"alias": "U", "column_mapping": ["B", "C"]}
    mapping = {"sources": sources(B="b", C="c"), "transformations": [{"union": step}]}
    with pytest.raises(AnalysisException):
        integrate(tables, mapping).collect()
    step["allow_missing_columns"] = True
    assert rows(integrate(tables, mapping)) == [(1, 2), (3, None)]


@pytest.fixture(scope="module")
def readings(frame):
    """Meter readings by season, in long form."""
    return frame_tables(
        {
            "reading": frame(
                [("m1", "wet", 4), ("m1", "wet", 9), ("m1", "dry", 2), ("m2", "dry", 7)], "meter string, season string, litres int"
            ),
            "limit": frame([(9, "high"), (7, "fair")], "level int, word string"),
        }
    )


def pivot_step(**more):
    return {"pivot": {"alias": "P", "group_cols": ["R.meter"], "pivot_col": "R.season", "pivot_value_col": "R.litres", **more}}


def test_pivot_with_named_and_with_discovered_columns(readings):
    mapping = {"sources": sources(R="reading"), "transformations": [pivot_step(column_mapping={"wet": "max", "dry": "min", "frost": "max"})]}
    df = integrate(readings, mapping)
    assert df.columns == ["meter", "wet", "dry", "frost"]
    assert rows(df) == [("m1", 9, 2, None), ("m2", None, 7, None)]
    found = integrate(readings, {**mapping, "transformations": [pivot_step(value_suffix="litres")]})
    assert sorted(found.columns) == ["dry_litres", "meter", "wet_litres"]


@pytest.fixture(scope="module")
def guests(frame):
    return frame([("ana", "gold", 8), ("bo", "tin", 30), ("cy", "gold", 2), ("di", "tin", 1)], "guest string, tier string, visits int")


@pytest.mark.parametrize(
    ("conditions", "left"), [(["tier = 'gold'"], 2), (["tier = 'gold'", "visits >= 8"], 1), ([], 4), (["visits < 3 or visits > 20", "tier <> 'tin'"], 1)]
)
def test_filter(guests, conditions, left):
    tables = frame_tables({"guest": guests})
    mapping = {"sources": sources(G="guest"), "transformations": [{"filter": {"conditions": conditions}}]}
    assert integrate(tables, mapping).count() == left


def test_filter_impact(guests):
    steps = filter_impact(guests, ["tier = 'gold'", "visits >= 8"]).orderBy("step").collect()
    assert [r["rows_left"] for r in steps] == [4, 2, 1]


def test_mapping_from_sources_to_target(frame):
    """Two filtered readings of one source, a step variable, an aggregate with a median, constants and target filters."""
    tables = frame_tables(
        {
            "trip": frame(
                [("t1", "rail", 3, 40), ("t1", "road", 2, 60), ("t2", "rail", 9, 10), ("t2", "rail", 5, 90), ("t3", "road", 1, 20)],
                "trip string, kind string, hours int, cost int",
            ),
            "city": frame([("t1", "Oslo"), ("t2", "Lima"), ("t3", None)], "trip string, city string"),
        }
    )
    mapping = {
        "target": "out_{{ RUN_MONTH }}.trips",
        "sources": [
            {"alias": "RAIL", "source": "trip", "columns": ["trip", "hours", "cost"], "filter": "kind = 'rail'"},
            {"alias": "ROAD", "source": "trip", "columns": ["trip", "cost"], "filter": "kind = 'road'"},
            {"alias": "C", "source": "city"},
        ],
        "transformations": [
            {"join": {"left_source": "C", "right_source": "RAIL", "condition": ["RAIL.trip = C.trip"]}},
            {"join": {"right_source": "ROAD", "condition": ["ROAD.trip = C.trip"]}},
            {"add_variables": {"column_mapping": {"slow": "coalesce(RAIL.hours, 0) > 4"}}},
            {"aggregation": {"alias": "S", "group": ["C.trip", "C.city"], "column_mapping": {
                "middle": "median(RAIL.cost)", "any_slow": "bool_or(slow)", "road": "sum(ROAD.cost)", "n": "count(RAIL.cost)"}}},
        ],
        "expressions": {
            "trip": "S.trip",
            "place": "coalesce(S.city, 'nowhere')",
            "middle": "S.middle",
            "pace": "case when S.any_slow then 'slow' else \"quick\" end",
            "road": "S.road",
            "note": "NULL",
            "blank": '""',
            "version": "7",
        },
        "filter_target": ["n >= 1", "middle between 40 and 50"],
    }
    assert rows(run_mapping(tables, mapping, run_month="202501")) == [
        ("t1", "Oslo", 40.0, "quick", 60, None, "", 7),
        ("t2", "Lima", 50.0, "slow", None, None, "", 7),
    ]


def test_pivoted_columns_are_join_keys(readings):
    mapping = {
        "sources": sources(R="reading", L="limit"),
        "transformations": [
            pivot_step(column_mapping={"wet": "max", "dry": "sum"}),
            {"join": {"right_source": "L", "condition": ["L.level = coalesce(P.wet, P.dry)"], "how": "inner"}},
        ],
        "expressions": {"meter": "P.meter", "dry": "P.dry", "word": "L.word"},
    }
    assert rows(run_mapping(readings, mapping)) == [("m1", 2, "high"), ("m2", 7, "fair")]


def test_alias_scoping(parcels):
    joined = {"left_source": "P", "right_source": "D", "condition": ["P.depot = D.depot"]}
    open_scope = {"sources": sources(P="parcel", D="depot"), "transformations": [{"join": joined}]}
    assert rows(integrate(parcels, open_scope).select("P.parcel", "D.town")) == [(70, "Northgate"), (71, None)]
    closed = {**open_scope, "transformations": [{"join": {**joined, "alias": "J"}}]}
    df = integrate(parcels, closed)
    assert rows(df.select("J.town")) == [(None,), ("Northgate",)]
    for gone in ("P.kilos", "J.depot"):  # re-aliased, and ambiguous
        with pytest.raises(AnalysisException):
            df.select(gone).collect()
    # A join without an alias leaves the left alias as it was.
    later = {**open_scope, "transformations": [{"join": joined}, {"union": {"alias": "U", "column_mapping": ["P", "P"]}}]}
    assert integrate(parcels, later).columns == ["parcel", "depot", "kilos", "left_on"]


def test_alias_may_start_with_a_digit(parcels):
    mapping = {"sources": [{"alias": "24HOURS", "source": "depot"}], "expressions": {"x": "24HOURS.town"}}
    assert rows(run_mapping(parcels, mapping)) == [("Northgate",), ("Westhill",)]


def test_target_filter_sees_hidden_columns_and_earlier_targets(parcels):
    mapping = {
        "sources": sources(P="parcel"),
        "expressions": {"next": "P.parcel + 1", "tenfold": "next * 10"},
        "filter_target": ["P.kilos > 5", "tenfold = 710"],
    }
    assert rows(run_mapping(parcels, mapping)) == [(71, 710)]


def test_large_cross_joins_must_be_asked_for(spark, frame, parcels):
    tables = frame_tables({"few": frame([(1,), (2,)], "x int"), "many": spark.range(10_001).withColumnRenamed("id", "y")})
    cross = {"right_source": "M", "how": "cross"}
    mapping = {"sources": sources(F="few", M="many"), "transformations": [{"join": cross}]}
    with pytest.raises(CrossJoinError):
        integrate(tables, mapping)
    cross["all_pairs"] = True
    assert integrate(tables, mapping).count() == 20_002
    cross.update(all_pairs=False, condition=["M.y = F.x"])
    plan = integrate(tables, mapping)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize(
    ("steps", "message"),
    [
        ([{"aggregation": {"alias": "X", "group": ["P.depot"], "column_mapping": {}, "filter": "kilos > 1"}}], "filter"),
        ([{"aggregation": {"group": ["P.depot"], "column_mapping": {"n": "count(*)"}}}], "alias"),
        ([{"shuffle": {}}], "shuffle"),
        ([{"join": {"right_source": "Z", "condition": ["1 = 1"]}}], "Z"),
        ([{"add_variables": {"column_mapping": {"v": "1"}}}, {"add_variables": {"column_mapping": {"v": "2"}}}], "twice"),
    ],
)
def test_faulty_steps_are_refused(parcels, steps, message):
    with pytest.raises(MappingError, match=message):
        integrate(parcels, {"sources": sources(P="parcel"), "transformations": steps})


def test_parameters():
    bound = bind_parameters(
        {"target": "int_{{ RUN_MONTH }}.{{ DELIVERY_ENTITY }}_x", "expressions": {"e": "'{{ DELIVERY_ENTITY }}'"}},
        run_month="202501",
        delivery_entity="Branch-7B",
    )
    assert bound == {"target": "int_202501.branch7b_x", "expressions": {"e": "'Branch-7B'"}}


def test_any_parameter_and_missing_ones():
    assert bind_parameters({"a": ["{{PARAMETER}} {{ run_month }}", 3]}, parameter=5, RUN_MONTH="x") == {"a": ["5 x", 3]}
    with pytest.raises(MappingError, match="RUN_MONTH"):
        bind_parameters("{{ RUN_MONTH }}")


@pytest.mark.parametrize(
    ("how", "expected"),
    [
        ("inner", [(2, 2)]),
        ("left_outer", [(1, None), (2, 2)]),
        ("rightouter", [(None, 3), (2, 2)]),
        ("full_outer", [(None, 3), (1, None), (2, 2)]),
        ("outer", [(None, 3), (1, None), (2, 2)]),
        ("semi", [(2,)]),
        ("leftanti", [(1,)]),
    ],
)
def test_join_kinds(frame, how, expected):
    tables = frame_tables({"a": frame([(1,), (2,)], "x int"), "b": frame([(2,), (3,)], "y int")})
    step = {"right_source": "B", "condition": ["A.x = B.y"], "how": how}
    assert rows(integrate(tables, {"sources": sources(A="a", B="b"), "transformations": [{"join": step}]})) == expected


def test_hyphens_become_underscores(frame):
    tables = frame_tables({"t": frame([(1, 2)], "x int, y int").withColumnsRenamed({"x": "a-b", "y": "c"})})
    source = {"alias": "T", "source": "t", "columns": ["a-b", "c - 1 as d"], "filter": "`a-b` = 1"}
    assert rows(run_mapping(tables, {"sources": [source], "expressions": {"y": "T.a_b", "d": "T.d"}})) == [(1, 1)]
    assert underscore_hyphens(tables("t")).columns == ["a_b", "c"]


YAML_TEXT = """
target: t_{{ RUN_MONTH }}
sources:
  - alias: T
    source: t
    filter: s = 'keep'
transformations:
  - add_variables:
      column_mapping:
        v: case when T.s = "keep" then 1 else 2 end
expressions:
  id: T.id
  v: v
  nothing: null
  text: "Hello World-123_! :)"
  wrapped: "'x'"
  empty: ""
  zero: 0
  month: '{{ RUN_MONTH }}'
"""


def test_mapping_from_yaml(frame):
    pytest.importorskip("yaml")
    tables = frame_tables({"t": frame([(1, "keep"), (2, "no")], "id int, s string")})
    got = run_mapping(tables, load_mapping(YAML_TEXT), run_month="202501")
    assert rows(got) == [(1, 1, None, "Hello World-123_! :)", "x", "", 0, "202501")]


def test_chain(frame):
    tables = frame_tables({"t": frame([(1,), (2,)], "x int")})
    chain = [
        {"target": "s_{{ RUN_MONTH }}", "sources": sources(T="t"), "expressions": {"y": "T.x + 1"}},
        {"target": "e", "sources": [{"alias": "S", "source": "s_{{ RUN_MONTH }}"}], "expressions": {"z": "S.y * 10"}},
    ]
    assert rows(run_chain(tables, chain, run_month="202501")) == [(20,), (30,)]


def test_cross_join_of_a_checked_side(frame):
    tables = frame_tables({"a": frame([(1,), (2,)], "x int"), "b": frame([(3,), (4,)], "y int")})
    step = {"right_source": "B", "how": "cross"}
    mapping = {"sources": sources(A="a", B="b"), "transformations": [{"join": step}]}
    assert integrate(tables, mapping).count() == 4
    step["condition"] = ["A.x + 2 = B.y"]
    assert rows(integrate(tables, mapping)) == [(1, 3), (2, 4)]


def test_window_in_variables(frame):
    tables = frame_tables({"a": frame([(1, 5), (1, 7), (2, 9)], "k int, v int")})
    mapping = {
        "sources": sources(A="a"),
        "transformations": [{"add_variables": {"column_mapping": {
            "lowest": "min(A.v) over (partition by A.k)", "is_lowest": "A.v = lowest"}}}],
        "expressions": {"v": "A.v", "is_lowest": "is_lowest"},
    }
    assert rows(run_mapping(tables, mapping)) == [(5, True), (7, False), (9, True)]


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id as a", "id as b", "id as c").write.parquet(f"{tmp_path}/t.parquet")
    df = run_mapping(
        lambda name: spark.read.parquet(f"{tmp_path}/{name}.parquet"),
        {"sources": [{"alias": "T", "source": "t", "filter": "a > 3"}], "expressions": {"x": "T.b"}},
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,3)" in plan
    assert "ReadSchema: struct<a:bigint,b:bigint>" in plan
    assert df.agg(F.count("*")).first()[0] == 6
