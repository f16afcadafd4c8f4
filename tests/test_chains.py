"""Chains of mappings as a graph, and row counts that come with a run."""

from __future__ import annotations

import logging

import pytest

from mapflow.plans.mapping import MappingError, StepCounts, order_chain, run_chain, run_mapping
from mapflow.sources.tables import parquet_tables
from tests.conftest import rows


def reading(target, *sources, **more):
    return {
        "target": target,
        "sources": [{"alias": f"S{i}", "source": s} for i, s in enumerate(sources)],
        "transformations": [{"join": {"left_source": "S0", "right_source": f"S{i}", "condition": [f"S0.k = S{i}.k"]}} for i in range(1, len(sources))],
        "expressions": {"k": "S0.k", "v": " + ".join(f"S{i}.v" for i in range(len(sources)))},
        **more,
    }


DIAMOND = [reading("d", "b", "c"), reading("c", "a"), reading("b", "a"), reading("a", "base")]


def test_mappings_are_put_in_order():
    assert [m["target"] for m in order_chain(DIAMOND)][0] == "a"
    assert [m["target"] for m in order_chain(DIAMOND)][-1] == "d"
    with pytest.raises(MappingError, match="read each other"):
        order_chain([reading("x", "y"), reading("y", "z"), reading("z", "x")])
    with pytest.raises(MappingError, match="one target"):
        order_chain([reading("x", "a"), reading("x", "b")])


@pytest.fixture
def tables(spark, frame, tmp_path):
    frame([(1, 10), (2, 20), (3, None)], "k int, v int").write.parquet(f"{tmp_path}/base.parquet")
    return parquet_tables(spark, str(tmp_path))


def test_a_target_with_two_readers_is_computed_once(tables):
    read = []

    def counting(name):
        read.append(name)
        return tables(name)

    result = run_chain(counting, DIAMOND)
    assert read == ["base"]
    assert rows(result) == [(1, 20), (2, 40), (3, None)] or rows(result) == [(3, None), (1, 20), (2, 40)]
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" Relation [") == 2 and "base.parquet" not in result._jdf.queryExecution().executedPlan().toString()


def test_a_target_that_its_reader_uses_twice_is_computed_once(tables):
    twice = {
        "target": "t",
        "sources": [{"alias": "A", "source": "a"}],
        "transformations": [
            {"aggregation": {"alias": "G", "group": ["A.k"], "column_mapping": {"top": "max(A.v)"}}},
            {"join": {"left_source": "A", "right_source": "G", "condition": ["A.k = G.k"]}},
        ],
        "expressions": {"k": "A.k", "top": "G.top"},
    }
    read = []
    result = run_chain(lambda name: read.append(name) or tables(name), [twice, reading("a", "base")])
    assert read == ["base"] and sorted(r["k"] for r in result.collect()) == [1, 2, 3]
    assert "base.parquet" not in result._jdf.queryExecution().executedPlan().toString()


def test_one_reader_stays_in_one_plan_and_unneeded_mappings_are_not_run(tables):
    read = []
    chain = [reading("lone", "absent"), reading("b", "a"), reading("a", "base")]
    result = run_chain(lambda name: read.append(name) or tables(name), chain)
    assert read == ["base"] and result.count() == 3
    assert "Scan parquet" in result._jdf.queryExecution().executedPlan().toString()


MAPPING = {
    "sources": [{"alias": "B", "source": "base"}],
    "transformations": [
        {"filter": {"conditions": ["B.k < 3", "B.v > 10"], "log_reductions": True}},
        {"join": {"left_source": "B", "right_source": "B2", "how": "inner", "condition": ["B.k = B2.k"]}},
        {"add_variables": {"column_mapping": {"double": "B.v * 2"}}},
    ],
    "expressions": {"k": "B.k", "double": "double"},
    "filter_target": ["double > 20"],
}


def test_counts_come_with_the_write(spark, tables, tmp_path, caplog):
    mapping = {**MAPPING, "sources": [*MAPPING["sources"], {"alias": "B2", "source": "base"}]}
    mapping["transformations"] = [MAPPING["transformations"][0], {"add_variables": {"column_mapping": {"double": "B.v * 2"}}}]
    counts = StepCounts()
    with caplog.at_level(logging.INFO):
        target = run_mapping(tables, mapping, counts)
    assert not caplog.records
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "one write")
    target.write.parquet(f"{tmp_path}/out")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts.rows() == [
        (0, "filter", "B.k < 3", 2), (1, "filter", "B.v > 10", 1), (2, "filter", "", 1), (3, "add_variables", "", 1), (4, "target", "", 1),
    ]
    assert len(tracker.getJobIdsForGroup("counted")) == 1


def test_without_counts_reductions_are_logged(tables, caplog):
    mapping = {**MAPPING, "transformations": MAPPING["transformations"][:1], "expressions": {"k": "B.k"}, "filter_target": []}
    with caplog.at_level(logging.INFO):
        run_mapping(tables, mapping)
    assert [r.args["rows_left"] for r in caplog.records if isinstance(r.args, dict)] == [3, 2, 1]
