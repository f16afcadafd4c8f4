"""Declarative mappings run as DataFrame plans.

A mapping is a dictionary: ``sources`` are scanned lazily, ``transformations``
are applied in order, ``expressions`` make the target, ``filter_target`` and
``drop_duplicates`` finish it. Nothing runs before the result is used, apart from
bounded look-ups that a step documents (pivot values, wildcard masks).
"""

from __future__ import annotations

import logging
import re
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from mapflow.operators.aggregates import pivot_values
from mapflow.operators.joins import cross_bounded
from mapflow.operators.conditions import analyse
from mapflow.operators.rules import attach_best_rule, join_rules
from mapflow.session import stored
from mapflow.sources.tables import Tables, read_source


class MappingError(ValueError):
    """A mapping that cannot be run, with the step that is at fault."""


class StepCounts:
    """Rows after each step of a mapping, counted while the target is written.

    Give one to `run_mapping`, run an action on the target, then ask for ``rows``. The counts
    are Spark's observed metrics: no further job, and no further pass. A step whose rows are
    computed in several places of the plan is counted in one of them. Where nothing reaches a
    step because a later one needs no rows, Spark may leave it out: its count is null.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, list[str], Observation]] = []

    def watch(self, df: DataFrame, step: str, tests: Mapping[str, Column] | None = None) -> DataFrame:
        """The frame with its rows counted under ``step``, for each test those that meet it."""
        counted = tests or {"": F.lit(True)}
        observation = Observation(f"{len(self._seen)} {step}")
        self._seen.append((step, list(counted), observation))
        return df.observe(observation, *[F.count_if(test).alias(f"n{i}") for i, test in enumerate(counted.values())])

    def rows(self) -> list[tuple[int, str, str, int | None]]:
        """Place, step, condition and number of rows, in the order of the mapping; ends with the action."""
        out = []
        for step, tests, observation in self._seen:
            found = observation.get
            out += [(step, test, found.get(f"n{i}")) for i, test in enumerate(tests)]
        return [(place, *row) for place, row in enumerate(out)]


@dataclass
class Flow:
    """Running state: the current frame and every frame that has an alias."""

    current: DataFrame
    named: dict[str, DataFrame]
    variables: set[str] = field(default_factory=set)
    counts: StepCounts | None = None

    def frame(self, alias: str) -> DataFrame:
        if alias not in self.named:
            raise MappingError(f"unknown alias {alias!r}; known: {sorted(self.named)}")
        return self.named[alias]


LOG = logging.getLogger(__name__)
_PLACEHOLDER = re.compile(r"(?P<quote>'?)\{\{\s*(?P<name>\w+)\s*\}\}(?P=quote)")


def bind_parameters(mapping: Any, **parameters: str) -> Any:
    """Fill every ``{{ NAME }}`` of a mapping; names are matched in any case.

    A quoted ``DELIVERY_ENTITY`` keeps the entity as spelled, any other becomes its
    normal form. A placeholder without a value is refused.
    """
    values = {name.upper(): str(value) for name, value in parameters.items()}

    def fill(match: re.Match) -> str:
        name, quote = match["name"].upper(), match["quote"]
        if name not in values:
            raise MappingError(f"no value for the parameter {name}")
        value = values[name]
        if name == "DELIVERY_ENTITY" and not quote:
            value = re.sub("[^a-zA-Z0-9]", "", value).lower()
        return f"{quote}{value}{quote}"

    def bind(part: Any) -> Any:
        if isinstance(part, Mapping):
            return {k: bind(v) for k, v in part.items()}
        if isinstance(part, list | tuple):
            return [bind(v) for v in part]
        return _PLACEHOLDER.sub(fill, part) if isinstance(part, str) else part

    return bind(mapping)


def join_frames(
    flow: Flow,
    right_source: str,
    condition: Sequence[str] = (),
    left_source: str | None = None,
    how: str = "left",
    all_pairs: bool = False,
) -> DataFrame:
    """Join on SQL conditions, all of which must hold.

    A cross join with conditions is an inner join, so that equalities are join keys. One
    without is meant for a small right side; ``all_pairs`` allows any.

    Conditions with alternatives, as rule tables have them (``rule = fact or rule = '*'``), are
    matched by equality, whatever their spelling and the kind of join.
    """
    left = flow.frame(left_source) if left_source else flow.current
    right = flow.frame(right_source)
    conditions = [condition] if isinstance(condition, str) else list(condition)
    if how == "cross":
        if not conditions:
            return cross_bounded(left, right, all_pairs=all_pairs)
        how = "inner"
    if any(re.search(r"\b(or|in)\b", c, re.IGNORECASE) for c in conditions):
        taken, rest = analyse(conditions, left, right, right_source)
        if any(c.has_choice for c in taken):
            return join_rules(left, right, taken, how, rest, right_source)
    return left.join(right, [F.expr(c) for c in conditions], how)


def best_rule(
    flow: Flow,
    right_source: str,
    condition: Sequence[str],
    order: str,
    column_mapping: Mapping[str, str],
    left_source: str | None = None,
) -> DataFrame:
    """Columns of the matching rule with the lowest ``order``; null where no rule matches.

    ``column_mapping`` maps new names to columns of the rules. Rows are not multiplied.
    """
    left = flow.frame(left_source) if left_source else flow.current
    conditions = [condition] if isinstance(condition, str) else list(condition)
    return attach_best_rule(left, flow.frame(right_source), conditions, order, column_mapping, right_source)


def add_variables(flow: Flow, column_mapping: Mapping[str, str]) -> DataFrame:
    """Derived columns; each may use the ones before it.

    Variables that do not need each other share one projection.
    """
    repeated = flow.variables & set(column_mapping)
    if repeated:
        raise MappingError(f"variables defined twice: {sorted(repeated)}")
    flow.variables.update(column_mapping)
    df, layer = flow.current, {}
    for name, expression in column_mapping.items():
        if any(re.search(rf"\b{re.escape(n)}\b", expression) for n in layer):
            df, layer = _add_layer(df, layer), {}
        layer[name] = expression
    return _add_layer(df, layer)


def _add_layer(df: DataFrame, layer: Mapping[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{e} AS {n}" for n, e in layer.items()]) if layer else df


def aggregate(flow: Flow, group: Sequence[str], column_mapping: Mapping[str, str]) -> DataFrame:
    """Named SQL aggregates per group; input qualifiers end here."""
    flow.variables.clear()
    groups = [F.expr(g) for g in ([group] if isinstance(group, str) else group)]
    return flow.current.groupBy(*groups).agg(
        *[F.expr(e).alias(n) for n, e in column_mapping.items()]
    )


def pivot(
    flow: Flow,
    group_cols: Sequence[str],
    pivot_col: str,
    pivot_value_col: str,
    column_mapping: Mapping[str, str] | None = None,
    value_suffix: str | None = None,
) -> DataFrame:
    """One column per value of ``pivot_col``."""
    flow.variables.clear()
    return pivot_values(
        flow.current, group_cols, pivot_col, pivot_value_col, column_mapping, value_suffix
    )


def union(
    flow: Flow,
    column_mapping: Sequence[str | Mapping[str, Mapping[str, str]]] | Mapping,
    allow_missing_columns: bool = False,
) -> DataFrame:
    """Union by name of aliases, each optionally projected by its own map.

    ``column_mapping`` is a list of aliases, a list of one-entry dictionaries
    ``{alias: {column: expression}}``, a mixture, or one dictionary.
    """
    flow.variables.clear()
    if isinstance(column_mapping, Mapping):
        branches = list(column_mapping.items())
    else:
        branches = []
        for entry in column_mapping:
            branches += [(entry, None)] if isinstance(entry, str) else list(entry.items())
    result = None
    for alias, projection in branches:
        frame = flow.frame(alias)
        if projection:
            frame = frame.selectExpr(*[f"{e} AS {n}" for n, e in projection.items()])
        result = (
            frame
            if result is None
            else result.unionByName(frame, allowMissingColumns=allow_missing_columns)
        )
    if result is None:
        raise MappingError("union without branches")
    return result


def filter_rows(
    flow: Flow, conditions: Sequence[str] = (), log_reductions: bool = False
) -> DataFrame:
    """Keep rows that meet all conditions; no conditions keep everything.

    ``log_reductions`` reports the rows left after each condition: with the run, where that
    counts its steps (`StepCounts`), else in the log, by a job of its own (``filter_impact``)
    while the plan is built.
    """
    if log_reductions and conditions and flow.counts:
        left = {c: F.expr(_all_of(conditions[: i + 1])) for i, c in enumerate(conditions)}
        return flow.counts.watch(flow.current, "filter", left).where(_all_of(conditions))
    if log_reductions:
        for row in filter_impact(flow.current, list(conditions)).collect():
            LOG.info("filter: %s", row.asDict())
    return flow.current.where(_all_of(conditions)) if conditions else flow.current


STEPS: dict[str, Callable[..., DataFrame]] = {
    "join": join_frames,
    "best_rule": best_rule,
    "add_variables": add_variables,
    "aggregation": aggregate,
    "pivot": pivot,
    "union": union,
    "filter": filter_rows,
}
NEEDS_ALIAS = {"aggregation", "pivot", "union"}


def apply_step(flow: Flow, step: Mapping[str, Mapping[str, Any]]) -> Flow:
    """Apply one ``{kind: arguments}`` step.

    Arguments every step takes: ``alias`` names the result, ``source`` picks another
    frame to start from.
    """
    (kind, arguments), *more = step.items()
    if more or kind not in STEPS:
        raise MappingError(f"expected one step of {sorted(STEPS)}, got {list(step)}")
    arguments = dict(arguments)
    alias, source = arguments.pop("alias", None), arguments.pop("source", None)
    if kind in NEEDS_ALIAS and not alias:
        raise MappingError(f"step {kind} needs an alias")
    start = source or arguments.get("left_source")
    if start:
        flow = Flow(flow.frame(start), flow.named, counts=flow.counts)
    try:
        result = STEPS[kind](flow, **arguments)
    except TypeError as error:
        if "argument" in str(error):
            raise MappingError(f"step {kind}: {error}") from error
        raise
    if flow.counts:
        result = flow.counts.watch(result, kind)
    named = flow.named
    if alias:
        result = result.alias(alias)
        named = {**named, alias: result}
    return Flow(result, named, flow.variables, flow.counts)


def integrate(tables: Tables, mapping: Mapping[str, Any], counts: StepCounts | None = None) -> DataFrame:
    """Sources and steps of a mapping, before its target expressions."""
    named = {s["alias"]: read_source(tables, **s) for s in mapping["sources"]}
    flow = Flow(next(iter(named.values())), named, counts=counts)
    for step in mapping.get("transformations") or []:
        flow = apply_step(flow, step)
    return flow.current


def to_target(df: DataFrame, mapping: Mapping[str, Any]) -> DataFrame:
    """Target expressions, then filters (which may use hidden columns), then dedup.

    An expression may use a target column defined before it.
    """
    target = df.selectExpr(*[f"{e} AS {n}" for n, e in mapping["expressions"].items()])
    if conditions := mapping.get("filter_target"):
        target = target.where(_all_of(conditions))
    return target.dropDuplicates() if mapping.get("drop_duplicates") else target


def run_mapping(
    tables: Tables, mapping: Mapping[str, Any], counts: StepCounts | None = None, **parameters: str
) -> DataFrame:
    """The target of a mapping as a lazy DataFrame.

    ``parameters`` fill the placeholders, as in ``run_month="202501"``. ``counts`` are filled
    when the target is written.
    """
    bound = bind_parameters(mapping, **parameters)
    target = to_target(integrate(tables, bound, counts), bound)
    return counts.watch(target, "target") if counts else target


def order_chain(mappings: Sequence[Mapping[str, Any]]) -> list[Mapping[str, Any]]:
    """Bound mappings such that each follows those it reads; targets are told apart by name."""
    by_target = {m["target"]: m for m in mappings}
    if len(by_target) < len(mappings):
        raise MappingError("two mappings of a chain have one target")
    graph = {t: {s["source"] for s in m["sources"]} & set(by_target) for t, m in by_target.items()}
    try:
        return [by_target[t] for t in TopologicalSorter(graph).static_order()]
    except CycleError as error:
        raise MappingError(f"mappings read each other: {' <- '.join(error.args[1])}") from error


def _reads(mapping: Mapping[str, Any]) -> Counter:
    """How often a mapping's steps start from or join each of its source tables, once at least."""
    steps = [arguments for step in mapping.get("transformations") or [] for arguments in step.values()]
    used: Counter = Counter()
    if steps and not (steps[0].get("source") or steps[0].get("left_source")):
        used[mapping["sources"][0]["alias"]] += 1
    for arguments in steps:
        used.update({arguments[k] for k in ("source", "left_source") if k in arguments})
        used.update([arguments["right_source"]] if "right_source" in arguments else [])
        branches = arguments.get("column_mapping")
        for entry in branches if isinstance(branches, list | tuple) else ():
            used.update([entry] if isinstance(entry, str) else entry)
    return sum((Counter({s["source"]: max(1, used[s["alias"]])}) for s in mapping["sources"]), Counter())


def run_chain(
    tables: Tables,
    mappings: Sequence[Mapping[str, Any]],
    **parameters: str,
) -> DataFrame:
    """Mappings that feed each other, in any order: a target is a source of others.

    A target that is read more than once is written to the shared folder and computed once; all
    others stay part of their reader's plan. Returns the last listed target that none reads;
    mappings it does not need are not run.
    """
    bound = [bind_parameters(mapping, **parameters) for mapping in mappings]
    if not bound:
        raise MappingError("empty chain")
    ordered = order_chain(bound)
    reads = sum((_reads(m) for m in bound), Counter())
    wanted = [m["target"] for m in bound if not reads[m["target"]]][-1]
    needed = {wanted}
    for mapping in reversed(ordered):
        if mapping["target"] in needed:
            needed.update(s["source"] for s in mapping["sources"])
    reads = sum((_reads(m) for m in ordered if m["target"] in needed), Counter())
    done: dict[str, DataFrame] = {}
    for mapping in (m for m in ordered if m["target"] in needed):
        result = run_mapping(lambda name: done[name] if name in done else tables(name), mapping)
        done[mapping["target"]] = stored(result, "chain") if reads[mapping["target"]] > 1 else result
    return done[wanted]


def filter_impact(df: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """Rows left after 0, 1, 2, ... conditions, all counted in one pass."""
    steps = ["input", *conditions]
    counts = [F.count(F.lit(1)).alias("n0")]
    counts += [
        F.count_if(F.expr(_all_of(conditions[: i + 1]))).alias(f"n{i + 1}")
        for i in range(len(conditions))
    ]
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(s).alias("condition"), F.col(f"n{i}").alias("rows_left"))
            for i, s in enumerate(steps)
        ]
    )
    return df.agg(*counts).select(F.inline(pairs))


def _all_of(conditions: Sequence[str]) -> str:
    """Conjunction in which every condition keeps its own parentheses."""
    return " AND ".join(f"({c})" for c in conditions)
