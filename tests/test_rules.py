"""Rule joins: conditions by operand, the discrimination tree, best and nearest rules."""

from __future__ import annotations

import random

import pytest

from mapflow.operators import conditions as C
from mapflow.operators.rules import RuleTree, attach_best_rule, combinations_of, join_rules, nearest_rules
from mapflow.plans.mapping import run_mapping
from mapflow.sources.tables import frame_tables
from tests.conftest import rows

VALUES = ["a", "b", "c", None, "*"]


def rule_case(seed, n_rules):
    pick = random.Random(seed)
    facts = [(i, pick.choice(VALUES), pick.choice(VALUES), pick.randrange(3)) for i in range(80)]
    rules = [
        (i, pick.choice(["a", "b", "*", None]), pick.choice(["a", "c", "*"]), pick.choice(["0", "01", "x", "*"]), pick.randrange(60))
        for i in range(n_rules)
    ]
    matches = [
        (f, r)
        for f in facts
        for r in rules
        if all(r[j] == "*" or (None not in (r[j], f[j]) and r[j].lstrip("0") == str(f[j]).lstrip("0")) for j in (1, 2, 3))
    ]
    return facts, rules, matches


FACT = "id int, p string, q string, s int"
RULE = "rule int, x string, y string, z string, lowest int"
WILD = {"x": "F.p", "y": "F.q", "z": "F.s"}
PLAIN = ["R.x = F.p or R.x = '*'", "R.y = F.q or R.y = '*'", "R.z = F.s or R.z = '*'"]


def expected_join(facts, rules, pairs, how):
    """Pairs of fact and rule number as each kind of join returns them."""
    met_facts, met_rules = {f for f, _ in pairs}, {r for _, r in pairs}
    lone_facts = [(f[0], None) for f in facts if f[0] not in met_facts]
    lone_rules = [(None, r[0]) for r in rules if r[0] not in met_rules]
    return {
        "inner": pairs,
        "left": pairs + lone_facts,
        "right": pairs + lone_rules,
        "full": pairs + lone_facts + lone_rules,
        "left_semi": [(f[0],) for f in facts if f[0] in met_facts],
        "left_anti": [(f[0],) for f in facts if f[0] not in met_facts],
    }[how]


KINDS = ["inner", "left", "right", "full", "left_semi", "left_anti"]


CASES = [(k, 0, r) for k in KINDS for r in ([], ["F.id >= R.lowest"])] + [("left", 64, ["F.id >= R.lowest"]), ("left_anti", 64, [])]


@pytest.mark.parametrize(("how", "loop", "residual"), CASES)
def test_every_kind_of_join(frame, how, loop, residual):
    facts, rules, matches = rule_case(1, 25)
    left, right = frame(facts, FACT).alias("F"), frame(rules, RULE).alias("R")
    taken, rest = C.analyse(PLAIN + residual, left, right)
    assert rest == residual
    got = join_rules(left, right, taken, how, rest, "R", max_loop_rules=loop)
    pairs = [(f[0], r[0]) for f, r in matches if not residual or f[0] >= r[4]]
    names = ["F.id"] if how in ("left_semi", "left_anti") else ["F.id", "R.rule"]
    assert sorted(map(str, rows(got.select(*names)))) == sorted(map(str, expected_join(facts, rules, pairs, how)))
    assert len(got.columns) == (4 if len(names) == 1 else 9)


def text(v):
    return None if v is None else str(v)


#: Conditions beside a meaning in Python: of a fact (p, q, s) and a rule (x, y, z).
FORMS = {
    "turned": ("F.p = R.x or R.x = '*'", lambda f, r: r[1] == "*" or (None not in (f[1], r[1]) and f[1] == r[1])),
    "wildcard first": ("'*' = R.x OR (R.x = F.p)", lambda f, r: r[1] == "*" or (None not in (f[1], r[1]) and f[1] == r[1])),
    "in list": ("R.x in (F.p, '*')", lambda f, r: r[1] == "*" or (None not in (f[1], r[1]) and f[1] == r[1])),
    "two candidates": ("R.x = F.p or R.x = F.q or R.x = '*'", lambda f, r: r[1] == "*" or (r[1] is not None and r[1] in (f[1], f[2]))),
    "functions": (
        "upper(R.x) = upper(coalesce(F.p, F.q)) or R.x = '*'",
        lambda f, r: r[1] == "*" or (r[1] is not None and (f[1] or f[2]) is not None and (f[1] or f[2]) == r[1]),
    ),
    "composite": (
        "(concat(R.x, R.y) = concat(F.p, F.q)) or (R.z = 'x' and R.y = F.q) or (R.x = '*')",
        lambda f, r: r[1] == "*"
        or (None not in (r[1], r[2], f[1], f[2]) and r[1] + r[2] == f[1] + f[2])
        or (r[3] == "x" and f[2] is not None and r[2] == f[2]),
    ),
    "case": (
        "R.x = case when F.s = 0 then 'a' when F.s = 1 or F.p = 'b' then 'b' end or R.x = '*'",
        lambda f, r: r[1] == "*" or r[1] == ("a" if f[3] == 0 else "b" if f[3] == 1 or f[1] == "b" else "?"),
    ),
    "guard on the fact": ("F.s = 2 or R.x = F.p", lambda f, r: f[3] == 2 or (f[1] is not None and f[1] == r[1])),
    "and of ors": (
        "(R.x = F.p or R.x = '*') and (R.y = F.q or R.y = '*')",
        lambda f, r: (r[1] == "*" or (f[1] is not None and f[1] == r[1])) and (r[2] == "*" or (f[2] is not None and f[2] == r[2])),
    ),
    "keys together": (
        "(R.x = F.p and R.y = F.q) or (R.x = '*' and R.y = '*')",
        lambda f, r: (r[1] == "*" and r[2] == "*") or (None not in (f[1], f[2]) and (r[1], r[2]) == (f[1], f[2])),
    ),
}


@pytest.mark.parametrize(("form", "how"), [(f, KINDS[i % 6]) for i, f in enumerate(FORMS)] + [("composite", "full"), ("two candidates", "inner")])
def test_every_spelling_without_nested_loop(frame, form, how):
    condition, meaning = FORMS[form]
    facts, rules, _ = rule_case(7, 200)
    tables = frame_tables({"facts": frame(facts, FACT), "rules": frame(rules, RULE)})
    single = how in ("left_semi", "left_anti")
    mapping = {
        "sources": [{"alias": "F", "source": "facts"}, {"alias": "R", "source": "rules"}],
        "transformations": [{"join": {"right_source": "R", "how": how, "condition": [condition]}}],
        "expressions": {"id": "F.id"} if single else {"id": "F.id", "rule": "R.rule"},
    }
    got = run_mapping(tables, mapping)
    pairs = [(f[0], r[0]) for f in facts for r in rules if meaning(f, r)]
    assert sorted(map(str, rows(got))) == sorted(map(str, expected_join(facts, rules, pairs, how)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_what_cannot_be_taken_apart_stays_as_written(frame):
    left, right = frame([], FACT).alias("F"), frame([], RULE).alias("R")
    rest = [
        "R.x = R.y or R.x = '*'",
        "R.x < F.p or R.x = '*'",
        "R.x between F.p and F.q or R.x = '*'",
        "R.x = F.p = true or R.x = '*'",
        "R.lowest = F.p",
        "not (R.x = F.p) or R.x = '*'",
    ]
    taken, left_over = C.analyse([*rest, "F.p = R.x", "R.lowest = F.s"], left, right)
    assert left_over == rest
    assert [c.text for c in taken] == ["F.p = R.x", "R.lowest = F.s"] and not any(c.has_choice for c in taken)


def test_unclear_names_are_left_to_spark(frame):
    left, right = frame([], "id int, x string").alias("F"), frame([], "x string, y string").alias("R")
    assert C.analyse(["x = F.x or R.y = '*'"], left, right) == ([], ["x = F.x or R.y = '*'"])


def test_rows_at_the_nodes_stay_few(frame):
    """Twelve rule columns in a thousand masks: rows below matches + combinations x columns."""
    pick = random.Random(3)
    width, n_rules, n_facts = 12, 1000, 300
    names = [f"c{i}" for i in range(width)]
    rules, seen = [], set()
    while len(rules) < n_rules:
        mask = tuple(pick.random() < 0.4 for _ in names)
        if mask not in seen:
            seen.add(mask)
            rules.append((len(rules), *["*" if m else f"v{pick.randrange(30)}" for m in mask]))
    facts = [(i, *[f"v{pick.randrange(30)}" for _ in names]) for i in range(n_facts - 30)]
    for i in range(n_facts - 30, n_facts):  # some facts that rules do match
        facts.append((i, *[v if v != "*" else f"v{pick.randrange(30)}" for v in pick.choice(rules)[1:]]))
    left = frame(facts, "id int, " + ", ".join(f"{n} string" for n in names)).alias("F")
    right = frame(rules, "rule int, " + ", ".join(f"{n} string" for n in names)).alias("R")
    taken, _ = C.analyse([f"R.{n} = F.{n} or R.{n} = '*'" for n in names], left, right)
    combinations = combinations_of(left, taken)
    tree = RuleTree(right, taken)
    states = list(tree.walk(combinations))
    # Each combination once at each node it comes to; at a leaf it stays.
    at_nodes = sum(state.where("not _ended").count() for state in states) + states[-1].where("_ended").count()
    matches = sum(all(r == "*" or r == f for f, r in zip(fact[1:], rule[1:], strict=True)) for fact in facts for rule in rules)
    assert tree.matches(combinations).count() == matches
    assert at_nodes <= matches + combinations.count() * width


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_equality_beside_wildcards(frame, kind):
    """In one type it is a level of the tree, in two Spark's own comparison decides."""
    facts, rules, matches = rule_case(4, 100)
    left = frame(facts, FACT).alias("F")
    right = frame(rules, RULE.replace("lowest int", f"lowest {kind}")).alias("R")
    taken, rest = C.analyse([*PLAIN, "R.lowest = F.id"], left, right)
    assert len(rest) == (kind == "bigint")
    got = join_rules(left, right, taken, "left", rest, "R")
    expected = expected_join(facts, rules, [(f[0], r[0]) for f, r in matches if f[0] == r[4]], "left")
    assert sorted(map(str, rows(got.select("F.id", "R.rule")))) == sorted(map(str, expected))


@pytest.mark.parametrize(("n_rules", "loop"), [(0, 0), (1, 0), (25, 0), (25, 64)])
@pytest.mark.parametrize("wild", [WILD, [c.replace("R.", "RULES.") for c in PLAIN]])
def test_best_rule(frame, n_rules, loop, wild):
    facts, rules, matches = rule_case(3, n_rules)
    outputs = {"best": "rule", "best_lowest": "lowest"}
    got = attach_best_rule(frame(facts, FACT).alias("F"), frame(rules, RULE), wild, "rule", outputs, max_loop_rules=loop)
    best = {f[0]: None for f in facts}
    for f, r in matches:
        best[f[0]] = r[0] if best[f[0]] is None else min(best[f[0]], r[0])
    lowest = {r[0]: r[4] for r in rules}
    assert {r["id"]: (r["best"], r["best_lowest"]) for r in got.collect()} == {k: (v, lowest.get(v)) for k, v in best.items()}
    assert got.columns == ["id", "p", "q", "s", "best", "best_lowest"]


@pytest.mark.parametrize("loop", [0, 64])
def test_rules_of_one_order_value_have_one_order(frame, loop):
    facts = frame([(1, "a")], "id int, p string").alias("F")
    rules = frame([(5, "*", "late"), (5, "a", "early"), (5, "*", "first"), (5, None, "none")], "place int, x string, name string")
    got = attach_best_rule(facts, rules, {"x": "F.p"}, "place", {"best": "name"}, max_loop_rules=loop)
    assert [r["best"] for r in got.collect()] == ["first"]


def test_best_rule_refuses_other_conditions(frame):
    with pytest.raises(ValueError, match="not conditions"):
        attach_best_rule(frame([], FACT).alias("F"), frame([], RULE), ["RULES.x < F.p"], "rule", {"b": "rule"})


@pytest.mark.parametrize(("top", "n_rules"), [(3, 0), (3, 2), (1, 40), (50, 40)])
def test_nearest_rules(frame, top, n_rules):
    facts, rules, _ = rule_case(9, n_rules)
    got = nearest_rules(frame(facts, FACT).alias("F"), frame(rules, RULE), WILD, "rule", top)

    def bits(f, r):
        same = [r[j] == "*" or (None not in (r[j], f[j]) and r[j].lstrip("0") == str(f[j]).lstrip("0")) for j in (1, 2, 3)]
        return sum(s << i for i, s in enumerate(same))

    groups = {}
    for f in facts:
        groups.setdefault((f[1], f[2], text(f[3])), []).append(f)
    expected = []
    for key, members in groups.items():
        near = sorted(((-bits(members[0], r).bit_count(), r[0], bits(members[0], r)) for r in rules))[:top]
        expected += [(*key, len(members), rule, met, -n, place) for place, (n, rule, met) in enumerate(near, 1)]
    assert sorted(map(str, rows(got))) == sorted(map(str, expected))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
