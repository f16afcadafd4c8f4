"""Join conditions taken apart by operand: what a rule asks for, and what a fact offers.

A condition is a disjunction. Each disjunct asks for equalities between a rule's and a fact's
expression, perhaps under a guard on either side; a disjunct without equalities and without a
guard on the fact (``R.x = '*'``) makes the condition hold for any fact. So a condition holds
exactly if a token that the rule asks for is among those that the fact offers, and joins on
tokens are joins by equality.

How a condition is spelled does not matter: sides in any order, ``in`` lists, nested
parentheses, functions of one side, several candidates. Which side an expression belongs to is
what Spark's analyzer says. Conditions that mix both sides otherwise are returned as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Disjuncts of one condition after multiplying out; a condition with more is left whole.
MAX_DISJUNCTS = 64

_LEXEME = re.compile(
    r"--[^\n]*|\s+|'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`(?:\.`[^`]*`)*|[\w.]+|<=>|<>|!=|<=|>=|==|\|\||.", re.DOTALL
)
_COMPARE = {"=", "==", "<=>", "<>", "!=", "<", ">", "<=", ">=", "not", "like", "rlike", "ilike", "in", "is", "between", "exists"}
#: Words beside qualified names that are no columns.
_WORDS = {"case", "when", "then", "else", "end", "and", "or", "not", "is", "null", "true", "false", "in", "as", "cast", "string", "int", "upper",
          "lower", "trim", "ltrim", "rtrim", "coalesce", "substr", "substring", "concat", "nvl", "left", "right", "like"}
_TEXT = re.compile(r"'((?:[^'\\])*)'")

Lexemes = list[str]
#: One comparison: two sides that must be equal, or one text that must hold.
Atom = tuple[str, ...]


def _lexemes(text: str) -> Lexemes:
    return [x for x in _LEXEME.findall(text) if x.strip() and not x.startswith("--")]


def _split(part: Lexemes, words: set[str]) -> list[Lexemes]:
    """Cut at words that stand outside parentheses and CASE expressions."""
    out: list[Lexemes] = [[]]
    depth = 0
    for x in part:
        low = x.lower()
        depth += (low in ("(", "[", "case")) - (low in (")", "]", "end"))
        if depth == 0 and low in words:
            out.append([])
        else:
            out[-1].append(x)
    return out


def _unwrapped(part: Lexemes) -> Lexemes:
    """Without parentheses around the whole."""
    while len(part) > 1 and part[0] == "(" and part[-1] == ")":
        depth = 0
        for x in part[:-1]:
            depth += (x == "(") - (x == ")")
            if depth == 0:
                return part
        part = part[1:-1]
    return part


def _outside(part: Lexemes) -> Lexemes:
    """Comparing words outside parentheses and CASE expressions."""
    depth, out = 0, []
    for x in part:
        low = x.lower()
        depth += (low in ("(", "[", "case")) - (low in (")", "]", "end"))
        if depth == 0 and low in _COMPARE:
            out.append(low)
    return out


def _disjuncts(part: Lexemes) -> list[list[Atom]]:
    """Alternatives, each a list of comparisons that must all hold."""
    part = _unwrapped(part)
    if "between" in _outside(part):
        return [[(" ".join(part),)]]
    either = _split(part, {"or"})
    if len(either) > 1:
        return [d for e in either for d in _disjuncts(e)]
    both = _split(part, {"and"})
    if len(both) > 1:
        parts = [_disjuncts(b) for b in both]
        size = 1
        for p in parts:
            size *= len(p)
        if size > MAX_DISJUNCTS:
            return [[(" ".join(part),)]]
        return [[atom for d in chosen for atom in d] for chosen in product(*parts)]
    compare = _outside(part)
    if compare in (["="], ["=="]):
        left, right = _split(part, {"=", "=="})
        if left and right:
            return [[(" ".join(_unwrapped(left)), " ".join(_unwrapped(right)))]]
    if compare == ["in"]:
        left, right = _split(part, {"in"})
        listed = _split(_unwrapped(right), {","})
        if left and right and right[0] == "(" and right[1].lower() != "select" and all(listed):
            return [[(" ".join(left), " ".join(x))] for x in listed]
    return [[(" ".join(part),)]]


def conjuncts(condition: str) -> list[str]:
    """Conditions that must all hold, as one text each."""
    part = _unwrapped(_lexemes(condition))
    if "between" in _outside(part) or len(_split(part, {"or"})) > 1:
        return [condition]
    both = _split(part, {"and"})
    return [c for b in both for c in conjuncts(" ".join(b))] if len(both) > 1 else [condition]


@dataclass
class Group:
    """Disjuncts with one rule side: its guards, its keys, and what facts may offer for them."""

    guards: list[str]
    keys: list[str]
    types: list[T.DataType]
    #: Guards and keys of the fact side, one pair for each candidate.
    offers: list[tuple[list[str], list[str]]] = field(default_factory=list)

    @property
    def free(self) -> bool:
        return not self.keys and any(not guards for guards, _ in self.offers)


@dataclass
class Condition:
    """A condition as groups; ``text`` is how it was written."""

    text: str
    groups: list[Group]

    @property
    def has_choice(self) -> bool:
        """Whether it is more than one plain equality, which Spark joins by itself."""
        return len(self.groups) > 1 or len(self.groups[0].offers) > 1


class _Sides:
    """Which of two frames an expression can be computed from."""

    def __init__(self, facts: DataFrame, rules: DataFrame, rule_alias: str | None):
        self.rule_alias = rule_alias.lower() if rule_alias else None
        # What can be computed from no column at all is a constant.
        self.frames = {"fact": facts, "rule": rules, "none": facts.select()}
        self.known: dict[str, tuple[str, dict[str, T.DataType]]] = {}

    def _possible(self, text: str) -> list[tuple[str, DataFrame]]:
        """Frames to try; only one where every name says by its qualifier whose it is."""
        names = {x.lower() for x in _lexemes(text) if re.match(r"[a-z_`]", x, re.IGNORECASE)}
        qualified = {n for n in names if "." in n}
        if self.rule_alias and qualified and names - qualified <= _WORDS:
            of_rules = {n.replace("`", "").startswith(f"{self.rule_alias}.") for n in qualified}
            if len(of_rules) == 1:
                side = "rule" if of_rules.pop() else "fact"
                return [(side, self.frames[side])]
        return list(self.frames.items())

    def of(self, text: str) -> tuple[str, dict[str, T.DataType]]:
        if text not in self.known:
            types = {}
            for side, df in self._possible(text):
                try:
                    types[side] = df.select(F.expr(text).alias("x")).schema["x"].dataType
                except AnalysisException:
                    continue
            kind = "constant" if "none" in types else next(iter(types)) if len(types) == 1 else "mixed"
            self.known[text] = kind, types
        return self.known[text]


def _rule_test(left: str, right: str) -> str:
    """An equality on the rule's side alone; texts are compared as text, so `*` fits any column."""
    for one, other in ((left, right), (right, left)):
        if _TEXT.fullmatch(other):
            return f"cast({one} as string) = {other}"
    return f"{left} = {right}"


def _grouped(text: str, sides: _Sides) -> Condition | None:
    groups: dict[tuple, Group] = {}
    found = _disjuncts(_lexemes(text))
    for disjunct in found:
        rule_guards, fact_guards, keys = [], [], []
        for atom in disjunct:
            kinds = [sides.of(x)[0] for x in atom]
            if len(atom) == 2 and set(kinds) == {"rule", "fact"}:
                rule, fact = atom if kinds[0] == "rule" else atom[::-1]
                keys.append((rule, fact, sides.of(rule)[1]["rule"], sides.of(fact)[1]["fact"]))
            elif "mixed" in kinds or set(kinds) == {"rule", "fact"}:
                return None
            elif "fact" in kinds:
                fact_guards.append(" = ".join(f"({x})" for x in atom))
            else:
                rule_guards.append(_rule_test(*atom) if len(atom) == 2 else atom[0])
        if len(found) == 1 and any(a != b for _, _, a, b in keys):
            return None  # a plain equality of two types follows Spark's rules
        name = tuple(sorted(rule_guards)), tuple((k[0], k[3].simpleString()) for k in keys)
        group = groups.setdefault(name, Group(rule_guards, [k[0] for k in keys], [k[3] for k in keys]))
        offer = fact_guards, [k[1] for k in keys]
        if offer not in group.offers:
            group.offers.append(offer)
    listed = list(groups.values())
    return Condition(text, listed) if any(g.keys or not g.free for g in listed) else None


def analyse(
    conditions: Sequence[str], facts: DataFrame, rules: DataFrame, rule_alias: str | None = None
) -> tuple[list[Condition], list[str]]:
    """Conditions that can be met by tokens, and the rest as written.

    Both frames must resolve the names as they are qualified in the conditions. What is known
    as ``rule_alias`` belongs to the rules alone, which spares most of the analyzer's trials.
    """
    sides = _Sides(facts, rules, rule_alias)
    taken, rest = [], []
    for text in [c for condition in conditions for c in conjuncts(condition)]:
        condition = _grouped(text, sides)
        if condition is None:
            rest.append(text)
        else:
            taken.append(condition)
    return taken, rest


def _held(guards: Sequence[str]) -> Column:
    test = F.lit(True)
    for guard in guards:
        test = test & F.expr(guard)
    return F.coalesce(test, F.lit(False))


def _joined(values: list[Column]) -> Column:
    """One text for several values, null if one is."""
    if len(values) == 1:
        return values[0]
    return F.concat(*[x for v in values for x in (F.length(v).cast("string"), F.lit(":"), v)]) if values else F.lit("")


def _as_fact_text(value: Column, rule_type: T.DataType, fact_type: T.DataType) -> Column:
    """Text of a rule value as the fact would print it, so that '01' meets the number 1."""
    if isinstance(fact_type, T.StringType) or rule_type == fact_type:
        return value.cast("string")
    return value.try_cast(fact_type).cast("string")


def fact_columns(conditions: Sequence[Condition]) -> dict[str, Column]:
    """What a fact offers: a column ``_f{condition}_{group}_{candidate}`` each, null for nothing."""
    out = {}
    for i, g, group in _numbered(conditions):
        for a, (guards, keys) in enumerate(group.offers):
            value = _joined([F.expr(k).cast("string") for k in keys])
            out[f"_f{i}_{g}_{a}"] = F.when(_held(guards), value) if guards else value
    return out


def rule_columns(conditions: Sequence[Condition], rules: DataFrame) -> dict[str, Column]:
    """What a rule asks for: ``_r{condition}_{group}``, null for nothing, and ``_free{condition}``."""
    out = {}
    for i, condition in enumerate(conditions):
        out[f"_free{i}"] = F.lit(False)
        for group in condition.groups:
            if group.free:
                out[f"_free{i}"] = out[f"_free{i}"] | _held(group.guards)
    for i, g, group in _numbered(conditions):
        types = [f.dataType for f in rules.select(*[F.expr(k) for k in group.keys]).schema]
        value = _joined([_as_fact_text(F.expr(k), r, t) for k, r, t in zip(group.keys, types, group.types, strict=True)])
        out[f"_r{i}_{g}"] = F.when(_held(group.guards), value) if group.guards else value
    return out


def _numbered(conditions: Sequence[Condition]) -> Iterator[tuple[int, int, Group]]:
    for i, condition in enumerate(conditions):
        for g, group in enumerate(condition.groups):
            if not group.free:
                yield i, g, group


def met(conditions: Sequence[Condition]) -> list[Column]:
    """One test for each condition, over the columns of both sides."""
    tests = [F.col(f"_free{i}") for i in range(len(conditions))]
    for i, g, group in _numbered(conditions):
        for a in range(len(group.offers)):
            tests[i] = tests[i] | F.coalesce(F.col(f"_r{i}_{g}") == F.col(f"_f{i}_{g}_{a}"), F.lit(False))
    return tests


def offered(conditions: Sequence[Condition], i: int) -> Column:
    """Tokens of a fact for condition ``i``: one that always fits, and one for each candidate."""
    tokens = [
        F.concat(F.lit(f"{g}:"), F.col(f"_f{i}_{g}_{a}"))
        for n, g, group in _numbered(conditions) if n == i
        for a in range(len(group.offers))
    ]
    return F.array_distinct(F.array_compact(F.array(F.lit("*"), *tokens)))


def asked(conditions: Sequence[Condition], i: int) -> Column:
    """Tokens of a rule for condition ``i``; only the one that always fits, where that is asked for."""
    tokens = [F.concat(F.lit(f"{g}:"), F.col(f"_r{i}_{g}")) for n, g, _ in _numbered(conditions) if n == i]
    return F.when(F.col(f"_free{i}"), F.array(F.lit("*"))).otherwise(F.array_distinct(F.array_compact(F.array(*tokens))))


def may_repeat(conditions: Sequence[Condition]) -> bool:
    """Whether a rule can be met in several ways by one fact."""
    return any(sum(not g.free for g in c.groups) > 1 for c in conditions)
