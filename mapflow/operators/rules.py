"""Joining facts to rule tables whose columns may hold a wildcard or several candidates.

``rule.c = fact.c OR rule.c = '*'`` on many columns leaves Spark only a nested loop over facts
and rules. That is the best plan for a handful of rules, whose number is checked. Beyond it the
rules become a discrimination tree: one level for each condition, the most selective first, a
branch for each value asked for and one beside them for the wildcard, down to leaves of a
handful of rules. The distinct combinations of fact values walk down the tree level by level,
each level an equi-join of (node, token), so a combination follows only branches that some rule
still has. At the leaves the few rules are tested, and matches are joined back to the facts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from mapflow.operators import conditions as C
from mapflow.operators.conditions import Condition
from mapflow.operators.joins import cross_bounded
from mapflow.session import durable

WILDCARD = "*"

# Up to this many rules every fact is tested against each rule where it stands.
MAX_LOOP_RULES = 64

# Up to this many rules the levels of the tree are broadcast.
MAX_BROADCAST_RULES = 20_000

JOIN_KINDS = {
    "inner": "inner", "left": "left", "leftouter": "left", "right": "right", "rightouter": "right", "full": "full",
    "outer": "full", "fullouter": "full", "semi": "left_semi", "leftsemi": "left_semi", "anti": "left_anti", "leftanti": "left_anti",
}


class RuleTree:
    """Rules by what they ask for: a level for each condition, leaves of at most ``leaf`` rules.

    A node is named by the tokens on the way to it, each with its length. Equal rules, however
    many, end in one leaf at the last level.
    """

    def __init__(self, rules: DataFrame, conditions: Sequence[Condition], leaf: int = MAX_LOOP_RULES):
        """``rules`` are read several times and keep their numbers, so they are checkpointed."""
        self.conditions = list(conditions)
        numbered = rules.withColumns(C.rule_columns(conditions, rules)).withColumn("_rule", F.monotonically_increasing_id())
        self.rules = durable(numbered)
        asked = self.rules.select("_rule", *[C.asked(conditions, i).alias(f"_t{i}") for i in range(len(conditions))])
        self.order = self._selective_first(asked)
        self.paths = durable(self._paths(asked, leaf))
        ways, depth = self.paths.agg(F.count(F.lit(1)), F.coalesce(F.max("_leaf"), F.lit(0))).first()
        self.depth, self.small = depth, ways <= MAX_BROADCAST_RULES

    def _selective_first(self, asked: DataFrame) -> list[int]:
        """Conditions by the share of the rules that a fact is expected to meet there."""
        every = range(len(self.conditions))
        token = [F.get(f"_t{i}", 0) for i in every]
        stats = asked.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(token[i] == WILDCARD).alias(f"free{i}") for i in every],
            *[F.approx_count_distinct(token[i]).alias(f"kinds{i}") for i in every],
        ).first()
        share = [stats[f"free{i}"] + (stats["n"] - stats[f"free{i}"]) / max(stats[f"kinds{i}"], 1) for i in every]
        return sorted(every, key=share.__getitem__)

    def _paths(self, asked: DataFrame, leaf: int) -> DataFrame:
        """Nodes ``_p0``, ``_p1``, ... and tokens ``_k1``, ... on each rule's ways down, and the level ``_leaf`` where one ends."""
        paths = asked.withColumn("_p0", F.lit(""))
        for n, i in enumerate(self.order, 1):
            paths = paths.withColumn(f"_k{n}", F.explode(f"_t{i}"))
            paths = paths.withColumn(f"_p{n}", F.concat(f"_p{n - 1}", F.length(f"_k{n}").cast("string"), F.lit(":"), f"_k{n}"))
        last = len(self.order)
        names = [x for n in range(last + 1) for x in ([f"_p{n}", f"_k{n}"] if n else ["_p0"])]
        paths = paths.select("_rule", *names)
        on_the_way = paths.select("_rule", f"_p{last}", F.posexplode(F.array(*[f"_p{n}" for n in range(last + 1)])).alias("_level", "_node"))
        crowded = on_the_way.groupBy("_level", "_node").agg(F.count_distinct("_rule").alias("_n")).where(F.col("_n") > leaf)
        ends = (
            on_the_way.join(crowded, ["_level", "_node"], "left_anti")
            .unionByName(paths.select("_rule", f"_p{last}", F.lit(last).alias("_level"), F.col(f"_p{last}").alias("_node")))
            .groupBy("_rule", f"_p{last}")
            .agg(F.min("_level").alias("_leaf"))
        )
        return paths.join(ends, ["_rule", f"_p{last}"])

    def _part(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df

    def walk(self, combinations: DataFrame) -> Iterator[DataFrame]:
        """The combinations at the nodes they have come to, level by level, in the end at leaves.

        ``combinations`` have the columns of `conditions.fact_columns`.
        """
        state = combinations.withColumn("_node", F.lit("")).withColumn("_ended", F.lit(self.depth == 0))
        for n, i in enumerate(self.order[: self.depth], 1):
            branches = self.paths.where(F.col("_leaf") >= n).select(
                F.col(f"_p{n - 1}").alias("_node"), F.col(f"_k{n}").alias("_token"), F.col(f"_p{n}").alias("_next"), (F.col("_leaf") == n).alias("_ends")
            )
            here = F.when(F.col("_ended"), F.array(F.lit(""))).otherwise(C.offered(self.conditions, i))
            offers = state.withColumn("_token", F.explode(here))
            # Who has come to a leaf has no branch and stays there.
            met = offers.join(self._part(branches.distinct()), ["_node", "_token"], "left").where("_ended or _next is not null")
            state = met.withColumns({"_node": F.coalesce("_next", "_node"), "_ended": F.coalesce("_ends", "_ended")}).drop("_token", "_next", "_ends")
            yield state
        if not self.depth:
            yield state

    def matches(self, combinations: DataFrame) -> DataFrame:
        """All (combination, rule) pairs that match, each once, with the rules' columns."""
        *_, state = self.walk(combinations)
        nodes = F.array(*[f"_p{n}" for n in range(len(self.order) + 1)])
        leaves = self.paths.select("_rule", F.get(nodes, F.col("_leaf")).alias("_node")).distinct().join(self.rules, "_rule")
        found = state.join(self._part(leaves), [state["_node"] == leaves["_node"], *C.met(self.conditions)]).drop("_node", "_ended")
        return found.dropDuplicates(["_rule", *combinations.columns]) if C.may_repeat(self.conditions) else found


def combinations_of(facts: DataFrame, conditions: Sequence[Condition]) -> DataFrame:
    """The distinct offers among the facts."""
    return facts.select(*[c.alias(n) for n, c in C.fact_columns(conditions).items()]).distinct()


def _same_offers(names: Sequence[str]) -> list[Column]:
    return [F.col(n).eqNullSafe(F.col(f"_of{n}")) for n in names]


def join_rules(
    facts: DataFrame,
    rules: DataFrame,
    conditions: Sequence[Condition],
    how: str = "left",
    residual: Sequence[str] = (),
    rule_alias: str = "RULES",
    max_loop_rules: int = MAX_LOOP_RULES,
) -> DataFrame:
    """Join facts to rules by analysed conditions; any kind of join but a cross join.

    ``residual`` conditions may name both sides, the rule side as ``rule_alias``.
    """
    kind = JOIN_KINDS[how.lower().replace("_", "")]
    rules = rules.alias(rule_alias)
    offers = C.fact_columns(conditions)
    asked = C.rule_columns(conditions, rules)
    ready = facts.withColumns(offers)
    others = [F.expr(c) for c in residual]
    if kind not in ("right", "full") and rules.limit(max_loop_rules + 1).count() <= max_loop_rules:
        few = rules.withColumns(asked).alias(rule_alias)
        return ready.join(F.broadcast(few), [*C.met(conditions), *others], kind).drop(*offers, *asked)
    tree = RuleTree(rules, conditions)
    matched = tree.matches(combinations_of(facts, conditions))
    matched = matched.withColumnsRenamed({n: f"_of{n}" for n in offers})
    on = [*_same_offers(list(offers)), *others]
    if kind in ("right", "full"):
        if residual:
            # Pairs that no fact confirms would stand for their rules without need.
            matched = matched.alias(rule_alias).join(ready, on, "left_semi")
        missing = tree.rules.join(matched.select("_rule").distinct(), "_rule", "left_anti")
        # A missing rule has no offers of a fact; `_missing` keeps it from facts that offer nothing.
        matched = matched.withColumn("_missing", F.lit(False)).unionByName(
            missing.withColumn("_missing", F.lit(True)), allowMissingColumns=True
        )
        on = [~F.col("_missing"), *on]
    joined = ready.join(matched.alias(rule_alias), on, kind)
    return joined.drop(*offers, *[f"_of{n}" for n in offers], *asked, "_rule", "_missing")


def _conditions(facts: DataFrame, rules: DataFrame, wild: Mapping[str, str] | Sequence[str], alias: str) -> list[Condition]:
    """Conditions of ``{rule column: fact expression}``, or of texts that must all be taken apart."""
    if isinstance(wild, Mapping):
        wild = [f"{alias}.`{rule}` = ({fact}) or {alias}.`{rule}` = '{WILDCARD}'" for rule, fact in wild.items()]
    taken, rest = C.analyse(wild, facts, rules.alias(alias), alias)
    if rest:
        raise ValueError(f"not conditions between a rule and a fact: {rest}")
    return taken


def attach_best_rule(
    facts: DataFrame,
    rules: DataFrame,
    wild: Mapping[str, str] | Sequence[str],
    order: str,
    outputs: Mapping[str, str],
    rule_alias: str = "RULES",
    max_loop_rules: int = MAX_LOOP_RULES,
) -> DataFrame:
    """The matching rule with the lowest ``order`` value, as extra columns.

    ``wild`` maps a rule column to the fact expression it must equal or be a wildcard, or is a
    list of conditions in which the rules are called ``rule_alias``. ``outputs`` maps new names
    to rule columns. A few rules become one CASE over them in order, without any join. More are
    matched once per combination of fact values, so no fact row is multiplied by its matching
    rules.
    """
    conditions = _conditions(facts, rules, wild, rule_alias)
    named = list(wild) if isinstance(wild, Mapping) else []
    used = list(dict.fromkeys([order, *named, *outputs.values()]))
    listed = rules.alias(rule_alias).where(F.col(f"{rule_alias}.{order}").isNotNull())
    # Rules of one order value follow each other by all columns used, on either path.
    texts = [f"_tie{i}" for i in range(len(used))]
    asked = C.rule_columns(conditions, listed)
    listed = listed.withColumns({**asked, **{t: F.col(c).cast("string") for c, t in zip(used, texts, strict=True)}})
    offers = C.fact_columns(conditions)
    ready = facts.withColumns(offers)
    few = listed.select(*dict.fromkeys(used), *asked, *texts).limit(max_loop_rules + 1).collect()
    if len(few) <= max_loop_rules:
        place = lambda r: (r[order], [(r[t] is not None, r[t] or "") for t in texts])
        return _first_rule(ready, rules, sorted(few, key=place), conditions, outputs).drop(*offers)
    first = F.struct(order, *texts)
    best = (
        RuleTree(listed.drop(*asked), conditions)
        .matches(combinations_of(facts, conditions))
        .groupBy(*offers)
        .agg(*[F.min_by(rule, first).alias(new) for new, rule in outputs.items()])
        .withColumnsRenamed({n: f"_of{n}" for n in offers})
    )
    return ready.join(best, _same_offers(list(offers)), "left").drop(*offers, *[f"_of{n}" for n in offers])


def _first_rule(
    facts: DataFrame,
    rules: DataFrame,
    ordered: Sequence[Row],
    conditions: Sequence[Condition],
    outputs: Mapping[str, str],
) -> DataFrame:
    """Outputs of the first of a few ordered rules that matches."""
    tests = []
    for rule in ordered:
        test = F.lit(True)
        for i, condition in enumerate(conditions):
            if not rule[f"_free{i}"]:
                wanted = [
                    F.coalesce(F.col(f"_f{i}_{g}_{a}") == F.lit(rule[f"_r{i}_{g}"]), F.lit(False))
                    for g, group in enumerate(condition.groups) if not group.free
                    for a in range(len(group.offers))
                ]
                test = test & reduce(lambda a, b: a | b, wanted, F.lit(False))
        tests.append(test)
    place = F.coalesce(*[F.when(test, F.lit(i)) for i, test in enumerate(tests)], F.lit(None).cast("int"))
    numbered = facts.withColumn("_rule", place)
    types = {f.name: f.dataType for f in rules.schema}
    found = {}
    for new, column in outputs.items():
        values = F.array(*[F.lit(rule[column]).cast(types[column]) for rule in ordered])
        found[new] = F.get(values, F.col("_rule")) if ordered else F.lit(None).cast(types[column])
    return numbered.withColumns(found).drop("_rule")


def nearest_rules(
    facts: DataFrame,
    rules: DataFrame,
    wild: Mapping[str, str] | Sequence[str],
    rule_id: str,
    top: int = 3,
    rule_alias: str = "RULES",
) -> DataFrame:
    """For each combination of what the facts offer, the ``top`` rules that meet most conditions.

    Columns: ``_f..`` (the combination), ``facts`` (how many have it), ``rule_id``, ``met`` (a
    bit for each condition), ``n_met``, ``place``. Ties go to the smaller ``rule_id``.

    An index (condition, token) -> rules is met by the tokens that are no wildcards, and what a
    pair shares is counted. Rules that share nothing with a combination meet only their free
    conditions, so of them no others than the ``top`` rules with most of these can be among
    the nearest; they are added to every combination.
    """
    conditions = _conditions(facts, rules, wild, rule_alias)
    every = range(len(conditions))
    named = rules.alias(rule_alias).select(
        F.col(f"{rule_alias}.{rule_id}").alias("rule_id"), *[c.alias(n) for n, c in C.rule_columns(conditions, rules.alias(rule_alias)).items()]
    )
    free = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.col(f"_free{i}"), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i in every])
    asked = durable(named.select("rule_id", free.alias("free"), *[C.asked(conditions, i).alias(f"_t{i}") for i in every]))
    offers = list(C.fact_columns(conditions))
    counted = facts.select(*[c.alias(n) for n, c in C.fact_columns(conditions).items()]).groupBy(*offers).agg(F.count(F.lit(1)).alias("facts"))
    combinations = durable(counted.withColumn("_combination", F.monotonically_increasing_id()))

    def tokens(lists: list[Column]) -> Column:
        def numbered(i: int) -> Callable[[Column], Column]:
            return lambda token: F.struct(F.lit(i).alias("i"), token.alias("token"))

        pairs = [F.transform(t, numbered(i)) for i, t in enumerate(lists)]
        return F.explode(F.filter(F.flatten(F.array(*pairs)), lambda p: p["token"] != WILDCARD)).alias("_pair")

    index = asked.select("rule_id", "free", tokens([F.col(f"_t{i}") for i in every]))
    sought = combinations.select("_combination", tokens([C.offered(conditions, i) for i in every]))
    shared = (
        sought.join(index, "_pair")
        .groupBy("_combination", "rule_id", "free")
        .agg(F.bit_or(F.expr("shiftleft(1L, _pair.i)")).alias("bits"))
        .select("_combination", "rule_id", F.col("free").bitwiseOR(F.col("bits")).alias("met"))
    )
    n_free = F.bit_count("free")
    widest = asked.orderBy(F.desc(n_free), "rule_id").limit(top).agg(F.collect_list(F.struct("rule_id", F.col("free").alias("met"))).alias("rules"))
    wide = combinations.select("_combination", F.inline(widest.scalar()))
    candidates = shared.unionByName(wide).groupBy("_combination", "rule_id").agg(F.bit_or("met").alias("met"))
    n_met = F.bit_count("met").cast("int")
    best = Window.partitionBy("_combination").orderBy(n_met.desc(), "rule_id")
    chosen = candidates.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
    return combinations.join(chosen, "_combination").select(*offers, "facts", "rule_id", "met", n_met.alias("n_met"), "place")


def explain_rules(facts: DataFrame, rules: DataFrame, wild: Mapping[str, str], rule_id: str) -> DataFrame:
    """Per fact, rule and rule column: ``MATCH``, ``WILDCARD`` or ``NO_MATCH``, and ``matches`` over all columns.

    Every pair is a row, as a diagnosis asks for: give the facts to be explained. The
    rules are a small table; more than ``MAX_CROSS_ROWS`` of them are refused.
    """
    wanted = rules.select(F.col(rule_id).alias("rule_id"), *[F.col(c).cast("string").alias(f"_rule_{c}") for c in wild])
    pairs = cross_bounded(facts, wanted)
    verdicts = {
        f"{column}_result": F.when(F.col(f"_rule_{column}") == WILDCARD, "WILDCARD")
        .when(F.expr(expression).cast("string") == F.col(f"_rule_{column}"), "MATCH")
        .otherwise("NO_MATCH")
        for column, expression in wild.items()
    }
    failed = [F.col(name) == "NO_MATCH" for name in verdicts]
    matches = ~reduce(lambda a, b: a | b, failed, F.lit(False))
    return pairs.withColumns(verdicts).withColumn("matches", matches).drop(*[f"_rule_{c}" for c in wild])
