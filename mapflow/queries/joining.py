"""Joins, look-ups, rule tables and hierarchies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.functions.amounts import exact_sum, hundredths
from mapflow.functions.columns import same_text
from mapflow.operators.hierarchy import roll_up
from mapflow.operators.joins import join_contains, with_flag, with_lookup_max
from mapflow.operators.links import propagate_over_links
from mapflow.operators.rules import attach_best_rule
from mapflow.plans.mapping import run_mapping
from mapflow.queries.registry import query
from mapflow.sources.tables import Tables, frame_tables, local_rows


def join_mapping(left: tuple, right: tuple, conditions: list[str], how: str | None, outputs: dict) -> dict:
    """Mapping with one join; a side is (alias, table, filter)."""
    step = {"right_source": right[0], "left_source": left[0], "condition": conditions}
    if how:
        step["how"] = how
    sources = [
        {"alias": alias, "source": table, **({"filter": condition} if condition else {})}
        for alias, table, condition in (left, right)
    ]
    return {"sources": sources, "transformations": [{"join": step}], "expressions": outputs}


@query(
    "join_left_multi",
    """SELECT l_orderkey, l_linenumber, cast(o_custkey AS varchar) AS party, o_totalprice FROM lineitem
       LEFT JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus""",
)
def join_left_multi(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        join_mapping(
            ("L", "lineitem", None),
            ("O", "orders", None),
            ["L.l_orderkey = O.o_orderkey", "L.l_linestatus = O.o_orderstatus"],
            None,
            {"l_orderkey": "L.l_orderkey", "l_linenumber": "L.l_linenumber",
             "party": "cast(O.o_custkey as string)", "o_totalprice": "O.o_totalprice"},
        ),
    )


@query(
    "join_inner",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE c_acctbal > 0""",
)
def join_inner(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        join_mapping(
            ("O", "orders", None),
            ("C", "customer", "c_acctbal > 0"),
            ["O.o_custkey = C.c_custkey"],
            "inner",
            {"o_orderkey": "O.o_orderkey", "c_name": "C.c_name", "c_mktsegment": "C.c_mktsegment"},
        ),
    )


@query(
    "join_right",
    """SELECT c_custkey, cast(o_orderkey AS varchar) AS order_id FROM (SELECT * FROM orders WHERE o_totalprice > 450000)
       RIGHT JOIN customer ON o_custkey = c_custkey""",
)
def join_right(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        join_mapping(
            ("O", "orders", "o_totalprice > 450000"),
            ("C", "customer", None),
            ["O.o_custkey = C.c_custkey"],
            "right_outer",
            {"c_custkey": "C.c_custkey", "order_id": "cast(O.o_orderkey as string)"},
        ),
    )


@query(
    "join_full",
    """SELECT coalesce(c_custkey, s_suppkey) AS id, CASE WHEN s_suppkey IS NULL THEN 'C' WHEN c_custkey IS NULL THEN 'S' ELSE 'B' END AS side
       FROM (SELECT * FROM customer WHERE c_acctbal > 0) FULL JOIN (SELECT * FROM supplier WHERE s_acctbal > 2000)
       ON c_custkey = s_suppkey""",
)
def join_full(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        join_mapping(
            ("C", "customer", "c_acctbal > 0"),
            ("S", "supplier", "s_acctbal > 2000"),
            ["C.c_custkey = S.s_suppkey"],
            "full",
            {"id": "coalesce(C.c_custkey, S.s_suppkey)",
             "side": "case when S.s_suppkey is null then 'C' when C.c_custkey is null then 'S' else 'B' end"},
        ),
    )


@query(
    "join_semi",
    """SELECT c_custkey, c_name FROM customer WHERE EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def join_semi(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        join_mapping(
            ("C", "customer", None),
            ("O", "orders", "o_totalprice > 400000"),
            ["C.c_custkey = O.o_custkey"],
            "left_semi",
            {"c_custkey": "C.c_custkey", "c_name": "C.c_name"},
        ),
    )


@query(
    "join_anti",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def join_anti(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        join_mapping(
            ("C", "customer", None),
            ("O", "orders", "o_totalprice > 400000"),
            ["C.c_custkey = O.o_custkey"],
            "left_anti",
            {"c_custkey": "C.c_custkey", "c_name": "C.c_name"},
        ),
    )


@query(
    "join_cross",
    """SELECT c_custkey, r_name, CASE WHEN n_regionkey = r_regionkey THEN 1 ELSE 0 END AS is_home
       FROM customer JOIN nation ON c_nationkey = n_nationkey CROSS JOIN region""",
)
def join_cross(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "C", "source": "customer"},
                {"alias": "N", "source": "nation"},
                {"alias": "R", "source": "region"},
            ],
            "transformations": [
                {"join": {"left_source": "C", "right_source": "N", "how": "inner",
                          "condition": ["C.c_nationkey = N.n_nationkey"]}},
                {"join": {"right_source": "R", "how": "cross"}},
            ],
            "expressions": {
                "c_custkey": "C.c_custkey",
                "r_name": "R.r_name",
                "is_home": "case when N.n_regionkey = R.r_regionkey then 1 else 0 end",
            },
        },
    )


@query(
    "join_computed_keys",
    """SELECT c1.c_custkey, cast(c2.c_custkey AS varchar) AS named_key, n_name FROM customer c1
       LEFT JOIN customer c2 ON lpad(cast(c1.c_custkey AS varchar), 9, '0') = substr(c2.c_name, 10)
       LEFT JOIN nation ON CASE WHEN c1.c_acctbal < 0 THEN 'NATION_0' ELSE 'NATION_' || c1.c_nationkey END = trim(n_name)""",
)
def join_computed_keys(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "C1", "source": "customer"},
                {"alias": "C2", "source": "customer", "columns": ["c_custkey", "c_name"]},
                {"alias": "N", "source": "nation"},
            ],
            "transformations": [
                {"join": {"right_source": "C2",
                          "condition": ["lpad(cast(C1.c_custkey as string), 9, '0') = substr(C2.c_name, 10)"]}},
                {"add_variables": {"column_mapping": {
                    "var_nation": "case when C1.c_acctbal < 0 then 'NATION_0' else concat('NATION_', C1.c_nationkey) end"}}},
                {"join": {"right_source": "N", "condition": ["var_nation = trim(N.n_name)"]}},
            ],
            "expressions": {"c_custkey": "C1.c_custkey", "named_key": "cast(C2.c_custkey as string)", "n_name": "N.n_name"},
        },
    )


@query(
    "join_residual_predicate",
    """SELECT o_orderkey, c_name FROM orders LEFT JOIN customer
       ON o_custkey = c_custkey AND o_orderstatus = 'F' AND c_acctbal * 20 < o_totalprice""",
)
def join_residual_predicate(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        join_mapping(
            ("O", "orders", None),
            ("C", "customer", None),
            ["O.o_custkey = C.c_custkey", "O.o_orderstatus = 'F'", "C.c_acctbal * 20 < O.o_totalprice"],
            "left",
            {"o_orderkey": "O.o_orderkey", "c_name": "C.c_name"},
        ),
    )


# Rule table of the wildcard queries: id, brand, type, order priority, return
# flag, approach, smallest quantity.
RULES = [
    (1, "Brand#1", "ECONOMY", "*", "R", "STD", 0),
    (2, "Brand#1", "*", "1-URGENT", "*", "FOU", 5),
    (3, "*", "PROMO", "2-HIGH", "A", "IRB", 0),
    (4, "Brand#7", "SMALL", "3-MEDIUM", "N", "STD", 10),
    (5, "*", "*", "*", "R", "FOU", 30),
    (6, "Brand#12", "*", "*", "*", "IRB", 0),
    (7, "*", "LARGE", "5-LOW", "*", "STD", 0),
    (8, "*", "STANDARD", "*", "*", "FOU", 20),
    (9, "Brand#25", "MEDIUM", "4-NOT SPECIFIED", "*", "IRB", 0),
    (10, "*", "*", "1-URGENT", "N", "STD", 45),
]
RULE_COLUMNS = (
    "rule_id int, brand string, type string, priority string, flag string, approach string, min_quantity int"
)
RULES_SQL = "(VALUES " + ", ".join(str(r) for r in RULES) + (
    ") rules(rule_id, brand, type, priority, flag, approach, min_quantity)"
)
RULE_MATCH_SQL = """(brand = p_brand OR brand = '*') AND (type = p_type OR type = '*')
         AND (priority = o_orderpriority OR priority = '*') AND (flag = l_returnflag OR flag = '*')"""


def with_rules(spark: SparkSession, t: Tables) -> Tables:
    return frame_tables({"rules": local_rows(spark, RULES, RULE_COLUMNS)}, t)


# Rules drawn from the parts: their size decides which columns are wildcards.
PART_RULES = """case when p_size % 4 < 2 then p_brand else '*' end AS brand,
         case when p_size % 3 > 0 then p_type else '*' end AS type,
         case p_size % 5 when 0 then '1-URGENT' when 1 then '5-LOW' else '*' end AS priority,
         case when p_size > 25 then 'R' else '*' end AS flag"""


def part_rules(t: Tables) -> DataFrame:
    return (
        t("part")
        .selectExpr("p_partkey", "p_size", *[c.strip() for c in PART_RULES.split(",\n")])
        .groupBy("brand", "type", "priority", "flag")
        .agg(F.min("p_partkey").alias("rule_id"), F.min("p_size").alias("min_quantity"))
    )


PART_RULES_SQL = f"""(SELECT brand, type, priority, flag, min(p_partkey) AS rule_id, min(p_size) AS min_quantity
                      FROM (SELECT p_partkey, p_size, {PART_RULES} FROM part) GROUP BY 1, 2, 3, 4) rules"""


@query(
    "join_wildcard_rules",
    f"""SELECT coalesce(rule_id, -1) AS rule_id, count(*) AS n_lines, cast(sum(l_quantity) AS bigint) AS quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN {PART_RULES_SQL} ON {RULE_MATCH_SQL} AND l_quantity >= min_quantity GROUP BY 1""",
)
def join_wildcard_rules_query(spark: SparkSession, t: Tables) -> DataFrame:
    """Hundreds of rules, matched by walking their tree."""
    return run_mapping(frame_tables({"rules": part_rules(t)}, t), rule_mapping("R.rule_id", -1))


@query(
    "join_wildcard_few_rules",
    f"""SELECT coalesce(rule_id, 0) AS rule_id, count(*) AS n_lines, cast(sum(l_quantity) AS bigint) AS quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN {RULES_SQL} ON {RULE_MATCH_SQL} AND l_quantity >= min_quantity GROUP BY 1""",
)
def join_wildcard_few_rules(spark: SparkSession, t: Tables) -> DataFrame:
    """Ten rules, tested where the facts stand."""
    return run_mapping(with_rules(spark, t), rule_mapping("R.rule_id", 0))


def rule_mapping(rule_id: str, default: int) -> dict:
    return {
        "sources": [
            {"alias": "L", "source": "lineitem",
             "columns": ["l_orderkey", "l_partkey", "l_returnflag", "l_quantity"]},
            {"alias": "P", "source": "part", "columns": ["p_partkey", "p_brand", "p_type"]},
            {"alias": "O", "source": "orders", "columns": ["o_orderkey", "o_orderpriority"]},
            {"alias": "R", "source": "rules"},
        ],
        "transformations": [
            {"join": {"right_source": "P", "how": "inner", "condition": ["L.l_partkey = P.p_partkey"]}},
            {"join": {"right_source": "O", "how": "inner", "condition": ["L.l_orderkey = O.o_orderkey"]}},
            {"join": {"right_source": "R", "condition": [
                "R.brand = P.p_brand or R.brand = '*'",
                "R.type = P.p_type or R.type = '*'",
                "R.priority = O.o_orderpriority or R.priority = '*'",
                "R.flag = L.l_returnflag or R.flag = '*'",
                "L.l_quantity >= R.min_quantity",
            ]}},
            {"add_variables": {"column_mapping": {"var_rule": f"coalesce({rule_id}, {default})"}}},
            {"aggregation": {"alias": "A", "group": ["var_rule"], "column_mapping": {
                "n_lines": "count(*)", "quantity": "cast(sum(L.l_quantity) as bigint)"}}},
        ],
        "expressions": {"rule_id": "A.var_rule", "n_lines": "A.n_lines", "quantity": "A.quantity"},
    }


# Items of the hierarchy: customers with a balance, whose parent is their number
# without the last digit; machinery has no parent.
HIERARCHY = """SELECT c_custkey AS item,
                      CASE WHEN c_mktsegment <> 'MACHINERY' THEN cast(floor(c_custkey / 10) AS bigint) END AS parent
               FROM customer WHERE c_acctbal >= 0"""


@query(
    "hierarchy_rollup",
    f"""WITH RECURSIVE node AS ({HIERARCHY}),
        climb(item, steps, reached, above) AS (
          SELECT item, 0, item, parent FROM node
          UNION ALL
          SELECT climb.item, steps + 1, node.item, node.parent FROM climb JOIN node ON climb.above = node.item WHERE steps < 3),
        top AS (SELECT item, max(steps) AS steps, arg_max(reached, steps) AS reached, arg_max(coalesce(above, -1), steps) AS above
                FROM climb GROUP BY item)
        SELECT item, reached AS highest_existing,
               'level ' || CASE WHEN steps < 3 AND above >= 0 THEN (steps + 1) || ' parent not found' ELSE steps || ' parent found' END AS level_text,
               CASE WHEN steps > 0 THEN 1 ELSE 0 END AS is_sub_item
        FROM top""",
)
def hierarchy_rollup(spark: SparkSession, t: Tables) -> DataFrame:
    items = t("customer").where("c_acctbal >= 0").selectExpr(
        "c_custkey AS item", "case when c_mktsegment <> 'MACHINERY' then c_custkey div 10 end AS parent"
    )
    return roll_up(items, "item", "parent").drop("parent")


@query(
    "join_role_playing",
    """SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n_lines,
              cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS price
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
       GROUP BY 1, 2""",
)
def join_role_playing(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "L", "source": "lineitem", "columns": ["l_orderkey", "l_suppkey", "l_extendedprice"]},
                {"alias": "O", "source": "orders", "columns": ["o_orderkey", "o_custkey"]},
                {"alias": "C", "source": "customer", "columns": ["c_custkey", "c_nationkey"]},
                {"alias": "S", "source": "supplier", "columns": ["s_suppkey", "s_nationkey"]},
                {"alias": "CN", "source": "nation"},
                {"alias": "SN", "source": "nation"},
            ],
            "transformations": [
                {"join": {"right_source": "O", "how": "inner", "condition": ["L.l_orderkey = O.o_orderkey"]}},
                {"join": {"right_source": "C", "how": "inner", "condition": ["O.o_custkey = C.c_custkey"]}},
                {"join": {"right_source": "S", "how": "inner", "condition": ["L.l_suppkey = S.s_suppkey"]}},
                {"join": {"right_source": "CN", "condition": ["C.c_nationkey = CN.n_nationkey"]}},
                {"join": {"right_source": "SN", "condition": ["S.s_nationkey = SN.n_nationkey"]}},
                {"add_variables": {"column_mapping": {"var_cn": "CN.n_name", "var_sn": "SN.n_name"}}},
                {"aggregation": {"alias": "A", "group": ["var_cn", "var_sn"], "column_mapping": {
                    "n_lines": "count(*)",
                    "price": exact_sum(hundredths("L.l_extendedprice"))}}},
            ],
            "expressions": {"customer_nation": "A.var_cn", "supplier_nation": "A.var_sn",
                            "n_lines": "A.n_lines", "price": "A.price"},
        },
    )


@query(
    "join_derived_alias",
    """WITH agg AS (SELECT o_custkey, max(o_totalprice) AS top_price, count(*) AS n_orders FROM orders GROUP BY 1)
       SELECT o.o_orderkey, o.o_totalprice, top_price, n_orders FROM orders o LEFT JOIN agg ON o.o_custkey = agg.o_custkey""",
)
def join_derived_alias(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "O", "source": "orders"}],
            "transformations": [
                {"aggregation": {"alias": "TOTALS", "group": ["O.o_custkey"], "column_mapping": {
                    "top_price": "max(O.o_totalprice)", "n_orders": "count(*)"}}},
                {"join": {"left_source": "O", "right_source": "TOTALS",
                          "condition": ["O.o_custkey = TOTALS.o_custkey"]}},
            ],
            "expressions": {"o_orderkey": "O.o_orderkey", "o_totalprice": "O.o_totalprice",
                            "top_price": "TOTALS.top_price", "n_orders": "TOTALS.n_orders"},
        },
    )


@query(
    "join_case_insensitive",
    """SELECT o_orderkey, c_custkey FROM orders JOIN customer
       ON lower(trim(' CUSTOMER#' || lpad(cast(o_custkey AS varchar), 9, '0') || ' ')) = lower(trim(c_name))""",
)
def join_case_insensitive(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t("orders").selectExpr(
        "o_orderkey", "concat(' CUSTOMER#', lpad(cast(o_custkey as string), 9, '0'), ' ') AS party"
    )
    return orders.join(t("customer"), same_text(F.col("party"), F.col("c_name"))).select(
        "o_orderkey", "c_custkey"
    )


@query(
    "join_contains",
    """SELECT c_custkey, s_suppkey, CASE WHEN c_digits = s_digits THEN 'EXACT' ELSE 'CONTAINS' END AS match_kind
       FROM (SELECT c_custkey, cast(c_custkey AS varchar) AS c_digits FROM customer)
       JOIN (SELECT s_suppkey, cast(s_suppkey AS varchar) AS s_digits FROM supplier) ON instr(c_digits, s_digits) > 0""",
)
def join_contains_query(spark: SparkSession, t: Tables) -> DataFrame:
    customers = t("customer").selectExpr("c_custkey", "cast(c_custkey as string) AS c_digits")
    suppliers = t("supplier").selectExpr("s_suppkey", "cast(s_suppkey as string) AS s_digits")
    return join_contains(customers, "c_digits", suppliers, "s_digits").select(
        "c_custkey", "s_suppkey", "match_kind"
    )


@query(
    "subquery_exists",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 AND EXISTS
              (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 250000)
              THEN 'Y' ELSE 'N' END AS default_flag FROM customer""",
)
def subquery_exists(spark: SparkSession, t: Tables) -> DataFrame:
    failed = t("orders").where("o_orderstatus = 'F' and o_totalprice > 250000")
    return with_flag(t("customer"), failed, F.col("c_custkey"), "o_custkey", "has_failed").selectExpr(
        "c_custkey", "case when c_acctbal > 0 and has_failed = 1 then 'Y' else 'N' end AS default_flag"
    )


@query(
    "subquery_scalar_max",
    """SELECT c_custkey,
         cast((SELECT max(cast(o_orderdate AS date)) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS varchar) AS default_date,
         (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS default_price
       FROM customer""",
)
def subquery_scalar_max(spark: SparkSession, t: Tables) -> DataFrame:
    failed = t("orders").where("o_orderstatus = 'F'")
    values = {
        "default_date": F.max(F.col("o_orderdate").cast("date")).cast("string"),
        "default_price": F.max("o_totalprice"),
    }
    return with_lookup_max(t("customer"), failed, F.col("c_custkey"), "o_custkey", values).select(
        "c_custkey", *values
    )


@query(
    "subquery_in",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000)""",
)
def subquery_in(spark: SparkSession, t: Tables) -> DataFrame:
    chosen = t("customer").where("c_mktsegment = 'BUILDING' and c_acctbal > 5000")
    orders = t("orders")
    return orders.join(chosen, orders.o_custkey == chosen.c_custkey, "left_semi").select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "join_link_propagation",
    """WITH parties AS (
         SELECT s_suppkey AS party, CASE WHEN s_acctbal >= 6000 THEN s_acctbal END AS rating, s_nationkey AS rating_year FROM supplier),
       links AS (SELECT DISTINCT l_suppkey AS party, l_orderkey AS item FROM lineitem),
       others AS (
         SELECT me.party, mine.item, o.rating,
                row_number() OVER (PARTITION BY me.party, mine.item ORDER BY o.rating_year DESC, o.party DESC) AS rn
         FROM parties me JOIN links mine ON me.party = mine.party
         JOIN links theirs ON mine.item = theirs.item AND theirs.party <> me.party
         JOIN parties o ON theirs.party = o.party
         WHERE me.rating IS NULL AND o.rating IS NOT NULL),
       best AS (SELECT party, max(CASE WHEN rn = 1 THEN rating END) AS found FROM others GROUP BY party)
       SELECT parties.party, parties.rating AS own_rating, coalesce(parties.rating, found) AS rating
       FROM parties LEFT JOIN best ON parties.party = best.party""",
)
def join_link_propagation(spark: SparkSession, t: Tables) -> DataFrame:
    parties = t("supplier").selectExpr(
        "s_suppkey AS party", "case when s_acctbal >= 6000 then s_acctbal end AS own_rating",
        "s_nationkey AS rating_year",
    )
    links = t("lineitem").selectExpr("l_suppkey AS party", "l_orderkey AS item")
    return propagate_over_links(
        parties.withColumnRenamed("party", "id"),
        links.withColumnRenamed("party", "id"),
        "id",
        "item",
        "own_rating",
        F.col("own_rating").isNotNull(),
        ["rating_year", "id"],
        "rating",
    ).selectExpr("id AS party", "own_rating", "rating")


@query(
    "join_using",
    """SELECT nationkey, c.n AS n_customers, s.n AS n_suppliers
       FROM (SELECT c_nationkey AS nationkey, count(*) AS n FROM customer GROUP BY 1) c
       JOIN (SELECT s_nationkey AS nationkey, count(*) AS n FROM supplier GROUP BY 1) s USING (nationkey)""",
)
def join_using(spark: SparkSession, t: Tables) -> DataFrame:
    customers = t("customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers")
    )
    suppliers = t("supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_suppliers")
    )
    return customers.join(suppliers, on="nationkey")


@query(
    "lookup_fallback",
    """WITH a AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_acctbal > 5000),
            b AS (SELECT s_suppkey AS k, s_acctbal AS v FROM supplier WHERE s_acctbal > 0),
            d AS (SELECT c_custkey AS k, c_nationkey AS nk FROM customer)
       SELECT o_orderkey, coalesce(a.v, b.v, cast(d.nk AS double)) AS rating,
              CASE WHEN a.v IS NOT NULL THEN 'step 1' WHEN b.v IS NOT NULL THEN 'step 2' ELSE 'step 3' END AS winner
       FROM orders LEFT JOIN a ON o_custkey = a.k LEFT JOIN b ON o_custkey = b.k LEFT JOIN d ON o_custkey = d.k""",
)
def lookup_fallback(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "O", "source": "orders"},
                {"alias": "A", "source": "customer", "filter": "c_acctbal > 5000",
                 "columns": ["c_custkey as k", "c_acctbal as v"]},
                {"alias": "B", "source": "supplier", "filter": "s_acctbal > 0",
                 "columns": ["s_suppkey as k", "s_acctbal as v"]},
                {"alias": "D", "source": "customer", "columns": ["c_custkey as k", "c_nationkey as nk"]},
            ],
            "transformations": [
                {"join": {"right_source": a, "condition": [f"O.o_custkey = {a}.k"]}} for a in ("A", "B", "D")
            ],
            "expressions": {
                "o_orderkey": "O.o_orderkey",
                "rating": "coalesce(A.v, B.v, cast(D.nk as double))",
                "winner": "case when A.v is not null then 'step 1' when B.v is not null then 'step 2' else 'step 3' end",
            },
        },
    )


# Parts as facts with two candidates for a priority; conditions in several spellings.
RULE_FACTS = """SELECT p_partkey, p_brand, p_type, p_size,
                       CASE p_size % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '5-LOW' ELSE '2-HIGH' END AS first_priority,
                       CASE p_size % 7 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '5-LOW' END AS second_priority FROM part"""
RULE_SPELLINGS = [
    "R.brand in (P.p_brand, '*')",
    "'*' = R.type or upper(P.p_type) = upper(R.type)",
    "R.priority = P.first_priority or R.priority = P.second_priority or R.priority = '*'",
    "(R.flag = 'R' and R.min_quantity = P.p_size) or (R.flag = '*' and P.p_size % 3 = 0)",
]
RULE_KINDS = {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "full": "FULL JOIN", "left_semi": "SEMI JOIN", "left_anti": "ANTI JOIN"}


def rule_kind_sql(kind: str, join: str) -> str:
    rule = "0" if kind in ("left_semi", "left_anti") else "coalesce(R.rule_id, 0)"
    return f"""SELECT '{kind}' AS kind, count(*) AS n, cast(sum(coalesce(P.p_partkey, 0)) AS bigint) AS parts, cast(sum({rule}) AS bigint) AS rules
               FROM ({RULE_FACTS}) AS P {join} {PART_RULES_SQL.removesuffix(' rules')} AS R ON {' AND '.join(f'({c})' for c in RULE_SPELLINGS)}"""


@query("join_rule_kinds", " UNION ALL ".join(rule_kind_sql(k, j) for k, j in RULE_KINDS.items()))
def join_rule_kinds(spark: SparkSession, t: Tables) -> DataFrame:
    """Every kind of join between parts and hundreds of rules, by conditions in several spellings."""
    facts = t("part").selectExpr(
        "p_partkey", "p_brand", "p_type", "p_size",
        "case p_size % 5 when 0 then '1-URGENT' when 1 then '5-LOW' else '2-HIGH' end AS first_priority",
        "case p_size % 7 when 0 then '1-URGENT' when 1 then '5-LOW' end AS second_priority",
    )
    tables = frame_tables({"rules": part_rules(t), "facts": facts})
    found = []
    for kind in RULE_KINDS:
        rule = "0" if kind in ("left_semi", "left_anti") else "coalesce(R.rule_id, 0)"
        mapping = {
            "sources": [{"alias": "P", "source": "facts"}, {"alias": "R", "source": "rules"}],
            "transformations": [
                {"join": {"right_source": "R", "how": kind, "condition": RULE_SPELLINGS}},
                {"aggregation": {"alias": "A", "group": [f"'{kind}'"], "column_mapping": {
                    "n": "count(*)", "parts": "cast(sum(coalesce(P.p_partkey, 0)) as bigint)", "rules": f"cast(sum({rule}) as bigint)"}}},
            ],
            "expressions": {"kind": f"'{kind}'", "n": "A.n", "parts": "A.parts", "rules": "A.rules"},
        }
        found.append(run_mapping(tables, mapping))
    return reduce(DataFrame.unionByName, found)


RULE_LEVEL_MATCH = """(brand = p_brand OR brand = '*') AND (upper(type) = upper(p_type) OR type = '*')
         AND (priority = o_orderpriority OR priority = o_shippriority OR priority = '*') AND (flag = l_returnflag OR flag = l_linestatus OR flag = '*')"""


@query(
    "mapping_rule_levels",
    f"""WITH lines AS (
          SELECT l_orderkey, l_linenumber, o_custkey, p_brand, p_type, o_orderpriority, cast(o_custkey % 9 AS varchar) AS o_shippriority, l_returnflag, l_linestatus
          FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
        cases AS (SELECT DISTINCT p_brand, p_type, o_orderpriority, o_shippriority, l_returnflag, l_linestatus FROM lines),
        found AS (SELECT cases.*, min(rule_id) AS item_rule, arg_min(min_quantity, rule_id) AS item_quantity, arg_min(brand, rule_id) AS item_brand
                  FROM cases LEFT JOIN {PART_RULES_SQL} ON {RULE_LEVEL_MATCH} GROUP BY ALL),
        items AS (SELECT * FROM lines JOIN found USING (p_brand, p_type, o_orderpriority, o_shippriority, l_returnflag, l_linestatus)),
        parties AS (SELECT o_custkey AS party, min(item_rule) AS party_rule, arg_min(item_quantity, item_rule) AS party_quantity,
                           arg_min(item_brand, item_rule) AS party_brand FROM items GROUP BY 1)
        SELECT DISTINCT l_orderkey, l_linenumber, least(item_rule, party_rule) AS rule_id, item_rule,
               CASE WHEN party_rule <= item_rule THEN party_quantity ELSE item_quantity END AS quantity,
               CASE WHEN CASE WHEN party_rule <= item_rule THEN party_brand ELSE item_brand END = '*' THEN 'any brand' ELSE 'one brand' END AS scope
        FROM items JOIN parties ON o_custkey = party WHERE item_rule IS NOT NULL AND least(item_rule, party_rule) < item_rule""",
)
def mapping_rule_levels(spark: SparkSession, t: Tables) -> DataFrame:
    """The lowest rule of each line and of each party, and the attributes of the lower one where the party's wins."""
    return run_mapping(
        frame_tables({"rules": part_rules(t)}, t),
        {
            "sources": [
                {"alias": "L", "source": "lineitem", "columns": ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"]},
                {"alias": "P", "source": "part", "columns": ["p_partkey", "p_brand", "p_type"]},
                {"alias": "O", "source": "orders", "columns": ["o_orderkey", "o_orderpriority", "o_custkey"]},
                {"alias": "R", "source": "rules"},
            ],
            "transformations": [
                {"join": {"right_source": "P", "how": "inner", "condition": ["L.l_partkey = P.p_partkey"]}},
                {"join": {"right_source": "O", "how": "inner", "condition": ["L.l_orderkey = O.o_orderkey"]}},
                {"best_rule": {"alias": "I", "right_source": "R", "order": "rule_id", "condition": [
                    "R.brand in (P.p_brand, '*')",
                    "upper(R.type) = upper(P.p_type) or R.type = '*'",
                    "R.priority = O.o_orderpriority or R.priority = cast(O.o_custkey % 9 as string) or R.priority = '*'",
                    "L.l_returnflag = R.flag or L.l_linestatus = R.flag or R.flag = '*'",
                ], "column_mapping": {"item_rule": "rule_id", "item_quantity": "min_quantity", "item_brand": "brand"}}},
                {"aggregation": {"alias": "Y", "group": ["I.o_custkey"], "column_mapping": {
                    "party_rule": "min(I.item_rule)", "party_quantity": "min_by(I.item_quantity, I.item_rule)",
                    "party_brand": "min_by(I.item_brand, I.item_rule)"}}},
                {"join": {"left_source": "I", "right_source": "Y", "how": "inner", "condition": ["I.o_custkey = Y.o_custkey"]}},
                {"add_variables": {"column_mapping": {
                    "var_brand": "case when Y.party_rule <= I.item_rule then Y.party_brand else I.item_brand end"}}},
            ],
            "expressions": {
                "l_orderkey": "I.l_orderkey",
                "l_linenumber": "I.l_linenumber",
                "item_rule": "I.item_rule",
                "rule_id": "least(I.item_rule, Y.party_rule)",
                "quantity": "case when Y.party_rule <= I.item_rule then Y.party_quantity else I.item_quantity end",
                "scope": "case when var_brand = '*' then 'any brand' else 'one brand' end",
            },
            "filter_target": ["item_rule is not null", "rule_id < item_rule"],
            "drop_duplicates": True,
        },
    )


@query(
    "mapping_rule_assignment",
    f"""WITH facts AS (
          SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_returnflag, p_brand, p_type, o_orderpriority, o_custkey
          FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
        item_rule AS (
          SELECT l_orderkey, p_brand, p_type, o_orderpriority, l_returnflag, l_linenumber, l_extendedprice, o_custkey,
                 (SELECT min(rule_id) FROM {RULES_SQL} WHERE {RULE_MATCH_SQL}) AS item_rule FROM facts),
        party AS (SELECT o_custkey AS party, min(item_rule) AS party_rule FROM item_rule
                  WHERE l_returnflag = 'R' GROUP BY 1),
        chosen AS (
          SELECT l_orderkey, l_linenumber, item_rule, party_rule, least(item_rule, party_rule) AS rule_id
          FROM item_rule LEFT JOIN party ON o_custkey = party)
        SELECT DISTINCT l_orderkey, l_linenumber, item_rule, coalesce(party_rule, 0) AS party_rule, chosen.rule_id,
               CASE approach WHEN 'STD' THEN 'SA' WHEN 'FOU' THEN 'FIRB' WHEN 'IRB' THEN 'AIRB' ELSE approach END AS approach
        FROM chosen JOIN {RULES_SQL} ON chosen.rule_id = rules.rule_id WHERE item_rule IS NOT NULL""",
)
def mapping_rule_assignment(spark: SparkSession, t: Tables) -> DataFrame:
    """Lowest rule per line and per party with returns; the lower of both applies."""
    rules = local_rows(spark, RULES, RULE_COLUMNS)
    facts = (
        t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
        .join(t("part").select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("orders").select("o_orderkey", "o_orderpriority", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    wild = {"brand": "p_brand", "type": "p_type", "priority": "o_orderpriority", "flag": "l_returnflag"}
    items = attach_best_rule(facts, rules, wild, "rule_id", {"item_rule": "rule_id"})
    parties = items.where("l_returnflag = 'R'").groupBy(F.col("o_custkey").alias("party")).agg(
        F.min("item_rule").alias("party_rule")
    )
    codes = rules.select("rule_id", "approach")
    return (
        items.where("item_rule is not null")
        .join(parties, F.col("o_custkey") == F.col("party"), "left")
        .withColumn("rule_id", F.least("item_rule", "party_rule"))
        .join(codes, "rule_id")
        .selectExpr(
            "l_orderkey", "l_linenumber", "item_rule", "coalesce(party_rule, 0) AS party_rule", "rule_id",
            "case approach when 'STD' then 'SA' when 'FOU' then 'FIRB' when 'IRB' then 'AIRB' else approach end AS approach",
        )
        .distinct()
    )
