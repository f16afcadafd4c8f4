"""Aggregations and pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.functions.amounts import exact_sum, hundredths
from mapflow.operators.aggregates import pivot_values
from mapflow.operators.windows import exact_median
from mapflow.plans.mapping import run_mapping
from mapflow.queries.registry import query
from mapflow.sources.tables import Tables


@query(
    "agg_group",
    """SELECT l_returnflag, l_linestatus, cast(sum(l_quantity) AS double) AS sum_qty,
              cast(sum(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2)))) AS double) AS revenue,
              count(*) AS n_lines FROM lineitem WHERE l_shipdate <= DATE '2000-12-31' GROUP BY 1, 2""",
)
def agg_group(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "L", "source": "lineitem", "filter": "l_shipdate <= date '2000-12-31'"}],
            "transformations": [
                {"aggregation": {"alias": "A", "group": ["L.l_returnflag", "L.l_linestatus"], "column_mapping": {
                    "sum_qty": "sum(L.l_quantity)",
                    "revenue": exact_sum(f"{hundredths('L.l_extendedprice')} * {hundredths('1 - L.l_discount')}", 4),
                    "n_lines": "count(*)"}}},
            ],
            "expressions": {c: f"A.{c}" for c in ("l_returnflag", "l_linestatus", "sum_qty", "revenue", "n_lines")},
        },
    )


@query(
    "agg_functions",
    """SELECT l_suppkey, cast(sum(l_quantity) AS double) AS sum_v, count(l_quantity) AS count_v, min(l_quantity) AS min_v,
              max(l_quantity) AS max_v, cast(sum(l_quantity) AS double) / count(*) AS avg_v, median(l_quantity) AS median_v,
              arg_min(l_returnflag, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS first_v FROM lineitem GROUP BY 1""",
)
def agg_functions(spark: SparkSession, t: Tables) -> DataFrame:
    """The median keeps one counter per distinct quantity, of which there are 50."""
    return run_mapping(
        t,
        {
            "sources": [{"alias": "L", "source": "lineitem"}],
            "transformations": [
                {"aggregation": {"alias": "A", "group": ["L.l_suppkey"], "column_mapping": {
                    "sum_v": "sum(L.l_quantity)",
                    "count_v": "count(L.l_quantity)",
                    "min_v": "min(L.l_quantity)",
                    "max_v": "max(L.l_quantity)",
                    "avg_v": "avg(L.l_quantity)",
                    "median_v": "median(L.l_quantity)",
                    "first_v": "min_by(L.l_returnflag, struct(L.l_orderkey, L.l_linenumber, L.l_partkey, L.l_extendedprice))"}}},
            ],
            "expressions": {c: f"A.{c}" for c in
                            ("l_suppkey", "sum_v", "count_v", "min_v", "max_v", "avg_v", "median_v", "first_v")},
        },
    )


@query(
    "agg_median_exact",
    """WITH v AS (SELECT l_returnflag, l_extendedprice AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS i,
                         count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem WHERE l_extendedprice IS NOT NULL)
       SELECT l_returnflag, (min(x) + max(x)) / 2 AS median_price FROM v WHERE i IN ((n + 1) // 2, n // 2 + 1) GROUP BY 1""",
)
def agg_median_exact(spark: SparkSession, t: Tables) -> DataFrame:
    """Few groups, each with about as many values as rows."""
    return exact_median(t("lineitem"), ["l_returnflag"], "l_extendedprice", "median_price")


@query(
    "agg_count_distinct",
    """SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts
       FROM lineitem GROUP BY 1""",
)
def agg_count_distinct(spark: SparkSession, t: Tables) -> DataFrame:
    return t("lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts")
    )


@query(
    "agg_conditional",
    """SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS top_closed,
              max(CASE o_orderstatus WHEN 'O' THEN o_totalprice END) AS top_open,
              count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent FROM orders GROUP BY 1""",
)
def agg_conditional(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "O", "source": "orders"}],
            "transformations": [
                {"aggregation": {"alias": "A", "group": ["O.o_custkey"], "column_mapping": {
                    "top_closed": "max(case when O.o_orderstatus = 'F' then O.o_totalprice end)",
                    "top_open": "max(O.o_totalprice) filter (where O.o_orderstatus = 'O')",
                    "n_urgent": "count(*) filter (where O.o_orderpriority = '1-URGENT')"}}},
            ],
            "expressions": {c: f"A.{c}" for c in ("o_custkey", "top_closed", "top_open", "n_urgent")},
        },
    )


@query(
    "agg_pivot",
    """SELECT user_id, min(value) FILTER (WHERE event_type = 'click') AS click_value,
              min(value) FILTER (WHERE event_type = 'purchase') AS purchase_value,
              min(value) FILTER (WHERE event_type = 'refund') IS NULL AS refund_missing
       FROM events GROUP BY 1""",
)
def agg_pivot(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "E", "source": "events"}],
            "transformations": [
                {"pivot": {"alias": "P", "group_cols": ["E.user_id"], "pivot_col": "E.event_type",
                           "pivot_value_col": "E.value", "value_suffix": "value",
                           "column_mapping": {"click": "min", "purchase": "min", "refund": "min"}}},
            ],
            "expressions": {"user_id": "P.user_id", "click_value": "P.click_value",
                            "purchase_value": "P.purchase_value", "refund_missing": "P.refund_value is null"},
        },
    )


@query(
    "agg_pivot_multi_fn",
    """SELECT user_id, min(value) FILTER (WHERE event_type = 'click') AS click,
              max(value) FILTER (WHERE event_type = 'purchase') AS purchase,
              count(value) FILTER (WHERE event_type = 'error') AS error FROM events GROUP BY 1""",
)
def agg_pivot_multi_fn(spark: SparkSession, t: Tables) -> DataFrame:
    return pivot_values(
        t("events"), ["user_id"], "event_type", "value", {"click": "min", "purchase": "max", "error": "count"}
    )


@query(
    "agg_pivot_discover",
    """SELECT o_custkey, min(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS "F",
              min(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS "O",
              min(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""",
)
def agg_pivot_discover(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "T", "source": "orders"}],
            "transformations": [
                {"pivot": {"alias": "P", "group_cols": ["T.o_custkey"], "pivot_col": "T.o_orderstatus",
                           "pivot_value_col": "T.o_totalprice"}},
            ],
            "expressions": {"o_custkey": "P.o_custkey", "F": "P.F", "O": "P.O", "P": "P.P"},
        },
    )


@query(
    "agg_having",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def agg_having(spark: SparkSession, t: Tables) -> DataFrame:
    return (
        t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    )


@query(
    "agg_collect_list",
    """SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS kinds, count(*) AS n_kinds
       FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1""",
)
def agg_collect_list(spark: SparkSession, t: Tables) -> DataFrame:
    """Distinct pairs first, so that a list is as long as there are kinds."""
    pairs = t("events").select("user_id", "event_type").distinct()
    kinds = pairs.groupBy("user_id").agg(F.array_sort(F.collect_list("event_type")).alias("kinds"))
    return kinds.select(
        "user_id", F.array_join("kinds", ",").alias("kinds"), F.size("kinds").cast("bigint").alias("n_kinds")
    )


@query("agg_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def agg_distinct(spark: SparkSession, t: Tables) -> DataFrame:
    return t("orders").select("o_custkey", "o_orderstatus").distinct()


@query(
    "agg_min_rejoin",
    """WITH first_day AS (SELECT l_orderkey AS k, min(l_shipdate) AS d FROM lineitem GROUP BY 1)
       SELECT l_orderkey, max(l_quantity) FILTER (WHERE l_returnflag = 'R') AS returned_qty,
              max(l_quantity) FILTER (WHERE l_returnflag = 'A') AS accepted_qty, count(*) AS n_lines
       FROM lineitem JOIN first_day ON l_orderkey = k AND l_shipdate = d GROUP BY 1""",
)
def agg_min_rejoin(spark: SparkSession, t: Tables) -> DataFrame:
    """Aggregate per day, then keep the first day's aggregates: no join back."""
    values = {
        "returned_qty": F.expr("max(l_quantity) filter (where l_returnflag = 'R')"),
        "accepted_qty": F.expr("max(l_quantity) filter (where l_returnflag = 'A')"),
        "n_lines": F.count(F.lit(1)),
    }
    per_day = t("lineitem").groupBy("l_orderkey", "l_shipdate").agg(*[c.alias(n) for n, c in values.items()])
    first = per_day.groupBy("l_orderkey").agg(F.min_by(F.struct(*values), "l_shipdate").alias("first"))
    return first.select("l_orderkey", "first.*")


@query(
    "agg_coalesce_priority",
    """SELECT user_id, coalesce(max(CASE WHEN event_type = 'purchase' AND value > 200 THEN value END),
                                max(CASE WHEN event_type = 'signup' AND value > 150 THEN value END),
                                max(CASE WHEN event_type = 'view' THEN value END)) AS best FROM events GROUP BY 1""",
)
def agg_coalesce_priority(spark: SparkSession, t: Tables) -> DataFrame:
    return t("events").groupBy("user_id").agg(
        F.expr(
            """coalesce(max(value) filter (where event_type = 'purchase' and value > 200),
                        max(value) filter (where event_type = 'signup' and value > 150),
                        max(value) filter (where event_type = 'view'))"""
        ).alias("best")
    )


@query(
    "agg_parent_selfjoin",
    """WITH own AS (SELECT o_custkey, cast(floor(o_custkey / 10) AS bigint) AS parent,
                           max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS turnover FROM orders GROUP BY 1, 2),
            companies AS (SELECT o_custkey AS company, max(o_orderkey) AS last_order, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS parent_turnover
                          FROM orders GROUP BY 1)
       SELECT own.o_custkey, cast(last_order AS varchar) AS last_order, coalesce(CASE WHEN c_acctbal > 9000 THEN c_acctbal END, parent_turnover, turnover) AS turnover
       FROM own LEFT JOIN companies ON own.parent = company LEFT JOIN customer ON own.o_custkey = c_custkey""",
)
def agg_parent_selfjoin(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "O", "source": "orders"},
                {"alias": "EXT", "source": "customer", "columns": ["c_custkey", "c_acctbal"]},
            ],
            "transformations": [
                {"add_variables": {"column_mapping": {
                    "var_parent": "O.o_custkey div 10",
                    "var_turnover": "case when O.o_orderstatus = 'F' then O.o_totalprice end"}, "alias": "BASE"}},
                {"aggregation": {"alias": "OWN", "group": ["BASE.o_custkey", "BASE.var_parent"],
                                 "column_mapping": {"turnover": "max(BASE.var_turnover)"}}},
                {"aggregation": {"alias": "COMPANY", "source": "BASE", "group": ["BASE.o_custkey"],
                                 "column_mapping": {"last_order": "max(BASE.o_orderkey)",
                                                    "parent_turnover": "max(BASE.var_turnover)"}}},
                {"join": {"left_source": "OWN", "right_source": "COMPANY",
                          "condition": ["OWN.var_parent = COMPANY.o_custkey"]}},
                {"join": {"right_source": "EXT", "condition": ["OWN.o_custkey = EXT.c_custkey"]}},
            ],
            "expressions": {
                "o_custkey": "OWN.o_custkey",
                "last_order": "cast(COMPANY.last_order as string)",
                "turnover": """coalesce(case when EXT.c_acctbal > 9000 then EXT.c_acctbal end,
                                        COMPANY.parent_turnover, OWN.turnover)""",
            },
        },
    )
