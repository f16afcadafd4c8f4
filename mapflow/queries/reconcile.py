"""Comparing tables and profiling them.

The compared versions are made from the given tables: the newer one has changed
prices, lost some rows and gained others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.operators.joins import key_presence
from mapflow.operators.rules import explain_rules, nearest_rules
from mapflow.plans import recon
from mapflow.queries.joining import PART_RULES_SQL, RULE_COLUMNS, RULES, RULES_SQL, part_rules
from mapflow.queries.registry import query
from mapflow.sources.tables import Tables, local_rows

NEW_PRICE = "case when o_orderpriority = '1-URGENT' then o_totalprice + 10 when o_orderpriority = '2-HIGH' then null else o_totalprice end"
NEW_SQL = f"""new AS (SELECT o_orderkey, {NEW_PRICE} AS o_totalprice, o_orderstatus
              FROM orders WHERE o_orderstatus <> 'P')"""
OLD_SQL = "old AS (SELECT o_orderkey, nullif(o_totalprice, 0) AS o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 5000)"


def old_orders(t: Tables) -> DataFrame:
    return t("orders").where("o_totalprice > 5000").select("o_orderkey", "o_totalprice", "o_orderstatus")


def new_orders(t: Tables) -> DataFrame:
    return t("orders").where("o_orderstatus <> 'P'").selectExpr(
        "o_orderkey", f"{NEW_PRICE} AS o_totalprice", "o_orderstatus"
    )


@query(
    "recon_schema_diff",
    """SELECT 'c_name' AS column_name, 'LEFT_ONLY' AS side, 'string' AS data_type, count(c_name) AS n_values FROM customer
       UNION ALL SELECT 'c_segment', 'RIGHT_ONLY', 'string', count(c_mktsegment) FROM customer
       UNION ALL SELECT 'c_mktsegment', 'LEFT_ONLY', 'string', count(c_mktsegment) FROM customer""",
)
def recon_schema_diff(spark: SparkSession, t: Tables) -> DataFrame:
    old = t("customer")
    new = old.drop("c_name").withColumnRenamed("c_mktsegment", "c_segment")
    diff = recon.schema_diff(old, new)
    counts = old.agg(F.count("c_name").alias("c_name"), F.count("c_mktsegment").alias("c_mktsegment"))
    values = counts.selectExpr(
        "stack(3, 'c_name', c_name, 'c_mktsegment', c_mktsegment, 'c_segment', c_mktsegment) AS (column_name, n_values)"
    )
    return diff.join(values, "column_name")


@query(
    "recon_key_presence",
    f"""WITH {OLD_SQL}, {NEW_SQL}
        SELECT coalesce(old.o_orderkey, new.o_orderkey) AS o_orderkey,
               CASE WHEN new.o_orderkey IS NULL THEN 'LEFT_ONLY' WHEN old.o_orderkey IS NULL THEN 'RIGHT_ONLY' ELSE 'BOTH' END AS presence
        FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey""",
)
def recon_key_presence(spark: SparkSession, t: Tables) -> DataFrame:
    return key_presence(old_orders(t), new_orders(t), ["o_orderkey"])


@query(
    "recon_value_tolerance",
    """WITH a AS (SELECT l_suppkey, max(l_extendedprice) AS price, max(l_quantity) AS qty FROM lineitem GROUP BY 1),
            b AS (SELECT l_suppkey, max(l_extendedprice) AS price, max(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS qty FROM lineitem
                  WHERE l_linestatus = 'O' GROUP BY 1)
       SELECT a.l_suppkey, a.price AS left_price, b.price AS right_price, abs(a.price - b.price) AS diff_price,
              CASE WHEN abs(a.price - b.price) < 0.01 THEN 1 ELSE 0 END AS match_price,
              a.qty AS left_qty, b.qty AS right_qty, abs(a.qty - b.qty) AS diff_qty,
              CASE WHEN abs(a.qty - b.qty) < 0.01 THEN 1 ELSE 0 END AS match_qty,
              CASE WHEN abs(a.price - b.price) < 0.01 AND abs(a.qty - b.qty) < 0.01 THEN 1 ELSE 0 END AS match_all
       FROM a JOIN b ON a.l_suppkey = b.l_suppkey""",
)
def recon_value_tolerance(spark: SparkSession, t: Tables) -> DataFrame:
    lines = t("lineitem")
    all_lines = lines.groupBy("l_suppkey").agg(
        F.max("l_extendedprice").alias("price"), F.max("l_quantity").alias("qty")
    )
    open_lines = lines.where("l_linestatus = 'O'").groupBy("l_suppkey").agg(
        F.max("l_extendedprice").alias("price"),
        F.expr("max(l_quantity) filter (where l_returnflag <> 'R')").alias("qty"),
    )
    return recon.compare_values(all_lines, open_lines, ["l_suppkey"], {"price": 0.01, "qty": 0.01})


STATUS_SQL = """CASE WHEN old.o_totalprice IS NULL AND new.o_totalprice IS NULL THEN 'BOTH_NULL'
                 WHEN old.o_totalprice IS NULL THEN 'LEFT_NULL' WHEN new.o_totalprice IS NULL THEN 'RIGHT_NULL'
                 WHEN old.o_totalprice = new.o_totalprice THEN 'MATCH' ELSE 'MISMATCH' END"""


def price_status(t: Tables) -> DataFrame:
    old = old_orders(t).withColumn("old_price", F.expr("nullif(o_totalprice, 0)"))
    new = new_orders(t).select("o_orderkey", F.col("o_totalprice").alias("new_price"))
    return old.join(new, "o_orderkey", "left").select(
        "o_orderkey", recon.null_status(F.col("old_price"), F.col("new_price")).alias("status")
    )


@query(
    "recon_null_aware",
    f"""WITH {OLD_SQL}, {NEW_SQL}
        SELECT old.o_orderkey, {STATUS_SQL} AS status FROM old LEFT JOIN new ON old.o_orderkey = new.o_orderkey""",
)
def recon_null_aware(spark: SparkSession, t: Tables) -> DataFrame:
    return price_status(t)


@query(
    "recon_mismatch_rows",
    f"""WITH {OLD_SQL}, {NEW_SQL}
        SELECT old.o_orderkey, old.o_totalprice AS left_o_totalprice, new.o_totalprice AS right_o_totalprice
        FROM old JOIN new ON old.o_orderkey = new.o_orderkey WHERE old.o_totalprice <> new.o_totalprice""",
)
def recon_mismatch_rows(spark: SparkSession, t: Tables) -> DataFrame:
    return recon.mismatched_rows(old_orders(t), new_orders(t), ["o_orderkey"], "o_totalprice")


DIAGNOSED = """SELECT p_partkey, p_brand, p_type, CASE p_size % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '5-LOW' ELSE '2-HIGH' END AS p_priority,
                      CASE WHEN p_size % 3 = 0 THEN 'R' ELSE 'N' END AS p_flag FROM part"""


def diagnosis_sql(column: str, fact: str) -> str:
    return f"CASE WHEN {column} = '*' THEN 'WILDCARD' WHEN {column} = {fact} THEN 'MATCH' ELSE 'NO_MATCH' END AS {column}_result"


@query(
    "recon_rule_diagnosis",
    f"""WITH facts AS ({DIAGNOSED}), told AS (
          SELECT p_partkey, rule_id, {diagnosis_sql('brand', 'p_brand')}, {diagnosis_sql('type', 'p_type')},
                 {diagnosis_sql('priority', 'p_priority')}, {diagnosis_sql('flag', 'p_flag')} FROM facts CROSS JOIN {RULES_SQL})
        SELECT *, 'NO_MATCH' NOT IN (brand_result, type_result, priority_result, flag_result) AS matches FROM told""",
)
def recon_rule_diagnosis(spark: SparkSession, t: Tables) -> DataFrame:
    facts = t("part").selectExpr(
        "p_partkey", "p_brand", "p_type",
        "case p_size % 5 when 0 then '1-URGENT' when 1 then '5-LOW' else '2-HIGH' end AS p_priority",
        "if(p_size % 3 = 0, 'R', 'N') AS p_flag",
    )
    wild = {"brand": "p_brand", "type": "p_type", "priority": "p_priority", "flag": "p_flag"}
    told = explain_rules(facts, local_rows(spark, RULES, RULE_COLUMNS), wild, "rule_id")
    return told.drop("p_brand", "p_type", "p_priority", "p_flag")


NEAREST = ("brand", "p_brand"), ("type", "p_type"), ("priority", "p_priority"), ("flag", "p_flag")


@query(
    "recon_rule_nearest",
    f"""WITH told AS (
          SELECT p_partkey, rule_id, {' + '.join(f"coalesce(({r} = {f} OR {r} = '*')::int, 0) * {1 << i}" for i, (r, f) in enumerate(NEAREST))} AS met
          FROM (SELECT p_partkey, p_brand, p_type, CASE p_size % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '5-LOW' ELSE '2-HIGH' END AS p_priority,
                       CASE WHEN p_size % 3 = 0 THEN 'R' ELSE 'N' END AS p_flag FROM part) CROSS JOIN {PART_RULES_SQL})
        SELECT p_partkey, rule_id, cast(met AS bigint) AS met, cast(bit_count(met) AS int) AS n_met, cast(place AS int) AS place
        FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY bit_count(met) DESC, rule_id) AS place FROM told) WHERE place <= 3""",
)
def recon_rule_nearest(spark: SparkSession, t: Tables) -> DataFrame:
    """The three rules each part comes nearest to, and which conditions it meets there."""
    facts = t("part").selectExpr(
        "p_partkey", "p_brand", "p_type",
        "case p_size % 5 when 0 then '1-URGENT' when 1 then '5-LOW' else '2-HIGH' end AS p_priority",
        "if(p_size % 3 = 0, 'R', 'N') AS p_flag",
    )
    nearest = nearest_rules(facts, part_rules(t), dict(NEAREST), "rule_id", 3)
    offers = [F.col(f).eqNullSafe(F.col(n)) for (_, f), n in zip(NEAREST, nearest.columns, strict=False)]
    return facts.join(nearest, offers).select("p_partkey", "rule_id", "met", "n_met", "place")


@query(
    "recon_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT l_partkey) AS distinct_l_partkey,
              count(DISTINCT l_returnflag) AS distinct_l_returnflag FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def recon_duplicate_keys(spark: SparkSession, t: Tables) -> DataFrame:
    return recon.duplicated_keys(t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_returnflag"])


@query(
    "profile_distribution",
    """SELECT 'customer' AS origin, c_mktsegment AS category, count(*) AS n_rows FROM customer GROUP BY 2
       UNION ALL SELECT 'documents', lang, count(*) FROM documents GROUP BY 2
       UNION ALL SELECT 'events', event_type, count(*) FROM events GROUP BY 2""",
)
def profile_distribution(spark: SparkSession, t: Tables) -> DataFrame:
    parts = None
    for table, column in (("customer", "c_mktsegment"), ("documents", "lang"), ("events", "event_type")):
        counts = t(table).groupBy(F.col(column).alias("category")).agg(F.count(F.lit(1)).alias("n_rows"))
        tagged = counts.select(F.lit(table).alias("origin"), "category", "n_rows")
        parts = tagged if parts is None else parts.unionByName(tagged)
    return parts


@query(
    "profile_step_funnel",
    """WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F')
       SELECT 1 AS step_no, 'lines' AS step, count(*) AS n_rows FROM lineitem
       UNION ALL SELECT 2, 'closed orders', count(*) FROM j
       UNION ALL SELECT 3, 'returned', count(*) FROM j WHERE l_returnflag = 'R'
       UNION ALL SELECT 4, 'suppliers', count(DISTINCT l_suppkey) FROM j WHERE l_returnflag = 'R'""",
)
def profile_step_funnel(spark: SparkSession, t: Tables) -> DataFrame:
    closed = t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey"), F.lit(True).alias("closed"))
    lines = t("lineitem").join(closed, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    returned = "closed and l_returnflag = 'R'"
    return recon.flag_funnel(
        lines,
        {
            "lines": F.count(F.lit(1)),
            "closed orders": F.expr("count_if(closed)"),
            "returned": F.expr(f"count_if({returned})"),
            "suppliers": F.expr(f"count(distinct case when {returned} then l_suppkey end)"),
        },
    )


@query(
    "recon_transition_class",
    f"""WITH {NEW_SQL}
        SELECT o.o_orderkey, CASE WHEN o.o_orderpriority <> '1-URGENT' AND o.o_totalprice IS NOT DISTINCT FROM new.o_totalprice THEN 'MATCH'
               WHEN o.o_orderpriority <> '1-URGENT' THEN 'MISMATCH'
               WHEN o.o_totalprice IS NOT DISTINCT FROM new.o_totalprice THEN 'UNCHANGED' ELSE 'CORRECTLY_MODIFIED' END AS transition
        FROM orders o JOIN new ON o.o_orderkey = new.o_orderkey""",
)
def recon_transition_class(spark: SparkSession, t: Tables) -> DataFrame:
    new = new_orders(t).select("o_orderkey", F.col("o_totalprice").alias("new_price"))
    kind = recon.transition_class(
        F.col("o_totalprice"), F.col("new_price"), F.col("o_orderpriority") != "1-URGENT"
    )
    return t("orders").join(new, "o_orderkey").select("o_orderkey", kind.alias("transition"))


@query(
    "recon_match_rate",
    f"""WITH {OLD_SQL}, {NEW_SQL}
        SELECT {STATUS_SQL} AS status, count(*) AS n_rows FROM old LEFT JOIN new ON old.o_orderkey = new.o_orderkey GROUP BY 1""",
)
def recon_match_rate(spark: SparkSession, t: Tables) -> DataFrame:
    return recon.match_rate(price_status(t), "status")
