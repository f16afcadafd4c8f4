"""Data-quality checks over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.plans import quality
from mapflow.queries.registry import query
from mapflow.sources.tables import Tables, frame_tables

RESULT = ["check_type", "check_details", "result", "violations"]


@query(
    "dq_column_count",
    """SELECT 'column_count' AS check_type, '11' AS check_details, 'PASS' AS result, 0::BIGINT AS violations, count(*) AS n_rows FROM lineitem
       UNION ALL SELECT 'column_count', '5', 'FAIL', 1, count(*) FROM orders""",
)
def dq_column_count(spark: SparkSession, t: Tables) -> DataFrame:
    lines = quality.run_checks(t("lineitem"), {"columns": 11}).select(*RESULT)
    orders = quality.run_checks(t("orders"), {"columns": 5}).select(*RESULT)
    return with_row_count(lines, t("lineitem")).unionByName(with_row_count(orders, t("orders")))


def with_row_count(results: DataFrame, df: DataFrame) -> DataFrame:
    """Check results next to the number of rows of the checked table."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("_table", F.lit(1))
    return results.withColumn("_table", F.lit(1)).join(counted, "_table").drop("_table")


ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "int",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_channel": "string",
}


@query(
    "dq_schema_types",
    """SELECT 'column_count' AS check_type, '6' AS check_details, 'PASS' AS result, 0::BIGINT AS violations, '' AS error, count(*) AS n_rows FROM orders
       UNION ALL SELECT 'columns_datatypes', 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_channel', 'FAIL', 4,
         'not found: [(''o_channel'', ''string''), (''o_custkey'', ''int'')]; not expected: [(''o_custkey'', ''bigint''), (''o_orderpriority'', ''string'')]',
         count(*) FROM orders""",
)
def dq_schema_types(spark: SparkSession, t: Tables) -> DataFrame:
    return with_row_count(quality.run_checks(t("orders"), {"columns": ORDER_TYPES}), t("orders"))


@query(
    "dq_primary_key",
    """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
            o AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1),
            m AS (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS s, count(*) AS n FROM customer GROUP BY 1, 2)
       SELECT 'primary_key' AS check_type, 'l_orderkey,l_linenumber' AS check_details,
              CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'PASS' ELSE 'FAIL' END AS result, count(*) FILTER (WHERE n > 1) AS violations FROM k
       UNION ALL SELECT 'primary_key', 'o_orderkey', CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FILTER (WHERE n > 1) FROM o
       UNION ALL SELECT 'primary_key', 'c_custkey,segment', 'FAIL', count(*) FILTER (WHERE n > 1 OR s IS NULL) FROM m""",
)
def dq_primary_key(spark: SparkSession, t: Tables) -> DataFrame:
    with_nulls = t("customer").selectExpr("c_custkey", "nullif(c_mktsegment, 'MACHINERY') AS segment")
    return (
        quality.primary_key_result(t("lineitem"), ["l_orderkey", "l_linenumber"])
        .unionByName(quality.primary_key_result(t("orders"), ["o_orderkey"]))
        .unionByName(quality.primary_key_result(with_nulls, ["c_custkey", "segment"]))
        .select(*RESULT)
    )


@query(
    "dq_unique_combo",
    """SELECT l_orderkey, nullif(l_returnflag, 'N') AS flag, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dq_unique_combo(spark: SparkSession, t: Tables) -> DataFrame:
    """The repeated combinations themselves, nulls counted as equal."""
    lines = t("lineitem").selectExpr("l_orderkey", "nullif(l_returnflag, 'N') AS flag")
    return quality.duplicate_keys(lines, ["l_orderkey", "flag"])


@query(
    "dq_unique_each",
    """WITH d AS (
         SELECT 'o_orderkey' AS c, count(*) AS n FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
         UNION ALL SELECT 'o_custkey', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)
         UNION ALL SELECT 'o_totalprice', count(*) FROM (SELECT 1 FROM orders GROUP BY o_totalprice HAVING count(*) > 1))
       SELECT 'unique' AS check_type, c AS check_details, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS result, n AS violations FROM d""",
)
def dq_unique_each(spark: SparkSession, t: Tables) -> DataFrame:
    return quality.unique_each_result(t("orders"), ["o_orderkey", "o_custkey", "o_totalprice"]).select(*RESULT)


@query(
    "dq_not_null",
    """WITH n AS (SELECT 'l_orderkey' AS c, count(*) FILTER (WHERE l_orderkey IS NULL) AS n FROM lineitem
         UNION ALL SELECT 'flag', count(*) FILTER (WHERE l_returnflag = 'N') FROM lineitem
         UNION ALL SELECT 'tax', count(*) FILTER (WHERE l_tax = 0) FROM lineitem)
       SELECT 'not_null' AS check_type, c AS check_details, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS result, n AS violations FROM n""",
)
def dq_not_null(spark: SparkSession, t: Tables) -> DataFrame:
    lines = t("lineitem").selectExpr(
        "l_orderkey", "nullif(l_returnflag, 'N') AS flag", "nullif(l_tax, 0d) AS tax"
    )
    return quality.not_null_result(lines, ["l_orderkey", "flag", "tax"]).select(*RESULT)


@query(
    "dq_referential",
    """SELECT cast(CASE WHEN o_totalprice > 490000 THEN NULL ELSE o_custkey END AS varchar) AS value, count(*) AS n_rows FROM orders
       WHERE o_orderstatus <> 'P' AND (o_totalprice > 490000 OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
       GROUP BY 1""",
)
def dq_referential(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t("orders").selectExpr(
        "o_orderstatus", "case when o_totalprice > 490000 then null else o_custkey end AS party"
    )
    missing = quality.missing_values(
        orders, "party", t("customer").where("c_acctbal > 0"), "c_custkey", "o_orderstatus <> 'P'"
    )
    return missing.select(F.col("value").cast("string").alias("value"), "n_rows")


GENERIC = {"columns": 1, "PK": ["o_orderkey"], "not_null": ["o_orderkey"]}
SPECIFIC = {
    "columns": 6,
    "unique": ["o_orderkey"],
    "not_null": ["o_custkey"],
    "referential_checks": [
        {"column": "o_custkey", "reference_table": "solvent", "reference_column": "c_custkey",
         "filter": "o_custkey is not null"},
    ],
}


def order_checks(t: Tables, expectations: dict, functional: bool) -> DataFrame:
    tables = frame_tables({"solvent": t("customer").where("c_acctbal > 0")}, t)
    return quality.run_checks(t("orders"), expectations, tables, functional)


MISSING_SQL = """(SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN
                   (SELECT c_custkey FROM customer WHERE c_acctbal > 0))"""


@query(
    "dq_run_all",
    f"""SELECT CASE WHEN {MISSING_SQL} = 0 THEN 'PASS' ELSE 'FAIL' END AS result, 6::BIGINT AS n_checks,
               CASE WHEN {MISSING_SQL} = 0 THEN 0::BIGINT ELSE 1::BIGINT END AS n_failed""",
)
def dq_run_all(spark: SparkSession, t: Tables) -> DataFrame:
    merged = quality.merge_expectations(GENERIC, SPECIFIC)
    return quality.overall(order_checks(t, merged, functional=True))


@query(
    "dq_generic_specific",
    """SELECT 'column_count' AS check_type, '6' AS check_details, 'PASS' AS result, 0::BIGINT AS violations
       UNION ALL SELECT 'primary_key', 'o_orderkey', 'PASS', count(*) - count(DISTINCT o_orderkey) FROM orders
       UNION ALL SELECT 'unique', 'o_orderkey', 'PASS', count(*) - count(DISTINCT o_orderkey) FROM orders
       UNION ALL SELECT 'not_null', 'o_orderkey', 'PASS', count(*) - count(o_orderkey) FROM orders
       UNION ALL SELECT 'not_null', 'o_custkey', 'PASS', count(*) - count(o_custkey) FROM orders""",
)
def dq_generic_specific(spark: SparkSession, t: Tables) -> DataFrame:
    files = {"staging/[]_orders": GENERIC, "staging/shop_orders": SPECIFIC}
    merged = quality.find_expectations(files, "staging", "shop_orders", "shop")
    return order_checks(t, merged, functional=False).select(*RESULT)


@query(
    "dq_log",
    f"""SELECT '199808' AS run_month, 'stg_orders' AS table_name, 'not_null' AS check_type, 'o_orderkey' AS check_details, 'PASS' AS result, '' AS error
          FROM (SELECT count(*) - count(o_orderkey) AS n FROM orders) WHERE n = 0
        UNION ALL SELECT '199808', 'stg_orders', 'referential', 'o_custkey in solvent.c_custkey', 'FAIL', {MISSING_SQL} || ' values not found'
        UNION ALL SELECT '199808', 'stg_empty', 'none', '', 'NA', ''""",
)
def dq_log(spark: SparkSession, t: Tables) -> DataFrame:
    expectations = {"not_null": ["o_orderkey"], "referential_checks": SPECIFIC["referential_checks"]}
    checked = quality.dq_log(order_checks(t, expectations, functional=True), "199808", "stg_orders")
    unchecked = quality.dq_log(quality.run_checks(t("customer"), {}), "199808", "stg_empty")
    return checked.unionByName(unchecked)


@query(
    "dq_gate",
    """SELECT c_custkey, c_name, 'open' AS gate FROM customer
       UNION ALL SELECT l_orderkey, l_returnflag, 'shut' FROM lineitem WHERE 1 = 0""",
)
def dq_gate(spark: SparkSession, t: Tables) -> DataFrame:
    """Customers pass their gate; lines must be stopped by theirs."""
    customers = t("customer")
    checks = {"PK": ["c_custkey"], "not_null": ["c_custkey", "c_name"]}
    through = quality.gate(customers, quality.run_checks(customers, checks), "customer")
    passed = through.select("c_custkey", "c_name", F.lit("open").alias("gate"))
    lines = t("lineitem")
    try:
        leaked = quality.gate(lines, quality.run_checks(lines, {"unique": ["l_orderkey"]}), "lineitem")
    except quality.QualityError:
        return passed
    return passed.union(leaked.select("l_orderkey", "l_returnflag", F.lit("shut").alias("gate")))
