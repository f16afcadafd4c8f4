"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.functions.amounts import hundredths
from mapflow.functions.columns import entity_code, is_entity_code
from mapflow.plans.mapping import filter_impact, run_mapping
from mapflow.queries.registry import query
from mapflow.sources.tables import Tables, local_rows


@query(
    "proj_target_expressions",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_no,
              cast(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2))) AS double) AS net_price,
              CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS state,
              cast(cast(l_shipdate AS date) AS varchar) AS ship_date FROM lineitem""",
)
def proj_target_expressions(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "L", "source": "lineitem"}],
            "expressions": {
                "order_id": "L.l_orderkey",
                "line_no": "L.l_linenumber",
                "net_price": f"{hundredths('L.l_extendedprice')} * {hundredths('1 - L.l_discount')} / 10000d",
                "state": "case when L.l_returnflag = 'R' then 'returned' else 'kept' end",
                "ship_date": "cast(cast(L.l_shipdate as date) as string)",
            },
        },
    )


@query(
    "proj_add_variables",
    """SELECT o_orderkey AS order_id,
              CASE WHEN o_totalprice >= 200000 THEN 'high' ELSE 'low' END AS size_class,
              CASE WHEN o_totalprice >= 200000 THEN 'high' ELSE 'low' END || '-' || substr(o_orderpriority, 1, 1) AS code,
              length(CASE WHEN o_totalprice >= 200000 THEN 'high' ELSE 'low' END || '-' || substr(o_orderpriority, 1, 1)) AS code_length
       FROM orders""",
)
def proj_add_variables(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "O", "source": "orders"}],
            "transformations": [
                {
                    "add_variables": {
                        "column_mapping": {
                            "var_class": "case when O.o_totalprice >= 200000 then 'high' else 'low' end",
                            "var_code": "concat(var_class, '-', substr(O.o_orderpriority, 1, 1))",
                            "var_length": "length(var_code)",
                        }
                    }
                }
            ],
            "expressions": {
                "order_id": "O.o_orderkey",
                "size_class": "var_class",
                "code": "var_code",
                "code_length": "cast(var_length as bigint)",
            },
        },
    )


@query(
    "proj_lateral_alias",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS closed_flag,
              CASE WHEN o_orderstatus = 'F' THEN 'EUR' ELSE o_orderpriority END AS currency FROM orders""",
)
def proj_lateral_alias(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "O", "source": "orders"}],
            "expressions": {
                "order_id": "O.o_orderkey",
                "closed_flag": "case when O.o_orderstatus = 'F' then 1 else 0 end",
                "currency": "case when closed_flag = 1 then 'EUR' else O.o_orderpriority end",
            },
        },
    )


@query(
    "proj_typed_nulls",
    """SELECT c_custkey AS party_id, 'N' AS flag, 0 AS priority, coalesce(cast(NULL AS varchar), '<null>') AS note,
              coalesce(cast(cast(NULL AS double) AS varchar), '<null>') AS rate,
              coalesce(cast(cast(NULL AS date) AS varchar), '<null>') AS end_date,
              'string,double,date,int' AS types FROM customer""",
)
def proj_typed_nulls(spark: SparkSession, t: Tables) -> DataFrame:
    layout = run_mapping(
        t,
        {
            "sources": [{"alias": "C", "source": "customer"}],
            "expressions": {
                "party_id": "C.c_custkey",
                "flag": "'N'",
                "priority": "0",
                "note": "cast(null as string)",
                "rate": "cast(null as double)",
                "end_date": "cast(null as date)",
                "level": "cast(null as integer)",
            },
        },
    )
    types = dict(layout.dtypes)
    return layout.select(
        "party_id",
        "flag",
        "priority",
        *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")).alias(c) for c in ("note", "rate", "end_date")],
        F.lit(",".join(types[c] for c in ("note", "rate", "end_date", "level"))).alias("types"),
    )


@query("proj_dynamic_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def proj_dynamic_columns(spark: SparkSession, t: Tables) -> DataFrame:
    wanted = local_rows(
        spark, [("lineitem", 1, "l_orderkey"), ("lineitem", 2, "l_linenumber"), ("lineitem", 3, "l_quantity"),
         ("lineitem", 4, "l_not_there"), ("orders", 1, "o_orderkey")],
        "table_name string, position int, column_name string",
    )
    data = t("lineitem")
    # As many names as the metadata lists for one table.
    names = [r["column_name"] for r in wanted.where("table_name = 'lineitem'").orderBy("position").collect()]
    return data.select(*[n for n in names if n in data.columns])


FILTERS = ["l_quantity > 10", "l_returnflag = 'R' or l_linestatus = 'O'", "l_discount < 0.08"]


@query(
    "filter_conjunction",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_quantity > 10 AND (l_returnflag = 'R' OR l_linestatus = 'O') AND l_discount < 0.08""",
)
def filter_conjunction(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "L", "source": "lineitem"}],
            "transformations": [{"filter": {"conditions": FILTERS, "alias": "KEPT"}}],
            "expressions": {c: f"KEPT.{c}" for c in ("l_orderkey", "l_linenumber", "l_quantity")},
        },
    )


@query(
    "filter_impact",
    """SELECT 0 AS step, 'input' AS condition, count(*) AS rows_left FROM lineitem
       UNION ALL SELECT 1, 'l_quantity > 10', count(*) FROM lineitem WHERE l_quantity > 10
       UNION ALL SELECT 2, 'l_returnflag = ''R'' or l_linestatus = ''O''', count(*) FROM lineitem
         WHERE l_quantity > 10 AND (l_returnflag = 'R' OR l_linestatus = 'O')
       UNION ALL SELECT 3, 'l_discount < 0.08', count(*) FROM lineitem
         WHERE l_quantity > 10 AND (l_returnflag = 'R' OR l_linestatus = 'O') AND l_discount < 0.08""",
)
def filter_impact_query(spark: SparkSession, t: Tables) -> DataFrame:
    return filter_impact(t("lineitem"), FILTERS)


@query(
    "filter_target",
    """SELECT o_orderkey AS order_id, o_totalprice AS price FROM orders
       WHERE (o_orderpriority = '1-URGENT' OR o_totalprice > 400000) AND o_orderstatus = 'O'""",
)
def filter_target(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "O", "source": "orders"}],
            "expressions": {"order_id": "O.o_orderkey", "price": "O.o_totalprice"},
            "filter_target": ["O.o_orderpriority = '1-URGENT' or price > 400000", "O.o_orderstatus = 'O'"],
        },
    )


@query(
    "filter_boolean_tree",
    """SELECT c_custkey, c_mktsegment FROM customer
       WHERE NOT (c_mktsegment <> 'BUILDING' AND c_acctbal < 5000 AND (c_nationkey < 20 OR c_acctbal < 0))""",
)
def filter_boolean_tree(spark: SparkSession, t: Tables) -> DataFrame:
    condition = """not (c_mktsegment <> 'BUILDING' and c_acctbal < 5000
                        and (c_nationkey < 20 or c_acctbal < 0))"""
    return t("customer").where(condition).select("c_custkey", "c_mktsegment")


@query(
    "pred_in_like_null",
    """SELECT p_partkey, p_brand, nullif(p_type, 'PROMO') AS p_type FROM part
       WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#12') AND p_size NOT IN (1, 2)
         AND p_name NOT LIKE 'small%' AND nullif(p_type, 'PROMO') IS NOT NULL AND p_type <> 'LARGE'
         AND (p_retailprice > 900)""",
)
def pred_in_like_null(spark: SparkSession, t: Tables) -> DataFrame:
    return (
        t("part")
        .selectExpr("p_partkey", "p_brand", "p_size", "p_name", "p_retailprice > 900 AS pricey",
                    "nullif(p_type, 'PROMO') AS p_type")
        .where("""p_brand in ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#12') and p_size not in (1, 2)
                  and p_name not like 'small%' and p_type is not null and p_type <> 'LARGE' and pricey is true""")
        .select("p_partkey", "p_brand", "p_type")
    )


@query("distinct_rows", "SELECT DISTINCT l_suppkey AS supplier_id, l_returnflag AS flag FROM lineitem")
def distinct_rows(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "L", "source": "lineitem"}],
            "expressions": {"supplier_id": "L.l_suppkey", "flag": "L.l_returnflag"},
            "drop_duplicates": True,
        },
    )


@query(
    "normalize_entity_code",
    """WITH codes AS (
         SELECT p_partkey, CASE WHEN p_size = 50 THEN NULL WHEN p_size < 10 THEN lower(p_type) ELSE p_brand || ' ' || p_name END AS code
         FROM part)
       SELECT p_partkey, code, lower(regexp_replace(code, '[^a-zA-Z0-9]', '', 'g')) AS entity,
              CASE WHEN code IS NULL OR code = lower(regexp_replace(code, '[^a-zA-Z0-9]', '', 'g')) THEN 1 ELSE 0 END AS is_standard
       FROM codes""",
)
def normalize_entity_code(spark: SparkSession, t: Tables) -> DataFrame:
    codes = t("part").selectExpr(
        "p_partkey",
        """case when p_size = 50 then null when p_size < 10 then lower(p_type)
                else concat(p_brand, ' ', p_name) end AS code""",
    )
    return codes.select(
        "*",
        entity_code(F.col("code")).alias("entity"),
        is_entity_code(F.col("code")).cast("int").alias("is_standard"),
    )
