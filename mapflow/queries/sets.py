"""Unions and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.plans.delivery import merge_entities
from mapflow.plans.mapping import run_mapping
from mapflow.queries.registry import query
from mapflow.sources.tables import Tables


@query(
    "union_by_name",
    """SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def union_by_name(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "CLOSED", "source": "orders", "filter": "o_orderstatus = 'F'",
                 "columns": ["o_orderkey", "o_orderstatus"]},
                {"alias": "URGENT", "source": "orders", "filter": "o_orderpriority = '1-URGENT'",
                 "columns": ["o_orderstatus", "o_orderkey"]},
            ],
            "transformations": [{"union": {"alias": "ALL", "column_mapping": ["CLOSED", "URGENT"]}}],
            "expressions": {"order_id": "ALL.o_orderkey", "status": "ALL.o_orderstatus"},
        },
    )


@query(
    "union_missing_columns",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def union_missing_columns(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "C", "source": "customer",
                 "columns": ["c_custkey as id", "c_name as name", "c_mktsegment as segment"]},
                {"alias": "S", "source": "supplier", "columns": ["s_suppkey as id", "s_name as name"]},
            ],
            "transformations": [
                {"union": {"alias": "P", "column_mapping": ["C", "S"], "allow_missing_columns": True}}
            ],
            "expressions": {"id": "P.id", "name": "P.name", "segment": "P.segment"},
        },
    )


@query(
    "union_mapped",
    """SELECT 'customer' AS role, c_custkey AS id, upper(c_name) AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name, -s_acctbal FROM supplier""",
)
def union_mapped(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "C", "source": "customer"}, {"alias": "S", "source": "supplier"}],
            "transformations": [
                {
                    "union": {
                        "alias": "P",
                        "column_mapping": [
                            {"C": {"role": "'customer'", "id": "C.c_custkey", "name": "upper(C.c_name)",
                                   "balance": "C.c_acctbal"}},
                            {"S": {"name": "S.s_name", "role": "'supplier'", "id": "S.s_suppkey",
                                   "balance": "-S.s_acctbal"}},
                        ],
                    }
                }
            ],
            "expressions": {c: f"P.{c}" for c in ("role", "id", "name", "balance")},
        },
    )


@query(
    "union_entities",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'fr1' WHEN 'O' THEN 'be2' ELSE 'nl3' END AS delivery_entity,
              o_orderkey AS order_id, o_totalprice AS amount FROM orders""",
)
def union_entities(spark: SparkSession, t: Tables) -> DataFrame:
    deliveries = {
        entity: t("orders").where(F.col("o_orderstatus") == status).selectExpr(
            "o_orderkey AS order_id", "o_totalprice AS amount"
        )
        for entity, status in (("fr1", "F"), ("be2", "O"), ("nl3", "P"))
    }
    return merge_entities(deliveries)


@query(
    "set_union_all",
    """SELECT 'order' AS origin, cast(o_orderdate AS date) || '' AS day, count(*) AS n_rows FROM orders GROUP BY 2
       UNION ALL SELECT 'shipment', cast(l_shipdate AS date) || '', count(*) FROM lineitem GROUP BY 2""",
)
def set_union_all(spark: SparkSession, t: Tables) -> DataFrame:
    def per_day(table: str, column: str, origin: str) -> DataFrame:
        day = F.col(column).cast("date").cast("string").alias("day")
        return t(table).groupBy(day).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(origin).alias("origin"), "day", "n_rows"
        )

    return per_day("orders", "o_orderdate", "order").union(per_day("lineitem", "l_shipdate", "shipment"))


@query(
    "set_except",
    "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000",
)
def set_except(spark: SparkSession, t: Tables) -> DataFrame:
    buyers = t("orders").where("o_totalprice > 300000").selectExpr("o_custkey AS id")
    return t("customer").selectExpr("c_custkey AS id").subtract(buyers)
