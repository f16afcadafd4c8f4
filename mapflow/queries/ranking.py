"""Window-style questions, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.functions.amounts import exact_sum, hundredths
from mapflow.operators.aggregates import last_valid_value
from mapflow.operators.windows import (
    attach_distinct_count,
    attach_totals,
    keep_extreme,
    keep_first,
    number_rows,
)
from mapflow.queries.registry import query
from mapflow.sources.tables import Tables


@query(
    "win_latest_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
       WHERE rn = 1""",
)
def win_latest_per_key(spark: SparkSession, t: Tables) -> DataFrame:
    latest = keep_first(t("orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "win_rank_asc",
    """SELECT o_custkey, o_orderkey, cast(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS integer) AS rank
       FROM orders""",
)
def win_rank_asc(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    ranked = number_rows(orders, ["o_custkey"], [F.asc("o_totalprice"), F.asc("o_orderkey")], "rank")
    return ranked.drop("o_totalprice")


@query(
    "win_conditional_rank",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN cast(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS varchar) END AS rank
       FROM orders""",
)
def win_conditional_rank(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    ranked = number_rows(orders, ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")], "all_ranks")
    return ranked.select("o_orderkey", F.expr("case when o_orderstatus = 'F' then cast(all_ranks as string) end").alias("rank"))


@query(
    "win_max_filter_ties",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem
       JOIN (SELECT l_suppkey AS k, max(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_suppkey = k AND l_quantity = q""",
)
def win_max_filter_ties(spark: SparkSession, t: Tables) -> DataFrame:
    lines = t("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return keep_extreme(lines, ["l_suppkey"], "l_quantity")


@query(
    "win_min_over",
    "SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderstatus) AS lowest FROM orders",
)
def win_min_over(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return attach_totals(orders, ["o_custkey", "o_orderstatus"], {"lowest": F.min("o_orderkey")}).select(
        "o_orderkey", "lowest"
    )


@query(
    "win_sum_over",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
              cast(sum(cast(l_extendedprice AS decimal(18,2))) OVER (PARTITION BY l_orderkey) AS double)
                / count(*) OVER (PARTITION BY l_orderkey) AS even_share FROM lineitem""",
)
def win_sum_over(spark: SparkSession, t: Tables) -> DataFrame:
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    totals = {
        "total": F.expr(exact_sum(hundredths("l_extendedprice"))),
        "members": F.count(F.lit(1)),
    }
    return attach_totals(lines, ["l_orderkey"], totals).select(
        *lines.columns, (F.col("total") / F.col("members")).alias("even_share")
    )


@query(
    "win_distinct_size",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n AS suppliers,
              CASE WHEN n > 1 THEN 1 ELSE 0 END AS shared FROM lineitem
       JOIN (SELECT l_orderkey AS k, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) ON l_orderkey = k""",
)
def win_distinct_size(spark: SparkSession, t: Tables) -> DataFrame:
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    counted = attach_distinct_count(lines, ["l_orderkey"], F.col("l_suppkey"), "suppliers")
    return counted.withColumn("shared", (F.col("suppliers") > 1).cast("int"))


@query(
    "win_flag_most_recent",
    """SELECT o_orderkey, CASE WHEN o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey) THEN 1 ELSE 0 END AS is_latest,
              CASE WHEN o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey) THEN 1 ELSE 0 END AS is_lowest FROM orders""",
)
def win_flag_most_recent(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    totals = {"latest": F.max("o_orderdate"), "lowest": F.min("o_orderkey")}
    return attach_totals(orders, ["o_custkey"], totals).select(
        "o_orderkey",
        (F.col("o_orderdate") == F.col("latest")).cast("int").alias("is_latest"),
        (F.col("o_orderkey") == F.col("lowest")).cast("int").alias("is_lowest"),
    )


@query(
    "win_topn_per_group",
    """SELECT o_orderpriority, rank, o_orderkey, o_totalprice FROM (
         SELECT *, cast(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS integer) AS rank FROM orders)
       WHERE rank <= 5""",
)
def win_topn_per_group(spark: SparkSession, t: Tables) -> DataFrame:
    """The group key has five values: the rank limit before the shuffle matters."""
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return keep_first(t("orders"), ["o_orderpriority"], order, n=5, rank="rank").select(
        "o_orderpriority", "rank", "o_orderkey", "o_totalprice"
    )


@query(
    "win_last_valid_lookup",
    """SELECT o.o_orderkey, o.o_orderstatus,
         CASE WHEN o.o_orderstatus = 'O' THEN o.o_orderpriority
              ELSE coalesce(
                (SELECT h.o_orderpriority FROM orders h WHERE h.o_custkey = o.o_custkey AND h.o_orderstatus = 'O'
                 ORDER BY h.o_orderdate DESC, h.o_orderkey DESC LIMIT 1),
                (SELECT h.o_orderpriority FROM orders h WHERE h.o_custkey = o.o_custkey ORDER BY h.o_orderkey LIMIT 1)) END AS last_model
       FROM orders o""",
)
def win_last_valid_lookup(spark: SparkSession, t: Tables) -> DataFrame:
    return last_valid_value(
        t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"),
        ["o_custkey"],
        "o_orderpriority",
        F.col("o_orderstatus") == "O",
        ["o_orderdate", "o_orderkey"],
        "o_orderkey",
        "last_model",
    ).select("o_orderkey", "o_orderstatus", "last_model")


@query(
    "sort_multi",
    "SELECT o_orderstatus, o_totalprice, o_orderkey FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey",
)
def sort_multi(spark: SparkSession, t: Tables) -> DataFrame:
    return t("orders").select("o_orderstatus", "o_totalprice", "o_orderkey").orderBy(
        "o_orderstatus", F.desc("o_totalprice"), "o_orderkey"
    )


@query(
    "topk_groups",
    """SELECT l_suppkey, count(*) AS n_lines FROM lineitem GROUP BY 1 ORDER BY n_lines DESC, l_suppkey LIMIT 20""",
)
def topk_groups(spark: SparkSession, t: Tables) -> DataFrame:
    return (
        t("lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_lines"))
        .orderBy(F.desc("n_lines"), "l_suppkey").limit(20)
    )


@query(
    "sort_case",
    """SELECT o_orderkey, o_orderstatus FROM orders
       ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 3 END, o_orderkey DESC""",
)
def sort_case(spark: SparkSession, t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_orderstatus").orderBy(
        F.expr("case o_orderstatus when 'P' then 1 when 'F' then 2 else 3 end"), F.desc("o_orderkey")
    )


@query(
    "limit_filtered",
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def limit_filtered(spark: SparkSession, t: Tables) -> DataFrame:
    return (
        t("orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .select("o_orderkey", "o_orderpriority", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
    )
