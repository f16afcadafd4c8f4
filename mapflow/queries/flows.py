"""Whole mappings: from sources to a finished target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.functions.amounts import exact_sum, hundredths
from mapflow.functions.columns import entity_code
from mapflow.operators.windows import keep_first
from mapflow.plans.mapping import StepCounts, run_chain, run_mapping
from mapflow.plans.publish import publish
from mapflow.queries.registry import query
from mapflow.session import scratch_path
from mapflow.sources import sinks
from mapflow.sources.tables import Tables, frame_tables, local_rows

RUN_MAPPING = {
    "target": "int_{{ RUN_MONTH }}.segment_nation",
    "sources": [
        {"alias": "O", "source": "orders", "filter": "o_orderstatus <> 'P'",
         "columns": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]},
        {"alias": "C", "source": "customer"},
        {"alias": "N", "source": "nation"},
    ],
    "transformations": [
        {"join": {"left_source": "O", "right_source": "C", "condition": ["O.o_custkey = C.c_custkey"]}},
        {"join": {"right_source": "N", "condition": ["C.c_nationkey = N.n_nationkey"]}},
        {"add_variables": {"column_mapping": {
            "var_amount": hundredths("O.o_totalprice"),
            "var_urgent": "case when O.o_orderpriority = '1-URGENT' then var_amount end"}}},
        {"aggregation": {"alias": "A", "group": ["C.c_mktsegment", "N.n_name"], "column_mapping": {
            "n_orders": "count(*)", "amount": exact_sum("var_amount"), "urgent": exact_sum("var_urgent")}}},
    ],
    "expressions": {
        "run_month": "'{{ RUN_MONTH }}'",
        "segment": "A.c_mktsegment",
        "nation": "A.n_name",
        "n_orders": "A.n_orders",
        "amount": "A.amount",
        "urgent_share": "try_divide(A.urgent, A.amount)",
    },
    "filter_target": ["n_orders > 1 or amount > 100000", "A.c_mktsegment <> 'FURNITURE'"],
    "drop_duplicates": True,
}


@query(
    "mapping_run",
    """SELECT DISTINCT '199808' AS run_month, c_mktsegment AS segment, n_name AS nation, count(*) AS n_orders,
              cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS amount,
              cast(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN cast(o_totalprice AS decimal(18,2)) END) AS double)
                / cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS urgent_share
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       WHERE o_orderstatus <> 'P' AND c_mktsegment <> 'FURNITURE' GROUP BY 2, 3
       HAVING count(*) > 1 OR sum(o_totalprice) > 100000""",
)
def mapping_run(spark: SparkSession, t: Tables) -> DataFrame:
    target = run_mapping(t, RUN_MAPPING, run_month="199808")
    checks = {"PK": ["segment", "nation"], "not_null": ["run_month"]}
    return publish(target, scratch_path(spark, "mapping"), "segment_nation", checks)


CHAIN = [
    {
        "target": "int.step1",
        "sources": [
            {"alias": "C", "source": "customer"},
            {"alias": "O", "source": "orders", "filter": "o_orderstatus = 'F'"},
        ],
        "transformations": [
            {"aggregation": {"alias": "LAST", "source": "O", "group": ["O.o_custkey"], "column_mapping": {
                "rating": "max_by(O.o_orderpriority, struct(O.o_orderdate, O.o_orderkey))"}}},
            {"join": {"left_source": "C", "right_source": "LAST", "condition": ["C.c_custkey = LAST.o_custkey"]}},
        ],
        "expressions": {"party": "C.c_custkey", "nation": "C.c_nationkey", "rating": "LAST.rating"},
    },
    {
        "target": "int.step2",
        "sources": [{"alias": "S1", "source": "int.step1"}],
        "transformations": [
            {"aggregation": {"alias": "BEST", "group": ["S1.nation"], "column_mapping": {"best": "min(S1.rating)"}}},
            {"join": {"left_source": "S1", "right_source": "BEST", "condition": ["S1.nation = BEST.nation"]}},
        ],
        "expressions": {
            "party": "S1.party",
            "rating": "coalesce(S1.rating, BEST.best)",
            "origin": "case when S1.rating is not null then 'own' when BEST.best is not null then 'nation' end",
        },
    },
    {
        "target": "int.step3",
        "sources": [{"alias": "S2", "source": "int.step2"}, {"alias": "C", "source": "customer"}],
        "transformations": [
            {"join": {"left_source": "S2", "right_source": "C", "how": "inner", "condition": ["S2.party = C.c_custkey"]}},
        ],
        "expressions": {
            "party": "S2.party",
            "rating": "coalesce(S2.rating, '9-DEFAULT')",
            "origin": "coalesce(S2.origin, 'default')",
            "segment": "C.c_mktsegment",
        },
        "filter_target": ["C.c_acctbal > -500"],
    },
]


@query(
    "mapping_chain",
    """WITH s1 AS (SELECT c_custkey AS party, c_nationkey AS nation, rating FROM customer LEFT JOIN (
           SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS rating FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey),
         best AS (SELECT nation, min(rating) AS best FROM s1 GROUP BY 1)
       SELECT party, coalesce(rating, best, '9-DEFAULT') AS rating,
              CASE WHEN rating IS NOT NULL THEN 'own' WHEN best IS NOT NULL THEN 'nation' ELSE 'default' END AS origin, c_mktsegment AS segment
       FROM s1 LEFT JOIN best ON s1.nation = best.nation JOIN customer ON party = c_custkey WHERE c_acctbal > -500""",
)
def mapping_chain(spark: SparkSession, t: Tables) -> DataFrame:
    return run_chain(t, CHAIN)


# A target with two readers, whose targets meet again; listed out of order.
DIAMOND = [
    {
        "target": "int.customers",
        "sources": [{"alias": "S", "source": "int.spending"}, {"alias": "L", "source": "int.latest"}],
        "transformations": [{"join": {"left_source": "S", "right_source": "L", "condition": ["S.party = L.party"]}}],
        "expressions": {"party": "S.party", "spent": "S.spent", "latest": "L.latest", "top": "L.top"},
        "filter_target": ["spent > 1000"],
    },
    {
        "target": "int.spending",
        "sources": [{"alias": "B", "source": "int.bought"}],
        "transformations": [{"aggregation": {"alias": "A", "group": ["B.party"], "column_mapping": {"spent": "cast(sum(B.cents) as bigint)"}}}],
        "expressions": {"party": "A.party", "spent": "A.spent"},
    },
    {
        "target": "int.latest",
        "sources": [{"alias": "B", "source": "int.bought"}],
        "transformations": [{"aggregation": {"alias": "A", "group": ["B.party"], "column_mapping": {
            "latest": "max(B.day)", "top": "max(B.cents)"}}}],
        "expressions": {"party": "A.party", "latest": "A.latest", "top": "A.top"},
    },
    {
        "target": "int.bought",
        "sources": [{"alias": "O", "source": "orders", "filter": "o_orderstatus <> 'P'"},
                    {"alias": "C", "source": "customer", "columns": ["c_custkey", "c_acctbal"]}],
        "transformations": [{"join": {"left_source": "O", "right_source": "C", "how": "inner", "condition": ["O.o_custkey = C.c_custkey"]}}],
        "expressions": {"party": "C.c_custkey", "cents": "cast(round(O.o_totalprice * 100) as bigint)", "day": "cast(O.o_orderdate as date)"},
        "filter_target": ["C.c_acctbal > 0"],
    },
]


@query(
    "mapping_diamond",
    """WITH b AS (SELECT c_custkey AS party, cast(round(o_totalprice * 100) AS bigint) AS cents, cast(o_orderdate AS date) AS day
                  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' AND c_acctbal > 0)
       SELECT party, cast(sum(cents) AS bigint) AS spent, max(day) AS latest, max(cents) AS top FROM b GROUP BY 1 HAVING sum(cents) > 1000""",
)
def mapping_diamond(spark: SparkSession, t: Tables) -> DataFrame:
    """Four mappings in any order; what two of them read is computed once."""
    return run_chain(t, DIAMOND)


COUNTED = {
    "sources": [
        {"alias": "L", "source": "lineitem", "columns": ["l_orderkey", "l_quantity", "l_returnflag"]},
        {"alias": "O", "source": "orders", "columns": ["o_orderkey", "o_custkey", "o_orderstatus"]},
    ],
    "transformations": [
        {"filter": {"conditions": ["L.l_returnflag in ('A', 'R')", "L.l_quantity > 10"], "log_reductions": True}},
        {"join": {"right_source": "O", "how": "inner", "condition": ["L.l_orderkey = O.o_orderkey", "O.o_orderstatus = 'F'"]}},
        {"aggregation": {"alias": "A", "group": ["O.o_custkey"], "column_mapping": {"n": "count(*)"}}},
    ],
    "expressions": {"party": "A.o_custkey", "n": "A.n"},
    "filter_target": ["n > 3"],
}


@query(
    "mapping_step_counts",
    """WITH l AS (SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R')), f AS (SELECT * FROM l WHERE l_quantity > 10),
            j AS (SELECT o_custkey FROM f JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'),
            a AS (SELECT o_custkey, count(*) AS n FROM j GROUP BY 1)
       SELECT 0 AS place, 'filter' AS step, 'L.l_returnflag in (''A'', ''R'')' AS condition, count(*) AS n_rows FROM l
       UNION ALL SELECT 1, 'filter', 'L.l_quantity > 10', count(*) FROM f UNION ALL SELECT 2, 'filter', '', count(*) FROM f
       UNION ALL SELECT 3, 'join', '', count(*) FROM j UNION ALL SELECT 4, 'aggregation', '', count(*) FROM a
       UNION ALL SELECT 5, 'target', '', count(*) FROM a WHERE n > 3""",
)
def mapping_step_counts(spark: SparkSession, t: Tables) -> DataFrame:
    """Rows after every step and every condition, counted while the target is written."""
    counts = StepCounts()
    run_mapping(t, COUNTED, counts).write.parquet(scratch_path(spark, "counted"))
    return local_rows(spark, counts.rows(), "place int, step string, condition string, n_rows bigint")


@query(
    "mapping_all_entities",
    """SELECT n_name AS entity, lower(regexp_replace(n_name, '[^a-zA-Z0-9]', '', 'g')) AS delivery_entity,
              strftime(o_orderdate, '%Y%m') AS run_month, count(*) AS n_orders, max(o_totalprice) AS top_price
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""",
)
def mapping_all_entities(spark: SparkSession, t: Tables) -> DataFrame:
    """All entities and months in one job; both are columns, not parts of table names."""
    orders = t("orders").withColumn("run_month", F.date_format("o_orderdate", "yyyyMM"))
    entities = t("nation").withColumn("delivery_entity", entity_code(F.col("n_name")))
    mapping = {
        "sources": [
            {"alias": "O", "source": "orders_by_month"},
            {"alias": "C", "source": "customer", "columns": ["c_custkey", "c_nationkey"]},
            {"alias": "E", "source": "entities"},
        ],
        "transformations": [
            {"join": {"right_source": "C", "how": "inner", "condition": ["O.o_custkey = C.c_custkey"]}},
            {"join": {"right_source": "E", "how": "inner", "condition": ["C.c_nationkey = E.n_nationkey"]}},
            {"aggregation": {"alias": "A", "group": ["E.n_name", "E.delivery_entity", "O.run_month"],
                             "column_mapping": {"n_orders": "count(*)", "top_price": "max(O.o_totalprice)"}}},
        ],
        "expressions": {"entity": "A.n_name", "delivery_entity": "A.delivery_entity", "run_month": "A.run_month",
                        "n_orders": "A.n_orders", "top_price": "A.top_price"},
    }
    target = run_mapping(frame_tables({"orders_by_month": orders, "entities": entities}, t), mapping)
    return publish(
        target,
        scratch_path(spark, "entities"),
        "orders",
        {"PK": ["delivery_entity", "run_month"]},
        partition_by=["delivery_entity"],
    )


@query("mapping_no_steps", "SELECT s_suppkey AS id, upper(s_name) AS name FROM supplier WHERE s_acctbal > 0")
def mapping_no_steps(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [{"alias": "S", "source": "supplier", "filter": "s_acctbal > 0"}, {"alias": "N", "source": "nation"}],
            "expressions": {"id": "S.s_suppkey", "name": "upper(S.s_name)"},
        },
    )


# Exchange rates of the examples, per region; one region has none, one is zero.
RATES = [("AFRICA", 16.5), ("AMERICA", 1.25), ("ASIA", 0.0), ("EUROPE", 1.0)]
RATES_SQL = "(VALUES " + ", ".join(f"('{r}', {x}::double)" for r, x in RATES) + ") rates(area, rate)"


@query(
    "mapping_fx_normalize",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * (o_totalprice / nullif(rate, 0)) AS amount
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey LEFT JOIN {RATES_SQL} ON r_name = area""",
)
def mapping_fx_normalize(spark: SparkSession, t: Tables) -> DataFrame:
    tables = frame_tables({"rates": local_rows(spark, RATES, "area string, rate double")}, t)
    return run_mapping(
        tables,
        {
            "sources": [
                {"alias": "O", "source": "orders"},
                {"alias": "C", "source": "customer"},
                {"alias": "N", "source": "nation"},
                {"alias": "R", "source": "region"},
                {"alias": "FX", "source": "rates"},
            ],
            "transformations": [
                {"join": {"right_source": "C", "how": "inner", "condition": ["O.o_custkey = C.c_custkey"]}},
                {"join": {"right_source": "N", "how": "inner", "condition": ["C.c_nationkey = N.n_nationkey"]}},
                {"join": {"right_source": "R", "how": "inner", "condition": ["N.n_regionkey = R.r_regionkey"]}},
                {"join": {"right_source": "FX", "condition": ["R.r_name = FX.area"]}},
                {"add_variables": {"column_mapping": {
                    "var_sign": "case when O.o_orderstatus = 'F' then -1 else 1 end",
                    "var_amount": "try_divide(O.o_totalprice, FX.rate)"}}},
            ],
            "expressions": {"o_orderkey": "O.o_orderkey", "amount": "var_sign * var_amount"},
        },
    )


@query(
    "mapping_rating_waterfall",
    """WITH latest AS (
         SELECT o_custkey, o_orderstatus, o_orderpriority AS model, o_totalprice AS score, o_orderdate,
                row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
       SELECT c_custkey AS party,
         CASE WHEN f.score > 250000 THEN 'final' WHEN o.score IS NOT NULL THEN 'open' WHEN p.score IS NOT NULL THEN 'pending' ELSE 'none' END AS winner,
         CASE WHEN c_acctbal < 0 THEN 'D' WHEN f.score > 250000 THEN f.model WHEN o.score IS NOT NULL THEN o.model ELSE p.model END AS model,
         CASE WHEN f.score > 250000 THEN f.score WHEN o.score IS NOT NULL THEN o.score ELSE p.score END AS score
       FROM customer LEFT JOIN latest f ON c_custkey = f.o_custkey AND f.o_orderstatus = 'F' AND f.rn = 1
       LEFT JOIN latest o ON c_custkey = o.o_custkey AND o.o_orderstatus = 'O' AND o.rn = 1
       LEFT JOIN latest p ON c_custkey = p.o_custkey AND p.o_orderstatus = 'P' AND p.rn = 1""",
)
def mapping_rating_waterfall(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t("orders").select("o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate", "o_orderkey")
    latest = keep_first(orders, ["o_custkey", "o_orderstatus"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    # One row for each party and status is left; side by side they are one row for each party.
    statuses = {"f": "F", "o": "O", "p": "P"}
    best = latest.groupBy("o_custkey").agg(
        *[F.expr(f"max(o_orderpriority) filter (where o_orderstatus = '{s}') AS model_{n}") for n, s in statuses.items()],
        *[F.expr(f"max(o_totalprice) filter (where o_orderstatus = '{s}') AS score_{n}") for n, s in statuses.items()],
    )
    return run_mapping(
        frame_tables({"best": best}, t),
        {
            "sources": [{"alias": "C", "source": "customer"}, {"alias": "B", "source": "best"}],
            "transformations": [
                {"join": {"left_source": "C", "right_source": "B", "condition": ["C.c_custkey = B.o_custkey"]}},
                {"add_variables": {"column_mapping": {
                    "var_winner": """case when B.score_f > 250000 then 'final' when B.score_o is not null then 'open'
                                          when B.score_p is not null then 'pending' else 'none' end"""}}},
            ],
            "expressions": {
                "party": "C.c_custkey",
                "winner": "var_winner",
                "model": """case when C.c_acctbal < 0 then 'D' else case var_winner when 'final' then B.model_f
                            when 'open' then B.model_o else B.model_p end end""",
                "score": "case var_winner when 'final' then B.score_f when 'open' then B.score_o else B.score_p end",
            },
        },
    )


@query(
    "mapping_valuation",
    """WITH claims AS (SELECT l_orderkey AS k, cast(sum(cast(l_extendedprice AS decimal(18,2)) * cast(l_tax AS decimal(4,2))) AS double) AS claim,
                              cast(max(l_shipdate) AS date) AS last_ship FROM lineitem GROUP BY 1),
            v AS (SELECT o_orderkey, o_totalprice AS market, coalesce(claim, 0) AS claim, last_ship, cast(o_orderdate AS date) AS d, o_orderstatus
                  FROM orders LEFT JOIN claims ON o_orderkey = k)
       SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 WHEN last_ship IS NULL OR last_ship > d + 200 THEN least(market, 100000.0)
                 ELSE greatest(market - claim, 1000.0) END AS value,
              CASE WHEN o_orderstatus = 'F' THEN 'closed' WHEN last_ship IS NULL OR last_ship > d + 200 THEN 'capped' ELSE 'net' END AS tier FROM v""",
)
def mapping_valuation(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "O", "source": "orders"},
                {"alias": "L", "source": "lineitem", "columns": ["l_orderkey", "l_extendedprice", "l_tax", "l_shipdate"]},
            ],
            "transformations": [
                {"aggregation": {"alias": "CL", "source": "L", "group": ["L.l_orderkey"], "column_mapping": {
                    "claim": exact_sum(f"{hundredths('L.l_extendedprice')} * {hundredths('L.l_tax')}", 4),
                    "last_ship": "cast(max(L.l_shipdate) as date)"}}},
                {"join": {"left_source": "O", "right_source": "CL", "condition": ["O.o_orderkey = CL.l_orderkey"]}},
                {"add_variables": {"column_mapping": {
                    "var_late": "CL.last_ship is null or CL.last_ship > date_add(cast(O.o_orderdate as date), 200)",
                    "var_tier": "case when O.o_orderstatus = 'F' then 'closed' when var_late then 'capped' else 'net' end",
                    "var_net": "greatest(O.o_totalprice - coalesce(CL.claim, 0), 1000d)"}}},
            ],
            "expressions": {
                "o_orderkey": "O.o_orderkey",
                "tier": "var_tier",
                "value": "case tier when 'closed' then 0d when 'capped' then least(O.o_totalprice, 100000d) else var_net end",
            },
        },
    )


@query(
    "mapping_default_override",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE o_orderstatus END AS default_code,
              CASE WHEN l_returnflag <> 'N' THEN 'item' WHEN o_orderstatus IS NOT NULL THEN 'party' ELSE 'none' END AS origin
       FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') ON l_orderkey = o_orderkey""",
)
def mapping_default_override(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "L", "source": "lineitem",
                 "columns": ["l_orderkey", "l_linenumber", "l_partkey", "nullif(l_returnflag, 'N') as item_code"]},
                {"alias": "O", "source": "orders", "filter": "o_orderpriority <> '5-LOW'",
                 "columns": ["o_orderkey", "o_orderstatus"]},
            ],
            "transformations": [{"join": {"right_source": "O", "condition": ["L.l_orderkey = O.o_orderkey"]}}],
            "expressions": {
                "l_orderkey": "L.l_orderkey",
                "l_linenumber": "L.l_linenumber",
                "l_partkey": "L.l_partkey",
                "default_code": "coalesce(L.item_code, O.o_orderstatus)",
                "origin": "case when L.item_code is not null then 'item' when O.o_orderstatus is not null then 'party' else 'none' end",
            },
        },
    )


@query(
    "mapping_split_layout",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'npl' ELSE 'pl' END AS book, o_orderkey AS exposure_id, o_totalprice AS amount, 'EUR' AS currency FROM orders""",
)
def mapping_split_layout(spark: SparkSession, t: Tables) -> DataFrame:
    """Both books are written by one job into partitions and read back."""
    layout = run_mapping(
        t,
        {
            "sources": [{"alias": "O", "source": "orders"}],
            "expressions": {
                "exposure_id": "O.o_orderkey",
                "amount": "O.o_totalprice",
                "currency": "'EUR'",
                "note": "cast(null as string)",
                "book": "case when O.o_orderstatus = 'F' then 'npl' else 'pl' end",
            },
        },
    )
    folder = scratch_path(spark, "books")
    sinks.export_parquet(layout, folder, "exposure", partition_by=["book"])
    stored = spark.read.parquet(f"{folder}/exposure.parquet")
    return stored.select("book", "exposure_id", "amount", "currency")


@query(
    "mapping_synthetic_rows",
    """WITH parents AS (SELECT * FROM customer WHERE c_acctbal > 0)
       SELECT 'C' || c_custkey AS facility, c_mktsegment AS kind, 0 AS synthetic FROM parents
       UNION ALL SELECT 'DUMMY' || o_orderkey, 'UNKNOWN', 1 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM parents)""",
)
def mapping_synthetic_rows(spark: SparkSession, t: Tables) -> DataFrame:
    return run_mapping(
        t,
        {
            "sources": [
                {"alias": "P", "source": "customer", "filter": "c_acctbal > 0"},
                {"alias": "O", "source": "orders", "columns": ["o_orderkey", "o_custkey"]},
            ],
            "transformations": [
                {"join": {"left_source": "O", "right_source": "P", "how": "left_anti",
                          "condition": ["O.o_custkey = P.c_custkey"], "alias": "ORPHAN"}},
                {"union": {"alias": "ALL", "column_mapping": {
                    "P": {"facility": "concat('C', P.c_custkey)", "kind": "P.c_mktsegment", "synthetic": "0"},
                    "ORPHAN": {"facility": "concat('DUMMY', ORPHAN.o_orderkey)", "kind": "'UNKNOWN'", "synthetic": "1"}}}},
            ],
            "expressions": {"facility": "ALL.facility", "kind": "ALL.kind", "synthetic": "ALL.synthetic"},
        },
    )
