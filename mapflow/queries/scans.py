"""Sources and sinks: every sink is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapflow.functions.amounts import exact_sum, hundredths
from mapflow.plans.mapping import run_mapping
from mapflow.queries.registry import query
from mapflow.session import scratch_path
from mapflow.sources import landing, sinks
from mapflow.sources.tables import Tables, local_rows, read_source, underscore_hyphens


def table_name(label: str) -> str:
    return f"mapflow_{label}_{uuid.uuid4().hex}"


@query(
    "src_filter_select",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
)
def src_filter_select(spark: SparkSession, t: Tables) -> DataFrame:
    return read_source(
        t,
        "orders",
        "O",
        filter="o_orderstatus = 'F' and o_totalprice > 100000",
        columns=["o_orderkey", "o_totalprice"],
    )


@query(
    "src_rename_hyphen",
    "SELECT o_orderkey AS order_key, o_custkey AS cust_key_id FROM orders WHERE o_orderstatus <> 'P'",
)
def src_rename_hyphen(spark: SparkSession, t: Tables) -> DataFrame:
    delivered = t("orders").withColumnsRenamed(
        {"o_orderkey": "order-key", "o_custkey": "cust-key-id"}
    )
    return underscore_hyphens(delivered).where("o_orderstatus <> 'P'").selectExpr(
        "order_key", "cust_key_id"
    )


@query(
    "src_csv",
    """SELECT cast(c_custkey AS varchar) AS c_custkey, c_name, c_mktsegment,
              cast(c_nationkey AS varchar) AS c_nationkey FROM customer""",
)
def src_csv(spark: SparkSession, t: Tables) -> DataFrame:
    path = scratch_path(spark, "csv")
    columns = ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"]
    t("customer").select(*columns).write.option("header", True).option("sep", ";").csv(path)
    return landing.read_delimited(spark, path, sep=";")


@query("src_parquet", "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 0")
def src_parquet(spark: SparkSession, t: Tables) -> DataFrame:
    path = scratch_path(spark, "landed")
    t("supplier").write.parquet(path)
    return landing.read_landed(spark, path).where("s_acctbal > 0").select(
        "s_suppkey", "s_name", "s_acctbal"
    )


def trigger_rows(t: Tables) -> DataFrame:
    """One delivery trigger per event; views have no consumer name."""
    return t("events").selectExpr(
        "nullif(concat('to_', event_type), 'to_view') AS dial_consumer_name",
        "event_type AS dial_source_system",
        "concat('user_', user_id) AS dial_source_file_name",
        "date_format(ts, 'yyyyMMdd') AS dial_source_file_snapshot_datetime",
        "cast(event_id AS string) AS dial_notification_datetime",
        "concat('landing/', event_type, '/', event_id) AS dial_target_file_full_path",
        "cast(event_id % 97 AS string) AS dial_target_file_row_count",
    )


TRIGGER_SQL = """SELECT nullif('to_' || event_type, 'to_view') AS dial_consumer_name,
  event_type AS dial_source_system, 'user_' || user_id AS dial_source_file_name,
  strftime(ts, '%Y%m%d') AS dial_source_file_snapshot_datetime,
  cast(event_id AS varchar) AS dial_notification_datetime,
  'landing/' || event_type || '/' || event_id AS dial_target_file_full_path,
  cast(event_id % 97 AS varchar) AS dial_target_file_row_count
  FROM events"""


@query("src_json_triggers", TRIGGER_SQL)
def src_json_triggers(spark: SparkSession, t: Tables) -> DataFrame:
    path = scratch_path(spark, "triggers")
    trigger_rows(t).write.json(path)
    return landing.read_triggers(spark, path)


@query("src_csv_schema", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def src_csv_schema(spark: SparkSession, t: Tables) -> DataFrame:
    path = scratch_path(spark, "metadata")
    schema = "p_partkey bigint, p_name string, p_size int, p_retailprice double"
    t("part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.option(
        "header", True
    ).csv(path)
    return landing.read_delimited(spark, path, schema=schema)


@query(
    "sink_land_parquet",
    """SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders""",
)
def sink_land_parquet(spark: SparkSession, t: Tables) -> DataFrame:
    delivered, landed = scratch_path(spark, "delivered"), scratch_path(spark, "landed")
    t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.option(
        "header", True
    ).option("sep", "|").csv(delivered)
    return spark.read.parquet(landing.land_parquet(spark, delivered, landed, "txt", sep="|"))


@query(
    "sink_overwrite_evolve",
    """SELECT c_custkey, c_mktsegment, c_acctbal,
              'added c_mktsegment,c_acctbal; removed c_name; retyped c_custkey' AS change FROM customer""",
)
def sink_overwrite_evolve(spark: SparkSession, t: Tables) -> DataFrame:
    name = table_name("evolve")
    old = t("customer").selectExpr("cast(c_custkey AS string) AS c_custkey", "c_name")
    sinks.overwrite_table(old, name, path=scratch_path(spark, "evolve"))
    new = t("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    change = sinks.overwrite_table(new, name, path=scratch_path(spark, "evolve"))
    text = "; ".join(f"{kind} {','.join(columns)}" for kind, columns in change.items())
    return spark.table(name).withColumn("change", F.lit(text))


@query(
    "sink_replace_self",
    """SELECT c_custkey, c_mktsegment, round(c_acctbal * 2) AS twice, 'added twice; removed c_acctbal; retyped ' AS change FROM customer WHERE c_acctbal > 0""",
)
def sink_replace_self(spark: SparkSession, t: Tables) -> DataFrame:
    """A table replaced by rows computed from itself."""
    name, folder = table_name("self"), scratch_path(spark, "self")
    sinks.replace_versioned(t("customer").select("c_custkey", "c_mktsegment", "c_acctbal"), name, folder)
    sinks.replace_versioned(spark.table(name).where("c_acctbal > 0"), name, folder, ["c_mktsegment"])
    doubled = spark.table(name).selectExpr("c_custkey", "c_mktsegment", "round(c_acctbal * 2) AS twice")
    change = sinks.replace_versioned(doubled, name, folder)
    text = "; ".join(f"{kind} {','.join(columns)}" for kind, columns in change.items())
    return spark.table(name).withColumn("change", F.lit(text))


@query(
    "sink_append_log",
    """SELECT event_id AS "RunID", 'staging' AS "Workflow", event_type AS "Component",
              CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Completed' END AS "Status"
       FROM events WHERE event_type IN ('error', 'signup')""",
)
def sink_append_log(spark: SparkSession, t: Tables) -> DataFrame:
    name = table_name("process_log")
    sinks.create_if_absent(
        spark, name, sinks.PROCESS_LOG_SCHEMA, path=scratch_path(spark, "process_log")
    )
    for kind, status in (("error", "Failed"), ("signup", "Completed")):
        records = t("events").where(F.col("event_type") == kind).select(
            F.col("event_id").alias("RunID"),
            F.col("ts").cast("timestamp").alias("Timestamp"),
            F.lit("staging").alias("Workflow"),
            F.col("event_type").alias("Component"),
            F.lit(None).alias("SourceSystem"),
            F.lit(status).alias("Status"),
            F.lit(None).alias("Comments"),
        )
        sinks.append_log(spark, records, name)
    return spark.table(name).select("RunID", "Workflow", "Component", "Status")


@query("sink_create_if_absent", "SELECT o_orderkey, o_orderstatus FROM orders")
def sink_create_if_absent(spark: SparkSession, t: Tables) -> DataFrame:
    name = table_name("status")
    schema = T.StructType(
        [T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())]
    )
    sinks.create_if_absent(spark, name, schema, path=scratch_path(spark, "status"))
    sinks.append_log(spark, t("orders"), name, schema)
    sinks.create_if_absent(spark, name, schema)
    return spark.table(name)


@query(
    "sink_export_parquet",
    """SELECT o_orderstatus, count(*) AS n_rows,
              cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS total FROM orders GROUP BY 1""",
)
def sink_export_parquet(spark: SparkSession, t: Tables) -> DataFrame:
    folder = scratch_path(spark, "export")
    if not sinks.export_parquet(t("orders"), folder, "orders", partition_by=["o_orderstatus"]):
        raise RuntimeError("export refused")
    return (
        spark.read.parquet(f"{folder}/orders.parquet")
        .groupBy("o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.expr(exact_sum(hundredths("o_totalprice"))).alias("total"),
        )
    )


@query(
    "sink_export_many",
    """SELECT 'customer' AS table_name, true AS exported, count(*) AS n_rows FROM customer
       UNION ALL SELECT 'broken', false, 0
       UNION ALL SELECT 'lineitem', true, count(*) FROM lineitem
       UNION ALL SELECT 'not_delivered', false, 0""",
)
def sink_export_many(spark: SparkSession, t: Tables) -> DataFrame:
    folder = scratch_path(spark, "export")
    broken = t("orders").select(F.expr("if(o_orderkey > 0, raise_error('unreadable'), 'x') AS x"))
    frames = {"customer": t("customer"), "broken": broken, "lineitem": t("lineitem"), "not_delivered": None}
    status = sinks.export_many(spark, frames, folder, {"lineitem": F.col("l_shipdate").cast("date")})
    counts = None
    for name in ("customer", "lineitem"):
        counted = spark.read.parquet(f"{folder}/{name}.parquet").agg(
            F.count(F.lit(1)).alias("n_rows")
        ).withColumn("table_name", F.lit(name))
        counts = counted if counts is None else counts.unionByName(counted)
    return status.join(counts, "table_name", "left").select(
        "table_name", "exported", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


@query(
    "export_manifest",
    """SELECT 'lineitem' AS table_name, count(*) AS record_count, 11 AS column_count,
              cast(min(cast(l_shipdate AS date)) AS varchar) AS snapshot_date, 1 AS hash_unchanged
       FROM lineitem""",
)
def export_manifest(spark: SparkSession, t: Tables) -> DataFrame:
    folder = scratch_path(spark, "manifest")
    day = F.col("l_shipdate").cast("date")
    sinks.export_parquet(t("lineitem"), folder, "lineitem")
    stored = spark.read.parquet(f"{folder}/lineitem.parquet")
    sinks.write_manifest(sinks.export_manifest(stored, "lineitem", day), folder, "lineitem")
    manifest = spark.read.json(f"{folder}/lineitem_manifest.json")
    source = sinks.export_manifest(t("lineitem"), "lineitem", day)
    return manifest.join(
        source.select("table_name", F.col("content_hash").alias("source_hash")), "table_name"
    ).select(
        "table_name",
        "record_count",
        F.col("column_count").cast("int").alias("column_count"),
        "snapshot_date",
        (F.col("content_hash") == F.col("source_hash")).cast("int").alias("hash_unchanged"),
    )


LINEAGE_MAPPING = {
    "sources": [{"alias": "O", "source": "orders"}],
    "expressions": {
        "order_id": "O.o_orderkey",
        "urgent_price": "case when O.o_orderpriority = '1-URGENT' then O.o_totalprice end",
        "customer_id": "O.o_custkey",
    },
}


@query(
    "sink_column_lineage",
    """SELECT 'order_id' AS column_name, 'O.o_orderkey' AS expression, count(o_orderkey) AS n_values FROM orders
       UNION ALL SELECT 'urgent_price', 'case when O.o_orderpriority = ''1-URGENT'' then O.o_totalprice end',
                        count(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) FROM orders
       UNION ALL SELECT 'customer_id', 'O.o_custkey', count(o_custkey) FROM orders""",
)
def sink_column_lineage(spark: SparkSession, t: Tables) -> DataFrame:
    name = table_name("lineage")
    target = sinks.with_comments(run_mapping(t, LINEAGE_MAPPING), LINEAGE_MAPPING["expressions"])
    sinks.overwrite_table(target, name, path=scratch_path(spark, "lineage"))
    sinks.comment_table(spark, name, "orders with their urgent price")
    stored = spark.table(name)
    counts = stored.agg(*[F.count(c).alias(c) for c in stored.columns]).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for c in stored.columns]
            )
        )
    )
    return sinks.column_lineage(spark, name).join(counts, "column_name")


@query(
    "sink_empty_like",
    """SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type, 0 AS n_rows, count(*) AS n_source_rows FROM orders
       UNION ALL SELECT 'o_totalprice', 'double', 0, count(*) FROM orders
       UNION ALL SELECT 'o_orderstatus', 'string', 0, count(*) FROM orders""",
)
def sink_empty_like(spark: SparkSession, t: Tables) -> DataFrame:
    name = table_name("empty")
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    sinks.create_empty_like(t("orders"), columns, name, path=scratch_path(spark, "empty"))
    empty = spark.table(name)
    schema = local_rows(spark, empty.dtypes, "column_name string, data_type string")
    stored = empty.agg(F.count(F.lit(1)).cast("int").alias("n_rows"))
    return schema.crossJoin(stored).crossJoin(t("orders").agg(F.count(F.lit(1)).alias("n_source_rows")))


@query(
    "delivery_inventory",
    """WITH files AS (
         SELECT event_id, 'landing/' || event_type || '/user_' || user_id
                || CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'error' THEN '.TXT' ELSE '.csv' END AS path
         FROM events),
       named AS (
         SELECT event_id, split_part(split_part(path, '/', 3), '.', 1) AS file_name,
                lower(split_part(split_part(path, '/', 3), '.', 2)) AS extension FROM files),
       expected AS (
         SELECT DISTINCT 'user_' || c_custkey AS name,
                CASE WHEN c_mktsegment = 'BUILDING' THEN 'txt' ELSE 'csv' END AS format
         FROM customer WHERE c_acctbal > 0)
       SELECT event_id, file_name, extension,
              CASE WHEN name IS NULL THEN 'UNKNOWN' WHEN format = extension THEN 'OK' ELSE 'WRONG_FORMAT' END AS verdict
       FROM named LEFT JOIN expected ON file_name = name""",
)
def delivery_inventory(spark: SparkSession, t: Tables) -> DataFrame:
    files = t("events").selectExpr(
        "event_id",
        """concat('landing/', event_type, '/user_', user_id,
                  case event_type when 'view' then '' when 'error' then '.TXT' else '.csv' end) AS path""",
    )
    expected = t("customer").where("c_acctbal > 0").selectExpr(
        "concat('user_', c_custkey) AS SourceFileName",
        "if(c_mktsegment = 'BUILDING', '.txt', '.csv') AS SourceFileFormat",
    )
    return landing.inventory(files, expected).select("event_id", "file_name", "extension", "verdict")
