"""Deliveries, status events, calendars and streams, made from the event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.functions import calendar
from mapflow.functions.columns import month_end
from mapflow.plans import delivery, evolve
from mapflow.queries.registry import query
from mapflow.queries.scans import TRIGGER_SQL, trigger_rows
from mapflow.session import durable, scratch_path
from mapflow.sources.tables import Tables, local_rows
from mapflow.streaming.intake import intake_triggers, keep_first_arrivals


def expected_deliveries(t: Tables) -> DataFrame:
    """Expected file and day of every sign-up, with a delivery step."""
    return (
        t("events").where("event_type = 'signup'")
        .groupBy(
            F.expr("concat('user_', user_id)").alias("SourceFileName"),
            F.date_format("ts", "yyyyMMdd").alias("SnapshotDate"),
        )
        .agg((F.min("event_id") % 9).cast("int").alias("FileDeliveryStep"))
        .withColumn("StgTableName", F.concat(F.lit("stg_"), "SourceFileName"))
    )


EXPECTED_SQL = """meta AS (SELECT 'user_' || user_id AS file, strftime(ts, '%Y%m%d') AS day, cast(min(event_id) % 9 AS integer) AS step
                    FROM events WHERE event_type = 'signup' GROUP BY 1, 2)"""
MATCH_SQL = f"""WITH trig AS ({TRIGGER_SQL}), {EXPECTED_SQL},
  matched AS (SELECT trig.*, file, 'stg_' || file AS stg,
      array_to_string([dial_consumer_name, dial_source_system, dial_source_file_name, dial_source_file_snapshot_datetime, dial_notification_datetime], '_') AS trigger_file_name
    FROM trig LEFT JOIN meta ON dial_source_file_name = file AND dial_source_file_snapshot_datetime = day AND step IN (0, 8))"""


@query(
    "delivery_match_triggers",
    f"{MATCH_SQL} SELECT trigger_file_name, file AS \"SourceFileName\", stg AS \"StgTableName\" FROM matched",
)
def delivery_match_triggers(spark: SparkSession, t: Tables) -> DataFrame:
    return delivery.match_triggers(trigger_rows(t), expected_deliveries(t)).select(
        "trigger_file_name", "SourceFileName", "StgTableName"
    )


@query(
    "delivery_split_matched",
    f"""{MATCH_SQL} SELECT DISTINCT CASE WHEN file IS NULL THEN 'archive' ELSE 'load' END AS target, trigger_file_name,
        dial_source_system, dial_source_file_name, dial_source_file_snapshot_datetime FROM matched""",
)
def delivery_split_matched(spark: SparkSession, t: Tables) -> DataFrame:
    return delivery.triggers_by_target(trigger_rows(t), expected_deliveries(t))


@query("delivery_trigger_name", f"{MATCH_SQL} SELECT dial_notification_datetime AS id, trigger_file_name FROM matched")
def delivery_trigger_name(spark: SparkSession, t: Tables) -> DataFrame:
    return trigger_rows(t).select(
        F.col("dial_notification_datetime").alias("id"), delivery.trigger_name().alias("trigger_file_name")
    )


@query(
    "delivery_row_count_check",
    """WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
            e AS (SELECT o_orderkey AS source, o_orderkey % 8 AS expected_rows, coalesce(n, 0) AS actual_rows FROM orders LEFT JOIN c ON o_orderkey = l_orderkey)
       SELECT *, CASE WHEN expected_rows = actual_rows THEN 'SUCCESS' ELSE 'FAILED' END AS result,
              CASE WHEN expected_rows = actual_rows THEN 'Expected and received ' || expected_rows || ' records'
                   ELSE 'Expected ' || expected_rows || ', received ' || actual_rows || ' records' END AS comment FROM e""",
)
def delivery_row_count_check(spark: SparkSession, t: Tables) -> DataFrame:
    announced = t("orders").selectExpr("o_orderkey AS source", "o_orderkey % 8 AS expected_rows")
    return delivery.row_count_check(t("lineitem"), "l_orderkey", announced)


def runs(t: Tables) -> DataFrame:
    """A run per order; orders of the same day share a run number, so ties occur."""
    return t("orders").selectExpr(
        "cast(date_format(o_orderdate, 'yyyyMMdd') as int) AS RunID",
        "o_orderpriority AS DeliveryEntity",
        "concat('T', o_custkey % 10) AS SSFTableName",
        "cast(last_day(cast(o_orderdate as date)) as string) AS FileReportingDate",
        "concat(o_orderkey, '_PAYLOAD.zip') AS FileName",
        "'2024Q2V1' AS XSDVersion",
        "o_orderstatus AS DeliverySet",
        "cast(o_orderkey % 3 as int) AS RedeliveryNumber",
    )


REPORTING_DATE = "1998-08-31"
LATEST_SQL = f"""r AS (
    SELECT cast(strftime(o_orderdate, '%Y%m%d') AS integer) AS run, o_orderpriority AS entity, 'T' || (o_custkey % 10) AS tab, *
    FROM orders WHERE last_day(cast(o_orderdate AS date)) = DATE '{REPORTING_DATE}'),
  latest AS (SELECT * FROM (SELECT *, max(run) OVER (PARTITION BY entity, tab) AS m FROM r) WHERE run = m)"""


@query(
    "delivery_latest_run",
    f"""WITH {LATEST_SQL} SELECT run AS "RunID", entity AS "DeliveryEntity", tab AS "SSFTableName", o_orderkey || '_PAYLOAD.zip' AS "FileName" FROM latest""",
)
def delivery_latest_run(spark: SparkSession, t: Tables) -> DataFrame:
    return delivery.latest_runs(runs(t), REPORTING_DATE).select(
        "RunID", "DeliveryEntity", "SSFTableName", "FileName"
    )


def expected_entities(t: Tables) -> DataFrame:
    """Entities and tables expected, in another spelling, from large orders."""
    return (
        t("orders").where("o_totalprice > 498000")
        .selectExpr("concat(' ', lower(o_orderpriority)) AS DeliveryEntity",
                    "concat('t', o_custkey % 10) AS SSFTableName", "'Facility' AS SSFEntityName",
                    "'Expected' AS FileDeliveryStatus", "0 AS FileDeliveryStep")
        .distinct()
    )


AVAILABLE_SQL = f"""WITH {LATEST_SQL},
  e AS (SELECT DISTINCT lower(o_orderpriority) AS entity, 't' || (o_custkey % 10) AS tab FROM orders WHERE o_totalprice > 498000),
  available AS (SELECT latest.*, o_orderkey || '_' AS stem, o_orderkey || '__2024Q2V1_' || o_orderstatus || '_' || (o_orderkey % 3) AS parquet
                FROM latest JOIN e ON lower(latest.entity) = e.entity AND lower(latest.tab) = e.tab)"""


@query(
    "delivery_available_expected",
    f"""{AVAILABLE_SQL} SELECT entity AS "DeliveryEntity", tab AS "SSFTableName", stem AS "FileName", parquet AS "FileNameParquet",
        'Facility' AS "SSFEntityName" FROM available""",
)
def delivery_available_expected(spark: SparkSession, t: Tables) -> DataFrame:
    latest = delivery.latest_runs(runs(t), REPORTING_DATE)
    return delivery.available_files(latest, expected_entities(t)).select(
        "DeliveryEntity", "SSFTableName", "FileName", "FileNameParquet", "SSFEntityName"
    )


@query("delivery_updated_entities", f"""{AVAILABLE_SQL} SELECT DISTINCT entity AS "DeliveryEntity" FROM available""")
def delivery_updated_entities(spark: SparkSession, t: Tables) -> DataFrame:
    latest = delivery.latest_runs(runs(t), REPORTING_DATE)
    return delivery.updated_entities(delivery.available_files(latest, expected_entities(t)))


# Attribute list of two schema versions: table, attribute, version, custom flag.
ATTRIBUTES = [
    ("orders", "O_OrderKey", "2024Q2V1", False),
    ("orders", "O_TotalPrice", "2024Q2V1", False),
    ("orders", "O_OrderPriority", "2024Q2V1", False),
    ("orders", "O_Clerk_Custom", "2024Q2V1", True),
    ("orders", "O_OrderKey", "2023Q1V1", False),
    ("customer", "C_CustKey", "2024Q2V1", False),
]


@query(
    "extract_by_attribute_list",
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
)
def extract_by_attribute_list(spark: SparkSession, t: Tables) -> DataFrame:
    listed = local_rows(
        spark, ATTRIBUTES, "SSFTableName string, AttributeName string, XSDVersion string, custom boolean"
    )
    wanted = evolve.attributes_per_table(listed.where("XSDVersion = '2024Q2V1' and not custom"))
    # One row: the attribute names of one table.
    names = wanted.where("SSFTableName = 'orders'").first()["attributes"]
    delivered = t("orders").where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
    return evolve.project_attributes(delivered, names)


# Each change starts from a delivered version; orders came in two, and none in the third.
CHANGES = [
    {"ChangeType": "Add", "NewEntityName": "orders", "NewAttributeName": "channel"},
    {"ChangeType": "Rename", "NewEntityName": "orders", "OldAttributeName": "o_orderpriority", "NewAttributeName": "priority"},
    {"ChangeType": "Remove", "NewEntityName": "orders", "OldAttributeName": "o_orderdate"},
    {"ChangeType": "Move", "NewEntityName": "orders", "OldEntityName": "customer", "NewAttributeName": "segment",
     "OldAttributeName": "C_MktSegment", "NewEntityKey": "party", "OldEntityKey": "c_name"},
    {"ChangeType": "Remove", "NewEntityName": "orders", "OldAttributeName": "never_there"},
    {"ChangeType": "Add", "NewEntityName": "not_delivered", "NewAttributeName": "x"},
]


@query(
    "schema_evolve",
    """SELECT o_orderkey, o_orderpriority AS priority, c_mktsegment AS segment, 'none' AS channel,
              'Added channel; Renamed o_orderpriority to priority; Removed o_orderdate; Moved customer.C_MktSegment to orders.segment; Skipped: no column never_there' AS changes
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def schema_evolve(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t("orders").withColumn(
        "party", F.expr("concat('CUSTOMER#', lpad(cast(o_custkey as string), 9, '0'))")
    )
    listed = [
        {"OldXSDVersion": version, "Place": place, **change}
        for version, changes in (("V1", CHANGES[:2]), ("V2", CHANGES[2:]), ("V3", [{"ChangeType": "Remove", "NewEntityName": "orders", "OldAttributeName": "o_orderkey"}]))
        for place, change in enumerate(changes)
    ]
    names = list(dict.fromkeys(n for change in listed for n in change))
    kinds = ", ".join(f"{n} {'int' if n == 'Place' else 'string'}" for n in names)
    table = local_rows(spark, [[change.get(n) for n in names] for change in listed], kinds)
    delivered = t("orders").selectExpr("case when o_orderkey % 2 = 0 then 'V1' else 'V2' end AS XSDVersion")
    # The change table is metadata: as many rows as the schema has changed.
    changes = [r.asDict() for r in evolve.changes_since(table, delivered).orderBy("OldXSDVersion", "Place").collect()]
    twice = t("customer").unionByName(t("customer").where("c_custkey % 5 = 0"))
    done, texts = evolve.evolve_tables({"orders": orders, "customer": twice}, changes)
    return done["orders"].select(
        "o_orderkey",
        "priority",
        "segment",
        F.coalesce("channel", F.lit("none")).alias("channel"),
        F.lit("; ".join(texts["orders"])).alias("changes"),
    )


@query(
    "schema_latest_version",
    """WITH a AS (SELECT o_orderpriority AS tab, 'attr_' || o_custkey AS attr, o_orderstatus || year(o_orderdate) AS version FROM orders)
       SELECT tab AS "SSFTableName", attr AS "AttributeName", version AS "XSDVersion" FROM a
       WHERE version = (SELECT max(b.version) FROM a b WHERE b.tab = a.tab)""",
)
def schema_latest_version(spark: SparkSession, t: Tables) -> DataFrame:
    attributes = t("orders").selectExpr(
        "o_orderpriority AS SSFTableName", "concat('attr_', o_custkey) AS AttributeName",
        "concat(o_orderstatus, year(o_orderdate)) AS XSDVersion",
    )
    return evolve.latest_version(attributes)


def status_events(t: Tables) -> DataFrame:
    return t("events").selectExpr(
        "event_id", "ts", "concat('user_', user_id) AS SourceFileName", "event_type AS SourceSystem",
        "cast(event_id % 9 as int) AS FileDeliveryStep", "event_id % 5 AS DeliveryNumber",
    )


@query(
    "status_transition",
    """SELECT file AS "SourceFileName", step AS "FileDeliveryStep", event_id FROM (
         SELECT 'user_' || user_id AS file, cast(event_id % 9 AS integer) AS step, event_id,
                row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def status_transition(spark: SparkSession, t: Tables) -> DataFrame:
    return delivery.current_status(status_events(t), ["SourceFileName"], ["ts", "event_id"]).select(
        "SourceFileName", "FileDeliveryStep", "event_id"
    )


@query(
    "status_delivery_number",
    """WITH expected AS (SELECT 'user_' || c_custkey AS file FROM customer WHERE c_acctbal > 0),
            steps AS (SELECT 'user_' || user_id AS file, max(event_id % 5) AS n FROM events WHERE event_id % 9 = 3 GROUP BY 1)
       SELECT expected.file AS "SourceFileName", coalesce(n, 0) AS "DeliveryNumber" FROM expected LEFT JOIN steps ON expected.file = steps.file""",
)
def status_delivery_number(spark: SparkSession, t: Tables) -> DataFrame:
    expected = t("customer").where("c_acctbal > 0").selectExpr("concat('user_', c_custkey) AS SourceFileName")
    log = status_events(t).where("FileDeliveryStep = 3")
    return delivery.delivery_number(expected, log, ["SourceFileName"])


@query(
    "status_dimension",
    """SELECT CASE event_type WHEN 'click' THEN 'trigger' WHEN 'view' THEN 'flat' ELSE 'view' END AS flow,
              cast(event_id % 9 AS integer) AS step,
              CASE event_id % 9 WHEN 0 THEN 'Expected' WHEN 5 THEN 'Loaded Staging table' WHEN 6 THEN 'Checked Data Quality'
                WHEN 7 THEN 'Completed' WHEN 8 THEN 'Redelivery expected'
                WHEN 1 THEN CASE event_type WHEN 'click' THEN 'Extracted raw parquet data' WHEN 'view' THEN 'Received / Placed' ELSE 'Extracted data from view' END
                WHEN 2 THEN CASE event_type WHEN 'click' THEN 'Validated expected count' WHEN 'view' THEN 'Initial checks done' ELSE 'Completeness checked' END
                WHEN 3 THEN CASE event_type WHEN 'click' THEN 'Copied parquet to storage account' WHEN 'view' THEN 'Converted to Parquet' ELSE 'Exported to Parquet' END
                ELSE CASE event_type WHEN 'click' THEN 'Moved JSON trigger file' WHEN 'view' THEN 'Moved source file' ELSE 'XSD converted to latest version' END
              END AS description, count(*) AS n_events FROM events GROUP BY 1, 2, 3""",
)
def status_dimension(spark: SparkSession, t: Tables) -> DataFrame:
    counted = t("events").groupBy(
        F.expr("case event_type when 'click' then 'trigger' when 'view' then 'flat' else 'view' end").alias("flow"),
        F.expr("cast(event_id % 9 as int)").alias("step"),
    ).agg(F.count(F.lit(1)).alias("n_events"))
    return counted.join(delivery.status_dimension(spark), ["flow", "step"])


# A file per customer: system from the segment, deadline from the balance.
FILES_SQL = """files AS (SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'ledger' WHEN 'MACHINERY' THEN 'RATES' ELSE 'reference' END AS system,
    'file_' || c_custkey AS file, CASE WHEN c_acctbal > 0 THEN '1998-0' || (1 + c_nationkey % 9) || '-15' END AS deadline FROM customer),
  got AS (SELECT DISTINCT 'file_' || o_custkey AS file FROM orders WHERE o_totalprice > 350000),
  missing AS (SELECT * FROM files WHERE deadline <= '1998-06-15' AND file NOT IN (SELECT file FROM got))"""


def expected_files(t: Tables) -> DataFrame:
    return t("customer").selectExpr(
        "case c_mktsegment when 'BUILDING' then 'ledger' when 'MACHINERY' then 'RATES' else 'reference' end AS SourceSystem",
        "concat('file_', c_custkey) AS SourceFileName",
        "case when c_acctbal > 0 then concat('1998-0', 1 + c_nationkey % 9, '-15') end AS Deadline",
    )


def missing_files(t: Tables) -> DataFrame:
    delivered = t("orders").where("o_totalprice > 350000").selectExpr("concat('file_', o_custkey) AS SourceFileName")
    systems = expected_files(t).select("SourceSystem", "SourceFileName")
    return delivery.missing_after_deadline(
        expected_files(t), delivered.join(systems, "SourceFileName"), "1998-06-15", critical=["Ledger", "rates"]
    )


@query(
    "deadline_missing",
    f"""WITH {FILES_SQL} SELECT system AS "SourceSystem", file AS "SourceFileName", deadline AS "Deadline",
        CASE WHEN system IN ('ledger', 'RATES') THEN 1 ELSE 0 END AS is_critical FROM missing""",
)
def deadline_missing(spark: SparkSession, t: Tables) -> DataFrame:
    return missing_files(t)


@query(
    "static_carry_forward",
    f"""WITH {FILES_SQL}, p AS (SELECT 'file_' || o_custkey AS file, max('processed/' || strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey) AS path FROM orders GROUP BY 1)
        SELECT missing.file AS "SourceFileName", path AS carried_path,
               CASE WHEN path IS NULL THEN 'no processed version' ELSE 'carried' END AS carry_status
        FROM missing LEFT JOIN p ON missing.file = p.file WHERE system = 'reference'""",
)
def static_carry_forward(spark: SparkSession, t: Tables) -> DataFrame:
    processed = t("orders").selectExpr(
        # Two spellings of a processed version: dated with an extension, and plain.
        """case when o_orderkey % 3 = 0 then concat('file_', o_custkey)
                else concat('file_', o_custkey, '_', date_format(o_orderdate, 'yyyyMMdd'), '.txt') end AS SourceFileName""",
        "concat('processed/', date_format(o_orderdate, 'yyyyMMdd'), '_', o_orderkey) AS path",
    )
    static = missing_files(t).where("SourceSystem = 'reference'")
    return delivery.carry_forward(static, processed).select("SourceFileName", "carried_path", "carry_status")


@query(
    "deadline_delayed",
    """SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS "SnapshotDate", 'file_' || o_custkey AS "SourceFileName" FROM orders
       WHERE o_orderkey % 9 <> 7 AND epoch(TIMESTAMP '1998-06-02 13:00:00' - o_orderdate) / 3600 > 36""",
)
def deadline_delayed(spark: SparkSession, t: Tables) -> DataFrame:
    meta = t("orders").selectExpr(
        "date_format(o_orderdate, 'yyyy-MM-dd') AS SnapshotDate", "concat('file_', o_custkey) AS SourceFileName",
        "o_orderkey % 9 AS FileDeliveryStep",
    )
    return delivery.delayed(meta, "1998-06-02 13:00:00")


@query(
    "delivery_expected_status",
    "SELECT event_id, CASE WHEN event_id % 9 IN (0, 8) THEN 1 ELSE 0 END AS is_open FROM events",
)
def delivery_expected_status(spark: SparkSession, t: Tables) -> DataFrame:
    return status_events(t).select(
        "event_id", delivery.is_open(F.col("FileDeliveryStep")).cast("int").alias("is_open")
    )


@query(
    "delivery_missing_tables",
    """WITH p AS (SELECT DISTINCT o_custkey AS entity, o_orderpriority AS table_name FROM orders)
       SELECT e.entity, n.table_name FROM (SELECT DISTINCT entity FROM p) e CROSS JOIN (SELECT DISTINCT table_name FROM p) n
       EXCEPT SELECT entity, table_name FROM p""",
)
def delivery_missing_tables(spark: SparkSession, t: Tables) -> DataFrame:
    return delivery.missing_tables(
        t("orders").selectExpr("o_custkey AS entity", "o_orderpriority AS table_name")
    )


@query(
    "process_log_summary",
    """WITH e AS (SELECT user_id AS run_id, event_type AS component, ts, event_id,
                    CASE WHEN value > 300 THEN 'Failed' WHEN event_id % 7 = 0 THEN 'Started' ELSE 'Completed' END AS status FROM events),
            l AS (SELECT *, row_number() OVER (PARTITION BY run_id, component ORDER BY ts DESC, event_id DESC) AS rn,
                    max(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END) OVER (PARTITION BY run_id) AS failed FROM e),
            c AS (SELECT * FROM l WHERE rn = 1)
       SELECT run_id, component, status AS last_status,
              CASE WHEN failed = 1 THEN 'Failed' WHEN run_id IN (SELECT run_id FROM c WHERE status = 'Started') THEN 'Running' ELSE 'Completed' END AS run_status
       FROM c""",
)
def process_log_summary(spark: SparkSession, t: Tables) -> DataFrame:
    events = t("events").selectExpr(
        "user_id AS run_id", "event_type AS component", "ts", "event_id",
        "case when value > 300 then 'Failed' when event_id % 7 = 0 then 'Started' else 'Completed' end AS status",
    )
    return delivery.run_summary(events)


@query(
    "log_values_default",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END, c_mktsegment) AS label,
              coalesce(CASE WHEN o_totalprice > 100000 THEN o_totalprice END, c_acctbal) AS amount
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 100) ON o_custkey = c_custkey""",
)
def log_values_default(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t("orders").selectExpr(
        "o_orderkey", "o_custkey AS party", "case when o_orderstatus <> 'F' then o_orderpriority end AS label",
        "case when o_totalprice > 100000 then o_totalprice end AS amount",
    )
    lookup = t("customer").where("c_acctbal > 100").selectExpr(
        "c_custkey AS party", "c_mktsegment AS label", "c_acctbal AS amount"
    )
    return delivery.with_defaults(rows, lookup, "party", ["label", "amount"]).select("o_orderkey", "label", "amount")


# The holidays of the years in the tables, written out as an independent check.
HOLIDAYS_SQL = """hol AS (
    SELECT make_date(y, m, d) AS h FROM (SELECT unnest(range(1995, 2003)) AS y), (VALUES (1, 1), (5, 5), (12, 25), (12, 26)) f(m, d)
    UNION SELECT e + o FROM (VALUES (DATE '1995-04-16'), (DATE '1996-04-07'), (DATE '1997-03-30'), (DATE '1998-04-12'),
                                    (DATE '1999-04-04'), (DATE '2000-04-23'), (DATE '2001-04-15'), (DATE '2002-03-31')) x(e),
                             (VALUES (-2), (0), (1), (39), (49), (50)) z(o)
    UNION SELECT make_date(y, 4, CASE WHEN isodow(make_date(y, 4, 30)) = 7 THEN 29 ELSE 30 END) FROM (SELECT unnest(range(1995, 2003)) AS y)),
  months AS (SELECT cast(date_trunc('month', o_orderdate) AS date) AS month, count(*) AS n_orders FROM orders GROUP BY 1),
  days AS (SELECT month, n_orders, unnest(generate_series(month, month + INTERVAL 2 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY))::date AS day FROM months),
  open AS (SELECT * FROM days WHERE day NOT IN (SELECT h FROM hol))"""


def order_months(t: Tables) -> DataFrame:
    return t("orders").groupBy(F.to_date(F.date_trunc("month", F.col("o_orderdate"))).alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


def holidays_of(months: DataFrame) -> DataFrame:
    """Holidays of the years of some months and of the years after."""
    years = months.select("month").distinct().select(F.explode(F.array(F.year("month"), F.year("month") + 1)).alias("y"))
    return calendar.dutch_holidays(years)


def with_orders(dates: DataFrame, months: DataFrame) -> DataFrame:
    return dates.join(months, "month").select(
        F.col("month").cast("string").alias("month"), F.col("snapshot_date").cast("string").alias("snapshot_date"), "n_orders"
    )


def calendar_sql(pick: str, condition: str) -> str:
    return f"""WITH {HOLIDAYS_SQL} SELECT cast(month AS varchar) AS month, cast({pick}(day) AS varchar) AS snapshot_date, any_value(n_orders) AS n_orders
               FROM open WHERE {condition} GROUP BY month"""


SAME_MONTH = "date_trunc('month', day) = month"


@query("cal_last_business_day", calendar_sql("max", f"{SAME_MONTH} AND isodow(day) <= 5"))
def cal_last_business_day(spark: SparkSession, t: Tables) -> DataFrame:
    months = order_months(t)
    return with_orders(calendar.last_business_day(months, holidays_of(months)), months)


@query("cal_first_business_day_next", calendar_sql("min", "date_trunc('month', day) <> month AND isodow(day) <= 5"))
def cal_first_business_day_next(spark: SparkSession, t: Tables) -> DataFrame:
    months = order_months(t)
    return with_orders(calendar.first_business_day_next(months, holidays_of(months)), months)


@query("cal_last_weekday", calendar_sql("max", f"{SAME_MONTH} AND isodow(day) = 5"))
def cal_last_weekday(spark: SparkSession, t: Tables) -> DataFrame:
    months = order_months(t)
    return with_orders(calendar.last_weekday(months, holidays_of(months), 4), months)


@query(
    "cal_snapshot_date",
    f"""WITH {HOLIDAYS_SQL},
      picked AS (
        SELECT month, 'M-1' AS schedule, max(day) AS d FROM open WHERE {SAME_MONTH} AND isodow(day) <= 5 GROUP BY 1
        UNION ALL SELECT month, 'M+1', min(day) FROM open WHERE NOT ({SAME_MONTH}) AND isodow(day) <= 5 GROUP BY 1
        UNION ALL SELECT month, 'M-F', max(day) FROM open WHERE {SAME_MONTH} AND isodow(day) = 5 GROUP BY 1
        UNION ALL SELECT month, 'M-T', max(day) FROM open WHERE {SAME_MONTH} AND isodow(day) = 2 GROUP BY 1),
      s AS (SELECT o_orderkey, cast(date_trunc('month', o_orderdate) AS date) AS month,
              CASE o_orderpriority WHEN '1-URGENT' THEN 'M-1' WHEN '2-HIGH' THEN 'M+1' WHEN '3-MEDIUM' THEN 'M-F' WHEN '5-LOW' THEN 'M-T' ELSE 'M+2' END AS schedule FROM orders)
      SELECT o_orderkey, s.schedule, coalesce(cast(d AS varchar), '') AS "SnapshotDate" FROM s LEFT JOIN picked ON s.month = picked.month AND s.schedule = picked.schedule""",
)
def cal_snapshot_date(spark: SparkSession, t: Tables) -> DataFrame:
    schedules = t("orders").select(
        "o_orderkey",
        F.to_date(F.date_trunc("month", F.col("o_orderdate"))).alias("month"),
        F.expr(
            """case o_orderpriority when '1-URGENT' then 'M-1' when '2-HIGH' then 'M+1' when '3-MEDIUM' then 'M-F'
               when '5-LOW' then 'M-T' else 'M+2' end"""
        ).alias("schedule"),
    )
    months = durable(schedules.select("month").distinct())  # a few rows, used for days and holidays
    return calendar.snapshot_dates(schedules, holidays_of(months), months).drop("month")


@query(
    "cal_month_end",
    "SELECT o_orderkey, cast(last_day(cast(o_orderdate AS date)) AS varchar) AS month_end FROM orders",
)
def cal_month_end(spark: SparkSession, t: Tables) -> DataFrame:
    return t("orders").select(
        "o_orderkey", month_end(F.date_format("o_orderdate", "yyyyMM")).cast("string").alias("month_end")
    )


@query(
    "stream_trigger_intake",
    f"""{MATCH_SQL} SELECT trigger_file_name, CASE WHEN file IS NULL THEN 'ARCHIVE' ELSE 'LOAD' END AS disposition FROM matched""",
)
def stream_trigger_intake(spark: SparkSession, t: Tables) -> DataFrame:
    folder = scratch_path(spark, "triggers")
    trigger_rows(t).write.json(folder)
    taken = intake_triggers(
        spark, folder, expected_deliveries(t), scratch_path(spark, "intake"), scratch_path(spark, "intake-state")
    )
    return taken.select("trigger_file_name", "disposition")


@query(
    "stream_redelivery_dedup",
    "SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS first_seen FROM events",
)
def stream_redelivery_dedup(spark: SparkSession, t: Tables) -> DataFrame:
    """Three runs: most events; those that come late, with repeats; repeats of late ones.

    Repeats are an hour younger. Late events are days behind what was taken in before.
    """
    folder, target, state = (scratch_path(spark, n) for n in ("deliveries", "kept", "kept-state"))
    first = t("events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    again = first.withColumn("ts", F.expr("ts + interval 1 hour"))
    late = "event_id % 10 = 3"
    repeated = "event_type in ('error', 'purchase')"
    runs = [
        first.where(f"not {late}"),
        first.where(late).unionByName(again.where(f"not {late} and {repeated}")),
        again.where(repeated),
    ]
    for arrived in runs:
        arrived.write.mode("append").parquet(folder)
        stream = spark.readStream.schema("event_id bigint, event_type string, ts timestamp").parquet(folder)
        kept = keep_first_arrivals(stream, ["event_id"], "ts", target, state)
    return kept.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))
