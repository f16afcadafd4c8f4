"""Delivery intake as set operations over all deliveries at once."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.functions.columns import joined_name, same_text
from mapflow.operators.windows import keep_extreme, keep_first
from mapflow.sources.tables import local_rows

# Delivery steps. 0 and 8 mean that a file may arrive.
EXPECTED, COMPLETED, REDELIVERY = 0, 7, 8
OPEN_STEPS = [EXPECTED, REDELIVERY]

# Step descriptions, common to all flows and per flow.
COMMON_STEPS = {
    0: "Expected",
    5: "Loaded Staging table",
    6: "Checked Data Quality",
    7: "Completed",
    8: "Redelivery expected",
}
FLOW_STEPS = {
    "trigger": {
        1: "Extracted raw parquet data",
        2: "Validated expected count",
        3: "Copied parquet to storage account",
        4: "Moved JSON trigger file",
    },
    "flat": {
        1: "Received / Placed",
        2: "Initial checks done",
        3: "Converted to Parquet",
        4: "Moved source file",
    },
    "view": {
        1: "Extracted data from view",
        2: "Completeness checked",
        3: "Exported to Parquet",
        4: "XSD converted to latest version",
    },
}

# Fixed value: hours after which an uncompleted delivery is late.
DELAY_HOURS = 36

# Triggers that a task of the split holds, about.
ROWS_PER_TASK = 250_000

TRIGGER_NAME_PARTS = [
    "dial_consumer_name",
    "dial_source_system",
    "dial_source_file_name",
    "dial_source_file_snapshot_datetime",
    "dial_notification_datetime",
]


def status_dimension(spark: SparkSession) -> DataFrame:
    """``flow, step, description`` for the three delivery flows (27 rows)."""
    rows = [
        (flow, step, text)
        for flow, own in FLOW_STEPS.items()
        for step, text in sorted({**COMMON_STEPS, **own}.items())
    ]
    return local_rows(spark, rows, "flow string, step int, description string")


def is_open(step: Column) -> Column:
    """Whether a file in this step may (again) be delivered."""
    return F.coalesce(step.isin(OPEN_STEPS), F.lit(False))


def trigger_name() -> Column:
    return joined_name(*[F.col(c) for c in TRIGGER_NAME_PARTS])


def match_triggers(triggers: DataFrame, meta: DataFrame) -> DataFrame:
    """Triggers with their open expected delivery, if any, and the trigger's name."""
    expected = meta.where(is_open(F.col("FileDeliveryStep")))
    on = [
        expected["SourceFileName"] == triggers["dial_source_file_name"],
        expected["SnapshotDate"] == triggers["dial_source_file_snapshot_datetime"],
    ]
    return triggers.join(expected, on, "left").withColumn("trigger_file_name", trigger_name())


SPLIT_COLUMNS = [
    "trigger_file_name",
    "dial_source_system",
    "dial_source_file_name",
    "dial_source_file_snapshot_datetime",
]


def split_triggers(matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct triggers to load, and distinct triggers to archive."""
    known = F.col("SourceFileName").isNotNull()
    return (
        matched.where(known).select(*SPLIT_COLUMNS).distinct(),
        matched.where(~known).select(*SPLIT_COLUMNS).distinct(),
    )


def triggers_by_target(triggers: DataFrame, meta: DataFrame) -> DataFrame:
    """Distinct triggers with their ``target``, `load` or `archive`, in one pass over them.

    They are dealt by file and day, once for the join and for the comparison of rows, to as
    many tasks as ``ROWS_PER_TASK`` asks for: what a task holds does not grow with the input,
    unless one file has more triggers of a day than that.
    """
    tasks = max(1, -(-triggers.count() // ROWS_PER_TASK))
    dealt = triggers.repartition(tasks, "dial_source_file_name", "dial_source_file_snapshot_datetime")
    target = F.when(F.col("SourceFileName").isNotNull(), "load").otherwise("archive")
    return match_triggers(dealt, meta).select(*SPLIT_COLUMNS, target.alias("target")).distinct()


def row_count_check(data: DataFrame, source: str, announced: DataFrame) -> DataFrame:
    """Actual against announced rows of every source in one pass.

    ``announced`` holds ``source, expected_rows``; a source without rows counts 0.
    """
    counted = data.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    actual = F.coalesce(F.col("_n"), F.lit(0))
    same = actual == F.col("expected_rows")
    expected_text = F.col("expected_rows").cast("string")
    return announced.join(counted, F.col("source") == F.col("_source"), "left").select(
        "source",
        "expected_rows",
        actual.alias("actual_rows"),
        F.when(same, "SUCCESS").otherwise("FAILED").alias("result"),
        F.when(same, F.concat(F.lit("Expected and received "), expected_text, F.lit(" records")))
        .otherwise(
            F.concat(
                F.lit("Expected "), expected_text, F.lit(", received "), actual.cast("string"), F.lit(" records")
            )
        )
        .alias("comment"),
    )


def latest_runs(runs: DataFrame, reporting_date: str) -> DataFrame:
    """Runs of a reporting date with the highest ``RunID`` per entity and table."""
    return keep_extreme(
        runs.where(F.col("FileReportingDate") == reporting_date),
        ["DeliveryEntity", "SSFTableName", "FileReportingDate"],
        "RunID",
    )


def available_files(runs: DataFrame, expected: DataFrame, suffix: str = "PAYLOAD.zip") -> DataFrame:
    """Latest runs that are expected, with their parquet name.

    Entities and tables are compared without regard to case.
    """
    wanted = expected.where(is_open(F.col("FileDeliveryStep"))).select(
        F.col("DeliveryEntity").alias("_entity"),
        F.col("SSFTableName").alias("_table"),
        "SSFEntityName",
        "FileDeliveryStatus",
    )
    joined = runs.join(
        wanted,
        [
            same_text(F.col("SSFTableName"), F.col("_table")),
            same_text(F.col("DeliveryEntity"), F.col("_entity")),
        ],
    )
    return (
        joined.withColumn("FileName", F.regexp_replace("FileName", suffix, ""))
        .withColumn(
            "FileNameParquet",
            F.concat_ws("_", "FileName", "XSDVersion", "DeliverySet", F.col("RedeliveryNumber").cast("string")),
        )
        .drop("_entity", "_table")
    )


def updated_entities(available: DataFrame) -> DataFrame:
    return available.select("DeliveryEntity").distinct()


def current_status(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Current state per key from append-only status events: the latest event."""
    return keep_first(events, keys, [F.col(c).desc() for c in order])


def delivery_number(expected: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """Highest logged delivery number of each expected row, 0 if none is logged."""
    highest = log.groupBy(*keys).agg(F.max("DeliveryNumber").alias("_n"))
    return (
        expected.join(highest, keys, "left")
        .withColumn("DeliveryNumber", F.coalesce(F.col("_n"), F.lit(0)))
        .drop("_n")
    )


def missing_after_deadline(
    expected: DataFrame, delivered: DataFrame, as_of: str, critical: Sequence[str]
) -> DataFrame:
    """Expected files whose deadline is reached and that are not delivered.

    ``critical`` names the source systems, in any case, whose missing files are critical.

    Both sides carry ``SourceSystem, SourceFileName``; ``Deadline`` is ``yyyy-MM-dd``
    text and ``as_of`` the day of the check. Files without a deadline never count.
    """
    due = expected.where(F.to_date("Deadline", "yyyy-MM-dd") <= F.lit(as_of).cast("date")).distinct()
    seen = delivered.select(
        F.upper("SourceSystem").alias("_system"), F.col("SourceFileName").alias("_file")
    ).distinct()
    on = [F.upper("SourceSystem") == F.col("_system"), F.col("SourceFileName") == F.col("_file")]
    return due.join(seen, on, "left_anti").withColumn(
        "is_critical", F.upper("SourceSystem").isin([c.upper() for c in critical]).cast("int")
    )


def carry_forward(missing: DataFrame, processed: DataFrame) -> DataFrame:
    """Latest processed version (``carried_path``) of each missing static file.

    Processed files carry ``SourceFileName, path``. A version belongs to a file if its name
    is the file's, with or without a date of eight digits and an extension behind it; the
    greatest path is the latest. Every missing file stays: ``carry_status`` is ``carried``,
    or ``no processed version`` where nothing can be carried forward.
    """
    base = F.regexp_replace("SourceFileName", r"_\d{8}(\.[A-Za-z0-9]+)?$", "")
    latest = processed.groupBy(base.alias("_base")).agg(F.max("path").alias("carried_path"))
    status = F.when(F.col("carried_path").isNull(), "no processed version").otherwise("carried")
    return (
        missing.join(latest, base == F.col("_base"), "left").drop("_base").withColumn("carry_status", status)
    )


def delayed(meta: DataFrame, as_of: str, hours: int = DELAY_HOURS) -> DataFrame:
    """Deliveries not completed although their snapshot is older than ``hours``."""
    age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(
        F.to_timestamp("SnapshotDate", "yyyy-MM-dd")
    )
    return (
        meta.where(F.col("FileDeliveryStep") != COMPLETED)
        .where(age / 3600 > hours)
        .select("SnapshotDate", "SourceFileName")
        .distinct()
    )


def missing_tables(expected: DataFrame) -> DataFrame:
    """Tables that some entity delivers but this one does not: ``entity, table_name``.

    The grid of entities and tables is bounded by the metadata that names them.
    """
    pairs = expected.select("entity", "table_name").distinct()
    entities = pairs.select("entity").distinct()
    names = pairs.select("table_name").distinct()
    return entities.crossJoin(names).subtract(pairs)


def run_summary(events: DataFrame) -> DataFrame:
    """Last status of each component, and the status of its run.

    A run is ``Failed`` if anything in it failed, else ``Running`` while some component has
    only started, else ``Completed``. Events carry ``run_id, component, status, ts, event_id``.
    """
    last = events.groupBy("run_id", "component").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("last_status"),
        F.max((F.col("status") == "Failed").cast("int")).alias("_failed"),
    )
    started = F.max((F.col("last_status") == "Started").cast("int"))
    runs = last.groupBy(F.col("run_id").alias("_run")).agg(F.max("_failed").alias("_any"), started.alias("_started"))
    run_status = F.when(F.col("_any") == 1, "Failed").when(F.col("_started") == 1, "Running").otherwise("Completed")
    return (
        last.join(runs, F.col("run_id") == F.col("_run"))
        .withColumn("run_status", run_status)
        .select("run_id", "component", "last_status", "run_status")
    )


def with_defaults(rows: DataFrame, lookup: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Row value, else the lookup's value for the same key."""
    defaults = lookup.select(
        F.col(key).alias("_lookup"), *[F.col(c).alias(f"_default_{c}") for c in columns]
    )
    joined = rows.join(defaults, F.col(key) == F.col("_lookup"), "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_default_{c}")) for c in columns}
    ).drop("_lookup", *[f"_default_{c}" for c in columns])


def merge_entities(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One table from per-entity tables, tagged ``delivery_entity``."""
    tagged = [df.withColumn("delivery_entity", F.lit(entity)) for entity, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)
