"""Writing results: tables, logs, exports, manifests and lineage comments."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapflow.sources.tables import local_rows

PROCESS_LOG_SCHEMA = T.StructType(
    [
        T.StructField("RunID", T.LongType()),
        T.StructField("Timestamp", T.TimestampType()),
        T.StructField("Workflow", T.StringType()),
        T.StructField("Component", T.StringType()),
        T.StructField("SourceSystem", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("Comments", T.StringType()),
    ]
)


def schema_change(old: T.StructType, new: T.StructType) -> dict[str, list[str]]:
    """Columns added, removed and retyped between two schemas."""
    before = {f.name: f.dataType.simpleString() for f in old}
    after = {f.name: f.dataType.simpleString() for f in new}
    return {
        "added": [c for c in after if c not in before],
        "removed": [c for c in before if c not in after],
        "retyped": [c for c in after if c in before and after[c] != before[c]],
    }


def overwrite_table(
    df: DataFrame,
    name: str,
    *,
    path: str | None = None,
    partition_by: Iterable[str] = (),
) -> dict[str, list[str]]:
    """Create or replace a table; returns how its schema changed.

    The written frame must not read the table it replaces; see `replace_versioned` for one that
    does.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    change = schema_change(spark.table(name).schema if exists else T.StructType(), df.schema)
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    if keys := list(partition_by):
        writer = writer.partitionBy(*keys)
    writer.saveAsTable(name)
    return change


def replace_versioned(
    df: DataFrame, name: str, folder: str, partition_by: Iterable[str] = ()
) -> dict[str, list[str]]:
    """Replace what the view ``name`` shows by a new version below ``folder``; returns how its schema changed.

    A version is a table of its own, written in full beside the others, then the view is pointed at it: the frame
    may read the view itself, readers at work keep the version they began with, and a write
    that is killed leaves the view as it was. Old versions are the user's to delete.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    exists = spark.catalog.tableExists(name)
    change = schema_change(spark.table(name).schema if exists else T.StructType(), df.schema)
    writer = df.write.option("path", f"{folder.rstrip('/')}/version-{version}")
    if keys := list(partition_by):
        writer = writer.partitionBy(*keys)
    writer.saveAsTable(f"{name}_{version}")
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {name}_{version}")
    return change


def create_if_absent(
    spark: SparkSession, name: str, schema: T.StructType, path: str | None = None
) -> None:
    """Empty table with a fixed schema, left alone if it exists."""
    writer = local_rows(spark, [], schema).write.mode("ignore")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_log(
    spark: SparkSession,
    records: DataFrame | list[dict],
    name: str,
    schema: T.StructType = PROCESS_LOG_SCHEMA,
) -> None:
    """Append typed records in one write; callers batch the events of a run."""
    if isinstance(records, DataFrame):
        rows = records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    else:
        rows = local_rows(spark, [[r.get(f.name) for f in schema] for r in records], schema)
    rows.write.mode("append").saveAsTable(name)


def create_empty_like(
    df: DataFrame, columns: list[str], name: str, path: str | None = None
) -> None:
    """Empty table with the projected schema of ``df``; an existing one is replaced."""
    overwrite_table(df.select(*columns).where(F.lit(False)), name, path=path)


def export_parquet(
    df: DataFrame | None,
    folder: str,
    file_name: str,
    partition_by: Iterable[str] = (),
    replace_partitions: bool = False,
) -> bool:
    """Write ``folder/file_name.parquet``; missing data is refused with ``False``.

    ``replace_partitions`` leaves partitions that ``df`` does not touch in place, so a
    month can be rerun next to the others. Partitioned output is rebalanced first:
    small pieces are merged and a hot partition is split over several files.
    """
    if df is None:
        return False
    keys = list(partition_by)
    writer = (df.hint("rebalance", *keys) if keys else df).write.mode("overwrite")
    if keys:
        mode = "dynamic" if replace_partitions else "static"
        writer = writer.partitionBy(*keys).option("partitionOverwriteMode", mode)
    writer.parquet(f"{folder.rstrip('/')}/{file_name}.parquet")
    return True


def export_many(
    spark: SparkSession,
    frames: Mapping[str, DataFrame | None],
    folder: str,
    snapshots: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Export each named frame; one status row per name, with the error of one that failed.

    A failing export does not keep the others from being written. ``snapshots`` gives the
    snapshot column of tables that get a manifest, taken from what was written.
    """
    status = []
    for name, df in frames.items():
        try:
            exported = export_parquet(df, folder, name)
            if exported and name in (snapshots or {}):
                written = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
                write_manifest(export_manifest(written, name, snapshots[name]), folder, name)
            status.append((name, exported, "" if exported else "no data"))
        except (PySparkException, Py4JJavaError) as failure:
            status.append((name, False, str(failure).strip().splitlines()[0]))
    return local_rows(spark, status, "table_name string, exported boolean, error string")


def content_hash(df: DataFrame) -> Column:
    """Order-free hash of all rows: two sums of 64-bit row hashes, so copies count."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    wide = T.DecimalType(38, 0)
    return F.concat_ws(
        "-",
        F.coalesce(F.sum(F.xxhash64(*columns).cast(wide)), F.lit(0)).cast("string"),
        F.coalesce(F.sum(F.hash(*columns).cast(wide)), F.lit(0)).cast("string"),
    )


def export_manifest(df: DataFrame, table: str, snapshot: Column) -> DataFrame:
    """One row: record count, column count, content hash and snapshot date."""
    return df.agg(
        F.count(F.lit(1)).alias("record_count"),
        content_hash(df).alias("content_hash"),
        F.min(snapshot).cast("string").alias("snapshot_date"),
    ).select(
        F.lit(table).alias("table_name"),
        "record_count",
        F.lit(len(df.columns)).alias("column_count"),
        "content_hash",
        "snapshot_date",
    )


def write_manifest(manifest: DataFrame, folder: str, table: str) -> None:
    """Store a manifest as JSON next to the export, with the extraction time."""
    stamped = manifest.withColumn("extraction_time", F.current_timestamp().cast("string"))
    stamped.write.mode("overwrite").json(f"{folder.rstrip('/')}/{table}_manifest.json")


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Carry each target expression as the comment of its column."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
            for c in df.columns
        ]
    )


def comment_table(spark: SparkSession, name: str, summary: str) -> None:
    quoted = summary.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS '{quoted}'")


def column_lineage(spark: SparkSession, name: str) -> DataFrame:
    """Column comments of a stored table as rows."""
    rows = [(c.name, c.description) for c in spark.catalog.listColumns(name)]
    return local_rows(spark, rows, "column_name string, expression string")
