"""Reading delivered files: delimited text, parquet, JSON triggers, file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a delivery trigger, all text.
TRIGGER_COLUMNS = [
    "dial_consumer_name",
    "dial_source_system",
    "dial_source_file_name",
    "dial_source_file_snapshot_datetime",
    "dial_notification_datetime",
    "dial_target_file_full_path",
    "dial_target_file_row_count",
]
TRIGGER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TRIGGER_COLUMNS])

# The delivery formats that can be landed.
DELIMITED_FORMATS = ("csv", "txt")


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | str | None = None,
    quote: str = '"',
) -> DataFrame:
    """Delimited text with a header. Without a schema every column is text."""
    reader = spark.read.option("header", True).option("sep", sep).option("quote", quote)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed parquet; an empty delivery is refused."""
    df = spark.read.parquet(path)
    if not df.take(1):
        raise ValueError(f"no rows in {path}")
    return df


def read_triggers(spark: SparkSession, folder: str) -> DataFrame:
    """Trigger files of a folder under the fixed schema."""
    return spark.read.schema(TRIGGER_SCHEMA).json(folder)


def read_delivery(spark: SparkSession, path: str, file_format: str, sep: str = ",") -> DataFrame:
    """One delivery in any supported format; other formats are rejected."""
    kind = file_format.lower().lstrip(".")
    if kind in DELIMITED_FORMATS:
        return read_delimited(spark, path, sep)
    if kind == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported delivery format {file_format!r}")


def land_parquet(
    spark: SparkSession, path: str, target: str, file_format: str, sep: str = ","
) -> str:
    """Normalise a delivery to parquet at ``target``."""
    df = read_delivery(spark, path, file_format, sep)
    df.write.mode("overwrite").parquet(target)
    return target


def file_stem(path: Column) -> Column:
    """File name of a path without folder and extension."""
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


def file_extension(path: Column) -> Column:
    """Lower-case extension of a path, empty if there is none."""
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, length and time of every file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length", "modificationTime")
    )


def inventory(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Judge listed files (``path``) against ``SourceFileName, SourceFileFormat``.

    Adds ``file_name``, ``extension`` and ``verdict``: ``OK``, ``WRONG_FORMAT`` or
    ``UNKNOWN``.
    """
    named = files.select("*", file_stem(F.col("path")).alias("file_name"),
                         file_extension(F.col("path")).alias("extension"))
    known = expected.select(
        F.col("SourceFileName").alias("_expected_name"),
        F.lower(F.ltrim(F.col("SourceFileFormat"), F.lit("."))).alias("_expected_format"),
    ).distinct()
    verdict = (
        F.when(F.col("_expected_name").isNull(), "UNKNOWN")
        .when(F.col("extension") == F.col("_expected_format"), "OK")
        .otherwise("WRONG_FORMAT")
    )
    return (
        named.join(known, F.col("file_name") == F.col("_expected_name"), "left")
        .withColumn("verdict", verdict)
        .drop("_expected_name", "_expected_format")
    )
