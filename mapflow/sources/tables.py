"""Table resolvers: a name goes in, a lazy DataFrame comes out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Tables = Callable[[str], DataFrame]


def parquet_tables(spark: SparkSession, folder: str) -> Tables:
    """Tables stored as ``folder/name.parquet``; a schema is read from files once."""
    root = folder.rstrip("/")
    schemas: dict[str, T.StructType] = {}

    def resolve(name: str) -> DataFrame:
        path = f"{root}/{name}.parquet"
        if name not in schemas:
            schemas[name] = spark.read.parquet(path).schema
        return spark.read.schema(schemas[name]).parquet(path)

    return resolve


def catalog_tables(spark: SparkSession) -> Tables:
    """Tables and temporary views of the session catalog."""
    return spark.table


def frame_tables(frames: Mapping[str, DataFrame], fallback: Tables | None = None) -> Tables:
    """Named DataFrames, with another resolver for every other name."""

    def resolve(name: str) -> DataFrame:
        if name in frames:
            return frames[name]
        if fallback is None:
            raise KeyError(f"unknown table {name!r}; known: {sorted(frames)}")
        return fallback(name)

    return resolve


def local_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A few driver-side rows (rule tables, check results, statuses) as a local relation.

    Coming in as Arrow they stay in the JVM: no Python worker is started, and the
    known size lets Spark broadcast them.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(fields)}
    frame = spark.createDataFrame(pa.table(columns))
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def month_partition(tables: Tables, run_month: str, column: str = "run_month") -> Tables:
    """Restrict tables that carry a month column to one month (prunes partitions)."""

    def resolve(name: str) -> DataFrame:
        df = tables(name)
        return df.where(F.col(column) == run_month) if column in df.columns else df

    return resolve


def underscore_hyphens(df: DataFrame) -> DataFrame:
    """Rename every ``a-b`` column to ``a_b``, so that SQL can name it bare."""
    return df.withColumnsRenamed({c: c.replace("-", "_") for c in df.columns if "-" in c})


def read_source(
    tables: Tables,
    source: str,
    alias: str,
    filter: str | None = None,  # noqa: A002 - the key users write
    columns: list[str] | str | None = None,
) -> DataFrame:
    """Aliased scan: filter first (it may use unselected columns), then project.

    A listed column with a hyphen gets an underscore instead.
    """
    df = tables(source)
    if filter:
        df = df.where(filter)
    if columns:
        listed = [columns] if isinstance(columns, str) else columns
        plain = [f"`{c}` AS {c.replace('-', '_')}" if "-" in c and c in df.columns else c for c in listed]
        df = df.selectExpr(*plain)
    return df.alias(alias)
