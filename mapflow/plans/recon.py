"""Comparing two versions of a table, and profiling one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapflow.sources.tables import local_rows


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """``column_name, side, data_type`` of columns that only one table has."""
    left_names, right_names = set(left.columns), set(right.columns)
    rows = [(c, "LEFT_ONLY", t) for c, t in left.dtypes if c not in right_names]
    rows += [(c, "RIGHT_ONLY", t) for c, t in right.dtypes if c not in left_names]
    return local_rows(left.sparkSession, rows, "column_name string, side string, data_type string")


def null_status(left: Column, right: Column, tolerance: float | None = None) -> Column:
    """``MATCH``, ``MISMATCH``, ``BOTH_NULL``, ``LEFT_NULL`` or ``RIGHT_NULL``."""
    equal = left == right if tolerance is None else F.abs(left - right) < tolerance
    return (
        F.when(left.isNull() & right.isNull(), "BOTH_NULL")
        .when(left.isNull(), "LEFT_NULL")
        .when(right.isNull(), "RIGHT_NULL")
        .when(equal, "MATCH")
        .otherwise("MISMATCH")
    )


def compare_values(
    left: DataFrame, right: DataFrame, keys: Sequence[str], tolerances: Mapping[str, float]
) -> DataFrame:
    """Joined rows with difference and match flag per column, and overall.

    Adds ``left_c, right_c, diff_c, match_c`` for each column and ``match_all``.
    """
    renamed = right.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(f"right_{c}") for c in tolerances],
    )
    on = [F.col(k) == F.col(f"_key{i}") for i, k in enumerate(keys)]
    joined = left.select(*keys, *[F.col(c).alias(f"left_{c}") for c in tolerances]).join(renamed, on)
    columns: list[Column] = [F.col(k) for k in keys]
    flags = []
    for c, tolerance in tolerances.items():
        diff = F.abs(F.col(f"left_{c}") - F.col(f"right_{c}"))
        flag = F.when(diff < tolerance, 1).otherwise(0)
        flags.append(flag)
        columns += [F.col(f"left_{c}"), F.col(f"right_{c}"), diff.alias(f"diff_{c}"), flag.alias(f"match_{c}")]
    overall = reduce(F.least, flags) if len(flags) == 1 else F.least(*flags)
    return joined.select(*columns, overall.alias("match_all"))


def mismatched_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows of both sides whose values differ; a null never differs."""
    other = right.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col(column).alias(f"right_{column}")
    )
    on = [F.col(k) == F.col(f"_key{i}") for i, k in enumerate(keys)]
    return (
        left.select(*keys, F.col(column).alias(f"left_{column}"))
        .join(other, on)
        .where(F.col(f"left_{column}") != F.col(f"right_{column}"))
        .drop(*[f"_key{i}" for i in range(len(keys))])
    )


def duplicated_keys(df: DataFrame, keys: Sequence[str], others: Sequence[str]) -> DataFrame:
    """Keys with several rows and the number of distinct values of other columns."""
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_distinct(c).alias(f"distinct_{c}") for c in others],
        )
        .where("n_rows > 1")
    )


def match_rate(statuses: DataFrame, column: str) -> DataFrame:
    """Rows per status."""
    return statuses.groupBy(F.col(column).alias("status")).agg(F.count(F.lit(1)).alias("n_rows"))


def step_funnel(steps: Mapping[str, DataFrame]) -> DataFrame:
    """``step, n_rows`` after each pipeline step, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(i).alias("step_no"), F.lit(name).alias("step"), "n_rows")
        for i, (name, df) in enumerate(steps.items(), 1)
    ]
    return reduce(DataFrame.unionByName, counts)


def flag_funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """``step, n_rows`` of nested steps over one joined frame: one pass, an aggregate for each step."""
    counted = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(steps.values())])
    rows = F.array(
        *[
            F.struct(F.lit(i + 1).alias("step_no"), F.lit(name).alias("step"), F.col(f"_{i}").alias("n_rows"))
            for i, name in enumerate(steps)
        ]
    )
    return counted.select(F.inline(rows))


def transition_class(old: Column, new: Column, valid: Column) -> Column:
    """How a value changed: valid rows should keep it, others should be corrected."""
    return (
        F.when(valid & old.eqNullSafe(new), "MATCH")
        .when(valid, "MISMATCH")
        .when(old.eqNullSafe(new), "UNCHANGED")
        .otherwise("CORRECTLY_MODIFIED")
    )
