"""Aggregations with a user-level meaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_segment(name: str) -> str:
    """Unqualified column name."""
    return name.rpartition(".")[2].strip("`")


def pivot_values(
    df: DataFrame,
    group_cols: Sequence[str],
    pivot_col: str,
    value_col: str,
    functions: Mapping[str, str] | None = None,
    suffix: str | None = None,
) -> DataFrame:
    """One column per pivot value, each with its own aggregate.

    All columns come from one aggregation with filtered aggregates; combinations
    that do not occur are null. Without ``functions`` the values are looked up
    (as many as there will be columns) and aggregated with ``min``; more than
    ``spark.sql.pivotMaxValues`` of them are refused.
    """
    if functions is None:
        found = df.select(F.col(pivot_col).cast("string").alias("v")).distinct()
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        values = [r["v"] for r in found.where("v is not null").limit(most + 1).collect()]
        if len(values) > most:
            raise ValueError(f"{pivot_col} has more than {most} values: name the columns")
        functions = dict.fromkeys(sorted(values), "min")
    columns = []
    for value, function in functions.items():
        quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
        name = f"{value}_{suffix}" if suffix else str(value)
        columns.append(
            F.expr(
                f"{function}({value_col}) filter (where cast({pivot_col} as string) = '{quoted}')"
            ).alias(name)
        )
    return df.groupBy(*group_cols).agg(*columns)


def last_valid_value(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    valid: Column,
    recency: Sequence[str],
    fallback_order: str,
    name: str,
) -> DataFrame:
    """A failing row takes ``value`` from the last valid row of its group.

    Last means the greatest ``recency`` tuple; a group without any valid row falls
    back to its row with the lowest ``fallback_order``. Valid rows keep their own.
    """
    summary = df.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        F.max_by(F.struct(value), F.when(valid, F.struct(*recency))).alias("_valid"),
        F.min_by(value, fallback_order).alias("_first"),
        F.max(valid.cast("int")).alias("_any"),
    )
    chosen = (
        F.when(valid, F.col(value))
        .when(F.col("_any") == 1, F.col(f"_valid.{value}"))
        .otherwise(F.col("_first"))
    )
    on = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return df.join(summary, on, "left").select(*df.columns, chosen.alias(name))
