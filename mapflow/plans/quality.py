"""Data-quality checks compiled to one pass; violations stay DataFrames.

Expectations are a dictionary with ``columns`` (a number, or name to type), ``PK``,
``not_null``, ``unique`` and ``referential_checks``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapflow.sources.tables import Tables, local_rows

RESULT_SCHEMA = "check_type string, check_details string, result string, violations bigint, error string"
MAX_ERROR_TEXT = 300  # fixed value: width of the error column of the log


class QualityError(RuntimeError):
    """A table that failed its data-quality checks."""


def merge_expectations(
    generic: Mapping[str, Any] | None, specific: Mapping[str, Any] | None
) -> dict[str, Any]:
    """Specific over generic: ``columns`` is replaced, lists are joined."""
    merged: dict[str, Any] = dict(generic or {})
    for key, value in (specific or {}).items():
        if key == "columns" or not isinstance(value, list | tuple):
            merged[key] = value
        else:
            merged[key] = [*merged.get(key, []), *[v for v in value if v not in merged.get(key, [])]]
    return merged


def find_expectations(
    files: Mapping[str, Mapping[str, Any]], schema: str, table: str, source_system: str = ""
) -> dict[str, Any]:
    """A table's expectations from named ones, ``schema/table``; absent files count as empty.

    The generic file of a source system has ``[]`` where the table's name has the system.
    """
    generic = files.get(f"{schema}/{table.replace(source_system, '[]')}") if source_system else None
    return merge_expectations(generic, files.get(f"{schema}/{table}"))


def schema_results(df: DataFrame, columns: int | Mapping[str, str]) -> list[tuple]:
    """Column count, and exact names and types where they are given."""
    wanted = columns if isinstance(columns, int) else len(columns)
    found = len(df.columns)
    off = abs(found - wanted)
    error = f"expected {wanted} columns, found {found}" if off else ""
    rows = [("column_count", str(wanted), "FAIL" if off else "PASS", off, error)]
    if not isinstance(columns, int):
        expected, actual = set(columns.items()), set(df.dtypes)
        missing, extra = sorted(expected - actual), sorted(actual - expected)
        error = f"not found: {missing}; not expected: {extra}" if missing or extra else ""
        rows.append(
            (
                "columns_datatypes",
                ",".join(columns),
                "FAIL" if error else "PASS",
                len(missing) + len(extra),
                error,
            )
        )
    return rows


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, nulls counted as equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def duplicate_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated values of each column by itself: ``column_name, value, n_rows``.

    All columns are counted by one aggregation over (column, value).
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(pairs))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where("n_rows > 1")
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n_nulls`` for all columns, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_nulls"))
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def missing_values(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str, condition: str | None = None
) -> DataFrame:
    """Distinct values without a counterpart: ``value, n_rows``.

    Values are counted before they are compared, so a frequent value is one row. A
    null is missing unless ``condition`` removes it.
    """
    checked = df.where(condition) if condition else df
    values = checked.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = reference.select(F.col(reference_column).alias("_known")).distinct()
    return values.join(known, F.col("value") == F.col("_known"), "left_anti")


def primary_key_result(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated combinations plus combinations with a null."""
    return run_checks(df, {"PK": keys})


def unique_each_result(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return run_checks(df, {"unique": columns})


def not_null_result(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return run_checks(df, {"not_null": columns})


@dataclass(frozen=True)
class _Check:
    """A check as what it takes from a row: a key, or nothing, and how keys are judged."""

    kind: str
    details: str
    message: str
    #: The row's key, and whether the row takes part.
    key: Column
    when: Column
    #: Violations of a key by its columns: n (rows), empty (some part is null), known (in the reference).
    wrong: str
    #: Whether each row of a wrong key counts, or the key.
    each_row: bool = False


def _key(df: DataFrame, columns: Sequence[str], kind: T.DataType | None = None) -> Column:
    """One text for the values of some columns, equal where they are equal, nulls included.

    ``kind`` is the type in which they are compared, if not their own.
    """
    parts = []
    for c in columns:
        value = F.col(c).cast(kind) if kind else F.col(c)
        if isinstance(df.select(value).schema[0].dataType, T.FloatType | T.DoubleType):
            value = value + F.lit(0.0)  # one zero
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def _row_checks(df: DataFrame, expectations: Mapping[str, Any]) -> list[_Check]:
    out = []
    if keys := expectations.get("PK"):
        some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        key = F.concat(F.when(some_null, "0").otherwise("1"), _key(df, keys))
        out.append(_Check("primary_key", ",".join(keys), "keys repeated or with nulls", key, F.lit(True), "n > 1 or key like '0%'"))
    for c in expectations.get("unique") or []:
        out.append(_Check("unique", c, "values repeated", _key(df, [c]), F.lit(True), "n > 1"))
    for c in expectations.get("not_null") or []:
        out.append(_Check("not_null", c, "nulls", F.lit(""), F.col(c).isNull(), "true", each_row=True))
    return out


def _reference(df: DataFrame, check: Mapping[str, str], tables: Tables) -> tuple[_Check, DataFrame]:
    """A referential check, and the keys of its reference table."""
    schema, table = check.get("reference_schema"), check["reference_table"]
    reference = tables(f"{schema}.{table}" if schema else table)
    column, other = check["column"], check["reference_column"]
    types = [df.select(column).schema[0].dataType, reference.select(other).schema[0].dataType]
    both = df.select(F.coalesce(*[F.lit(None).cast(t) for t in types])).schema[0].dataType
    key, known = _key(df, [column], both), _key(reference, [other], both)
    details = f"{column} in {table}.{other}"
    when = F.coalesce(F.expr(check["filter"]), F.lit(False)) if check.get("filter") else F.lit(True)
    return _Check("referential", details, "values not found", key, when, "n > 0 and not known"), reference.where(
        F.col(other).isNotNull()
    ).select(known.alias("key"))


def _judged(df: DataFrame, checks: Sequence[_Check], references: Mapping[int, DataFrame]) -> DataFrame:
    """Result rows of all checks from one pass over the rows and one over each reference.

    Rows become (check, key) for each check that takes something from them; these are counted
    before they are shuffled, next to the keys of the references under their check's number.
    """
    taken = [
        F.when(c.when, F.struct(F.lit(i).alias("check"), c.key.alias("key"), F.lit(False).alias("known")))
        for i, c in enumerate(checks)
    ]
    entries = df.select(F.inline(F.array_compact(F.array(*taken))))
    for i, known in references.items():
        entries = entries.unionByName(known.select(F.lit(i).alias("check"), "key", F.lit(True).alias("known")))
    keys = entries.groupBy("check", "key").agg(F.count_if(~F.col("known")).alias("n"), F.bool_or("known").alias("known"))
    wrong = F.coalesce(*[F.when(F.col("check") == i, F.expr(c.wrong)) for i, c in enumerate(checks)])
    each_row = F.coalesce(*[F.when(F.col("check") == i, F.lit(c.each_row)) for i, c in enumerate(checks)])
    counts = keys.where(wrong).groupBy("check").agg(F.sum(F.when(each_row, F.col("n")).otherwise(F.lit(1))).alias("violations"))
    rows = [(i, c.kind, c.details, c.message) for i, c in enumerate(checks)]
    listed = local_rows(df.sparkSession, rows, "check int, check_type string, check_details string, message string")
    violations = F.coalesce("violations", F.lit(0)).cast("bigint")
    return listed.join(counts, "check", "left").select(
        "check_type",
        "check_details",
        F.when(violations == 0, "PASS").otherwise("FAIL").alias("result"),
        violations.alias("violations"),
        F.when(violations == 0, "").otherwise(F.concat(violations.cast("string"), F.lit(" "), "message")).alias("error"),
    )


def run_checks(
    df: DataFrame,
    expectations: Mapping[str, Any],
    tables: Tables | None = None,
    functional: bool = False,
) -> DataFrame:
    """One result row per check, whatever their number from one pass over the table.

    Referential checks run only when ``functional``; each takes one pass over its reference.
    """
    parts: list[DataFrame] = []
    if "columns" in expectations:
        rows = schema_results(df, expectations["columns"])
        parts.append(local_rows(df.sparkSession, rows, RESULT_SCHEMA))
    checks, references = _row_checks(df, expectations), {}
    if functional and tables is not None:
        for check in expectations.get("referential_checks", []):
            judged, references[len(checks)] = _reference(df, check, tables)
            checks.append(judged)
    if checks:
        parts.append(_judged(df, checks, references))
    if not parts:
        return local_rows(df.sparkSession, [], RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def overall(results: DataFrame) -> DataFrame:
    """``result``: PASS, FAIL or NA if no check is defined."""
    passed = F.bool_and(F.col("result") == "PASS")
    return results.agg(
        F.when(passed.isNull(), "NA").when(passed, "PASS").otherwise("FAIL").alias("result"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(F.col("result") == "FAIL").alias("n_failed"),
    )


def passed(results: DataFrame) -> bool | None:
    """True, false, or None where no check is defined."""
    return {"PASS": True, "FAIL": False}.get(overall(results).first()["result"])


def dq_log(results: DataFrame, run_month: str, table: str) -> DataFrame:
    """Log rows of a check run; a table without checks logs one ``NA`` row.

    The checks run once, here: their verdicts, a row each, become local rows.
    """
    verdicts = results.select("check_type", "check_details", "result", "error").collect()
    rows = [
        (run_month, table, r["check_type"], r["check_details"], r["result"], (r["error"] or "")[:MAX_ERROR_TEXT])
        for r in verdicts
    ]
    schema = "run_month string, table_name string, check_type string, check_details string, result string, error string"
    return local_rows(results.sparkSession, rows or [(run_month, table, "none", "", "NA", "")], schema)


def gate(df: DataFrame, results: DataFrame, table: str) -> DataFrame:
    """Hand the frame on if its checks passed or none is defined, else raise. The checks run once."""
    verdicts = results.select("check_type", "check_details", "result", "error").collect()
    failed = [(r["check_type"], r["check_details"], r["error"]) for r in verdicts if r["result"] == "FAIL"]
    if failed:
        raise QualityError(f"{table}: {failed}")
    return df
