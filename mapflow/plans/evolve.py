"""Bringing delivered tables to the newest schema version from a change table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapflow.operators.windows import keep_extreme


def _find(names: Iterable[str], wanted: str | None) -> str | None:
    """The name in the list that equals the wanted one in any case."""
    return next((n for n in names if wanted and n.lower() == wanted.lower()), None)


class SchemaChangeError(ValueError):
    """A change that would lose a column."""


@dataclass
class _Layout:
    """A table and the projection that it will get: output name to column."""

    rows: DataFrame
    columns: dict[str, Column]
    log: list[str] = field(default_factory=list)

    def column(self, name: str | None) -> Column | None:
        found = _find(self.columns, name)
        return self.columns[found] if found else None

    def without(self, name: str | None) -> None:
        self.columns.pop(_find(self.columns, name), None)

    def put(self, name: str, column: Column) -> None:
        self.without(name)
        self.columns[name] = column

    def rename(self, old: str | None, new: str) -> None:
        found = _find(self.columns, old)
        if _find((n for n in self.columns if n != found), new):
            raise SchemaChangeError(f"cannot rename {old} to {new}: there is a column of that name")
        self.columns = {new if n == found else n: c for n, c in self.columns.items()}


def evolve_tables(
    tables: Mapping[str, DataFrame], changes: Iterable[Mapping[str, str | None]]
) -> tuple[dict[str, DataFrame], dict[str, list[str]]]:
    """Apply change rows in order; returns the new tables and the change texts.

    ``Add`` gives a null text column, ``Remove`` and ``Rename`` act on one table,
    ``Move`` brings a column to another table by a left join over a case-insensitive
    key and drops it at its source; of rows that repeat a key there, the smallest value
    is taken, so no row is multiplied. Changes that name an absent table, column or key are
    skipped, with a text where the table itself is there. Renaming onto another column is
    refused. All changes of a table end up in one projection.
    """
    layouts = {n: _Layout(df, {c: F.col(f"`{c}`") for c in df.columns}) for n, df in tables.items()}
    for number, change in enumerate(changes):
        table = layouts.get(change["NewEntityName"])
        if table is not None:
            _apply(change, table, layouts, f"_moved{number}")
    done = {n: t.rows.select(*[c.alias(o) for o, c in t.columns.items()]) for n, t in layouts.items()}
    return done, {n: t.log or ["No changes done"] for n, t in layouts.items()}


def _apply(
    change: Mapping[str, str | None], table: _Layout, layouts: Mapping[str, _Layout], carrier: str
) -> None:
    old, new = change.get("OldAttributeName"), change.get("NewAttributeName")
    match change["ChangeType"]:
        case "Add":
            table.put(new, F.lit(None).cast("string"))
            table.log.append(f"Added {new}")
        case "Remove" | "Rename" if table.column(old) is None:
            table.log.append(f"Skipped: no column {old}")
        case "Remove":
            table.without(old)
            table.log.append(f"Removed {old}")
        case "Rename":
            table.rename(old, new)
            table.log.append(f"Renamed {old} to {new}")
        case "Move":
            origin = layouts.get(change["OldEntityName"])
            needed = [(origin, old), (origin, change.get("OldEntityKey")), (table, change.get("NewEntityKey"))]
            absent = [name for layout, name in needed if layout is None or layout.column(name) is None]
            if absent:
                table.log.append(f"Skipped: nothing to move for {new}, no {', '.join(map(str, absent))}")
                return
            values = (
                origin.rows.select(
                    F.lower(origin.column(change["OldEntityKey"]).cast("string")).alias(f"{carrier}_key"),
                    origin.column(old).alias(carrier),
                )
                .groupBy(f"{carrier}_key")
                .agg(F.min(carrier).alias(carrier))
            )
            key = F.lower(table.column(change["NewEntityKey"]).cast("string"))
            table.rows = table.rows.join(values, key == F.col(f"{carrier}_key"), "left")
            table.put(new, F.col(carrier))
            origin.without(old)
            text = f"Moved {change['OldEntityName']}.{old} to {change['NewEntityName']}.{new}"
            for affected in (table, origin):
                affected.log.append(text)


def changes_since(changes: DataFrame, delivered: DataFrame) -> DataFrame:
    """The change rows that start from a version some available file was delivered in.

    ``changes`` carries ``OldXSDVersion``, ``delivered`` the files' ``XSDVersion``.
    """
    versions = delivered.select(F.col("XSDVersion").alias("OldXSDVersion")).distinct()
    return changes.join(versions, "OldXSDVersion", "left_semi")


def latest_version(attributes: DataFrame) -> DataFrame:
    """Attribute rows of the highest ``XSDVersion`` of each ``SSFTableName``."""
    return keep_extreme(attributes, ["SSFTableName"], "XSDVersion")


def attributes_per_table(attributes: DataFrame) -> DataFrame:
    """Sorted attribute names per table; as many as the table has columns."""
    return attributes.groupBy("SSFTableName").agg(
        F.array_sort(F.collect_set("AttributeName")).alias("attributes")
    )


def project_attributes(df: DataFrame, attributes: Iterable[str]) -> DataFrame:
    """Only the listed attributes that the table has, in the listed order."""
    present = [c for c in (_find(df.columns, a) for a in attributes) if c is not None]
    return df.select(*present)
