"""Finishing a mapping: write the target once, check what was written, hand it on."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from mapflow.plans.quality import gate, run_checks
from mapflow.sources import sinks
from mapflow.sources.tables import Tables


def publish(
    target: DataFrame,
    folder: str,
    name: str,
    expectations: Mapping[str, Any],
    tables: Tables | None = None,
    functional: bool = False,
    partition_by: Iterable[str] = (),
    replace_partitions: bool = False,
) -> DataFrame:
    """Write ``folder/name.parquet``, run the checks on it and return it.

    The plan behind the target runs once; checks and later mappings read the stored
    columns they need. A failed check raises and leaves the files for inspection.
    """
    sinks.export_parquet(target, folder, name, partition_by, replace_partitions)
    path = f"{folder.rstrip('/')}/{name}.parquet"
    # The schema keeps partition values such as months from turning into numbers.
    stored = target.sparkSession.read.schema(target.schema).parquet(path)
    return gate(stored, run_checks(stored, expectations, tables, functional), name)
