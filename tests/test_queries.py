"""Every query of the library proper next to its SQL, on the smallest tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from mapflow.queries import REGISTRY

pytestmark = pytest.mark.skipif(not Path(SMOKE_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for path in Path(SMOKE_DIR).glob("*.parquet"):
        made.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return made


def in_name_order(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("key", list(REGISTRY))
def test_query_agrees_with_sql(spark, connection, key):
    df = queries()[key](spark, SMOKE_DIR)
    found = in_name_order(df.columns, df.collect())
    cursor = connection.execute(oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert found == in_name_order(names, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
