"""Every operator's query that has SQL next to it, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR
from mapflow.llm.queries import ORACLES, QUERIES
from tests.test_queries import in_name_order

pytestmark = pytest.mark.skipif(not Path(SMOKE_DIR).exists(), reason="no test tables")


@pytest.mark.parametrize("key", list(ORACLES))
def test_query_agrees_with_sql(spark, key):
    connection = duckdb.connect()
    for path in Path(SMOKE_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[key](spark, SMOKE_DIR)
    cursor = connection.execute(ORACLES[key])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert in_name_order(df.columns, df.collect()) == in_name_order(names, cursor.fetchall())
