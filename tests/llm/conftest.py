from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tests.llm.texts import prose

#: A table of documents with columns of its own that operators might use as names.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("candidate", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """DataFrame of (doc_id, text) pairs over several partitions, with further columns."""

    def build(rows, partitions: int = 3):
        full = [(i, t, "src/a.txt", None if t is None else len(t), "k", 0.5, None) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty and blank texts, null ids, copies, repeated rows and ids, one long text, other scripts."""
    base = prose(1, 120)
    changed = base.split()
    changed[60] = "other"
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, base),
        (5, base),
        (5, base),
        (6, base.replace(" ", "\n")),
        (7, " ".join(changed)),
        (None, base),
        (None, "no id here"),
        (8, prose(2, 30_000)),
        (9, "word"),
        (10, "Überraschung 漢字 テスト İstanbul ΑΣ <|endoftext|> don't I'LL 123 ½ \x1c x y"),
        (10, "the same id, another text"),
        (11, "Orre " * 700),
        (12, base + " " + prose(3, 80)),
    ]
