"""Parent chains by repeated self-joins of fixed depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def roll_up(
    items: DataFrame,
    key: str,
    parent: str,
    depth: int = 3,
) -> DataFrame:
    """Highest existing ancestor of every item, up to ``depth`` levels.

    Adds ``highest_existing``, ``level_text`` and ``is_sub_item``. The ancestors depend
    on the parent alone, so the chain is walked once per distinct parent, with key
    columns only, and joined to the items in the end. A hot parent is one row of the
    chain; in the last join AQE can split its items.
    """
    chain = items.select(F.col(parent).alias("_parent0")).where("_parent0 is not null").distinct()
    for level in range(1, depth + 1):
        ancestors = items.select(
            F.col(key).alias(f"_key{level}"), F.col(parent).alias(f"_parent{level}")
        )
        chain = chain.join(ancestors, F.col(f"_parent{level - 1}") == F.col(f"_key{level}"), "left")
    chain = items.join(chain, F.col(parent) == F.col("_parent0"), "left")
    return chain.select(
        *items.columns,
        F.coalesce(*[F.col(f"_key{n}") for n in range(depth, 0, -1)], F.col(key)).alias(
            "highest_existing"
        ),
        _level_text(parent, depth).alias("level_text"),
        F.col("_key1").isNotNull().cast("int").alias("is_sub_item"),
    )


def _level_text(parent: str, depth: int):
    # The level texts.
    text = F.when(F.col(f"_key{depth}").isNotNull(), f"level {depth} parent found")
    for level in range(depth, 0, -1):
        wanted = f"_parent{level - 1}" if level > 1 else parent
        text = text.when(F.col(wanted).isNotNull(), f"level {level} parent not found")
        if level > 1:
            text = text.when(F.col(f"_key{level - 1}").isNotNull(), f"level {level - 1} parent found")
    return text.otherwise("level 0 parent found")
