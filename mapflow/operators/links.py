"""Filling a missing value from other parties on the same item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def propagate_over_links(
    parties: DataFrame,
    links: DataFrame,
    party: str,
    item: str,
    value: str,
    valid: Column,
    recency: Sequence[str],
    name: str,
) -> DataFrame:
    """Parties without a valid value take one from the other parties on their items.

    On each item the valid party with the greatest ``recency`` wins; over several
    items the greatest winning value is taken. A valid party never needs a value, so
    a needy party can only meet others: one winner per item is enough, and the
    pairs of parties on an item are never formed.

    ``links`` holds ``party, item`` pairs under the same column names; copies of a pair
    do no harm.
    """
    rated = parties.where(valid).select(
        F.col(party).alias("_rated"), F.col(value).alias("_value"), F.struct(*recency).alias("_recency")
    )
    winners = (
        links.join(rated, F.col(party) == F.col("_rated"))
        .groupBy(F.col(item).alias("_item"))
        .agg(F.max_by("_value", "_recency").alias("_best"))
    )
    needy = parties.where(~F.coalesce(valid, F.lit(False))).select(F.col(party).alias("_needy"))
    found = (
        links.join(needy, F.col(party) == F.col("_needy"))
        .join(winners, F.col(item) == F.col("_item"))
        .groupBy("_needy")
        .agg(F.max("_best").alias("_found"))
    )
    return (
        parties.join(found, F.col(party) == F.col("_needy"), "left")
        .withColumn(name, F.when(valid, F.col(value)).otherwise(F.col("_found")))
        .drop("_needy", "_found")
    )
