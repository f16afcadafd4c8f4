"""Joins beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side may be broadcast without keys only up to this many rows.
MAX_CROSS_ROWS = 10_000

# The shortest lengths of parts, so many at most, are looked up as whole stretches of the texts.
WHOLE_LENGTHS = 8


class CrossJoinError(ValueError):
    """A cross join of two large sides that nobody asked for in so many words."""


def cross_bounded(
    left: DataFrame, right: DataFrame, max_rows: int = MAX_CROSS_ROWS, all_pairs: bool = False
) -> DataFrame:
    """Cross join with a right side of at most ``max_rows`` rows, which is broadcast.

    A larger right side is refused, unless ``all_pairs`` says that every pair is wanted.
    """
    if all_pairs:
        return left.crossJoin(right)
    if right.limit(max_rows + 1).count() > max_rows:
        raise CrossJoinError(f"cross join with more than {max_rows} rows: give a condition, or all_pairs")
    return left.crossJoin(F.broadcast(right))


def with_flag(df: DataFrame, others: DataFrame, key: Column, other_key: str, name: str) -> DataFrame:
    """``EXISTS`` as a 0/1 column: one distinct key list instead of a subquery per row."""
    keys = others.select(F.col(other_key).alias("_present")).distinct()
    return (
        df.join(keys, key == F.col("_present"), "left")
        .withColumn(name, F.col("_present").isNotNull().cast("int"))
        .drop("_present")
    )


def with_lookup_max(
    df: DataFrame, others: DataFrame, key: Column, other_key: str, values: dict[str, Column]
) -> DataFrame:
    """Correlated ``(select max(x) ...)`` subqueries as one aggregate and one join."""
    summary = others.groupBy(F.col(other_key).alias("_lookup")).agg(
        *[c.alias(n) for n, c in values.items()]
    )
    return df.join(summary, key == F.col("_lookup"), "left").drop("_lookup")


def grams_of(df: DataFrame, text: str, size: int) -> DataFrame:
    """``text, _gram``: each text with its distinct stretches of ``size`` characters."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    pieces = F.transform(starts, lambda i: F.substring(F.col(text), i, F.lit(size)))
    return df.where(F.length(text) >= size).select(text, F.explode(F.array_distinct(pieces)).alias("_gram"))


def join_contains(
    texts: DataFrame, text: str, parts: DataFrame, part: str, kind: str = "match_kind"
) -> DataFrame:
    """Pairs in which ``text`` contains ``part``, tagged ``EXACT`` or ``CONTAINS``.

    Instead of testing all pairs, distinct texts are indexed by their stretches. Parts of the
    ``WHOLE_LENGTHS`` shortest lengths are themselves such stretches, so they meet the texts
    that contain them and no others. A longer part meets the texts that hold the one of its
    stretches of the last of these lengths which the fewest texts hold, and those are tested.
    A text emits no more rows than it has characters for each of these lengths, whatever the
    number of parts and their lengths. Every text contains an empty part.
    """
    needles = parts.select(F.col(part).alias("_part")).where("_part is not null").distinct()
    haystack = texts.select(F.col(text).alias("_text")).where("_text is not null").distinct()
    size = F.length("_part").alias("size")
    sizes = [r["size"] for r in needles.select(size).where("size > 0").distinct().orderBy("size").limit(WHOLE_LENGTHS).collect()]
    last = max(sizes, default=1)
    held = reduce(DataFrame.unionByName, [grams_of(haystack, "_text", n) for n in sizes or [last]])
    whole = held.join(needles.where(F.length("_part") <= last), F.col("_gram") == F.col("_part")).select("_text", "_part")
    held = grams_of(haystack, "_text", last)
    asked = grams_of(needles.where(F.length("_part") > last), "_part", last)
    times = held.join(asked.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # A stretch that no text holds has no count: its part is in no text.
    weighed = asked.join(times, "_gram", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    rarest = weighed.groupBy("_part").agg(F.min(F.struct("_n", "_gram")).alias("_rarest")).where("_rarest._n > 0")
    met = held.join(rarest.select("_part", F.col("_rarest._gram").alias("_gram")), "_gram")
    longer = met.where(F.contains("_text", F.col("_part"))).select("_text", "_part")
    empty = haystack.join(F.broadcast(needles.where("_part = ''").limit(1)), F.length("_text") >= F.length("_part"))
    # Without longer parts, their branch would still read the texts.
    pairs = whole.unionByName(empty)
    if len(sizes) == WHOLE_LENGTHS and not needles.where(F.length("_part") > last).isEmpty():
        pairs = pairs.unionByName(longer)
    tagged = pairs.withColumn(
        kind, F.when(F.col("_text") == F.col("_part"), "EXACT").otherwise("CONTAINS")
    )
    return (
        texts.alias("_t")
        .join(tagged, F.col(f"_t.{text}") == F.col("_text"))
        .join(parts.alias("_p"), F.col("_part") == F.col(f"_p.{part}"))
        .select("_t.*", "_p.*", kind)
    )


def key_presence(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    labels: tuple[str, str, str] = ("BOTH", "LEFT_ONLY", "RIGHT_ONLY"),
) -> DataFrame:
    """Distinct keys of either side with a ``presence`` label.

    A union with flags, pre-aggregated before the shuffle: unlike a full outer
    join it neither multiplies repeated keys nor piles them up in one task.
    """
    both, left_only, right_only = labels
    flagged = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    presence = (
        F.when((F.max("_l") == 1) & (F.max("_r") == 1), both)
        .when(F.max("_l") == 1, left_only)
        .otherwise(right_only)
    )
    return flagged.groupBy(*keys).agg(presence.alias("presence"))
