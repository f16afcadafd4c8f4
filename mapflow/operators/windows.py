"""Ranking and partition totals that stay spread out when one key is hot.

A plain window puts every row of a key into one task. Here totals are
pre-aggregated and joined back, top rows use a rank limit that Spark applies
before the shuffle, and full ranks are numbered across range partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapflow.session import durable

# monotonically_increasing_id() keeps the partition number above these bits.
_ROW_BITS = 33


def attach_totals(df: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """``agg(...) over (partition by keys)`` for every row, null keys included.

    Two-phase aggregate (partial sums before the shuffle) and a join back to one
    row per key. AQE broadcasts a small total side and splits a hot key.
    """
    renamed = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    summary = df.groupBy(*renamed).agg(*[c.alias(n) for n, c in totals.items()])
    on = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return df.join(summary, on, "left").drop(*[f"_key{i}" for i in range(len(keys))])


def attach_distinct_count(
    df: DataFrame, keys: Sequence[str], value: Column, name: str
) -> DataFrame:
    """``size(collect_set(value)) over (partition by keys)`` without collecting the set.

    The distinct pairs are found first, so a hot key is counted by many tasks.
    """
    renamed = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    key_names = [f"_key{i}" for i in range(len(keys))]
    summary = (
        df.select(*renamed, value.alias("_value"))
        .distinct()
        .groupBy(*key_names)
        .agg(F.count("_value").alias(name))
    )
    on = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return df.join(summary, on, "left").drop(*key_names)


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    rank: str | None = None,
) -> DataFrame:
    """The first ``n`` rows per key.

    ``row_number() <= n`` lets Spark cut every map task's output to ``n`` rows per
    key before the shuffle, so no task ever sees a whole hot group.
    """
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def keep_extreme(
    df: DataFrame, keys: Sequence[str], value: str, *, largest: bool = True
) -> DataFrame:
    """Rows whose value is the largest (or smallest) of their key; ties stay."""
    best = (F.max if largest else F.min)(value)
    return (
        attach_totals(df, keys, {"_best": best}).where(F.col(value) == F.col("_best")).drop("_best")
    )


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` kept for every row.

    Rows equal in ``order`` follow each other by a hash of all their columns, so the numbers are
    the same whatever the number of rows, tasks or partitions.
    """
    running = running_totals(df, keys, order, F.lit(1), name)
    return running.withColumn(name, F.col(name).cast("int"))


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], weight: Column, name: str
) -> DataFrame:
    """``sum(weight)`` (a whole number) of each row and those before it among the rows of its key.

    Rows are range-partitioned by (keys, order), so a hot key spreads over many tasks. Each
    partition holds one run of consecutive rows per key; a row's total is that within its run
    plus the totals of the key's runs in earlier partitions. The checkpoint fixes the
    partitioning, which both uses below rely on.
    """
    key_cols = [F.col(k) for k in keys]
    # The hash last: rows equal in all the rest can then be cut apart too.
    sort = [*key_cols, *order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    placed = durable(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .withColumn("_weight", weight.cast("bigint"))
    )
    run = ["_part", *keys]
    lengths = placed.groupBy(*run).agg(F.sum("_weight").alias("_length"))
    # At most one run per key and partition: this window is bounded by the
    # number of partitions.
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Only the first key of a partition can have begun before it, so this side
    # has at most one row per partition.
    offsets = (
        lengths.withColumn("_offset", F.sum("_length").over(earlier))
        .where(F.col("_offset") > 0)
        .select(
            F.col("_part").alias("_offset_part"),
            *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
            "_offset",
        )
    )
    on = [F.col("_part") == F.col("_offset_part")]
    on += [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    so_far = Window.partitionBy(*run).orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        placed.withColumn("_in_run", F.sum("_weight").over(so_far))
        .join(F.broadcast(offsets), on, "left")
        .select(
            *df.columns,
            (F.col("_in_run") + F.coalesce(F.col("_offset"), F.lit(0))).alias(name),
        )
    )


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The median of a numeric column per key as a double, nulls left out: the middle value, or the mean of the middle two.

    Values are counted before anything else, so what is ranked are distinct values with their
    counts, and a key with many of them spreads over many tasks. Null where a key has no value.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counts, keys, [F.asc(value)], F.col("_n"), "_upto")
    sizes = df.groupBy(*keys).agg(F.count(value).alias("_size"))
    named = sizes.withColumnsRenamed({k: f"_median_key{i}" for i, k in enumerate(keys)})
    same = [F.col(k).eqNullSafe(F.col(f"_median_key{i}")) for i, k in enumerate(keys)] or F.lit(True)
    low, high = F.floor((F.col("_size") + 1) / 2), F.floor(F.col("_size") / 2) + 1
    first = F.col("_upto") - F.col("_n") + 1
    middle = ranked.join(named, same).where((first <= high) & (F.col("_upto") >= low))
    number = F.col(value).cast("double")
    found = middle.groupBy(*keys).agg(((F.min(number) + F.max(number)) / 2).alias(name))
    missing = sizes.where("_size = 0").select(*keys, F.lit(None).cast("double").alias(name))
    return found.unionByName(missing)
