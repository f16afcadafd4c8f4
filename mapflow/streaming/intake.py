"""Trigger intake and redelivery handling as streams.

Both run with ``availableNow``: they take what has arrived since the last run and
stop. Progress lives in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.plans.delivery import is_open, match_triggers
from mapflow.session import durable
from mapflow.sources.landing import TRIGGER_SCHEMA


def intake_triggers(
    spark: SparkSession,
    folder: str,
    meta: DataFrame,
    target: str,
    checkpoint: str,
    max_files: int = 1000,
) -> DataFrame:
    """Match newly arrived trigger files to expected deliveries.

    Every micro-batch replaces its own folder, so a batch repeated after a failure
    leaves no duplicates. Returns all triggers taken in so far with ``disposition``
    ``LOAD`` or ``ARCHIVE``.
    """
    # What may be delivered is looked up once, not again for every micro-batch; and the
    # result can be read with the right columns before any file has arrived.
    open_deliveries = durable(meta.where(is_open(F.col("FileDeliveryStep"))))
    disposition = F.when(F.col("SourceFileName").isNotNull(), "LOAD").otherwise("ARCHIVE")
    nothing = spark.createDataFrame([], TRIGGER_SCHEMA)
    nothing = match_triggers(nothing, open_deliveries).withColumn("disposition", disposition)
    nothing.write.mode("overwrite").parquet(f"{target}/batch_id=-1")
    stream = (
        spark.readStream.schema(TRIGGER_SCHEMA).option("maxFilesPerTrigger", max_files).json(folder)
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        (
            match_triggers(batch, open_deliveries)
            .withColumn("disposition", disposition)
            .write.mode("overwrite")
            .parquet(f"{target}/batch_id={batch_id}")
        )

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(target).drop("batch_id")


def keep_first_arrivals(
    stream: DataFrame, keys: list[str], order: str, target: str, checkpoint: str
) -> DataFrame:
    """Store the first arrival of each key, however late it is; repeats of a stored key go.

    Which keys have arrived is kept in Spark's keyed state store, below ``checkpoint``: a batch
    looks up and writes its own keys, whatever the history. Nothing is judged by its event time,
    so a late first arrival is kept and a late repeat is not. Within a batch the row with the
    lowest ``order`` is the first, nulls before all, rows of one ``order`` by their hash. Null
    keys are equal to each other. Every batch replaces its own folder, so one repeated after a
    failure leaves no duplicates. Takes in what has arrived since the last run and returns all
    stored rows.
    """
    spark = stream.sparkSession
    schema = stream.schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{target}/batch_id=-1")
    # In a stream the current time is that of the batch, and the same if the batch is repeated.
    # A key is new where the time it was first seen, the oldest in its state, is the batch's.
    now = F.current_timestamp()
    rows = stream.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.struct(*[F.col(f"`{c}`") for c in stream.columns]).alias("_row"),
        F.struct(F.col(order), F.xxhash64(*stream.columns)).alias("_place"),
        now.alias("_now"),
    )
    first = rows.groupBy(*[f"_key{i}" for i in range(len(keys))]).agg(
        F.first("_now").alias("_since"), F.min_by("_row", "_place").alias("_row")
    )
    arrived = first.where(F.col("_since") == now).select("_row.*")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    query = (
        arrived.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(target)
