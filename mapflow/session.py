"""Session defaults and the shared folder for durable intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One key may hold a third of the rows: let AQE split such partitions even
    # where the split costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort where every partition's build side was measured small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Stream state lives on disk, not in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "mapflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` wins over them.

    ``master`` is left to the cluster unless given, and so are shuffle partition
    counts and memory.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and hand-over tables.

    The cluster names it in ``spark.checkpoint.dir``. A local session without that
    setting uses a folder of its warehouse.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = context.getCheckpointDir()
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            warehouse = spark.conf.get("spark.sql.warehouse.dir")
            configured = f"{warehouse.rstrip('/')}/_scratch/{context.applicationId}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Lineage ends and lost executors cost nothing, as with `durable`; readers still scan only
    the columns and rows they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
