"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the skew and partition-size work: reducers are merged
# to the advisory size, hot partitions of joins are split, and a side is broadcast
# only when its size is under Spark's own threshold. Where one side's partitions are
# measured small, a hash join spares sorting the other side, which may carry texts.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Well below the advisory size: that one counts compressed bytes, and several tasks
    # share an executor's memory.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "24m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # Spark 4.1 takes a union of tables bucketed alike as dealt by their buckets, but runs one of
    # plain scans with the tasks of both, so a grouping on it gives a key twice.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.session.timeZone": "UTC",
}


# On a cluster, shuffles start with many reducers, since adaptive execution can merge but not
# add any: 20,000 of 5 GB for 100 TB of text. Small ones are merged to the advisory size.
CLUSTER_DEFAULTS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000"}


def scan_tasks(spark: SparkSession) -> int | None:
    """Tasks that a caller asks for on scans of single-file tables; None: as Spark plans."""
    wanted = spark.conf.get("spark.panelloom.scanTasks", None)
    return int(wanted) if wanted else None


def build_session(
    app: str = "panelloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the defaults above; ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = (master or os.environ.get("MASTER", "")).startswith("local")
    cluster = {} if local else CLUSTER_DEFAULTS
    for key, value in {**DEFAULTS, **cluster, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_root() -> str:
    root = tempfile.TemporaryDirectory(prefix="panelloom-", ignore_cleanup_errors=True)
    atexit.register(root.cleanup)
    return root.name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder.

    Executors on any machine must see it, so the session's
    ``spark.checkpoint.dir`` is used. Only for local masters, where it is unset, one
    folder of this process is made, used throughout and removed at its end.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A frame written to the scratch folder and read from there, so it is computed once."""
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session options that hold inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
