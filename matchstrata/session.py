"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCRATCH_PREFIX = "matchstrata-"


def build_session(app: str = "matchstrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    ``spark.sql.shuffle.partitions`` is left to the caller: it is the upper
    bound AQE coalesces from, so a cluster sets it high and a laptop low.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of
    its own; on a cluster a machine-local folder would be lost with its host.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix=_SCRATCH_PREFIX)
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{_SCRATCH_PREFIX}{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the scratch folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a write in this block shuffles is removed when the write ends.

    Without it the files of each shuffle stay until the driver happens to collect
    garbage, so those of many writes lie on the disks at once.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, "false")
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


class Staged:
    """A frame written once to the scratch folder and read back from there.

    The stored copy cuts the lineage, survives the loss of executors, gives
    Catalyst true sizes, and makes non-deterministic values (row slots) fixed.
    """

    def __init__(self, df: DataFrame, label: str, partition_by: tuple[str, ...] = ()):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, label)
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffles_removed(self.spark):
            writer.parquet(self.path)
        self.schema = df.schema

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def discard(self) -> None:
        """Delete the stored copy once nothing reads it any more."""
        delete(self.spark, self.path)


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> Staged:
    return Staged(df, label, partition_by)
