"""Session settings and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job in this package expects. Shuffle sizing is left to AQE:
# partitions are coalesced at runtime from measured shuffle sizes, skewed join
# partitions are split, and sort-merge joins whose side turns out small are
# converted to broadcast joins from *measured* (not estimated) sizes.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Extra settings for a cluster run at full scale. Streaming state moves to
# RocksDB (off-heap, bounded memory, incremental changelog checkpoints); on
# local[8] with small state the heap store is faster, so it is not a default.
CLUSTER_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    # upper bound of the reduce side; AQE merges what turns out small
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
}


def build_session(master: str | None = None, app: str = "shoplens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """``cluster``: on a master that is not local, ``CLUSTER_DEFAULTS`` hold for
    what the submitted configuration leaves open."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if cluster and not spark.sparkContext.master.startswith("local"):
        given = spark.sparkContext.getConf()
        for key, value in CLUSTER_DEFAULTS.items():
            if not given.contains(key):
                spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests) that has none gets a private folder, which is
    registered, so ``DataFrame.checkpoint()`` works the same way; on a cluster
    executors could not see it, so there the setting must be given.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="shoplens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root for one run of one job."""
    return f"{checkpoint_root(spark)}/shoplens/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: Spark deletes an execution's files as it ends. Else they
    stay until the driver happens to collect its garbage, so those of all steps lie on the disks together."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads."""
    spark, size = df.sparkSession, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in df.inputFiles():
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        size += p.getFileSystem(conf).getFileStatus(p).getLen()
    return size


#: Stored bytes for each turn of a step that is done in turns, and turns at most.
TURN_BYTES, TURNS = 32 << 20, 8


def turns(*tables: DataFrame) -> int:
    """In how many turns to shuffle ``tables``, by the bytes they read: one while they are few."""
    return max(1, min(TURNS, -(-sum(map(stored_bytes, tables)) // TURN_BYTES)))


def in_turn(df: DataFrame, keys: list[str], i: int, k: int) -> DataFrame:
    """The rows of turn ``i`` of ``k``: those of equal ``keys`` are in one."""
    return df if k == 1 else df.where(F.pmod(F.xxhash64(*keys), F.lit(k)) == i)
