"""Session settings the operators are written for, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only; nothing here pins a partition count. AQE picks partition counts, splits
# skewed joins and rebalanced writes, and turns a sort-merge join into a hash join once every
# partition of the build side is seen to be small.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    # Deduplication state can outgrow the heap: keep it off-heap and on disk, upload only changes.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


PARTITION_BYTES = 128 * 1024 * 1024


def configure(spark: SparkSession, largest_shuffle: int | None = None) -> SparkSession:
    """Apply the recommended runtime settings to a session.

    ``largest_shuffle`` is the size in bytes of the largest exchange expected, for instance the
    state of the largest table merged without buckets. AQE merges small shuffle partitions but does
    not split evenly large ones, so batch exchanges start with enough of them. The partitions of
    streaming state are a matter of ``spark.sql.shuffle.partitions`` and stay as they are.
    """
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    if largest_shuffle:
        base = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(base, -(-largest_shuffle // PARTITION_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", wanted)
    return spark


#: Folders made for local sessions that name none, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder, kept as long as the session; on
    a cluster that would lose data with the machine, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="strataflow-")
    return _LOCAL[context.applicationId]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table once nothing reads it any more; only paths below the shared folder."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"{path} is not a scratch path")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
