"""Session settings used by the jobs and the tests."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A third of all rows may share one account or customer: let AQE split the hot
    # shuffle partition even when that costs a later exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


#: Files of transactions hold 20 bytes a row and less, rows that are sorted before a shuffle 200 and more:
#: Spark's own 128 MB are over a GB in memory, which is then spilled.
SPLIT_BYTES = 32 << 20
UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def fine_splits(spark: SparkSession) -> None:
    """Scans of a session that was built elsewhere read splits of SPLIT_BYTES at most."""
    asked = re.fullmatch(r"(\d+)([bkmg]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower())
    if asked is None or int(asked[1]) * UNITS[asked[2]] > SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """`master` stays unset on a cluster, where spark-submit decides it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which driver and executors share. Only a local session
    may do without the setting; it gets a temporary folder, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-checkpoints-"))
    return context.getCheckpointDir().rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """A frame cut from its lineage: written to the shared folder, so it survives lost executors
    and files that a later step replaces. With `spark.cleaner.referenceTracking.cleanCheckpoints`
    its files go when nothing refers to it any more."""
    spark = df.sparkSession
    spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, prefix: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{shared_folder(spark)}/{prefix}-{uuid.uuid4().hex}"


#: Spark's setting by which an execution drops its shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, **options: str) -> DataFrame:
    """The frame written to the shared folder and read back: a lineage cut that outlives lost
    executors. Parquet, so that later readers take only the columns they need. Shuffle files of the
    execution go when it has been written. `options` are the writer's."""
    spark = df.sparkSession
    path = new_folder(spark, "staged")
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Removes the files of staged frames that nothing will read again."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.staged_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
