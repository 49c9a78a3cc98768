"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a cluster session should carry.  Nothing in the library depends on
# these for its results; they only decide how a plan is carried out.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot products or customers: split their partitions even when that costs
    # the operator above another shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Dedup keys of a long stream do not fit the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


_TASK_BYTES = 256 << 20


def cluster_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job that shuffles about so many bytes on so many cores.

    Enough shuffle partitions that one fits a task's memory with room to sort,
    and never fewer than two per core; adaptive execution joins small ones.
    Ranges of ranks and running totals follow the same number.
    """
    parts = max(2 * cores, -(-shuffle_bytes // _TASK_BYTES), 8)
    return {
        **CLUSTER_SETTINGS,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(_TASK_BYTES),
    }


def local_session(app: str = "millrace", cores: str = "8", **settings: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
    )
    for name, value in {**CLUSTER_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name that every executor can reach.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``.
    Only a local session, whose executors share this machine, may fall back to
    a temporary folder.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{tempfile.mkdtemp(prefix='run-')}/{label}"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and continue from there.

    Used where later steps must see the very same rows in the very same
    partitions, also after an executor is lost, and between rounds of a loop.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def filed(df: DataFrame) -> DataFrame:
    """Write ``df`` as files in the shared folder and read them again.

    Like ``pin``, but Spark then knows how large the rows are, so it can
    choose a join by that.
    """
    folder = scratch_dir(df.sparkSession, "filed")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of files that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
