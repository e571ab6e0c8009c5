"""Session helpers: a local session for tests and bench, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "crowdspark", shuffle_partitions: int = 8) -> SparkSession:
    """A single-node session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # no call-site capture for every column expression: it dominates the time to build a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # state on disk: a batch writes its changes, not all keys
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so later branches all see the same rows.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder: on a cluster a machine-local folder would be lost with its executor.
    """
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        _set_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _set_checkpoint_dir(spark: SparkSession) -> None:
    sc, shared = spark.sparkContext, spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="crowdspark-checkpoint-"))


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over all cores if the input has fewer splits than cores.

    Quoted CSV with line breaks and small single-block files come as one split each; parsing their JSON
    columns is the costly step. Inputs with enough splits are left alone.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, where all executors can read and write."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        _set_checkpoint_dir(spark)
    return f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
