"""Session helpers: settings, reliable checkpoints, small-input spreading."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "corpusweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Large key sets of streams outgrow the heap.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        # Split a skewed join side even where that costs a shuffle later on.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of its own; executors on other machines could not
    read one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="corpusweave-")
    return _own_dirs[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder for one run's written tables."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so lost executors cost no rerun."""
    spark = df.sparkSession
    target = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(target)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Store a table that is read many times as parquet in the shared folder, so
    that later reads prune columns and filter at the scan."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return temporary(df.sparkSession, path).read.schema(df.schema).parquet(path)


def temporary(spark: SparkSession, path: str) -> SparkSession:
    """Have a written folder deleted when the driver ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# A scan of at most this many splits is spread over the cores.
SPREAD_SPLITS = 8


def spread_small(df: DataFrame) -> DataFrame:
    """Let CPU-heavy scans of a few splits use every core.

    More splits than ``SPREAD_SPLITS`` are left as they are, so no more than
    that many times the split size of page bodies is ever shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores) if splits <= SPREAD_SPLITS and splits < cores else df


# Rows of which one task makes pages: a few seconds of work.
ROWS_A_TASK = 16_384


def shares(df: DataFrame) -> int:
    """Tasks for narrow rows that much is made of; files and shuffles are cut by bytes, of
    which such rows have few. Counting reads no column."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK))


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    For sessions whose workers do not inherit the driver's path; a cluster
    without that folder needs the package installed or passed as py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, root])
    return spark
