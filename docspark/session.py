"""Session helpers: a tuned local session for tests and benches, table loading and
lineage cutting through the cluster's shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "docspark") -> SparkSession:
    """A local session configured the way the engine expects a cluster to be:
    AQE with partition coalescing and skew-join splitting, Arrow for the rare
    Python step, no UI server."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config(SCAN_PARTITIONS, str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it (a path that all executors share) and we only
    read it. Where it is unset, a local session -- tests -- gets a scratch folder of
    its own; any other master is an error, since executors would not see the files."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    sc = _context(spark)
    path = sc.getCheckpointDir() if sc is not None else None
    if path:
        return path
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="docspark-ckpt-"))
    return sc.getCheckpointDir()


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def materialize(df: DataFrame, partition_by: list[str] | None = None, options: dict | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` once as a Parquet table under the shared
    checkpoint folder (``spark.checkpoint.dir``) and reading it back.

    The job runs once (an eager RDD checkpoint of an unpersisted plan would compute
    it twice), survives lost executors, and later readers get column pruning and
    filter pushdown. ``options`` go to the Parquet writer. Never ``localCheckpoint``: its blocks die with the executor."""
    root = ensure_checkpoint_dir(df.sparkSession)
    path = f"{root.rstrip('/')}/tables/{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").options(**{"compression": "zstd"} | (options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)  # later filters prune whole folders
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Session setting: deal every table read by its leading id column to so many
#: partitions. For test files of a single row group; unset (no exchange) on a cluster.
SCAN_PARTITIONS = "docspark.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filters push into the scan, and its splits
    are the input's, unless :data:`SCAN_PARTITIONS` is set."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    n = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n), df.columns[0]) if n else df
