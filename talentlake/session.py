"""Session construction and shared-folder resolution.

Cluster jobs read ``spark.checkpoint.dir`` from the session (the shared
folder the cluster names); a machine-local temporary folder is only used
when the session runs in local mode and the setting is unset (tests).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults sized for the cluster: AQE re-plans joins and coalesces or splits
# shuffle partitions at runtime from measured sizes.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files of a DataFrame are removed once it is unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None, app: str = "talentlake",
                  extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master.startswith("local"):
        builder = builder.config("spark.driver.memory", "8g")   # local mode: the driver JVM runs every task
    for k, v in CLUSTER_DEFAULTS.items():
        builder = builder.config(k, v)
    if master.startswith("local"):
        # tables of one machine: partitions small enough that every core writes
        builder = builder.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Unset in local mode -> a fresh temporary folder is created and
    registered as the checkpoint dir. Unset on a cluster -> error, because
    a machine-local folder is not visible to all executors.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="talentlake-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return sc.getCheckpointDir().rstrip("/") if sc.getCheckpointDir() else path


_scratch: list[tuple[SparkSession, str]] = []


def scratch_table(spark: SparkSession) -> str:
    """A folder name of its own in the shared folder; what is written there is removed
    when the driver ends."""
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


@atexit.register
def remove_scratch() -> None:
    for spark, path in _scratch:
        try:
            sc = spark.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session or the folder is gone already
            pass
    _scratch.clear()


def lake_root(spark: SparkSession) -> str:
    """Root of the lake (bronze/silver/gold): ``talentlake.lake.root`` if set,
    else a ``lake`` folder inside the shared checkpoint folder."""
    root = spark.conf.get("talentlake.lake.root", None)
    if root:
        return root.rstrip("/")
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "lake") if "://" not in base else base + "/lake"


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Compute ``df`` once and cut its lineage: write it as a Parquet table in
    the shared folder (``path`` or a fresh sub-folder) and read it back.

    Used where one derived table feeds several branches of a plan, and where
    filters on derived columns would otherwise be pushed into the parsing
    chain: on the written table they become Parquet predicate pushdown and
    column pruning instead. The write goes through the commit protocol, so a
    lost executor only re-runs its own task. (A reliable RDD checkpoint would
    compute the plan twice unless also persisted, and stores rows, not
    columns.)"""
    spark = df.sparkSession
    if path is None:
        path = scratch_table(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
