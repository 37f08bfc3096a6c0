"""Session helpers.

Library code never creates a session; callers pass one in.  ``local_session``
is for tests and the benchmark only.  ``checkpoint_dir`` reads the shared folder
the cluster names in ``spark.checkpoint.dir`` and only sets one when it is
unset (local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def scale_conf(scan_bytes: int, checkpoint_dir: str) -> dict[str, str]:
    """Session settings for a cluster run that scans about ``scan_bytes``
    (after partition pruning): shuffle partitions sized so that each starts
    near 512 MB of scanned input (AQE then coalesces small ones and splits
    skewed ones), 256 MB file splits, and a shared checkpoint folder."""
    partitions = max(200, -(-int(scan_bytes) // (512 << 20)))
    conf = dict(DEFAULT_CONF)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.files.maxPartitionBytes": str(256 << 20),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
            "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
            "spark.checkpoint.dir": checkpoint_dir,
        }
    )
    return conf


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "feedlens") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session; set one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; name a shared folder (HDFS, S3, ...) for this cluster")
        conf_dir = tempfile.mkdtemp(prefix="feedlens-ckpt-")  # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the session's shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def materialize(df):
    """Cut lineage: a reliable checkpoint in the shared checkpoint folder.

    Used for small derived frames read by several consumers (a distinct-value
    table, a daily series), so their upstream scans and shuffles run once and a
    lost executor does not force recomputation from the raw tables."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
