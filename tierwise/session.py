"""Session helpers.

Library code never builds its own session; callers pass one in.  This
module only offers a local session for tests and the benchmark, and the
lookup of the shared checkpoint folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tierwise") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``).  Only when the session names none and runs
    in local mode (tests) is a fresh scratch folder set; a cluster session
    without the setting is an error."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        # a machine-local scratch folder is only right when driver and
        # executors share the machine (tests, the local benchmark)
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tierwise-ckpt-"))
    else:
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder on the cluster's shared file system "
            "(checkpoints and derived tables are written there)"
        )
    return sc.getCheckpointDir()
