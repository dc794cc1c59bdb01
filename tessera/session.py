"""Session helpers.

The library never creates a session behind the user's back; these helpers are
for tests, the bench and local runs. On a cluster the caller's session (and its
``spark.checkpoint.dir``) is used as is.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session built here gets. AQE re-plans joins from runtime sizes
# (broadcast conversion, skew split, partition coalescing); ANSI stays on.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime broadcast only for sides measured under this size
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a local session with the library defaults."""
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName("tessera")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory. On a cluster the shared
    folder named in ``spark.checkpoint.dir`` is used as is; a scratch folder
    is created only for a ``local`` master with none configured (tests,
    local runs). A cluster session without one is an error: a machine-local
    folder would leave each executor writing to its own disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder on shared storage (HDFS, object store): "
                                 "lineage cuts, row-id layouts and stream state are written there")
            current = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(current)
    return current


def ship_package(spark: SparkSession) -> None:
    """Let this session's Python workers import the package from where the
    driver has it, whatever folder the session was started in. On a cluster
    whose nodes don't share that folder, install the package there or pass it
    with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
