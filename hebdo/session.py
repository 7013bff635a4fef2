"""Spark session helpers.

On a cluster the session comes from the platform; ``configure`` only sets the
SQL options the library relies on (UTC session zone, AQE with partition
coalescing - also of persisted intermediates - and skew-join splitting) and
never overrides a checkpoint directory the cluster already names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # let AQE coalesce the partitions of persisted intermediates (the small
    # series x week tables would otherwise keep spark.sql.shuffle.partitions)
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SQL_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session has none is ``fallback`` installed, or, in local
    mode, a fresh scratch folder; on a cluster a missing folder raises.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises in some versions
            current = None
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if sc.getCheckpointDir() is None:
        if not fallback and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = fallback or tempfile.mkdtemp(prefix="hebdo-ckpt-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "hebdo", driver_memory: str = "8g") -> SparkSession:
    """Session for tests and single-node benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark, os.environ.get("HEBDO_CHECKPOINT_DIR"))
    return spark
