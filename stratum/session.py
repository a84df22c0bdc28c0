"""Session construction and the shared checkpoint directory."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every stratum session wants; callers may override any of them. On a cluster also set
# spark.checkpoint.dir, and spark.sql.shuffle.partitions to the largest shuffle's bytes / 200 MB (AQE merges small
# partitions, it does not make more of them).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Of the tables and intermediate results that are written: about a third smaller than Spark's default.
COMPRESSION = "zstd"


def build_session(master: str | None = None, app: str = "stratum",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; without it there is nowhere that
    all executors can read, so this raises. In local mode (tests, ad-hoc sessions) a folder under the warehouse
    directory serves.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not (sc.master or "").split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        configured = warehouse.rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = build_session(master=f"local[{cores}]", shuffle_partitions=shuffle_partitions,
                          extra={"spark.driver.memory": os.environ.get("STRATUM_DRIVER_MEMORY", "8g")})
    if checkpoint_dir and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark
