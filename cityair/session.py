"""Session settings shared by tests, bench and the driver entry point."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.
#  * UTC session zone: ``to_date`` / ``date_format`` of timestamps must not move days.
#  * AQE on: runtime coalescing of shuffle partitions, skew-join splitting and
#    runtime promotion of small join sides to broadcast.
#  * ANSI stays on (Spark default); plans use try_divide / get() where the
#    reference tolerates missing values.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst broadcasts a join side only when its estimated size is below
    # this bound; everything larger is a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "cityair", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect sessions have no SparkContext
        pass
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Partition sizing for a cluster run over ``input_bytes`` of raw data.

    Scan splits and shuffle partitions aim at ``target_partition_bytes``
    so a task's input fits executor memory and spills rarely; AQE starts
    from that many shuffle partitions and coalesces small ones, and splits
    partitions over 5x the median (skewed keys) in joins.
    """
    slots = executors * cores_per_executor
    shuffle = max(slots * 2, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": SESSION_CONF[
            "spark.sql.autoBroadcastJoinThreshold"],
        # Bound output files of partitioned writes (a hot month still ends
        # up in several files rather than one huge one).
        "spark.sql.files.maxRecordsPerFile": "20000000",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is the folder the cluster names in
    ``spark.checkpoint.dir`` and it must be set there: a machine-local
    folder would vanish with its executor. Only a local-mode session (tests,
    the bench) gets a fresh scratch folder when the setting is unset.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="cityair-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:  # RDD checkpoints too (not available on a Spark Connect session)
        spark.sparkContext.setCheckpointDir(path)
    except Exception:
        pass
    return path
