"""SparkSession construction and the shared checkpoint folder.

Library code never creates a session on its own; callers pass one in. The
helpers here are for tests, ``bench.py`` and local runs.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session of this engine should carry. AQE re-plans joins from
# runtime sizes (sort-merge -> broadcast, skew splitting, partition coalescing),
# which is what keeps the join strategies right from sf0.001 up to cluster scale.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Only for a single-JVM local master: both are needed, or task results and
# broadcasts over ~1 MB can be lost.
LOCAL_CONF = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
}


def cluster_conf(largest_shuffle_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the biggest shuffle expected.

    * initial shuffle partitions ~ bytes / target (AQE coalesces small ones and
      splits skewed ones, so erring high is cheap);
    * AQE's skew split on, with a partition counted as skewed at 5x the median
      and over 512 MB;
    * runtime Bloom filters on, with a creation side up to 1 GB, so a selective
      filter on a dimension scan (one category's parts in U1) prunes the fact
      table before it is shuffled;
    * file splits of 256 MB.
    """
    partitions = max(200, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(1 << 30),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
    }


def local_session(
    cores: str | int = "*",
    shuffle_partitions: int = 8,
    app_name: str = "stockyard",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local[N] session with the engine's settings (tests, bench, examples)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = {**BASE_CONF, **LOCAL_CONF}
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder used to cut lineage (``DataFrame.checkpoint``).

    Order of precedence: a directory already set on the SparkContext, then the
    ``spark.checkpoint.dir`` setting of the session. On a cluster one of them
    must name a shared folder; nothing else is guessed there. Only for a local
    master, where the machine *is* the cluster, a fresh folder under the system
    temp directory is created when neither is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="stockyard-ckpt-"))
    else:
        raise RuntimeError(
            "No checkpoint folder: set spark.checkpoint.dir to a shared folder "
            "(HDFS/S3/ABFS) that every executor can reach."
        )
    # Spark makes a folder of this application's own in it, which goes with the application.
    own = sc.getCheckpointDir() or configured
    place = sc._jvm.org.apache.hadoop.fs.Path(own)
    if own != configured:
        place.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(place)
    return own
