"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder used to cut lineage.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a
shared, fault-tolerant path such as HDFS or an object store). Only a local
master may fall back to a scratch folder of its own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a user would put in spark-defaults for these jobs. AQE re-plans
# joins from runtime sizes, coalesces small shuffle partitions and splits
# skewed sort-merge join partitions.
#
# Broadcast policy: no broadcast from *static* estimates (a Parquet
# relation's estimate is its compressed file size scaled by the projected
# columns, and without column statistics a join's estimate is the product
# of its inputs, which can make a fact table look smaller than its
# dimensions). AQE broadcasts a join side only when its *measured* shuffle
# output is under the adaptive threshold. Relations fixed in size by
# definition are still hinted explicitly (operators.joins.broadcast_fixed).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pitchline") -> SparkSession:
    """A local[N] session for tests and the bench."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it from
    ``spark.checkpoint.dir``. A scratch folder is made only for a local
    master where nothing is configured (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) so lineage can be cut safely")
    path = tempfile.mkdtemp(prefix="pitchline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def drop_intermediates(spark: SparkSession) -> None:
    """Delete what this application has written under the checkpoint folder
    (tables that cut lineage); call it when their last reader is done."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{ensure_checkpoint_dir(spark).rstrip('/')}/pitchline/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cluster_conf(total_cores: int, shuffle_bytes: float | None = None,
                 checkpoint_dir: str | None = None) -> dict[str, str]:
    """Starting settings for a large cluster (e.g. 1000 executors, ~100 TB
    input): enough initial shuffle partitions for AQE to coalesce down to
    ~128 MB partitions, 256 MB input splits, skew splitting for sort-merge
    joins, and the shared checkpoint folder. ``shuffle_bytes`` is the
    largest expected shuffle (e.g. the projected columns of the biggest
    fact table)."""
    partitions = 2 * total_cores
    if shuffle_bytes:
        partitions = max(partitions, int(shuffle_bytes // (128 * 1024 * 1024)) + 1)
    conf = dict(DEFAULT_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    })
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    return conf
