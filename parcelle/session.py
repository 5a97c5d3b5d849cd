"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "parcelle", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine's defaults.

    On a cluster the master and partition count come from spark-submit; locally
    ``master`` defaults to ``local[$BENCH_CPUS or *]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset and
    all runs on this machine (tests) fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = sc._jsc.sc().getCheckpointDir()
        path = path.get() if path.isDefined() else None
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all machines share")
        path = tempfile.mkdtemp(prefix="parcelle-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor
    loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back: a cut
    of the lineage that survives lost executors and fixes what ``df`` computes."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_driver_memory(spark: SparkSession) -> None:
    """Give back what dropped models left in the driver: Spark drops broadcasts, shuffle files
    and their blocks only after a collection, which comes late while the heap can grow."""
    gc.collect()                            # Python's hold on objects of the JVM
    spark.sparkContext._jvm.System.gc()


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings sized from the input volume: about ``target_partition_bytes``
    per scan split and per shuffle partition before AQE coalescing, with the
    skew-join split on.  E.g. 100 TB -> ~400k shuffle partitions, which AQE
    coalesces where stages shrink (aggregates) and splits where a key is hot."""
    parts = max(200, int(input_bytes // target_partition_bytes))
    size = f"{target_partition_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
