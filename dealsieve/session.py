"""Session construction and the few cluster-level settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here is written against.  AQE re-plans joins at run time
# (broadcast only once the real build-side size is known, skew-join splitting,
# partition coalescing), so no operator hard-codes a join strategy.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "dealsieve", extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces downwards).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.ui.enabled", "false")
        conf.setdefault("spark.ui.showConsoleProgress", "false")
        conf.setdefault("spark.driver.memory", os.environ.get("DEALSIEVE_DRIVER_MEMORY", "16g"))
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage that survives executor loss,
    so it has to come from the session.  Only a local-mode session (tests,
    benchmarks on one machine) gets a private temporary folder when unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    folder = tempfile.mkdtemp(prefix="dealsieve-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def stored(df, name: str):
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: later steps read the table instead of recomputing it,
    and a lost executor only costs the tasks that run.  Every call writes a
    folder of its own; clear them with the checkpoint folder.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cpu_partitions(spark: SparkSession) -> int:
    """Partition count for CPU-heavy steps on small data.

    AQE coalesces shuffle partitions by bytes, which would put a small but
    expensive input (say, distinct names to hash 64 times each) into one task.
    An explicit ``repartition(n, key)`` is left as is, so such steps use the
    configured parallelism instead: executors x cores, at least the shuffle
    partition setting.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(spark.sparkContext.defaultParallelism, shuffle)


def spread_for_cpu(df):
    """Round-robin a small-but-expensive input over the configured parallelism.

    Only when it has fewer partitions than that (one small file is one or a
    few partitions); large inputs already have enough and are left alone, so
    this never shuffles a big table.
    """
    n = cpu_partitions(df.sparkSession)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df
