"""Session helpers: one place that decides Spark settings and the checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _launcher_conf() -> dict[str, str]:
    """spark.* settings already fixed by a launcher (``spark-submit`` flags and
    ``spark-defaults.conf``); empty when this process starts its own JVM."""
    if not os.environ.get("PYSPARK_GATEWAY_PORT"):
        return {}
    from pyspark import SparkConf, SparkContext

    SparkContext._ensure_initialized()  # attaches to the launcher's JVM (no new one)
    return dict(SparkConf().getAll())


def get_session(master: str | None = None, app: str = "sparkqc", shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session tuned for the engine.

    Only sets what is not already configured, so a cluster launcher's settings win:
    an active session is returned as it is, and under ``spark-submit`` the master,
    shuffle partitions and memory given there are kept. ``master`` and
    ``shuffle_partitions`` passed here (local tests, bench) are always applied.
    """
    active = SparkSession.getActiveSession()
    if active is not None and master is None and shuffle_partitions is None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    launched = _launcher_conf()
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "16g"),
    }
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    elif "spark.master" not in launched:
        builder = builder.master(f"local[{cpus}]")
    local = (master or launched.get("spark.master", "local")).startswith("local") and not (master or launched.get("spark.master", "")).startswith("local-cluster")
    if local:  # on a cluster Spark's own value stays
        defaults["spark.sql.shuffle.partitions"] = str(int(cpus))
    for key, value in defaults.items():
        if key not in launched:
            builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared file system; there an unset
    folder is an error. Only on a local master (tests, bench) is a folder of
    our own created when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder every executor shares "
                               "(lineage cuts must survive executor loss)")
        conf_dir = tempfile.mkdtemp(prefix="sparkqc-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_garbage(spark: SparkSession) -> None:
    """Between stages of a long job: Spark's cleaner removes broadcasts, shuffles and checkpoints only when the driver's heap is collected,
    and the plans of ended stages would let that heap grow to its limit first."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def write_shared(df: DataFrame, name: str, partition_by: str | None = None) -> str:
    """Write ``df`` as a Parquet table below the shared checkpoint folder; returns its path."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return path


def spread(df: DataFrame) -> DataFrame:
    """Before a CPU-heavy expansion (a parameter grid x rows): deal the rows evenly; AQE sizes and splits the partitions."""
    return df.hint("rebalance")
