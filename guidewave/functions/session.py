"""Session handling and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "guidewave", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; only a session on one machine may go without and gets a temporary one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY, None)
    if not configured and not sc.master.split("[")[0] == "local":
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Used where a table is read by several branches whose rows must agree to the
    last bit (floating-point sums may differ between two evaluations), where
    recomputing it would repeat heavy joins, and between the rounds of iterative
    operators.  A written table survives lost executors and, unlike a cached one,
    keeps column pruning and size statistics.
    """
    spark = df.sparkSession
    path = shared_path(spark, "guidewave")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
