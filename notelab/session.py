"""Spark session helpers.

Library code never creates its own session; callers pass one in.  These
helpers exist for tests, the bench and the driver entry point, and to make
sure lineage cuts go to the shared checkpoint folder the cluster names.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins at runtime (broadcast only
# when the measured side is small, split skewed partitions, coalesce tiny
# ones); UTC keeps timestamps identical to the SQL oracle.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "notelab") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
        # task-side commits: many small per-note files commit in parallel
        .config("spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version", "2")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the cluster's
    ``spark.checkpoint.dir``.  Only a local session, whose executors share the
    driver's disk, gets a scratch folder of its own when none is set; on a
    cluster that would leave parts on each machine, so it is an error there."""
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir()
    if hasattr(current, "isDefined"):
        current = current.get() if current.isDefined() else None
    if current:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    path = tempfile.mkdtemp(prefix="notelab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of executors, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared checkpoint folder, computed once; unlike a
    checkpoint it has a size that joins are planned by."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/notelab-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
