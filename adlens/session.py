"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes
# (broadcast when a side turns out small, split skewed partitions), and
# timestamps are read and printed in UTC.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # nested documents are wide rows: columnar batches of 4096 of them
    # over-allocate; nested parquet is read row by row instead
    "spark.sql.parquet.enableNestedColumnVectorizedReader": "false",
}


def get_spark(app: str = "adlens", master: str | None = None,
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session with neither set gets a
    private temporary folder; on a cluster an unset dir is an error, since a
    machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc._jsc.sc().getCheckpointDir().get()
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="adlens-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()
