"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only behaviour that the results or the skew handling rely on is set here. Parallelism and
# memory belong to the cluster's own configuration and are left alone.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_folder: str | None = None


def build_session(app_name: str = "mailshape", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session carrying :data:`ENGINE_CONF` plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up where the whole of Spark runs on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="mailshape-")
    return _local_folder


def land(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder as parquet and return a scan of what was written.

    This cuts the lineage durably (lost executors re-read files instead of recomputing) and makes
    every later reader see the same rows in the same files, which steps built on partition numbers
    need. Unlike ``checkpoint()`` the scan still prunes columns, and the values of ``partition_by``, the
    last column, where it is given. All tables of one application lie in
    one folder, which may be removed once the application has ended.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/mailshape/{application}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
