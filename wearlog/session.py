"""Session helpers: the configuration every job in this package assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on. AQE re-plans joins at runtime (broadcast only
# when the measured side is small, split skewed join partitions); the session
# zone is pinned so timestamps and report times agree across engines.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "wearlog",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment and is only read here.
    When it is unset a private scratch folder is used on a local master; on any
    other the executors could not see it, and that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="wearlog-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (stream state, cut lineage)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


#: Bytes of one Arrow batch on the way to a Python worker (Spark's own limit is 64 MB).
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> None:
    """Lets Spark cut Arrow batches at ``BATCH_BYTES``, unless the session has a limit of its own.

    A batch of whole texts is held several times over, by the executor's JVM (whose
    buffers double as they fill) and by its Python worker, once for each core.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, BATCH_BYTES)


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts the lineage (survives executor loss without recomputing the
    upstream plan) and gives later scans file statistics and pruning."""
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # its columns are known: no job to find them in the files (folders of a partitioned table come last)
    out = (spark.read if partition_by else spark.read.schema(df.schema)).parquet(path)
    out._written_at = path
    return out


def discard(*frames) -> None:
    """Delete the files behind frames that :func:`materialize` returned, once nothing
    that is still to run reads them (a turn of a loop after the next one is written).
    Frames of other origin are left alone."""
    for df in frames:
        path = getattr(df, "_written_at", None)
        if path is not None:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
