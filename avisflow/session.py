"""Session construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.driver.memory": "16g",
}


# Suggested settings for a large cluster (100 TB inputs, ~1000 executors); pass as ``extra``.
# AQE coalesces the many shuffle partitions down to ~advisory size and splits skewed join
# partitions; scans split parquet into 256 MB tasks.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.task.maxFailures": "8",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "avisflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every plan assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(master: str) -> bool:
    """One JVM on one machine; a local cluster's executors are processes of their own."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``; only a local-mode session (tests) may fall back to
    a fresh scratch folder. Elsewhere a missing setting is an error: a machine-local
    folder would not survive the loss of that machine, nor would executors see it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's configuration decides
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="avisflow-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(shared_dir(spark), *parts)


_CLEANED: set[str] = set()


def scratch_path(spark: SparkSession, kind: str, name: str) -> str:
    """A fresh path for an intermediate table, below a folder of this application that is removed
    when the application ends."""
    app = spark.conf.get("spark.app.id", "application")
    root = shared_path(spark, "avisflow", app)
    if root not in _CLEANED:
        _CLEANED.add(root)
        atexit.register(_remove, spark, root)
    return os.path.join(root, kind, f"{name}-{uuid.uuid4().hex}")


def _remove(spark: SparkSession, root: str) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(conf).delete(path, True)
    except Exception:  # noqa: BLE001 - the session is gone already; the folder is named after it
        pass


def checkpointed(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage (eager).

    Used where a small intermediate feeds several branches of a plan (so it is computed
    once) and to make long lineages survive executor loss without recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialized_table(df, name: str):
    """Write ``df`` as a parquet table under the shared folder and read it back.

    Unlike a checkpoint (read back as an RDD scan), the re-read table is columnar: each later
    consumer reads only the columns it uses and gets scan-level filters."""
    path = scratch_path(df.sparkSession, "tables", name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_TABLES: dict[tuple, tuple] = {}


def input_state(spark: SparkSession, paths) -> tuple | None:
    """Name, length and modification time of every input file; None where they cannot be listed."""
    try:
        conf, out = spark._jsparkSession.sessionState().newHadoopConf(), []
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            for f in path.getFileSystem(conf).listStatus(path):
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return tuple(sorted(out))
    except Exception:  # noqa: BLE001 - Spark Connect, or a store that does not list
        return None


def built_once(spark: SparkSession, name: str, state: tuple | None, build):
    """The table ``name`` built from inputs in ``state``: written on first use, then read by every
    later query of the application that asks for it with the same inputs."""
    if state is None:
        return materialized_table(build(), name)
    key = (spark.conf.get("spark.app.id", ""), name, state)
    if key not in _TABLES:
        df = build()
        path = scratch_path(spark, "warehouse", name)
        df.write.parquet(path)
        _TABLES[key] = (path, df.schema)
    path, schema = _TABLES[key]
    return spark.read.schema(schema).parquet(path)
