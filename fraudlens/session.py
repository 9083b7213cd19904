"""Session construction and shared scratch locations.

Lineage cuts and job outputs go under the shared folder the cluster names
in ``spark.checkpoint.dir``.  Only when that setting is absent (a laptop or
a test run) does ``shared_dir`` pick a local default.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a session this library creates itself.  A session handed in
# by the caller is used as it is.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested settings for a large cluster (pass as ``conf=CLUSTER_CONF`` or put
# them in the cluster's defaults).  Many initial shuffle partitions that AQE
# coalesces to ~256 MB keep every reducer's share small enough not to spill
# heavily; AQE splits skewed join partitions; input splits of 256 MB; the
# RocksDB state store keeps streaming state off the JVM heap.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_MADE: list[str] = []            # folders named by shared_dir


def get_session(master: str | None = None, app: str = "fraudlens",
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a local one only if the
    cluster did not name one (tests, single machine)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:        # no SparkContext handle (remote session)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="fraudlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location, for job
    outputs that later stages read back (survives executor loss)."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/fraudlens/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def remove_shared(spark: SparkSession) -> int:
    """Delete every folder that ``shared_dir`` named in this process: staged
    tables, topics and job outputs.  Call it when nothing reads them any more."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (eager): later
    stages re-read the written result instead of recomputing it, and an
    executor loss does not replay the upstream plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
