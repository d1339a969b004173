"""Session and shared-folder helpers.

Staged extracts and stream checkpoints go under the folder the cluster names
in ``spark.checkpoint.dir``; a local session without one gets a folder of its
own.  Targets are live data and have their own root, ``tidemark.target.dir``
(by default a folder in the warehouse), so that clearing out scratch files
never touches them.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


# Settings the jobs are written for.  On a cluster, also size
# spark.sql.shuffle.partitions to the largest shuffle (AQE coalesces it down).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session configured the way the library expects (tests, bench, CLI)."""
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    base = shared_dir(spark)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex[:12]}") if "://" not in base \
        else f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


TARGET_DIR_CONF = "tidemark.target.dir"


def target_root(spark: SparkSession) -> str:
    """The folder of all targets: ``tidemark.target.dir``, or else one in the warehouse.

    On a cluster one of the two has to be set: the warehouse's own default is a
    folder of each machine, where a table's files would be scattered.
    """
    root = spark.conf.get(TARGET_DIR_CONF, None)
    if not root:
        conf, master = spark.sparkContext.getConf(), spark.sparkContext.master
        alone = master.startswith("local") and not master.startswith("local-cluster")
        if not alone and not conf.contains("spark.sql.warehouse.dir"):
            raise RuntimeError(f"{TARGET_DIR_CONF} or spark.sql.warehouse.dir has to name a folder that the driver and all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidemark-targets"
    return root.rstrip("/")


def target_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for a target's data, under the root for targets."""
    return f"{target_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder through Hadoop's file system; false if it wasn't there."""
    fs, p = _filesystem(spark, path)
    return bool(fs.delete(p, True))


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly in ``path``; none if it doesn't exist."""
    fs, p = _filesystem(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()]


def create_exclusive(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file; false if there is one already.  Of several callers, on any machine, one gets true.

    On a local or mounted file system the operating system decides, elsewhere
    the file system's own create without overwriting (atomic on HDFS).
    """
    fs, p = _filesystem(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getUri().getScheme() == "file":
        if not spark._jvm.java.io.File(p.toUri().getPath()).createNewFile():
            return False
        out = fs.create(p, True)  # its own file by now
    else:
        try:
            out = fs.create(p, False)
        except Py4JJavaError:
            if fs.exists(p):
                return False
            raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return bool(fs.exists(p))
