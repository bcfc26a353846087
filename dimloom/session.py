"""Session helpers.

The library never overrides settings a cluster already provides. Local
defaults (``get_spark``) are for tests and the benchmark only.

Materialised intermediate tables (staging, dimensions, quarantine files) go
under the shared folder named by ``spark.checkpoint.dir``; a machine-local
temporary folder is used only where that setting is absent and the master is
local (one machine); on a cluster its absence is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# The cleaning projection is wide: fused into one method, its generated code exceeds the
# size (bytes) up to which the JVM compiles a method, and would stay interpreted. From that
# size on Spark runs the operators one by one, in methods that are compiled.
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000


def get_spark(master: str | None = None, app: str = "dimloom", **conf: str) -> SparkSession:
    """Create (or reuse) a session with local defaults; used by tests and bench."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_LOCAL_DEFAULTS)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.
    (The limit of generated methods is set here too where the session has none.)"""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.conf.get(HUGE_METHOD, None) is None:
        spark.conf.set(HUGE_METHOD, COMPILED_BYTES)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    local = tempfile.mkdtemp(prefix="dimloom-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_root(spark: SparkSession) -> str:
    """Per-application folder for tables this library writes between steps."""
    base = ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    return f"{base}/dimloom/{app}"


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem, so any URI works."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table this library wrote for itself, through the Hadoop FileSystem."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
