"""Session helpers: one place for the settings every plan relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans assume.  AQE coalesces the many small shuffle outputs a
# panel produces and splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# the folder a local session without spark.checkpoint.dir made for itself
_LOCAL: dict[str, str] = {}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "dockcast", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let the launcher decide; locally
    ``local[N]`` with ``shuffle_partitions`` near the core count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder there; it is used
    as is.  Unset, a local session (tests) gets a folder of its own, and any
    other master is an error: executors could not see each other's files.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL.get("dir")
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = _LOCAL["dir"] = tempfile.mkdtemp(prefix="dockcast-ckpt-", dir=os.environ.get("DOCKCAST_LOCAL_DIR"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


# one folder of stored tables per application
_TABLES: dict[str, str] = {}


def table_folder(spark: SparkSession) -> str:
    """A new folder for one stored table; Hadoop deletes it when the session's JVM ends.

    Only a folder that exists can be registered for deletion, so the application's
    folder is made first and each table is a folder below it.
    """
    app = spark.sparkContext.applicationId
    if app not in _TABLES:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/dockcast-tables/{uuid.uuid4().hex}"
        jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(jpath)
        fs.deleteOnExit(jpath)
        _TABLES[app] = root
    return f"{_TABLES[app]}/{uuid.uuid4().hex}"
