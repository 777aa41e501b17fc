"""Session helpers: sensible defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Let the web-archive source see simple predicates (rec_type, ...).
    "spark.sql.python.filterPushdown.enabled": "true",
    # Page rules are thousands of column calls; each would walk the stack for its call site.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "warcsift", extra: dict | None = None) -> SparkSession:
    """Get or create a session with the engine's defaults.

    On a cluster ``master`` stays ``None`` and spark-submit decides; tests pass
    ``local[N]``.
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
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Uses ``spark.checkpoint.dir`` as configured for the cluster. Only where it
    is unset and everything runs on this machine (local runs, tests) a
    directory under the system temp folder is chosen and registered; on a
    cluster that is an error, as executors would not see each other's files.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("Set spark.checkpoint.dir to a folder that driver and executors share.")
        d = tempfile.mkdtemp(prefix="warcsift-ckpt-")
    sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")


def delete_path(spark: SparkSession, url: str) -> None:
    """Delete a folder through Hadoop, wherever it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(url)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once a session), for clusters on which
    it is not installed: data sources and functions that run there import it."""
    import os
    import zipfile

    key = "warcsift.shipped"
    if spark.conf.get(key, None):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="warcsift-ship-"), "warcsift.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("warcsift", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(target)
    spark.conf.set(key, "true")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def fs_and_path(uri: str):
    """(pyarrow FileSystem, path) for a local path or any Hadoop-style URI."""
    from pyarrow import fs as pafs
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        p = uri[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return pafs.LocalFileSystem(), p
    # Hadoop spells S3 as s3a:// or s3n://; pyarrow knows it as s3://.
    for alias in ("s3a://", "s3n://"):
        if uri.startswith(alias):
            uri = "s3://" + uri[len(alias):]
    return pafs.FileSystem.from_uri(uri)
