"""Session construction and shared scratch space.

Settings are the ones that matter at scale: AQE on (runtime broadcast
decisions from measured sizes, partition coalescing, skew-join splitting),
UTC session time (landing times are UTC), UI off.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # when every build-side partition of a shuffled join is measured under
    # this size, AQE hashes it instead of sorting both sides (the large
    # claims side is then never sorted); the bound is checked at runtime
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # partitionBy writes replace only the partitions they touch
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "casegrade", extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the pipeline's defaults.

    On a cluster, leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces small ones afterwards); locally, tests pass
    ``local[*]`` and 8.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests) a
    folder of our own is created and registered. A cluster without the setting
    is an error: a folder of the driver's machine would not be shared.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return qualified(spark, path.rstrip("/"))
    try:
        sc = spark.sparkContext
    except Exception:          # a remote session has no SparkContext here
        sc = None
    path = sc.getCheckpointDir() if sc is not None else None
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="casegrade-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(path)
            path = sc.getCheckpointDir()
    return path.rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system: a path without a scheme lies on the cluster's default one."""
    if ":/" in path:
        return path
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:          # a remote session: the path is the server's to read
        return path
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf).makeQualified(place).toString().rstrip("/")


def located(spark: SparkSession, path: str) -> str:
    """``path`` as Hadoop spells it: with its file system, without doubled or last slashes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf).makeQualified(place).toString()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder for one run of one job."""
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    path = f"{base}/casegrade/{purpose}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Operators with Python tasks need it importable there; ``spark-submit
    --py-files`` does the same for a job started that way.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):                      # a package inside a zip came by --py-files
        from .sources.store import open_store
        archive = f"{scratch_dir(spark, 'package')}/casegrade.zip"
        store, path = open_store(archive)
        with store.open_output_stream(path) as out, zipfile.ZipFile(out, "w") as z:
            for folder, _, names in sorted(os.walk(here)):
                for name in sorted(n for n in names if n.endswith(".py")):
                    source = os.path.join(folder, name)
                    z.write(source, os.path.relpath(source, os.path.dirname(here)))
        sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
