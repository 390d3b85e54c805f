"""Session helpers.

The library never creates its own cluster settings behind the caller's back.
One setting is required for exact semantics; :func:`ensure_semantics` sets it on
the session of whatever DataFrame is decoded, and the README says so:
``spark.sql.variant.allowDuplicateKeys=true``, so that a JSON object with a
repeated key keeps the last value (as ``JSON.parse`` does) instead of
``try_parse_json`` returning NULL for the whole body.

Everything else (shuffle partitions, AQE, memory) is the caller's choice;
:func:`local_session` is only for tests and the benchmark.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def ensure_semantics(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sluice") -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage; it
    is read from the session.  Only in local mode may it be unset: a fresh
    folder is then created, registered, and removed when the process ends.  On
    any other master an unset folder is an error, because executors would not
    see one another's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="sluice-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return (sc.getCheckpointDir() or conf_dir).rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of its own file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the checkpoint root for a job's outputs."""
    root = checkpoint_root(spark)
    path = f"{root}/sluice-{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path
