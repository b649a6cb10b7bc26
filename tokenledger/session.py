"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app_name: str = "tokenledger",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster the caller's ``spark-defaults`` win for anything not given
    here; ``master`` is only set when passed explicitly.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always preferred.  Only a local-mode session without any setting (tests)
    gets a fresh folder of its own, removed when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/...) before training on a cluster")
    path = tempfile.mkdtemp(prefix="tokenledger-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table under the checkpoint folder."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tokenledger/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` once as Parquet in the shared checkpoint folder and read
    it back: the plan runs a single time, lineage is cut, and a lost
    executor re-reads the files instead of recomputing upstream stages.
    Returns ``(frame, path)``; pass the path to ``drop_scratch`` when done.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table written by ``materialize``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hpath, True)


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package from where the
    driver found it (on a cluster it is installed or sent with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, *known) if x)


#: Bytes of rows that Spark hands to a Python worker at a time (a smaller setting
#: of the session stays), and settings by which workers give freed memory back.
BATCH_BYTES = 4 << 20
_WORKER_ENV = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": str(16 << 20), "MALLOC_TRIM_THRESHOLD_": str(32 << 20),
               "ARROW_DEFAULT_MEMORY_POOL": "system"}


def bounded_workers(spark: SparkSession) -> None:
    """Python workers that import this package and get bounded batches: the
    setting by rows alone lets a batch of long texts take any size."""
    workers_import_package(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    if now is None or not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    for k, v in _WORKER_ENV.items():
        spark.sparkContext.environment.setdefault(k, v)


def num_partitions(df) -> int | None:
    """Partition count of a DataFrame's plan, or None where the RDD view is
    not available (e.g. a Spark Connect session)."""
    try:
        return df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - any client without RDD access
        return None
