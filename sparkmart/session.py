"""Session construction and shared settings."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults for a session that this module starts itself; a value that the
# deployment has set (spark-defaults, --conf) is left as it is.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "sparkmart", extra: dict | None = None) -> SparkSession:
    """Return (or create) the active session with sparkmart's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = SparkConf()
    for k, v in _DEFAULTS.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the deployment and is read, never
    replaced. Only when nothing is configured (local tests) a private folder is
    created and registered.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="sparkmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint location for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sparkmart/{name}"


def written(df, name: str):
    """``df`` as Parquet in a new folder of the shared checkpoint location, read
    back: what a checkpoint gives, in a fraction of its size (columns, compressed).
    Columns that Parquet cannot hold (untyped nulls, intervals, equal names) are checkpointed."""
    kinds, names = df.schema.simpleString(), [c.lower() for c in df.columns]
    if "void" in kinds or "interval" in kinds or len(set(names)) < max(len(names), 1):
        return df.checkpoint(eager=True)
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of long rows stay small (unless the session sets a size)."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(8 << 20))


def ship_package(spark) -> None:
    """Make ``sparkmart`` importable in the executors' Python workers
    (Pandas UDFs, ``mapInPandas``) by zipping the package once per
    SparkContext and adding it with ``addPyFile`` - the runtime form of
    ``--py-files``. The zip is written under the shared checkpoint folder
    when that is a local / mounted path."""
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_sparkmart_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.join("sparkmart", os.path.relpath(full, pkg)))
    target = scratch_path(spark, "pyfiles")
    name = f"sparkmart-{uuid.uuid4().hex[:8]}.zip"
    if "://" in target and not target.startswith("file:"):
        # shared remote folder (e.g. hdfs://, s3a://): write through Hadoop's FileSystem
        jvm = spark._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(f"{target}/{name}")
        fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
        out = fs.create(jpath, True)
        try:
            out.write(bytearray(buf.getvalue()))
        finally:
            out.close()
        path = jpath.toString()
    else:
        local = target.replace("file:", "", 1) if target.startswith("file:") else target
        os.makedirs(local, exist_ok=True)
        path = os.path.join(local, name)
        with open(path, "wb") as fh:
            fh.write(buf.getvalue())
    sc.addPyFile(path)
    sc._sparkmart_shipped = True
