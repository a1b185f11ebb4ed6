"""Session helpers.

The library never creates a cluster session itself; callers pass their own
``SparkSession``. ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Settings every plan in this package relies on (safe on a cluster too).
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot never compiles a method of more bytecode than this: such stages run faster without whole-stage codegen
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a batch for Python is cut by its bytes, not only by its rows: long texts, blocks and sets come in small batches
    BATCH_BYTES: "8m",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wearline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    for k, v in PLAN_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_plan_conf(spark: SparkSession) -> None:
    """Session-level settings the plans assume (idempotent)."""
    for k, v in PLAN_CONF.items():
        spark.conf.set(k, v)


def _configured_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    return sc.getConf().get("spark.checkpoint.dir", None) or None


@contextmanager
def scan_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Inside, a task scans ``most`` bytes of files at most: those of compressed text are many rows, and a task's sort grows with them."""
    had = spark.conf.get(SCAN_BYTES)
    spark.conf.set(SCAN_BYTES, min(most, spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(had)))
    try:
        yield
    finally:
        spark.conf.set(SCAN_BYTES, had)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, based on the shared ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is used as is. Only
    when nothing is set and the master is local (tests) a scratch folder is created here;
    elsewhere a machine's own folder would be invisible to the executors.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = _configured_dir(spark)
        if path is None and sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="wearline-ckpt-"))
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (not the per-app subfolder)."""
    root = _configured_dir(spark)
    if root:
        return root.rstrip("/")
    ckpt = ensure_checkpoint_dir(spark).rstrip("/")
    return ckpt.rsplit("/", 1)[0] if "/" in ckpt else ckpt


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for written tables under the shared checkpoint folder."""
    return f"{shared_root(spark)}/wearline-tables/{name}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per application).

    Pandas-based operators (``mapInPandas``, ``applyInPandas``,
    ``applyInPandasWithState``) pickle functions by module reference, so workers
    must import ``wearline``. The package is zipped in memory, written through
    the Hadoop filesystem into the shared folder and added with ``addPyFile``
    (no machine-local temporary folder). On a cluster that ships the package
    with ``--py-files`` this is a harmless extra copy.
    """
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import wearline

    pkg = os.path.dirname(os.path.abspath(wearline.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = f"{shared_root(spark)}/wearline-pkg/{app}/wearline.zip"
    jvm = sc._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(target)
    fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)
