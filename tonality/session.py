"""Session construction and the shared scratch location.

Operators never create a session; they take the one they are given.  The
helpers here are for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make the plans in this package behave as intended.  AQE stays on so
# that shuffle partitions coalesce and skewed joins split at run time.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast policy: no static broadcast from file-size estimates (compressed sizes are
    # not bounds); joins broadcast up front only through hints whose size is measured or
    # bounded by construction, and AQE may convert a join at run time from the measured
    # size of a finished shuffle.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows holding padded sequences are wide: keep Arrow batches modest.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # One BLAS thread per Python worker: the workers already fill the cores.
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    "spark.executorEnv.MKL_NUM_THREADS": "1",
}


def build_session(master: str = "local[8]", app: str = "tonality",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with this package's defaults."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    ship_package(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and round-trip files.

    It is the cluster's checkpoint directory (``spark.checkpoint.dir`` or the one set on
    the context).  Only when neither is set -- local runs and tests -- a private folder
    is created and registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
    if not current:
        current = tempfile.mkdtemp(prefix="tonality-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so that Python code in a task can open the path.

    Only fixture writers use this (they need a POSIX-mounted shared folder); every
    reader goes through Spark's own file system layer.
    """
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def is_local_fs(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_dir(path: str) -> str:
    os.makedirs(local_path(path), exist_ok=True)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tonality`` importable in executors' Python workers (once per application).

    The package is zipped and registered with ``addPyFile`` -- Spark's own code
    distribution (what ``spark-submit --py-files`` does) -- so Arrow/pandas task
    functions resolve wherever the executors run.
    """
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: ship code with the session's artifacts instead
        return
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tonality-pyfiles-"), "tonality.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, files in os.walk(pkg):
            if "__pycache__" in base:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
