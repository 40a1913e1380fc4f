"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# UTC keeps text timestamps as written; column names are compared as written.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot keys even where a later step could have reused the shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A batch of long texts lies outside the heap, and in a Python worker once more: 10,000 rows can be 35 MB.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


# Collecting a stack trace for every column expression takes longer than planning the query.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_shipped_to: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where it is installed on every node; harmless there.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped_to:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="logtrail-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped_to.add(context.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on to an existing session."""
    ship_package(spark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "logtrail", master: str | None = None, **conf: str) -> SparkSession:
    """Make (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A temporary folder of this machine is used only where none is set, which
    is right for local tests alone.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured and not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    if not configured:
        configured = tempfile.mkdtemp(prefix="logtrail-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/logtrail/{label}-{uuid.uuid4().hex}"
