"""Session helpers."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; one of our own only where that is unset and all
    runs on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set: name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def put_bytes(spark: SparkSession, path: str, data: bytes) -> str:
    """Writes one small file through Spark's own file systems."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    try:
        out.write(data)
    finally:
        out.close()
    return path


def ship(spark: SparkSession) -> SparkSession:
    """Hands this package to the Python workers, once a context, so that they can import it without an installation, and
    bounds the rows of an Arrow batch unless the session has set them."""
    context = spark.sparkContext
    if spark.conf.get(BATCH_ROWS) == "10000":  # the default: too much where rows hold long texts
        spark.conf.set(BATCH_ROWS, "1000")
    if context.applicationId not in _SHIPPED:
        home, out = Path(__file__).resolve().parent, io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for p in sorted(home.rglob("*.py")):
                z.write(p, p.relative_to(home.parent))
        context.addPyFile(put_bytes(spark, f"{shared_dir(spark)}/lattica-{uuid.uuid4().hex}.zip", out.getvalue()))
        _SHIPPED.add(context.applicationId)
    return spark
