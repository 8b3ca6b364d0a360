"""Readies a session for Python workers: they get the package, in batches of bounded size."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()
#: Bytes of an Arrow batch sent to a Python worker, where the session leaves Spark's default of 64 MB.
BATCH_KEY, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20
#: Environment of Python workers, where it is not set: freed memory goes back to the system, and not into pools that workers keep while idle.
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(4 << 20)}


def ensure_shipped(spark: SparkSession) -> SparkSession:
    """Adds a zip of this package to the session's Python files, once an application; bounds Arrow batches and workers' memory unless the session does."""
    if spark.conf.get(BATCH_KEY, None) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)
    context = spark.sparkContext
    for k, v in WORKER_ENV.items():
        context.environment.setdefault(k, v)
    if context.applicationId not in _SENT:
        top = Path(__file__).resolve().parent
        at = Path(tempfile.mkdtemp()) / f"{top.name}.zip"
        with zipfile.ZipFile(at, "w") as out:
            for p in sorted(top.rglob("*.py")):
                out.write(p, p.relative_to(top.parent))
        context.addPyFile(str(at))
        _SENT.add(context.applicationId)
    return spark
