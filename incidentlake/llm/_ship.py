"""Readies a session for the operators that run Python in its tasks."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

# Rows per Arrow batch. Spark's default suits narrow rows; ten thousand texts at
# once, in and out, would be hundreds of megabytes outside the heap.
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DEFAULT_ROWS, _TEXT_ROWS = "10000", "1000"


def ship(spark: SparkSession) -> None:
    """Add the package's source as a zip to the application, once. Spark hands
    the file to every executor, also to those that join later. Where the session
    has the default number of rows per Arrow batch, it is set to 1 000."""
    if spark.conf.get(_BATCH_ROWS, _DEFAULT_ROWS) == _DEFAULT_ROWS:
        spark.conf.set(_BATCH_ROWS, _TEXT_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="incidentlake-code-")) / "incidentlake_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
