"""Brings this package to the executors, so that kernels run wherever the driver was started."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds a zip of the package to the session's files, once for each Spark application."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="inkwell-")) / "inkwell.zip"  # on the driver only; Spark serves it to executors
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(str(target))
    _SENT.add(app)
