"""Sends this package to the Python workers, which import the operators' functions by name."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once per session; Spark hands the archive to executors that join later too."""
    context = spark.sparkContext
    if getattr(context, "_debtlens_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="debtlens-")) / "debtlens-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._debtlens_shipped = True
