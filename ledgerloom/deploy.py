"""Make the package importable in the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors once per application, like ``--py-files``.

    The zip is read on the driver and served to the executors by Spark.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ledgerloom-src-")) / "ledgerloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
