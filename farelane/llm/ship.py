"""Sends the library to the executors' Python workers, as --py-files would."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import farelane

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the session's Python files, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SENT:
        root = Path(farelane.__file__).parent
        # Spark's own folder for files to send; its file server takes them from there.
        archive = Path(sc._temp_dir) / "farelane.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent).as_posix())
        sc.addPyFile(str(archive))
        _SENT.add(sc.applicationId)
    return spark
