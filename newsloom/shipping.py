"""Makes this package importable in the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def add_package(spark: SparkSession) -> None:
    """Give the package to the executors of a session, once, as ``--py-files`` does.

    Some operators run Arrow functions of this package in Python workers. These find it
    only where it is installed, in the working folder or on ``PYTHONPATH``; an archive
    that Spark itself hands to every executor, new ones included, works everywhere.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="newsloom-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(_PACKAGE.rglob("*.py")):
            file.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
