"""Makes this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import newsloom

_ROOT = Path(newsloom.__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, as ``--py-files`` does.

    Nothing is done where workers find it by themselves: on ``PYTHONPATH`` or in
    the working folder. Spark itself copies the small archive to its executors.
    """
    context = spark.sparkContext
    paths = [Path(p or ".").resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if _ROOT in paths or Path.cwd().resolve() == _ROOT or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="newsloom-")) / "newsloom.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted((_ROOT / "newsloom").rglob("*.py")):
            file.write(source, source.relative_to(_ROOT))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
