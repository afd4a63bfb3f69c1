"""Give the executors this package, whatever folder their Python starts in."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def package(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="opscore-ship-"), "opscore.zip")
    with zipfile.ZipFile(path, "w") as z:
        for where, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
