"""The package on the Python workers of a cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to all executors, once per application.

    Python workers import it by name; without this they could only where the
    repository is on their path too.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    out = os.path.join(tempfile.mkdtemp(prefix="siltworks-ship-"), f"{root.name}.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)
