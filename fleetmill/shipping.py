"""Makes this package importable in Python workers, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Sends the package's modules to the executors through Spark's own file server, once for
    each application; workers that have the package installed use theirs."""
    sc = spark.sparkContext
    if getattr(sc, "_fleetmill_shipped", False):
        return
    top = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="fleetmill-"), "fleetmill_modules.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, f"{top.name}/{p.relative_to(top)}")
    sc.addPyFile(target)
    sc._fleetmill_shipped = True
