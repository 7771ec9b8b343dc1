"""Gives Python workers this package, wherever the driver found it."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path
from threading import Lock

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_lock = Lock()  # fits run side by side: none starts before the package is there


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, through Spark's own file server."""
    app = spark.sparkContext.applicationId
    with _lock:
        if app in _shipped:
            return
        _shipped.add(app)
        here = Path(__file__).resolve().parent
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(here.rglob("*.py")):
                z.write(f, f.relative_to(here.parent))
        path = Path(tempfile.mkdtemp(prefix="ship-")) / f"{here.name}.zip"  # read by the driver alone, as long as it runs
        path.write_bytes(packed.getvalue())
        spark.sparkContext.addPyFile(str(path))


def ship_active() -> None:
    """``ship`` for the session at hand, if there is one: for column functions, which see no table."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship(spark)
