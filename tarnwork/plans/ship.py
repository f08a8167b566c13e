"""What driver and executors share: this package's sources, and a folder."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Bytes of a batch that goes to a Python worker, instead of 64 MB: long documents come in thousands.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once an application; bound Arrow batches unless the session does."""
    if spark.conf.get(_BATCH).rstrip("b") == str(64 << 20):
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="tarnwork-src-")) / f"{top.name}_src.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; one of our own only where driver and executors are one machine's process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share; a machine-local one would lose rows")
    global _own_folder
    if _own_folder is None:
        _own_folder = f"file://{tempfile.mkdtemp(prefix='tarnwork-')}"
    return _own_folder
