"""Makes this package importable where Python workers run, and finds the folder that the driver and the executors share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent
ROOT = PACKAGE.parent


def ship(spark: SparkSession) -> None:
    """Send the package's files to the workers, once a session, unless its folder is on their path."""
    sc = spark.sparkContext
    known = {os.path.realpath(p or ".") for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]}
    if str(ROOT) in known or getattr(sc, "_quillstone_shipped", False):
        return
    out = Path(tempfile.mkdtemp(prefix="quillstone-")) / "quillstone.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in PACKAGE.rglob("*.py"):
            z.write(p, p.relative_to(ROOT))
    sc.addPyFile(str(out))
    sc._quillstone_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, spark.checkpoint.dir. Only a local session may go without: it gets a folder of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    at = f"file://{tempfile.mkdtemp(prefix='quillstone-')}"
    spark.conf.set("spark.checkpoint.dir", at)
    return at
