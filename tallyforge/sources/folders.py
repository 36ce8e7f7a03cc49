"""Folders: one to share within a job, and reads that miss a path without failing."""

from __future__ import annotations

import logging
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share, as spark.checkpoint.dir names it; a session on this machine alone may do without."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not folder and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{folder or tempfile.mkdtemp(prefix='scratch-')}/{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context, so that their Python finds it without an installation."""
    sc = spark.sparkContext
    if getattr(sc, "_package_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="send-")) / "tallyforge.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    sc._package_sent = True


def read_each(paths: str | list[str], read: Callable[[int, str], DataFrame]) -> list[DataFrame]:
    """`read` of every path that exists; others are named in a warning."""
    found = []
    for i, path in enumerate([paths] if isinstance(paths, str) else paths):
        try:
            found.append(read(i, path))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            log.warning("no such path: %s", path)
    return found
