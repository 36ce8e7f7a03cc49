"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_CACHES: dict[str, dict] = {}
#: The operator that a worker served last.
_CLAIMED: list[str] = []


def worker_cache(name: str) -> dict:
    """A dict that lives as long as a Python worker, known by name to `claim`."""
    return _CACHES.setdefault(name, {})


def claim(name: str) -> None:
    """Empty the other operators' caches: a worker that serves several stages keeps those of the last one only, and gives memory back."""
    others = [cache for other, cache in _CACHES.items() if other != name and cache]
    if others or _CLAIMED[-1:] not in ([], [name]):
        for cache in others:
            cache.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass
    _CLAIMED[:] = [name]


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


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir that all executors share. A session on this machine alone, as in tests, gets one of its own where the setting is missing."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt-"))
    return sc.getCheckpointDir()


def store(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` through a Parquet table in the shared folder; smaller than a checkpoint."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint `df` in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def utf8(column: Column) -> Column:
    """A text column as UTF-8 bytes; null reads as empty."""
    return F.coalesce(column, F.lit("")).cast("binary")


def batches(rows, schema: pa.Schema, size: int = 5_000, weigh=None, most: int = 16 << 20):
    """Turn an iterator of tuples into Arrow batches of at most `size` rows and, where `weigh` gives a row's bytes, about `most` bytes."""
    buffer, held = [], 0
    for row in rows:
        buffer.append(row)
        held += weigh(row) if weigh else 0
        if len(buffer) >= size or held > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*buffer), schema)], schema=schema)
            buffer, held = [], 0
    if buffer:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*buffer), schema)], schema=schema)
