"""Small control files beside a table's data, in any file system that Spark reads."""

from __future__ import annotations

import hashlib
import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def whole_path(spark: SparkSession, path: str) -> str:
    """`path` with its file system and folder, as a table's location must name it."""
    system, where = _open(spark, path)
    return system.makeQualified(where).toString()


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names of a folder's entries; none if there is no such folder."""
    system, where = _open(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def write_new(spark: SparkSession, path: str, value: dict) -> bool:
    """Writes a value as JSON with its digest, unless the file exists; tells whether it did."""
    text = json.dumps(value, sort_keys=True)
    system, where = _open(spark, path)
    try:
        out = system.create(where, False)
    except Py4JJavaError as error:
        if system.exists(where):
            return False
        raise error
    try:
        out.write(bytearray(f"{text}\n{hashlib.sha256(text.encode()).hexdigest()}\n".encode()))
    finally:
        out.close()
    return True


def read(spark: SparkSession, path: str) -> dict | None:
    """The value that was written; None if the writer died on the way."""
    system, where = _open(spark, path)
    source = system.open(where)
    try:
        text, _, rest = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8").partition("\n")
    finally:
        source.close()
    return json.loads(text) if hashlib.sha256(text.encode()).hexdigest() == rest.strip() else None


def remove(spark: SparkSession, path: str) -> None:
    system, where = _open(spark, path)
    system.delete(where, True)
