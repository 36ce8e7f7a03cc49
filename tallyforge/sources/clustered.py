"""Rows on disk that lie together by a key, as Spark's bucketed tables: joins and groups by the key read them without a shuffle.

Tables are external and named at random in the session's catalog, which only
notes where the files are; the files stay as they are when it goes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyforge.sources.control import whole_path


def slices(spark: SparkSession) -> int:
    """As many parts as Spark's own shuffles have, so that rows that were shuffled by the key stay in their part."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_clustered(rows: DataFrame, path: str, key: str, parts: int, by: str) -> str:
    """Writes `rows` in folders by the values of `by`, and in each by `parts` hashes of `key`; returns the table's name.

    Rows that lie in `parts` partitions by `key` already make one file for each
    value of `by` and part.
    """
    name = f"clustered_{uuid.uuid4().hex}"
    rows.write.format("parquet").option("path", whole_path(rows.sparkSession, path)).option("compression", "zstd").partitionBy(by).bucketBy(parts, key).sortBy(key).saveAsTable(name)
    return name


def read_clustered(spark: SparkSession, schema: T.StructType, key: str, parts: int, by: str, folders: dict[int, str]) -> DataFrame:
    """Rows that `write_clustered` wrote, from the folder of each value of the whole number `by`; adds `by`."""
    name = f"clustered_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    quoted = {value: whole_path(spark, path).replace("\\", "\\\\").replace("'", "\\'") for value, path in folders.items()}
    place = next(iter(quoted.values()))
    spark.sql(f"CREATE TABLE {name} ({columns}, `{by}` int) USING parquet PARTITIONED BY (`{by}`) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {parts} BUCKETS LOCATION '{place}'")
    spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (`{by}` = {value}) LOCATION '{path}'" for value, path in quoted.items()))
    return spark.table(name)
