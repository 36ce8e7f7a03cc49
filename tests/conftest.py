import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    """Rows as sorted tuples of text, doubles to 9 digits."""

    def one(v):
        if v is None or (isinstance(v, float) and v != v):
            return "null"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(one(v) for v in r) for r in rows)


def same(spark_df, relation):
    assert sorted(spark_df.columns) == sorted(relation.columns)
    columns = sorted(spark_df.columns)
    left = plain([[r[c] for c in columns] for r in spark_df.collect()])
    at = [relation.columns.index(c) for c in columns]
    right = plain([[r[i] for i in at] for r in relation.fetchall()])
    assert left == right
