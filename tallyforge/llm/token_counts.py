"""Exact histogram of encoded document lengths, and what its suffix sums answer.

Tasks encode the documents and hand on one row per length. The histogram has a
row per distinct length, however many documents share it. For every length L a
suffix sum gives the documents and tokens at or above L; from these follow the
tokens left when every document is truncated to L, and quantiles. Suffix sums
run over blocks of lengths and then over the block totals, so that no window
holds more than one block or one row per block.

Defined results
---------------
Null or empty text: length 0. Repeated rows count each. An empty table gives an
empty histogram. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm import encoding
from tallyforge.llm.common import batches, cut, ship, table

COUNTS = pa.schema([("n_tokens", pa.int64()), ("n_docs", pa.int64())])
BLOCK = 1024
#: Context limits reported beside the lengths that occur.
LIMITS = (128, 256, 512, 1024, 2048, 4096, 8192, 16384, 32768, 65536, 131072)


def length_histogram(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """n_tokens, n_docs for every encoded length that occurs."""
    ship(docs.sparkSession)
    path = path or encoding.default_path()

    def count(source):
        encode, seen = encoding.encoder(path).ids, Counter()
        for batch in source:
            seen.update(len(encode(t.as_py() or "")) for t in batch.column(0))
        yield from batches(seen.items(), COUNTS)

    parts = docs.select(F.col(text).cast("string")).mapInArrow(count, "n_tokens long, n_docs long")
    return parts.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def context_limits(histogram: DataFrame, limits: tuple[int, ...] = LIMITS, block: int = BLOCK) -> DataFrame:
    """For every length that occurs and every limit L: sums over documents of at least and at most L tokens.

    total_if_truncated is the sum of min(length, L). share_below and
    share_at_most are the shares of documents of fewer and of at most L tokens:
    the quantile of every share between them, the latter included, is L.
    """
    spark = histogram.sparkSession
    zeros = spark.createDataFrame([(x, 0) for x in limits], "n_tokens long, n_docs long")
    rows = histogram.unionByName(zeros).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    rows = rows.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("block", F.floor(F.col("n_tokens") / block))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    ever = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in "dt"], *[F.sum(c).over(ever).alias(f"{c}_all") for c in "dt"])
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(blocks, "block").withColumn("docs_at_least", F.sum("n_docs").over(within) + F.col("d_later")).withColumn("tokens_at_least", F.sum("tokens").over(within) + F.col("t_later"))
    longer = F.col("docs_at_least") - F.col("n_docs")
    return rows.select(
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("t_all") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("total_if_truncated"),
        longer.alias("docs_cut"),
        F.try_divide(F.col("d_all") - F.col("docs_at_least"), F.col("d_all")).alias("share_below"),
        F.try_divide(F.col("d_all") - longer, F.col("d_all")).alias("share_at_most"),
        F.col("t_all").alias("total_tokens"),
    )


def quantiles(limits: DataFrame, shares: tuple[float, ...]) -> DataFrame:
    """For each share, the least length that at least this share of documents do not exceed."""
    each = F.explode(F.filter(F.array(*map(F.lit, shares)), lambda q: q <= F.col("share_at_most"))).alias("share")
    return limits.filter("n_docs > 0").select("n_tokens", each).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_limits(cut(length_histogram(table(spark, sf_dir, "documents"))))


def character_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sums over lengths in characters, which SQL can count."""
    docs = table(spark, sf_dir, "documents").filter("n_chars IS NOT NULL")
    return context_limits(cut(docs.groupBy(F.col("n_chars").alias("n_tokens")).agg(F.count("*").alias("n_docs"))))


QUERIES = {"op8_length_histogram": op8_length_histogram, "character_limits": character_limits}
ORACLE: dict[str, str] = {
    "character_limits": f"""
WITH h AS (SELECT n_chars AS n_tokens, count(*) AS n_docs FROM documents WHERE n_chars IS NOT NULL GROUP BY 1 UNION ALL SELECT unnest([{", ".join(map(str, LIMITS))}]), 0),
l AS (SELECT n_tokens, CAST(sum(n_docs) AS BIGINT) AS n_docs FROM h GROUP BY 1),
w AS (SELECT *, sum(n_docs) OVER (ORDER BY n_tokens DESC) AS docs, sum(n_tokens * n_docs) OVER (ORDER BY n_tokens DESC) AS tokens, sum(n_docs) OVER () AS d, sum(n_tokens * n_docs) OVER () AS t FROM l)
SELECT n_tokens, n_docs, CAST(docs AS BIGINT) AS docs_at_least, CAST(tokens AS BIGINT) AS tokens_at_least, CAST(t - tokens + n_tokens * docs AS BIGINT) AS total_if_truncated, CAST(docs - n_docs AS BIGINT) AS docs_cut,
  (d - docs)::DOUBLE / d::DOUBLE AS share_below, (d - docs + n_docs)::DOUBLE / d::DOUBLE AS share_at_most, CAST(t AS BIGINT) AS total_tokens FROM w"""
}
