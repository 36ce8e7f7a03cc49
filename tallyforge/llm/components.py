"""Connected components of an edge table by alternating stars, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import cut

#: A key is hot from so many rows, and from so large a part of all rows that at most HOT_KEYS keys can be hot.
HOT_ROWS, HOT_KEYS = 500, 50_000


def join_by_key(rows: DataFrame, values: DataFrame, keys: list[str], total: int) -> DataFrame:
    """`rows` joined to `values` (one row per key, with `n`, the rows that have it), without `n`; `total` is at least the number of rows.

    Rows of hot keys stay where they are and meet their values by a broadcast:
    each such key has over max(HOT_ROWS, total / HOT_KEYS) rows, so there are at
    most HOT_KEYS of them. The others are shuffled, in which no key has more.
    """
    bound = max(HOT_ROWS, total // HOT_KEYS)
    hot, cold = F.broadcast(values.filter(F.col("n") > bound).drop("n")), values.filter(F.col("n") <= bound).drop("n")
    return rows.join(hot, keys).unionByName(rows.join(hot, keys, "left_anti").join(cold, keys))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge to another node; the root is the least node.

    Each round hangs a node's larger neighbours, then its smaller ones, onto the
    least of them, and cuts the lineage. Rounds grow with the logarithm of the
    nodes. Only two figures of a round come to the driver. The neighbours of a
    node are never in one task: least ones are found by partial minima, and are
    sent to the edges of nodes that have many.
    """
    u, v = F.col("u"), F.col("v")
    now = cut(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == before:
            return now.select(u.alias("node"), v.alias("root"))
        before, total = mark, 2 * mark["n"]
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_by_key(both.filter(v > u), least, ["u"], total).select(v.alias("u"), F.col("m").alias("v")).filter(u != v).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_by_key(large, least, ["u"], total).select(v.alias("u"), F.col("m").alias("v")).filter(u != v)
        now = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
