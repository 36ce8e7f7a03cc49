"""Joins on containment: which texts hold which short texts, by an equi-join on character grams and an exact check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.sources.folders import scratch

#: Characters of grams; a text is found by one of its grams of the most characters that fit.
GRAMS = (1, 2, 3, 5, 8, 16, 32)


def grams(text: Column, q: int = 3) -> Column:
    """The different substrings of `q` characters, in one pass over the text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * q}))"), F.lit(1)))


def gram_hashes(text: Column, q: int) -> Column:
    return F.transform(grams(text, q), lambda g: F.xxhash64(g))


def anchored(needles: DataFrame, text: str, on: tuple[str, ...] = ()) -> DataFrame:
    """Distinct needles that are not empty with __q, the characters of their grams, and __gram: the gram that the fewest needles of the same `on` share."""
    q = F.lit(GRAMS[0])
    for n in GRAMS[1:]:
        q = F.when(F.length(text) >= n, n).otherwise(q)
    rows = needles.select(*on, text).filter(F.length(text) > 0).distinct().withColumn("__q", q)
    of = F.coalesce(*[F.when(F.col("__q") == n, gram_hashes(F.col(text), n)) for n in GRAMS])
    rows = rows.select(F.struct(*on, text).alias("__key"), "__q", F.explode(of).alias("__gram"))
    shared = Window.partitionBy(*[f"__key.{c}" for c in on], "__q", "__gram")
    chosen = rows.withColumn("__n", F.count("*").over(shared)).groupBy("__key", "__q").agg(F.min_by("__gram", F.struct("__n", "__gram")).alias("__gram"))
    return chosen.select(*[F.col(f"__key.{c}").alias(c) for c in (*on, text)], "__q", "__gram")


def containing(texts: DataFrame, text: str, needles: DataFrame, needle: str, on: tuple[str, ...] = ()) -> DataFrame:
    """Rows of `texts` with each row of `needles` whose `needle` is a substring of `text`, among rows with equal `on` columns.

    A needle meets only the texts that hold its anchor gram, so neither all pairs
    nor a nested loop arise. Grams travel with a hash of their text and not with
    the text, so what is shuffled grows with the characters; the check that
    follows is exact. Anchors are written first, so that Spark knows whether they
    are few. Nulls and empty needles are in no text. Columns of the two tables
    must differ but for `on`.
    """
    path = scratch(texts.sparkSession)
    anchored(needles, needle, on).write.parquet(path)
    anchors = texts.sparkSession.read.parquet(path)
    keyed = texts.withColumn("__id", F.xxhash64(text))
    met = []
    for (q,) in anchors.select("__q").distinct().collect():  # of GRAMS
        held = keyed.select(*on, "__id", F.explode(gram_hashes(F.col(text), q)).alias("__gram"))
        met.append(held.join(anchors.filter(F.col("__q") == q).drop("__q"), [*on, "__gram"]).select(*on, "__id", needle))
    if not met:
        return texts.join(needles.limit(0), list(on)) if on else texts.limit(0).crossJoin(needles.limit(0))
    pairs = reduce(DataFrame.unionByName, met).distinct()
    found = keyed.join(pairs, [*on, "__id"]).filter(F.contains(text, needle)).drop("__id")
    return found.join(needles, [*on, needle]).select(*texts.columns, *[c for c in needles.columns if c not in on])


def containing_words(words: DataFrame, word: str, needles: DataFrame, needle: str) -> DataFrame:
    """`containing` for short texts, with distinct needles: rows stay where they are as long as Spark broadcasts the needles' anchors, so they need not be shuffled to be told apart."""
    path = scratch(words.sparkSession)
    anchored(needles, needle).write.parquet(path)
    anchors = words.sparkSession.read.parquet(path)
    sizes = sorted(q for (q,) in anchors.select("__q").distinct().collect())  # of GRAMS
    if not sizes:
        return words.withColumn(needle, F.lit("")).limit(0)
    each = F.concat(*[F.transform(grams(F.col(word), q), lambda g: F.struct(F.length(g).alias("q"), F.xxhash64(g).alias("g"))) for q in sizes])
    held = words.select("*", F.inline(each)).withColumnsRenamed({"q": "__q", "g": "__gram"})
    return held.join(anchors, ["__q", "__gram"]).filter(F.contains(word, needle)).drop("__q", "__gram")


def occurrences(text: Column, needle: Column) -> Column:
    """How often a needle that is not empty occurs in a text, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, needle, F.lit("")))) / F.length(needle)).cast("long")
