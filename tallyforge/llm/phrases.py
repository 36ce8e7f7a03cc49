"""Phrase collocations: frequent phrases scored by how far their parts attract each other.

Only the longest windows are counted. Every word opens one: the word and lead
columns with the next words of its piece, null beyond the piece's end. Lead
columns are shifted copies of the piece's own array, so that no row is shuffled
to find its neighbours. Counts of equal windows are the counts of the longest
phrases; a ROLLUP over the windows' leading columns sums them to successively
shorter prefixes, down to the words and the group's total. No n-gram but the
longest is ever exploded.

What is shuffled is short. A first pass counts words and groups, and gives the most frequent
ones, at most HEAD, a code of WIDTH characters; windows are counted as texts of
codes. If these are all words of `min_count` or more, windows end before a rarer
word, since no phrase of interest holds it; if not, other words are spelled out.
The results are the same either way, and codes are turned back into words once
only frequent phrases are left.

From there on only phrases of `min_count` or more matter: a part of a candidate
is at least as frequent as the candidate. They are written once; cuts, scores and
the phrases that longer ones swallow are joins of that table with itself. A word
that begins a large part of all phrases is a skewed key of these joins, which AQE
splits; counting is combined before each shuffle, so hot phrases do no harm.

Scores are decimals without fraction: exact while 1000000 * a * a is below
10^38, that is for counts up to 10^15.

Defined results
---------------
Null text: empty. Null group: `und`, together with a group of that name. Texts
and pieces without words give nothing. Repeated rows count each. Ties of score
and count go to the phrase of least UTF-8 bytes. An empty table gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import store, table

LONGEST, MIN_COUNT, SHARE, TOP, NAMELESS = 3, 10, 50, 2000, "und"
#: Each group's phrases are ranked in so many parts first; the first `top` of each part are ranked again.
PARTS = 256
#: Words that get a code for the time of counting, and the code's characters (36^WIDTH > HEAD).
HEAD, WIDTH = 1 << 20, 4
BREAKS, BLANKS = r"[.,;:!?\x0A-\x0D]", r"[\x20\x09]+"
OTHER_CAPITALS = r"[\x{80}-\x{10FFFF}&&[\p{javaUpperCase}\p{javaTitleCase}]]"
EXACT = "decimal(38,0)"


def pieces(docs: DataFrame, text: str = "text", group: str = "lang") -> DataFrame:
    """One row per piece: grp and w, the array of its words."""
    whole = F.replace(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("\t"), F.lit(" "))
    rows = docs.select(F.coalesce(F.col(group).cast("string"), F.lit(NAMELESS)).alias("grp"), F.explode(F.split(whole, BREAKS)).alias("piece"))
    # `lower` is much faster, and right where it changes A-Z alone
    plain = (F.length("piece") == F.octet_length("piece")) | ~F.rlike("piece", F.lit(OTHER_CAPITALS))
    lower = F.when(plain, F.lower("piece")).otherwise(F.translate("piece", string.ascii_uppercase, string.ascii_lowercase))
    return rows.select("grp", F.array_remove(F.split(lower, " "), "").alias("w"))


def windows(docs: DataFrame, text: str = "text", group: str = "lang", longest: int = LONGEST) -> DataFrame:
    """One row per word: grp, w1 (the word) and w2 .. (the words after it in its piece, else null)."""
    leads = [F.col("w"), *[F.slice("w", i + 1, F.size("w")) for i in range(1, longest)]]
    return pieces(docs, text, group).select("grp", F.inline(F.arrays_zip(*leads))).toDF("grp", *[f"w{i + 1}" for i in range(longest)])


def word_counts(docs: DataFrame, text: str = "text", group: str = "lang") -> DataFrame:
    """grp, word, f of all words, written once."""
    return store(pieces(docs, text, group).select("grp", F.explode("w").alias("word")).groupBy("grp", "word").agg(F.count("*").alias("f")))


def word_codes(counts: DataFrame, min_count: int = MIN_COUNT, head: int = HEAD) -> tuple[DataFrame, bool]:
    """(word, code of WIDTH characters) of the most frequent words, at most `head`, and whether these are all words that some group has `min_count` times or more."""
    counted = store(counts.groupBy("word").agg(F.sum("f").alias("f"), F.max("f").alias("most")).filter(F.col("most") >= min_count))
    grade = F.floor(F.log2("f") * 16)
    grades = sorted(((r["grade"], r["n"]) for r in counted.groupBy(grade.alias("grade")).agg(F.count("*").alias("n")).collect()), reverse=True)  # under 1,024 rows
    least, total = None, 0
    for g, n in grades:
        if total + n > head:
            break
        least, total = g, total + n
    chosen = counted.filter(F.lit(False) if least is None else grade >= least)
    number = F.row_number().over(Window.orderBy("word"))  # at most `head` rows
    return store(chosen.select("word", F.lpad(F.conv(number.cast("string"), 10, 36), WIDTH, "0").alias("code"))), total == sum(n for _, n in grades)


def coded(rows: DataFrame, codes: DataFrame, whole: bool, longest: int) -> DataFrame:
    """The windows as one text `key`: a code per word, blanks for missing ones, the group.

    Where every frequent word has a code (`whole`), a window ends before its first
    word that has none, since no frequent phrase holds it, and all codes together
    have a fixed width. Else words without a code stand between tabs, which no
    word contains, and one blank ends the words.
    """
    codes = F.broadcast(codes)  # at most HEAD rows
    for i in range(1, longest + 1):
        rows = rows.join(codes.select(F.col("word").alias(f"w{i}"), F.col("code").alias(f"c{i}")), f"w{i}", "left")
        rows = rows if whole else rows.withColumn(f"c{i}", F.coalesce(f"c{i}", F.concat(F.lit("\t"), f"w{i}", F.lit("\t"))))
    names = [f"c{i}" for i in range(1, longest + 1)]
    end = lambda k: F.lit(" " * (WIDTH * (longest - k) if whole else 1))
    return rows.select(F.coalesce(*[F.concat(*names[:k], end(k), "grp") for k in range(longest, -1, -1)]).alias("key"))


def frequent_phrases(docs: DataFrame, text: str = "text", group: str = "lang", longest: int = LONGEST, min_count: int = MIN_COUNT, head: int = HEAD) -> DataFrame:
    """grp, k, w (array of the k words), f: how often; k = 0 is the group's number of words. Phrases of fewer than `min_count` are left out."""
    counts = word_counts(docs, text, group)
    codes, whole = word_codes(counts, min_count, head)
    counted = coded(windows(docs, text, group, longest), codes, whole, longest).groupBy("key").agg(F.count("*").alias("f"))
    names = [f"e{i + 1}" for i in range(longest)]
    if whole:
        codes_at = lambda i: F.nullif(F.substring("key", 1 + WIDTH * i, WIDTH), F.lit(" " * WIDTH))
        rows = counted.select("f", F.substring("key", 1 + WIDTH * longest, 1 << 30).alias("grp"), *[codes_at(i).alias(n) for i, n in enumerate(names)])
    else:
        body = F.substring_index("key", " ", 1)
        words = F.regexp_extract_all(body, F.lit(rf"\t[^\t]*\t|[^\t]{{{WIDTH}}}"), F.lit(0))
        rows = counted.select("f", F.substring("key", F.length(body) + 2, F.length("key")).alias("grp"), *[F.get(words, F.lit(i)).alias(n) for i, n in enumerate(names)])
    # one condition on key and count together: it stays above the counting, whose shuffle both branches share
    top = rows.filter(F.when(F.col("f") >= min_count, F.col(names[-1]).isNotNull())).select("grp", F.lit(longest).alias("k"), *names, "f")
    first = F.concat(F.coalesce("e1", F.lit("")), F.lit(" "), "grp").alias("e1")  # the group goes with the first word
    rolled = rows.select(first, *names[1:-1], "f").rollup(*names[:-1]).agg(F.sum("f").alias("f"), F.grouping_id().alias("id")).filter("e1 IS NOT NULL")
    # the bits of grouping_id tell a prefix's own nulls (padding) from the columns that are summed over
    level = (F.lit(longest - 1) - F.length(F.replace(F.bin("id"), F.lit("0"), F.lit("")))).cast("int")
    word = F.substring_index("e1", " ", 1)
    rolled = rolled.select(F.substring("e1", F.length(word) + 2, F.length("e1")).alias("grp"), level.alias("k"), F.nullif(word, F.lit("")).alias("e1"), *names[1:-1], F.lit(None).cast("string").alias(names[-1]), "f")
    last = F.get(F.array(*names[:-1]), F.col("k") - 1)
    shorter = rolled.filter(F.when(F.col("f") >= min_count, last.isNotNull())).select("grp", "k", *names, "f")
    sums = counts.groupBy("grp").agg(F.sum("f").alias("f")).select("grp", F.lit(0).alias("k"), *[F.lit(None).cast("string").alias(n) for n in names], "f")
    found = top.unionByName(shorter).unionByName(sums)
    for n in names:
        found = found.join(F.broadcast(codes.select(F.col("code").alias(n), F.col("word").alias(f"of_{n}"))), n, "left").withColumn(n, F.coalesce(f"of_{n}", F.translate(n, "\t", "")))
    return found.select("grp", "k", F.slice(F.array(*names), F.lit(1), F.col("k")).alias("w"), "f")


def parts(k: Column, w: Column) -> Column:
    """Every cut of a phrase: k words before it, the first and the second part."""
    return F.transform(F.sequence(F.lit(1), k - 1), lambda i: F.struct(i.cast("int").alias("cut"), F.slice(w, F.lit(1), i).alias("first"), F.slice(w, i + 1, k - i).alias("rest")))


def inner(k: Column, w: Column) -> Column:
    """All phrases of two or more words inside a longer one."""
    return F.flatten(F.transform(F.sequence(F.lit(2), k - 1), lambda n: F.transform(F.sequence(F.lit(1), k - n + 1), lambda i: F.slice(w, i, n))))


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", longest: int = LONGEST, min_count: int = MIN_COUNT, share: int = SHARE, top: int | None = TOP, head: int = HEAD) -> DataFrame:
    """grp, rank, phrase, k, a, l, r, n, score of phrases of 2 to `longest` words.

    `score` is floor(1000000 a a / (l r)) of the lowest-scoring cut. Phrases of
    which a longer one has `share` percent or more of the occurrences are left
    out. `top` are the ranks kept of each group; None keeps all.
    """
    if longest < 2 or min_count < 1:
        raise ValueError("phrases have two words or more and occur once or more")
    known = store(frequent_phrases(docs, text, group, longest, min_count, head))
    candidates = known.filter("k >= 2").withColumnRenamed("f", "a")
    cuts = candidates.select("grp", "w", "a", F.explode(parts(F.col("k"), F.col("w"))).alias("c")).select("grp", "w", "a", "c.*")
    left = known.filter("k >= 1").select("grp", F.col("w").alias("first"), F.col("f").alias("l"))
    right = known.filter("k >= 1").select("grp", F.col("w").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["grp", "first"]).join(right, ["grp", "rest"])
    exact = lambda c: F.col(c).cast(EXACT)
    cuts = cuts.withColumns({"over": (exact("a") * exact("a") * F.lit(1_000_000).cast("decimal(7,0)")).cast(EXACT), "under": (exact("l") * exact("r")).cast(EXACT)}).withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("grp", "w").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"), F.first("a").alias("a"))
    if longest > 2:
        longer = candidates.filter("k > 2").select("grp", "a", F.explode(inner(F.col("k"), F.col("w"))).alias("w")).groupBy("grp", "w").agg(F.max("a").alias("most"))
        best = best.join(longer, ["grp", "w"], "left").filter(f"most IS NULL OR 100 * most < {share} * a")
    found = best.select("grp", F.array_join("w", " ").alias("phrase"), F.size("w").alias("k"), "a", "b.l", "b.r", "b.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    if top is not None:
        part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
        found = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order))).filter(F.col("rank") <= top).drop("part", "rank")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    sums = known.filter("k = 0").select("grp", F.col("f").alias("n"))
    return ranked.join(sums, "grp").select("grp", "rank", "phrase", "k", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).withColumnRenamed("grp", "lang").drop("k")


QUERIES = {"op12_collocations": op12_collocations}
ORACLE: dict[str, str] = {
    "op12_collocations": rf"""
WITH pieces AS (SELECT coalesce(lang, '{NAMELESS}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{BREAKS}')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '{BLANKS}'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM words, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= {MIN_COUNT}),
cuts AS (SELECT c.*, s.k AS cut, array_to_string(w[:s.k], ' ') AS first, array_to_string(w[s.k + 1:], ' ') AS rest FROM c, (VALUES (1), (2)) AS s(k) WHERE s.k < c.k),
scored AS (SELECT cuts.lang, cuts.k, cuts.phrase, a, cut, x.f AS l, y.f AS r, CAST((a::HUGEINT * a * 1000000) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, array_to_string(w[:2], ' ') AS phrase FROM c WHERE k = 3 UNION ALL SELECT lang, a, array_to_string(w[2:], ' ') FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < {SHARE} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang) QUALIFY rank <= {TOP}"""
}
