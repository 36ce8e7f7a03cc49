"""URL filter: rules, and gradient-boosted trees on lexical features, in DataFrame functions and Spark ML.

Features of a URL are its lengths, path depth, digit ratio, entropy of the host,
parameter counts, hyphens, and statistics of the host's suffixes: how frequent a
suffix is and its smoothed share of blocked labelled URLs. Suffixes are the last
label and the last two. Their statistics are counted in one pass over all URLs
and all labels, and every suffix keeps its own; one without labels has the
labels' mean as its rate. The trees are fitted on a bounded sample of labelled
URLs, whose rates leave out the labels of their own fold; every URL is scored.

Labels are the caller's input, as are the rules. The query has no table of
labelled URLs, so it labels the pages' own hosts with a list of seed words
(SEEDS), as block lists do: a host with a seed among its words is blocked. Seeds
are no features, and the README says how well hosts without labels are judged.

Defined results
---------------
Null url, or one without `://`: empty host and path, no rule fits, and the trees
judge the empty features. Equal urls get equal verdicts. Of equally long rules
the first in text order wins. Without both labels in training there are no
trees, and the method allows. An empty table gives no rows. All columns of the
input are kept whatever their names, but for one that has the name of the result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import cut, table
from tallyforge.llm.components import join_by_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Rules up to which one expression tests them all; more are joined.
IN_EXPRESSION = 1_000
#: Words of a host that mark it as blocked in training.
SEEDS = ("ads", "adult", "bet", "bets", "casino", "cheap", "free", "loan", "loans", "pills", "poker", "porn", "spam", "track", "tracker", "win", "xxx")
#: Labelled rows that the trees are fitted on, in the mean.
SAMPLE, TREES, DEPTH = 20_000, 12, 3
#: Suffixes whose statistics are broadcast: the most frequent ones. All others are joined by a shuffle.
SUFFIXES = 2_000
#: Labels of a suffix that its rate is smoothed by; folds of labelled rows; values that rows of broadcast suffixes are dealt by in the shuffle.
SMOOTH, FOLDS, DEALT = 20, 5, 4_096
FEATURES = ("url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "query_length", "labels", "hyphens", "vowel_ratio", "suffix1_share", "suffix1_rate", "suffix2_share", "suffix2_rate")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def count_of(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), URL, 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), URL, 2)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct of rule and verdict, else null; for short lists."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def with_rule(urls: DataFrame, rules=RULES, url: str = "url", result: str = "ruled", in_expression: int = IN_EXPRESSION) -> DataFrame:
    """Adds a struct of rule and verdict, null where no rule fits.

    Long lists are a table: the distinct hosts and paths meet the rules of each
    of the host's suffixes, and the longest that fits goes back to the urls.
    """
    host, path = url_host(F.col(url)), url_path(F.col(url))
    if len(rules) <= in_expression:
        return urls.withColumn(result, rule_for(host, path, rules))
    rows = urls.drop(result).select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    each = rows.groupBy("host", "path").agg(F.count("*").alias("n"))
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = urls.sparkSession.createDataFrame(list(rules), "suffix string, start string, verdict string").withColumn("rule", F.concat("suffix", "start"))
    fits = each.withColumn("suffix", F.explode(ends)).join(known, "suffix").filter(F.col("path").startswith(F.col("start")))
    longest = fits.groupBy("host", "path").agg(F.min_by(F.struct("rule", "verdict"), F.struct(-F.length("rule"), "rule")).alias(result))
    found = each.join(longest, ["host", "path"], "left")
    return join_by_key(rows, found, ["host", "path"], rows.count()).select("row.*", result)


def entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.array_distinct(F.split(text, ""))
    size = F.length(text)
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    return F.when(size > 0, -F.aggregate(F.filter(letters, lambda c: c != ""), F.lit(0.0), lambda a, c: a + share(c) * F.log2(share(c)))).otherwise(0.0)


def suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def lexical(urls: DataFrame) -> DataFrame:
    """Adds host, path and the features that a URL has by itself; `urls` has url, and no column of the names that are added."""
    u, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    ratio = lambda n, d: F.when(d > 0, n / d).otherwise(0.0)
    return urls.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url"))).withColumns(
        {
            "url_length": F.length(u),
            "host_length": F.length(host),
            "path_length": F.length(path),
            "depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")),
            "digit_ratio": ratio(count_of(u, "0123456789"), F.length(u)),
            "entropy": entropy(host),
            "parameters": F.when(query == "", 0).otherwise(count_of(query, "&;") + 1),
            "query_length": F.length(query),
            "labels": F.size(F.filter(F.split(host, r"\."), lambda s: s != "")),
            "hyphens": count_of(host, "-"),
            "vowel_ratio": ratio(count_of(host, "aeiou"), F.length(host)),
            "suffix1": suffix(host, 1),
            "suffix2": suffix(host, 2),
        }
    )


def fold() -> Column:
    return F.pmod(F.xxhash64(F.coalesce("url", F.lit("")), F.lit("fold")), F.lit(FOLDS)).cast("int")


def suffix_statistics(urls: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row per suffix2: for it (s2) and its suffix1 (s1) the n of all urls, and the labels and blocked labels of each fold."""
    none, zero = F.lit(None).cast("int"), F.lit(0)
    each = urls.select("suffix2", F.lit(1).alias("n"), none.alias("fold"), zero.alias("label")).unionByName(labelled.select("suffix2", zero.alias("n"), fold().alias("fold"), F.col("label").cast("int").alias("label")))
    mine = lambda f, value: F.sum(F.when(F.col("fold") == f, value).otherwise(0))
    two = each.groupBy("suffix2").agg(F.struct(F.sum("n").alias("n"), F.array(*[mine(f, F.lit(1)) for f in range(FOLDS)]).alias("told"), F.array(*[mine(f, F.col("label")) for f in range(FOLDS)]).alias("blocked")).alias("s2"))
    two = two.withColumn("suffix1", suffix(F.col("suffix2"), 1))
    total = lambda name: F.array(*[F.sum(F.col(f"s2.{name}")[f]) for f in range(FOLDS)]).alias(name)
    one = two.groupBy("suffix1").agg(F.struct(F.sum("s2.n").alias("n"), total("told"), total("blocked")).alias("s1"), F.count("*").alias("n"))
    return join_by_key(two, one, ["suffix1"], two.count()).select("suffix2", "s1", "s2")


def with_statistics(rows: DataFrame, statistics: DataFrame, total: int, prior: float, left_out: Column | None = None) -> DataFrame:
    """Adds both suffixes' shares of all urls and their smoothed rates of blocked labels, those of fold `left_out` not counted.

    The most frequent suffixes are broadcast. Where there are more, rows of the
    others meet theirs in a shuffle, in which rows that have found theirs are
    dealt evenly.
    """
    value = F.struct("s1", "s2")
    head = statistics.orderBy(F.desc("s2.n"), "suffix2").limit(SUFFIXES) if (more := statistics.count() > SUFFIXES) else statistics
    head = cut(head) if more else head
    out = rows.join(F.broadcast(head.select("suffix2", value.alias("found"))), "suffix2", "left")
    if more:
        tail = statistics.join(F.broadcast(head.select("suffix2")), "suffix2", "left_anti").select(F.col("suffix2").alias("key"), value.alias("rare"))
        key = F.when(F.col("found").isNull(), F.col("suffix2")).otherwise(F.concat(F.lit("\u0001"), F.pmod(F.monotonically_increasing_id(), F.lit(DEALT)).cast("string")))
        out = out.withColumn("key", key).join(tail, "key", "left").withColumn("found", F.coalesce("found", "rare")).drop("key", "rare")
    whole = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    counted = lambda c: F.coalesce(whole(c) - (c[left_out] if left_out is not None else 0), F.lit(0))
    for k in (1, 2):
        s = F.col(f"found.s{k}")
        rate = (counted(s["blocked"]) + SMOOTH * prior) / (counted(s["told"]) + SMOOTH)
        out = out.withColumns({f"suffix{k}_share": F.coalesce(s["n"], F.lit(0)) / F.lit(float(max(1, total))), f"suffix{k}_rate": rate})
    return out.drop("found")


def seeded(host: Column, seeds=SEEDS) -> Column:
    return F.arrays_overlap(F.split(host, r"[.\-]"), F.array(*map(F.lit, seeds))).cast("int")


def judge(urls: DataFrame, labelled: DataFrame, url: str = "url", sample: int = SAMPLE, result: str = "judged") -> DataFrame:
    """`urls` with a struct `result` of host, path and blocked (0 or 1, by the trees).

    `labelled` has url and label (1: block). The trees learn from about `sample`
    of its rows, chosen by a hash of the url; suffix statistics count all of them.
    """
    rows = lexical(urls.drop(result).select(F.struct("*").alias("row"), F.col(url).cast("string").alias("url")))
    told = lexical(labelled.filter("label IS NOT NULL").select(F.col("url").cast("string").alias("url"), F.col("label").cast("int").alias("label")))
    statistics = cut(suffix_statistics(rows, told))
    each = lambda name: F.sum(F.aggregate(f"s2.{name}", F.lit(0).cast("long"), lambda a, x: a + x)).alias(name)
    figures = statistics.agg(F.sum("s2.n").alias("total"), each("told"), each("blocked")).first()
    total, n, blocked = (figures[c] or 0 for c in ("total", "told", "blocked"))
    judged = lambda df, value: df.select("row.*", F.struct("host", "path", value.cast("int").alias("blocked")).alias(result))
    if not 0 < blocked < n:
        return judged(rows, F.lit(0))
    prior = blocked / n
    # both labels share the sample, so that rare ones are seen
    odds = {1: min(1.0, sample / 2 / blocked), 0: min(1.0, sample / 2 / (n - blocked))}
    draw = F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(1_000_000)) / 1_000_000.0
    weight = {1: n / blocked / odds[1], 0: n / (n - blocked) / odds[0]}
    drawn = told.filter(draw < F.when(F.col("label") == 1, odds[1]).otherwise(odds[0])).withColumn("weight", F.when(F.col("label") == 1, weight[1]).otherwise(weight[0]))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform
    drawn = cut(assemble(with_statistics(drawn, statistics, total, prior, fold())).select("features", "label", "weight"))
    trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(drawn)
    return judged(trees.transform(assemble(with_statistics(rows, statistics, total, prior))), F.col("prediction"))


def op9_boosted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = pages.select("url", seeded(url_host(F.col("url"))).alias("label"))
    found = with_rule(judge(pages, labelled))
    method = F.when(F.col("judged.blocked") == 1, "block").otherwise("allow")
    return found.select("page_id", "judged.host", "judged.path", F.col("ruled.rule").alias("rule"), F.coalesce("ruled.verdict", method).alias("verdict"), method.alias("method_verdict"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op9 SQL can say: host, path and rule of every page, the rules as a joined table."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = with_rule(pages, RULES, in_expression=0)
    return found.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "ruled.rule", F.col("ruled.verdict").alias("rule_verdict"))


QUERIES = {"op9_boosted_urls": op9_boosted_urls, "url_rules": url_rules}

RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
ORACLE: dict[str, str] = {
    "url_rules": rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, translate(regexp_extract(url, '{URL[4:]}', 1, 's'), '{UPPER}', '{LOWER}') AS host, regexp_extract(url, '{URL[4:]}', 2, 's') AS path FROM u),
r(h, start, verdict) AS (VALUES {RULES_SQL}),
m AS (SELECT page_id, h || start AS rule, verdict FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || start) DESC, h || start) = 1)
SELECT page_id, host, path, rule, verdict AS rule_verdict FROM p LEFT JOIN m USING (page_id)"""
}
