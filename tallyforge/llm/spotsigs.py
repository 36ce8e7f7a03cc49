"""SpotSigs fingerprints and near-duplicate pairs, in DataFrame functions only.

A spot signature is a run of common words (the anchors) and the chain of content
words that follow it, anchors between them skipped. The set of a text's signatures,
hashed and sorted, is its fingerprint; likeness is the Jaccard coefficient of
two such sets.

Where anchors are rare, words stand for them, so that every part of a text
contributes: in a stretch of RUN or more content words without an anchor, each
word has the virtual anchor before it, and in a text without any anchor all have.
The rule looks at the stretch alone, so an edit changes the signatures near it.

Two sets of sizes a <= b can only reach a likeness t if a >= t b. Partners are
therefore sought between neighbouring size classes, whose bounds grow by 1 / t,
and within them by the first signatures of a set: two sets of likeness t share
one of the first (1 - t) a + 1 signatures in one fixed order, that of the number of
sets that have them. So buckets are small, and sets whose rarest signatures are
their own have none. A bucket of many sets is dealt to blocks, two of which meet in a task.

Defined results
---------------
Words are runs of letters and digits, A-Z lowered. A virtual anchor before the
first word gives one-word texts a signature; a chain at the end of the text may
be shorter than asked for. Null or empty texts have an empty
fingerprint; two empty fingerprints have likeness 1. The next document follows
in the order of doc_id (null first), then text; after the last comes the first.
A single document is its own next one. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import cut, store, table
from tallyforge.llm.components import components, join_by_key

#: Frequent function words of English, French, German and Spanish.
ANCHORS = ("a", "an", "and", "are", "at", "avec", "con", "das", "dans", "de", "del", "der", "des", "die", "du", "el", "en", "est", "et", "for", "from", "in", "is", "it", "la", "las", "le", "les", "los", "mit", "of", "on", "para", "par", "pour", "que", "qui", "sur", "that", "the", "this", "to", "un", "una", "und", "une", "von", "was", "with", "zu")
CHAIN = 2
THRESHOLD = 0.8
#: Content words without an anchor from which each has the virtual one.
RUN = 8
#: Signatures of so many sets or more are equally common in the order; sets in a block, two of which meet in a task.
COMMON, BLOCK = 1 << 20, 512
GROUP = ("sig", "part", "i", "j")  # a pair of blocks of a bucket
#: Documents in a range of ids, in the mean, where each text is joined to the next; at most RANGES ranges.
RANGE_ROWS, RANGES = 2_000, 2_000


#: Stands between an anchor and what follows it; no word has it.
MARK = "\u0001"
#: A content word with another word after it, in a stretch of RUN of them: the first by looking ahead, others where the one before was found.
BARE = f" [^ {MARK}]++(?= |$)"
IN_RUN = f"(?:\\G(?!\\A)|(?=(?:{BARE}){{{RUN}}})) ([^ {MARK}]++)(?= )"


def with_chains(rows: DataFrame, text: str, name: str, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Adds each run of anchors of a text with the content words that follow it, as strings; repeated ones are kept.

    Anchors are glued to the word after them, so that each blank-separated token
    is a content word with the anchors before it. Tokens are then put beside the
    content words that come after. Steps are columns of their own, so that each
    is evaluated once.
    """
    low = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "))
    glued = F.regexp_replace(F.concat(F.lit(" "), plain, F.lit(" ")), f"(?<= )({'|'.join(anchors)}) ", f"$1{MARK}")
    out = rows.withColumn("__glued", F.concat(F.lit(f"^{MARK}"), F.trim(glued)))
    # the last word of a text is in the chain of the one before it
    every = F.regexp_replace("__glued", " (?=[^ ]+ )", f" ^{MARK}")
    rare = F.regexp_replace("__glued", IN_RUN, f" ^{MARK}$1")
    out = out.withColumn("__glued", F.when(F.locate(MARK, F.col("__glued"), 3) == 0, every).otherwise(rare))
    out = out.withColumn("__tokens", F.split("__glued", " ")).withColumn("__content", F.split(F.regexp_replace("__glued", f"[^ ]*{MARK}", ""), " "))
    joined = F.col("__tokens")
    for n in range(2, chain + 1):
        later = F.slice("__content", n, F.greatest(F.size("__content"), F.lit(1)))
        joined = F.zip_with(joined, later, lambda t, c: F.when(c != "", F.concat(t, F.lit(" "), c)).otherwise(t))
    spots = F.filter(joined, lambda t: t.contains(MARK) & ~t.endswith(MARK))
    return out.withColumn(name, spots).drop("__glued", "__tokens", "__content")


def with_signatures(rows: DataFrame, text: str, name: str, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Adds the sorted set of the hashed spot signatures of a text."""
    out = with_chains(rows, text, "__chains", anchors, chain)
    return out.withColumn(name, F.sort_array(F.array_distinct(F.transform("__chains", lambda s: F.xxhash64(s))))).drop("__chains")


def fingerprint(sigs: Column) -> Column:
    """A signature set as text: each signature in 16 hex digits, in order."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every > 0, common / every).otherwise(1.0)


def with_next(docs: DataFrame, doc: str, columns: list[str]) -> DataFrame:
    """Each row with next_<column> of the row that follows in the order of `doc`.

    Ids are dealt to ranges. The first rows of a range are also sent to the
    range before, where they stand last; so each range finds all its next rows
    alone, and texts are shuffled once.
    """
    at = F.coalesce(F.col(doc), F.lit(-(2**63)))
    n = docs.count()
    wanted = max(1, min(RANGES, -(-n // RANGE_ROWS)))
    bounds = docs.select(F.percentile_approx(at, [i / wanted for i in range(1, wanted)] or [0.5], 20 * wanted)).first()[0] or []
    bounds = sorted(set(bounds))[: wanted - 1] if wanted > 1 else []
    ranges = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < at)) if bounds else F.lit(0)
    dealt = docs.withColumn("__range", ranges)
    starts = {r["__range"]: r["start"] for r in dealt.select("__range", at.alias("at")).groupBy("__range").agg(F.min("at").alias("start")).collect()}  # a row for each range
    used = sorted(starts)
    before = {k: used[i - 1] for i, k in enumerate(used)}
    firsts = F.create_map(*[x for k, s in starts.items() for x in (F.lit(k), F.struct(F.lit(s).cast("long").alias("start"), F.lit(before[k]).alias("to")))]) if starts else F.lit(None).cast("map<int,struct<start:long,to:int>>")
    first = firsts[F.col("__range")]
    own = F.struct(F.col("__range").alias("to"), F.lit(False).alias("halo"))
    copies = F.when(first["start"] == at, F.array(own, F.struct(first["to"].alias("to"), F.lit(True).alias("halo")))).otherwise(F.array(own))
    sent = dealt.withColumn("__sent", F.explode(copies)).select(*columns, F.col("__sent.to").alias("__to"), F.col("__sent.halo").alias("__halo"))
    order = Window.partitionBy("__to").orderBy("__halo", F.col(doc).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in columns if c != doc])
    return sent.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])


def edited(text: Column, following: Column) -> Column:
    """`text`, its last half replaced with the start of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def shared_signatures(sets: DataFrame, threshold: float) -> DataFrame:
    """(key, copies, size, sigs, kept) of sets that may have a partner: their signatures that other sets have, too, rare ones first, the first `kept` of them the prefix.

    Signatures of one set only are the rarest: they fill its prefix first and are
    in no intersection, so they are left out, and with them all sets whose prefix
    they fill.
    """
    each = sets.select("key", F.explode("sigs").alias("sig"))
    counts = store(each.groupBy("sig").agg(F.count("*").alias("n")).filter("n > 1").withColumn("often", F.least("n", F.lit(COMMON))))
    total = sets.agg(F.sum(F.size("sigs"))).first()[0] or 0
    ranked = join_by_key(each, counts, ["sig"], total).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("often", "sig"))).alias("r"))
    rows = sets.select("key", "copies", F.size("sigs").alias("size")).join(ranked, "key")
    kept = (F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - 1e-9) + 1) - (F.col("size") - F.size("r"))
    rows = rows.select("key", "copies", "size", F.transform("r", lambda x: x["sig"]).alias("sigs"), kept.cast("int").alias("kept"))
    return store(rows.filter("kept > 0"))


def signature_sets(docs: DataFrame, doc: str, text: str, anchors: tuple[str, ...], chain: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id and digest of every row with an id, distinct sets: a number as key, digest, least id, copies and sigs)."""
    rows = with_signatures(docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL"), "text", "sigs", anchors, chain)
    # texts without a word are equal to equal texts only
    rows = store(rows.select("doc_id", F.unhex(F.sha2(F.when(F.size("sigs") > 0, F.to_json("sigs")).otherwise(F.concat(F.lit("-"), F.coalesce("text", F.lit("")))), 256)).alias("digest"), "sigs"))
    sets = rows.groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies"), F.first("sigs").alias("sigs"))
    return rows.select("doc_id", "digest"), store(sets.withColumn("key", F.monotonically_increasing_id()))


def bucket_members(sets: DataFrame, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(sets in the buckets of their prefix signatures and length classes, dealt to pairs of blocks (i, j) that meet; sets as `shared_signatures` gives them).

    A set is compared as the longer one in its own class, as the shorter one in
    its own and the next. Each set's shared signatures are put in order. Where
    all sets of a bucket have the same shared one before this one, every two of
    them are compared in an earlier bucket, so this one is left out.
    """
    rows = shared_signatures(sets, threshold)
    own_class = F.floor(F.log(F.col("size")) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")
    each = rows.select("key", F.posexplode(F.slice("sigs", F.lit(1), F.col("kept"))).alias("pos", "sig"), own_class.alias("own")).withColumn("up", F.explode(F.array(F.lit(0), F.lit(1))))
    each = each.select("key", "pos", "sig", (F.col("own") + F.col("up")).alias("part"), (F.col("up") == 0).alias("longer"))
    total = rows.agg(F.sum(F.col("kept") * 2)).first()[0] or 0
    shared = each.groupBy("sig", "part").agg(F.count("*").alias("n"), F.count_if("longer").alias("longer")).filter("n > 1 AND longer > 0").select("sig", "part", "n")
    each = store(join_by_key(each, shared, ["sig", "part"], total))
    before = F.lag("sig").over(Window.partitionBy("key", "part").orderBy("pos"))
    figures = F.count("*").alias("n"), F.count("before").alias("later"), F.min("before").alias("low"), F.max("before").alias("high")
    buckets = each.withColumn("before", before).groupBy("sig", "part").agg(*figures).filter("NOT (later = n AND low = high)").select("sig", "part", F.ceil(F.col("n") / block).cast("int").alias("blocks"), "n")
    own, others = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = join_by_key(each, buckets, ["sig", "part"], total).withColumn("block", own).withColumn("other", others)
    return store(met.select("sig", "part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "longer", "key")), rows


def partners(members: DataFrame, threshold: float) -> DataFrame:
    """(sig, part, i, j, key, root, documents, texts, peer): for each member of a pair of blocks, its linked sets there and the least of them with another root.

    A pair is looked at in the bucket of the first signature that its prefixes
    share, and nowhere else. Pairs are no rows.
    """
    member = F.struct("key", "copies", "size", "sigs", "kept", "longer", "block", "root")
    grouped = members.groupBy(*GROUP).agg(F.collect_list(member).alias("m"))
    grouped = grouped.withColumn("m", F.transform("m", lambda x: x.withField("prefix", F.slice(x["sigs"], F.lit(1), x["kept"]))))

    def linked(x: Column, y: Column) -> Column:
        first = (x["size"] < y["size"]) | ((x["size"] == y["size"]) & (x["key"] < y["key"]))
        fits = F.when(first, y["longer"] & (x["size"] >= threshold * y["size"] - 1e-9)).otherwise(x["longer"] & (y["size"] >= threshold * x["size"] - 1e-9))
        meet = (x["key"] != y["key"]) & ((F.col("i") == F.col("j")) | (x["block"] != y["block"]))
        here = F.get(F.array_intersect(x["prefix"], y["prefix"]), F.lit(0)) == F.col("sig")
        common = F.size(F.array_intersect(x["sigs"], y["sigs"]))
        return meet & fits & here & (common / (x["size"] + y["size"] - common) >= threshold - 1e-9)

    found = F.transform("m", lambda x: F.struct(x["key"].alias("key"), x["root"].alias("root"), F.transform(F.filter("m", lambda y: linked(x, y)), lambda y: F.struct(y["copies"].alias("copies"), y["root"].alias("root"))).alias("of")))
    some = grouped.select(*GROUP, F.explode(F.filter(found, lambda x: F.size(x["of"]) > 0)).alias("x"))
    documents = F.aggregate("x.of", F.lit(0).cast("long"), lambda acc, y: acc + y["copies"])
    peer = F.array_min(F.transform(F.filter("x.of", lambda y: y["root"] != F.col("x.root")), lambda y: y["root"]))
    return some.select(*GROUP, "x.key", "x.root", documents.alias("documents"), F.size("x.of").cast("long").alias("texts"), peer.alias("peer"))


def near_classes(docs: DataFrame, doc: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN, block: int = BLOCK) -> DataFrame:
    """One row per document with an id: doc_id, class_id, copy_id, n_links, n_text_links.

    Two documents are linked if the likeness of their signature sets is at least
    the threshold, those of equal sets included. class_id is the least id of the
    documents that are linked directly or through others, copy_id that of the
    documents of equal sets. Each round joins every set to its least partner of
    another root, until none has one; from the second on, only pairs of blocks
    whose linked sets still have several roots are looked at.
    """
    rows, sets = signature_sets(docs, doc, text, anchors, chain)
    members, ordered = bucket_members(sets, threshold, block)
    roots, links = sets.select("key", F.col("key").alias("root")), None
    while True:
        found = cut(partners(members.join(ordered, "key").join(roots, "key"), threshold))
        links = found.groupBy("key").agg(F.sum("documents").alias("documents"), F.sum("texts").alias("texts")) if links is None else links
        edges = cut(found.filter("peer IS NOT NULL").groupBy("root").agg(F.min("peer").alias("peer")))
        if edges.isEmpty():
            break
        joined = components(edges, "root", "peer").select(F.col("node").alias("__node"), F.col("root").alias("top"))
        sizes = roots.groupBy("root").agg(F.count("*").alias("n")).join(joined, F.col("root") == F.col("__node"), "left").select("root", F.coalesce("top", "root").alias("top"), "n")
        roots = cut(join_by_key(roots, sizes, ["root"], sets.count()).select("key", F.col("top").alias("root")))
        apart = found.select(*GROUP, "key").join(roots, "key").groupBy(*GROUP).agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
        members = store(members.join(apart, list(GROUP), "left_semi"))
    n = rows.count()
    least = sets.join(roots, "key").groupBy("root").agg(F.min("least_id").alias("class_id"), F.count("*").alias("n"))
    zero = F.lit(0).cast("long")
    named = join_by_key(sets.drop("sigs").join(roots, "key"), least, ["root"], n).join(links, "key", "left")
    named = named.select("digest", "class_id", F.col("least_id").alias("copy_id"), (F.col("copies") - 1 + F.coalesce("documents", zero)).alias("n_links"), F.coalesce("texts", zero).alias("n_text_links"), F.col("copies").alias("n"))
    return join_by_key(rows, named, ["digest"], n).select("doc_id", "class_id", "copy_id", "n_links", "n_text_links")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", ["doc_id", "text"])
    rows = with_signatures(rows, "text", "sigs")
    order = Window.partitionBy("__to").orderBy("__halo", F.col("doc_id").asc_nulls_first(), "text")
    rows = rows.withColumn("next_sigs", F.lead("sigs").over(order)).filter(~F.col("__halo"))
    rows = with_signatures(rows.withColumn("edited", edited(F.col("text"), F.col("next_text"))), "edited", "edited_sigs")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def spotsigs_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by their signatures."""
    return near_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op4_spotsigs": op4_spotsigs, "spotsigs_classes": spotsigs_classes}
ORACLE: dict[str, str] = {}
