"""N-gram Jaccard self-join by MinHash banding, for near-duplicate documents.

1. One pass hashes each document's words and the MinHash bands of its n-gram
   set. Rows and bands are chosen for a target recall at the threshold.
2. Documents of equal words form a copy class; the join works on classes.
3. A shuffle on band hashes finds classes that meet in a bucket. Each bucket
   hands on one edge per member, to its least member, so that a bucket of n
   classes costs n rows. Components of these edges are the candidate groups.
4. Inside a candidate group all pairs are verified on their full n-gram sets.
   A group is dealt into blocks of bounded size and every two blocks meet in one
   task, which returns rows per member: the links counted, and one edge to the
   least member of its verified component. Pairs themselves are never rows.
5. Components of the verified edges are the near-duplicate classes.

No bucket, group or partner is capped, and copies are never expanded.

Defined results
---------------
Words are runs of digits, ASCII letters (lowered) and anything above ASCII. A
text of fewer than `n` words has one n-gram of all its words. Texts without
words, null and empty ones included, are linked to equal texts only. A null id
gives a row of its own: no class, no links. Rows that repeat an id are one
document if their words are equal, else each has the result of its own words. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import claim, cut, ship, table
from tallyforge.llm.components import components, join_by_key
from tallyforge.llm.decontaminate import words

N, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.999, 256
#: Classes in a block; two blocks meet in a task.
BLOCK = 1024
#: Up to so many grouped classes (under 100 bytes each) their ids are broadcast to find their texts.
BROADCAST_ROWS = 200_000
SKETCH = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])
COUNTED = pa.schema([("key", pa.binary()), ("documents", pa.int64()), ("texts", pa.int64()), ("peer", pa.binary())])


def banding(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): as many rows as `max_hashes` allows with this recall at the threshold."""
    best = (1, 1)
    for rows in range(1, max_hashes + 1):
        if threshold >= 1:
            return 1, max_hashes
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def words_key(w: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(w))


def ngram_hashes(w: list[bytes], n: int) -> np.ndarray:
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    odd = np.array([xxhash.xxh3_64_intdigest(b"%d" % i) | 1 for i in range(n)], dtype=np.uint64)
    if len(h) < n:
        out = np.array([(h * odd[: len(h)]).sum(dtype=np.uint64)])
    else:
        out = sum(h[i : len(h) - n + 1 + i] * odd[i] for i in range(n))
    return np.unique(out ^ (out >> np.uint64(29)))


def minhash(values: np.ndarray, hashes: int) -> np.ndarray:
    rng = np.random.default_rng(20)
    a, b = rng.integers(0, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, hashes, dtype=np.uint64)
    least = np.full(hashes, 2**32 - 1, dtype=np.uint64)
    for at in range(0, len(values), 2_000):
        least = np.minimum(least, ((values[at : at + 2_000, None] * a + b) >> np.uint64(32)).min(axis=0))
    return least.astype(np.uint32)


def named(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """row (the document's own columns, whatever their names), __id, __mark and __text: the mark and the id tell rows of different texts apart."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(row, F.col(f"`{doc}`").cast("long").alias("__id"), F.xxhash64(body).alias("__mark"), body.cast("binary").alias("__text"))


def sketches(docs: DataFrame, doc: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, hash of the raw text, key of equal words, band hashes (none without words)."""

    def run(source):
        claim("sketches")
        for batch in source:
            keys, all_bands = [], []
            for raw in batch.column(2):
                raw = raw.as_py()
                w = words(raw)
                if not w:
                    keys.append(xxhash.xxh3_128_digest(b"\0" + raw))
                    all_bands.append([])
                    continue
                keys.append(words_key(w))
                m = minhash(ngram_hashes(w, n), bands * rows)
                all_bands.append([xxhash.xxh3_64_intdigest(m[i * rows : (i + 1) * rows].tobytes(), seed=i) - 2**63 for i in range(bands)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(all_bands, pa.list_(pa.int64()))], schema=SKETCH)

    return named(docs, doc, text).select("__id", "__mark", "__text").filter("__id IS NOT NULL").mapInArrow(run, "doc_id long, mark long, key binary, bands array<long>")


def ngram_ids(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Each text's full n-gram set, as numbers that equal n-grams of these texts share."""
    ids: dict[bytes, int] = {}
    out = []
    for raw in texts:
        w = words(raw)
        grams = {b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}
        out.append(np.fromiter((ids.setdefault(g, len(ids)) for g in grams), np.int64, len(grams)))
    return out


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float):
    """Yields (row, its partners) for every row of `left`, over n-gram sets and an inverted index of `right`."""
    sizes = np.array([len(s) for s in sets])
    grams = np.concatenate([sets[r] for r in right]) if len(right) else np.zeros(0, np.int64)
    order = np.argsort(grams, kind="stable")
    owner = np.repeat(np.arange(len(right)), sizes[right])[order]
    grams = grams[order]
    for row in left:
        a, b = np.searchsorted(grams, sets[row], "left"), np.searchsorted(grams, sets[row], "right")
        n = b - a
        if not n.sum():
            continue
        hits = owner[np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
        common = np.bincount(hits, minlength=len(right))
        found = right[common >= threshold * (sizes[row] + sizes[right] - common) - 1e-9]
        yield row, found[found != row]


def verify(members: pa.Table, n: int, threshold: float) -> pa.Table:
    """Rows for one pair of blocks (or one block with itself)."""
    keys = members.column("key").to_pylist()
    weight = members.column("copies").to_numpy()
    block = members.column("block").to_numpy()
    first, second = members.column("i")[0].as_py(), members.column("j")[0].as_py()
    sets = ngram_ids(members.column("text").to_pylist(), n)
    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    documents, texts = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    root = list(range(len(keys)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for row, found in linked(sets, left, right, threshold):
        documents[row] += weight[found].sum()
        texts[row] += len(found)
        if first != second:
            documents[found] += weight[row]
            texts[found] += 1
        for other in found:
            x, y = top(int(row)), top(int(other))
            if x != y:
                root[max(x, y, key=lambda k: keys[k])] = min(x, y, key=lambda k: keys[k])
    some = np.flatnonzero(texts)
    return pa.Table.from_arrays([pa.array([keys[k] for k in some], pa.binary()), pa.array(documents[some]), pa.array(texts[some]), pa.array([keys[top(int(k))] for k in some], pa.binary())], schema=COUNTED)


def judged(docs: DataFrame, doc: str, text: str, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES, block: int = BLOCK) -> tuple[DataFrame, DataFrame, int]:
    """(sketch: doc_id, mark and key of every row with an id; one row per key: its class's root, its rep (id and mark) and copies, linked documents and texts; rows of sketch)."""
    ship(docs.sparkSession)
    bands, rows = banding(threshold, recall, max_hashes)
    sketch = cut(sketches(docs, doc, text, n, bands, rows))
    total = sketch.count()
    repeated = cut(sketch.groupBy("doc_id", "mark").agg(F.count("*").alias("n")).filter("n > 1"))
    classes = sketch.groupBy("key").agg(F.min(F.struct("doc_id", "mark")).alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    met = classes.select("key", F.explode("bands").alias("bucket"))
    pivots = met.groupBy("bucket").agg(F.min("key").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    groups = components(join_by_key(met, pivots, ["bucket"], total * bands).select("key", "pivot").distinct(), "key", "pivot")
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "key")
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("n"))
    members = join_by_key(groups, sizes, ["root"], total).join(classes.select("key", "copies", F.col("rep.doc_id").alias("__id"), F.col("rep.mark").alias("__mark")), "key")
    members = cut(members.join(repeated.withColumnsRenamed({"doc_id": "__id", "mark": "__mark"}), ["__id", "__mark"], "left").withColumn("n", F.coalesce("n", F.lit(1))))
    texts = named(docs, doc, text).select("__id", "__mark", F.col("__text").alias("text"))
    texts = texts.join(F.broadcast(members), ["__id", "__mark"]) if members.count() <= BROADCAST_ROWS else join_by_key(texts, members.withColumn("again", F.col("n")), ["__id", "__mark"], total).withColumnRenamed("again", "n")
    if not repeated.isEmpty():  # a text is compared once, however many rows repeat it under one id
        texts = texts.filter("n = 1").unionByName(texts.filter("n > 1").dropDuplicates(["__id", "__mark"]))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met_blocks = texts.withColumn("block", own).withColumn("other", other).select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "copies", "text")
    counted = cut(met_blocks.groupBy("root", "i", "j").applyInArrow(lambda t: verify(t, n, threshold), "key binary, documents long, texts long, peer binary"))
    links = counted.groupBy("key").agg(F.sum("documents").alias("documents"), F.sum("texts").alias("texts"))
    joined = components(counted.select("key", "peer"), "key", "peer")
    roots = classes.select("key", "rep", "copies").join(joined.withColumnRenamed("node", "key"), "key", "left").join(links, "key", "left").withColumn("root", F.coalesce("root", "key"))
    return sketch.select("doc_id", "mark", "key"), roots, total


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_text_links, copy_id.

    class_id is the least id of the near-duplicate class, copy_id that of the
    documents with equal words; n_links counts the other documents at or above
    the threshold, copies included, n_text_links the different texts among them.
    `settings` are those of `judged`.
    """
    sketch, roots, total = judged(docs, doc, text, **settings)
    least = roots.groupBy("root").agg(F.min("rep.doc_id").alias("class_id"), F.count("*").alias("n"))
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    result = join_by_key(roots, least, ["root"], total).select("key", "class_id", F.col("rep.doc_id").alias("copy_id"), (F.col("copies") - 1 + F.coalesce("documents", zero)).alias("n_links"), F.coalesce("texts", zero).alias("n_text_links"), F.col("copies").alias("n"))
    found = join_by_key(sketch, result, ["key"], total).select("doc_id", "class_id", "n_links", "n_text_links", "copy_id")
    nameless = docs.filter(F.col(f"`{doc}`").isNull()).select(none.alias("doc_id"), none.alias("class_id"), zero.alias("n_links"), zero.alias("n_text_links"), none.alias("copy_id"))
    return found.unionByName(nameless)


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One document of each class, that of least id, with its columns; rows without an id stay.

    Texts are judged, not ids: where an id occurs with different texts, each is
    kept or goes with its own class. Of rows with equal ids and words the first
    stays, in the order of text and then of all columns as JSON.
    """
    sketch, roots, total = judged(docs, doc, text, **settings)
    kept = roots.groupBy("root").agg(F.min(F.struct("rep.doc_id", "key")).alias("k")).select("k.*")
    mine = sketch.groupBy("doc_id", "key", "mark").agg(F.count("*").alias("n")).join(kept, ["doc_id", "key"])
    rows = mine.groupBy("doc_id", "key").agg(F.sum("n").alias("rows"))
    wanted = cut(mine.join(rows, ["doc_id", "key"]).select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), F.col("key").alias("__key"), F.col("rows").alias("__rows"), "n"))
    found = join_by_key(named(docs, doc, text).select("__row", "__id", "__mark"), wanted, ["__id", "__mark"], total)
    nameless = docs.filter(F.col(f"`{doc}`").isNull())
    if wanted.filter("__rows > 1").isEmpty():
        return found.select("__row.*").unionByName(nameless)
    row = F.col("__row")
    first = found.filter("__rows > 1").groupBy("__id", "__key").agg(F.min_by(row, F.struct(row[text], F.to_json(row))).alias("__row"))
    return found.filter("__rows = 1").select("__row.*").unionByName(first.select("__row.*")).unionByName(nameless)


def op10_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op10_minhash_join": op10_minhash_join}

WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

NEAR_SQL = f"""
d AS (SELECT doc_id, {WORDS_SQL} AS w, coalesce(text, '') AS text FROM documents),
k AS (SELECT doc_id, w, CASE WHEN len(w) > 0 THEN array_to_string(w, ' ') ELSE chr(1) || text END AS key FROM d),
c AS (SELECT key, any_value(w) AS w, min(doc_id) AS rep, count(*) AS copies FROM k GROUP BY key),
g AS (SELECT DISTINCT key, array_to_string(list_slice(w, i, i + 4), ' ') AS gram FROM (SELECT key, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM c WHERE len(w) > 0)),
z AS (SELECT key, count(*) AS n FROM g GROUP BY key),
i AS (SELECT a.key AS a, b.key AS b, count(*) AS n FROM g a JOIN g b ON a.gram = b.gram AND a.key <> b.key GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN z x ON x.key = a JOIN z y ON y.key = b WHERE i.n >= 0.8 * (x.n + y.n - i.n) - 1e-9),
t AS (SELECT key AS a, key AS b FROM c UNION SELECT t.a, l.b FROM t JOIN l ON l.a = t.b),
m AS (SELECT t.a AS key, min(c.rep) AS class_id FROM t JOIN c ON c.key = t.b GROUP BY t.a),
n AS (SELECT l.a AS key, sum(c.copies) AS docs, count(*) AS texts FROM l JOIN c ON c.key = l.b GROUP BY l.a)"""

ORACLE = {
    "op10_minhash_join": f"""
WITH RECURSIVE {NEAR_SQL}
SELECT k.doc_id, m.class_id, CAST(c.copies - 1 + coalesce(n.docs, 0) AS BIGINT) AS n_links, CAST(coalesce(n.texts, 0) AS BIGINT) AS n_text_links, c.rep AS copy_id
FROM k JOIN c USING (key) JOIN m USING (key) LEFT JOIN n USING (key)"""
}
