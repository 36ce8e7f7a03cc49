"""Benchmark decontamination: one Aho-Corasick automaton scans each text once.

Benchmark items are normalised to words; a window is `width` consecutive words
of an item, and an item of fewer words is one window. Every window of `width`
words holds a whole block of (width + 1) / 2 words that starts at a multiple of
that number in its item. The automaton's patterns are these blocks and the short
items, so it has about one node per benchmark word. It goes over the words of all
texts of a batch at once, cut into lanes that advance together; where a block
ends, the windows around it are looked up among the benchmark's and compared
word by word. Hits are mapped to word numbers and to code points of the original
text.

Words are 64-bit hashes. A task gets the items as such words (8 bytes each) and
builds the automaton once. One automaton holds up to `most_words` words; a larger
benchmark is dealt to several by item, which scan the texts one after another.

Defined results
---------------
Words are runs of digits, ASCII letters and anything above ASCII, A-Z lowered.
Null or empty text has no words and no hits. Items without words, or null, match
nothing. Repeated items and windows shared by items count for each item; repeated
documents are scanned each. An empty benchmark leaves all documents clean. All
document columns are kept, whatever their names, but for one that has the name of
the result. Item ids keep their type, which may be text or number.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import claim, cut, ship, table, utf8, worker_cache

WIDTH = 10
#: Benchmark words of one automaton, about 24 MB of text; a task holds about 45 bytes for each, and three times that while it builds.
MOST_WORDS = 4_000_000
#: The same words in the original text, where A-Z is not lowered yet.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
#: Lower-cases A-Z and blanks every byte between words.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
SPANS_SQL = "array<struct<start:long,end:long>>"
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
#: Bytes of a text whose words are held at once; words scanned in one go; words of a lane; hashes of words that are kept.
SLICE, TOGETHER, LANE, KEPT = 1 << 20, 4_000_000, 256, 500_000
ODD = np.random.default_rng(6).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: An automaton is built once per worker process.
_BUILT: dict[str, "Automaton"] = worker_cache("automaton")


def words(raw: bytes) -> list[bytes]:
    return raw.translate(NORMAL).split()


class Hashes(dict):
    """Words to their hashes, which are never 0."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word) or 1
        return h


def word_hashes(raw: bytes, known: Hashes) -> np.ndarray:
    """The hash of every word, over slices of bounded size."""
    plain, parts, at = raw.translate(NORMAL), [], 0
    while at < len(plain):
        end = len(plain) if at + SLICE >= len(plain) else plain.find(b" ", at + SLICE)
        end = len(plain) if end < 0 else end
        some = plain[at:end].split()
        parts.append(np.fromiter(map(known.__getitem__, some), np.uint64, len(some)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers from each start on, `counts` of them."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


class Automaton:
    """Aho-Corasick over word hashes, and the windows of the items."""

    BITS = 22  # of a key, that tell at once of most keys that they are none

    def __init__(self, text: np.ndarray, sizes: np.ndarray, items: np.ndarray, width: int = WIDTH):
        """`text` holds the items' word hashes one after another, `sizes` of them; `items` are their ids, which may repeat."""
        self.text, self.width, self.block = text, width, (width + 1) // 2
        starts = np.cumsum(sizes) - sizes
        long, short = sizes >= width, (sizes > 0) & (sizes < width)
        blocks = expand(np.zeros(long.sum(), np.int64), sizes[long] // self.block) * self.block + np.repeat(starts[long], sizes[long] // self.block)
        at = np.concatenate([blocks, starts[short]])
        length = np.concatenate([np.full(len(blocks), self.block), sizes[short]])
        ends = self.build(at, length)
        # short items by the node they end at, windows by hash: both as lists of items
        self.short_nodes, self.short_lists, _ = self.lists(ends[len(blocks) :].astype(np.uint64), items[short])
        per = np.where(long, sizes - width + 1, 0)
        window = expand(starts, per)
        self.windows, self.window_lists, first = self.lists(self.hashed(text, window), np.repeat(items, per))
        self.example = window[first]  # where each window stands in the text

    def hashed(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for k in range(self.width):
            out += text[at + k] * ODD[k]
        return out

    @staticmethod
    def lists(keys: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        """(distinct keys, (number of each key's list, where lists start, items), a row of each key); keys of equal items share a list."""
        order = np.lexsort((items, keys))
        keys, items = keys[order], items[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (items[1:] != items[:-1])
        keys, items, order = keys[fresh], items[fresh], order[fresh]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([first, [len(keys)]])).astype(np.int64)
        mark = np.array([xxhash.xxh3_64_intdigest(items[a : a + n].tobytes()) for a, n in zip(first.tolist(), counts.tolist())], dtype=np.uint64) if len(first) else np.zeros(0, np.uint64)
        _, chosen, number = np.unique(mark, return_index=True, return_inverse=True)
        kept = expand(first[chosen], counts[chosen]) if len(chosen) else np.zeros(0, np.int64)
        return keys[first], (number.astype(np.int64), np.concatenate([[0], np.cumsum(counts[chosen])]).astype(np.int64), items[kept]), order[first]

    def key(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        h = (word ^ (state.astype(np.uint64) * self.seed)) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(32))

    def build(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The trie by levels, then failure links; returns the node of each pattern's end."""
        for seed in ODD[32:].tolist():  # another seed, should two edges have one key
            self.seed = np.uint64(seed)
            node, count, levels = np.zeros(len(at), np.int64), 1, []
            parents, letters, clash = [np.zeros(1, np.int64)], [np.zeros(1, np.uint64)], False
            for d in range(int(length.max()) if len(length) else 0):
                some = np.flatnonzero(length > d)
                parent, letter = node[some], self.text[at[some] + d]
                keys, first, number = np.unique(self.key(parent, letter), return_index=True, return_inverse=True)
                clash |= bool(((parent[first][number] != parent) | (letter[first][number] != letter)).any())
                node[some] = count + number
                levels.append(keys)
                parents.append(parent[first])
                letters.append(letter[first])
                count += len(keys)
            keys = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
            order = np.argsort(keys, kind="stable")
            if not clash and (keys[order][1:] != keys[order][:-1]).all():
                break
        self.keys, self.child = keys[order], (order + 1).astype(np.int64)
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[(self.keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True
        self.fail, self.end = np.zeros(count, np.int64), np.zeros(count, bool)
        self.end[node] = True
        self.link = np.zeros(count, np.int64)  # the longest proper suffix that is a pattern
        self.depth = np.zeros(count, np.int64)
        begin = 1
        for d, (keys_, parent, letter) in enumerate(zip(levels, parents[1:], letters[1:])):
            nodes = np.arange(begin, begin + len(keys_))
            self.depth[nodes] = d + 1
            if d:
                self.fail[nodes] = self.step(self.fail[parent], letter)
            self.link[nodes] = np.where(self.end[self.fail[nodes]], self.fail[nodes], self.link[self.fail[nodes]])
            begin += len(keys_)
        return node

    def edge(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Children, or 0."""
        out = np.zeros(len(state), np.int64)
        if not len(self.keys):
            return out
        key = self.key(state, word)
        some = np.flatnonzero(self.maybe[(key >> np.uint64(64 - self.BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, key[some]), len(self.keys) - 1)
        found = self.keys[at] == key[some]
        out[some[found]] = self.child[at[found]]
        return out

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states after a word each."""
        state = state.copy()
        out = self.edge(state, word)
        left = np.flatnonzero((out == 0) & (state > 0))
        while len(left):
            state[left] = self.fail[state[left]]
            out[left] = self.edge(state[left], word[left])
            left = left[(out[left] == 0) & (state[left] > 0)]
        return out

    def ends(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the last word, node) of every pattern that occurs, in lanes that advance together."""
        warm = int(self.depth.max()) - 1 if len(self.keys) else 0
        lanes = np.arange(0, len(stream), LANE)
        state = np.zeros(len(lanes), np.int64)
        places, nodes = [], []
        for t in range(-warm, LANE):
            at = lanes + t
            live = np.flatnonzero((at >= 0) & (at < len(stream)))
            state[live] = self.step(state[live], stream[at[live]])
            if t >= 0:
                hit = live[self.end[state[live]] | (self.link[state[live]] > 0)]
                if len(hit):
                    places.append(at[hit])
                    nodes.append(state[hit])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place, node = np.concatenate(places), np.concatenate(nodes)
        found = [(place[self.end[node]], node[self.end[node]])]
        while len(node):
            more = self.link[node] > 0
            place, node = place[more], self.link[node[more]]
            found.append((place, node))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def scan(self, texts: list[np.ndarray]) -> list[tuple[list[tuple[int, int]], list[int]]]:
        """(merged half-open ranges of hit words, items hit) of each text."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        stream = np.zeros(int((sizes + 1).sum()), np.uint64)  # a 0 after each text, which no pattern has
        for s, t in zip(starts.tolist(), texts):
            stream[s : s + len(t)] = t
        place, node = self.ends(stream)
        place, first = np.unique(np.stack([place, node]), axis=1) if len(place) else (place, node)
        node = first
        number = np.searchsorted(self.short_nodes, node.astype(np.uint64)) if len(self.short_nodes) else np.zeros(len(node), np.int64)
        is_short = (number < len(self.short_nodes)) & (self.short_nodes[np.minimum(number, max(0, len(self.short_nodes) - 1))] == node) if len(self.short_nodes) else np.zeros(len(node), bool)
        begin, count, which = [place[is_short] - self.depth[node[is_short]] + 1], [self.depth[node[is_short]]], [(self.short_lists, number[is_short])]
        ended = place[self.depth[node] == self.block]
        around = np.unique((ended[:, None] - self.block + 1 - np.arange(self.width - self.block + 1)).ravel())
        text_of = np.searchsorted(starts, around, side="right") - 1
        around = around[(around >= 0) & (around + self.width <= starts[text_of] + sizes[text_of])] if len(around) else around
        if len(around) and len(self.windows):
            h = self.hashed(stream, around)
            at = np.minimum(np.searchsorted(self.windows, h), len(self.windows) - 1)
            same = self.windows[at] == h
            for k in range(self.width):
                same[same] = stream[around[same] + k] == self.text[self.example[at[same]] + k]
            begin.append(around[same])
            count.append(np.full(int(same.sum()), self.width))
            which.append((self.window_lists, at[same]))
        out: list[tuple[list[tuple[int, int]], list[int]]] = [([], []) for _ in texts]
        whole = np.concatenate(begin)
        if not len(whole):
            return out
        edges = np.zeros(len(stream) + 1, np.int32)
        np.add.at(edges, whole, 1)
        np.add.at(edges, whole + np.concatenate(count), -1)
        change = np.diff(np.concatenate([[False], np.cumsum(edges) > 0]).astype(np.int8))
        ranges = np.flatnonzero(change > 0), np.flatnonzero(change < 0)
        for text, a, b in zip((np.searchsorted(starts, ranges[0], side="right") - 1).tolist(), ranges[0].tolist(), ranges[1].tolist()):
            out[text][0].append((a - int(starts[text]), b - int(starts[text])))
        for places, ((numbers, bounds, items), key) in zip(begin, which):
            pairs = np.unique(np.stack([np.searchsorted(starts, places, side="right") - 1, numbers[key]]), axis=1) if len(places) else np.zeros((2, 0), np.int64)
            for text, n in zip(*pairs.tolist()):
                out[text][1].extend(items[bounds[n] : bounds[n + 1]].tolist())
        return out


def original_spans(raw: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Code points of the original text that the hit words cover."""
    out, edges, at = [], iter(ranges), next(iter(ranges), None)
    if at is None:
        return out
    next(edges)
    points = byte = begin = 0
    for i, m in enumerate(WORD.finditer(raw)):
        if i == at[0]:
            points += len(raw[byte : m.start()].decode())
            byte, begin = m.start(), points
        if i == at[1] - 1:
            points += len(raw[byte : m.end()].decode())
            byte = m.end()
            out.append({"start": begin, "end": points})
            at = next(edges, None)
            if at is None:
                break
    return out


def benchmark_words(benchmark: DataFrame, item: str = "item_id", texts: tuple[str, ...] = ("text",)) -> DataFrame:
    """item, words (as hashes) of every text; questions and answers may be several columns."""

    def hash_items(source):
        known = Hashes()
        for batch in source:
            for column in batch.columns[1:]:
                found = [word_hashes(raw.as_py(), known) for raw in column]
                full = [i for i, w in enumerate(found) if len(w)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(full, pa.int64())), pa.array([found[i].view(np.int64) for i in full], pa.list_(pa.int64()))], names=["item", "words"])

    rows = benchmark.filter(F.col(f"`{item}`").isNotNull()).select(F.col(f"`{item}`").alias("item"), *[utf8(F.col(f"`{t}`")).alias(f"text{i}") for i, t in enumerate(texts)])
    return rows.mapInArrow(hash_items, T.StructType([rows.schema["item"], T.StructField("words", T.ArrayType(T.LongType()))]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", texts: tuple[str, ...] = ("text",), width: int = WIDTH, most_words: int = MOST_WORDS, keep: list[str] | None = None, result: str = "contamination") -> DataFrame:
    """The columns of `docs` in `keep` (all, if not given), and a struct `result` of n_words, n_hit, items and spans."""
    spark = docs.sparkSession
    ship(docs.sparkSession)
    found = cut(benchmark_words(benchmark, item, texts).distinct())
    size = found.agg(F.sum(F.size("words"))).first()[0] or 0
    count = max(1, -(-size // most_words))
    found = found.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(count)))
    ids_type = T.ArrayType(found.schema["item"].dataType)
    kept = [c for c in (docs.columns if keep is None else keep) if c != result]
    # the document's own columns travel as one, so that their names meet no others
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(None).cast("string").alias("none"))
    out = docs.select(row.alias("row"), utf8(F.col(f"`{text}`")).alias("raw"), F.array().cast(SPANS_SQL).alias("ranges"), F.array().cast(ids_type).alias("items"))
    for k in range(count):
        shard = found.filter(F.col("shard") == k).orderBy("item", "words").toArrow()  # about `most_words` words
        kind = shard.schema.field("item").type
        listed = shard.column("words").combine_chunks() if len(shard) else pa.array([], pa.list_(pa.int64()))
        ids = (shard.column("item").combine_chunks() if len(shard) else pa.array([], kind)).dictionary_encode()
        arrays = (listed.flatten().to_numpy().view(np.uint64), listed.value_lengths().to_numpy().astype(np.int64), ids.indices.to_numpy().astype(np.int64))
        sent = spark.sparkContext.broadcast((arrays, ids.dictionary.to_pylist()))
        key = hashlib.sha256(b"".join(a.tobytes() for a in arrays) + b"%d" % width).hexdigest()
        final = k == count - 1

        def run(source, sent=sent, key=key, final=final, kind=kind):
            claim("automaton")
            arrays, names = sent.value
            if key not in _BUILT:
                _BUILT.clear()
                _BUILT[key] = Automaton(*arrays, width)
            built, known = _BUILT[key], Hashes()
            for batch in source:
                scanned, waiting, held = [], [], 0
                counts = np.zeros(batch.num_rows, np.int64)
                for at, raw in enumerate(batch.column(1)):
                    waiting.append(word_hashes(raw.as_py(), known))
                    counts[at] = len(waiting[-1])
                    held += len(waiting[-1])
                    if held > TOGETHER:
                        scanned += built.scan(waiting)
                        waiting, held = [], 0
                scanned += built.scan(waiting) if waiting else []
                ranges, items = [], []
                for (new, of), old, had in zip(scanned, batch.column(2), batch.column(3)):
                    ranges.append([{"start": a, "end": b} for a, b in sorted([(r["start"], r["end"]) for r in old.as_py()] + new)] if len(old) else [{"start": a, "end": b} for a, b in new])
                    items.append(sorted({*(names[i] for i in of), *had.as_py()}))
                columns = [pa.array(ranges, pa.list_(SPAN)), pa.array(items, pa.list_(kind))]
                if not final:
                    yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=batch.schema.names)
                    continue
                hit, spans = [], []
                for raw, rs in zip(batch.column(1), ranges):
                    merged: list[list[int]] = []
                    for r in rs:
                        if merged and r["start"] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], r["end"])
                        else:
                            merged.append([r["start"], r["end"]])
                    hit.append(sum(b - a for a, b in merged))
                    spans.append(original_spans(raw.as_py(), merged) if merged else [])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), pa.array(hit, pa.int64()), columns[1], pa.array(spans, pa.list_(SPAN))], names=["row", "n_words", "n_hit", "items", "spans"])

        schema = out.schema
        if final:
            long = T.LongType()
            schema = T.StructType([out.schema["row"], T.StructField("n_words", long), T.StructField("n_hit", long), T.StructField("items", ids_type), T.StructField("spans", T.DataType.fromDDL(SPANS_SQL))])
        out = out.mapInArrow(run, schema)
    hits = F.struct("n_words", "n_hit", "items", "spans").alias(result)
    return out.select("row.*", hits) if kept else out.select(hits)


def op6_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    c = F.col("contamination")
    ids = F.array_join(F.array_sort(F.transform(c["items"], lambda i: i.cast("string"))), ",")
    return found.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (c["n_hit"] > 0).alias("contaminated"))


QUERIES = {"op6_aho_corasick": op6_aho_corasick}

ORACLE = {
    "op6_aho_corasick": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS g
       FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)"""
}
