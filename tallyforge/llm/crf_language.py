"""Language ID of words and texts by a linear-chain conditional random field.

Each word has features: affixes, letter n-grams, and lexicon features that tell
in which languages' lists of frequent words it stands. Together with learned
transitions between languages they give a chain over the words of a text, and
forward-backward gives every word its probability of each language. A text's
language is the one with the largest sum of these; the score is its mean.

Fitting
-------
The field is fitted on the driver to a bounded sample: in the mean
`sample_docs` training documents per language, fewer where there are so many
languages that all together would be over SAMPLE_TOTAL, of each a window of at
most `sample_words` words at a place chosen by hash. Every language is learnt;
more than SAMPLE_TOTAL of them raise an error. Texts of one language say nothing
on switches, so training chains are spans of several documents put together.
Prediction covers whole texts, in Spark tasks.

Defined results
---------------
Null text, or a text without letters: language `und`, score 0. Words are runs
without white space; of text without any, every PART characters of a run of more
than LONGEST bytes are a word. Words without letters are left out of the chain. A null language in training is not learnt
from; without any training row every text is `und`. Of equal sums the language
that comes first in text order wins. Repeated rows are predicted each. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyforge.llm.common import claim, ship, table, utf8, worker_cache

UNKNOWN = "und"
SAMPLE_DOCS, SAMPLE_WORDS, SAMPLE_TOTAL = 300, 150, 6_000
#: Bytes of a word from which it is cut, and characters of a part.
LONGEST, PART = 96, 24
#: Rows of hashed feature weights, as many as keep weights of all languages within WEIGHTS, and frequent words listed per language.
BUCKETS, WEIGHTS, LEXICON = 1 << 17, 1 << 25, 300
CHAIN, EPOCHS, RATE = 32, 6, 0.5
#: `\w` without digits takes numerals like a half or a Roman four as well; runs that have any are cut at them.
WORD = re.compile(r"[^\W\d_]+")
#: Words whose potentials a worker keeps, words in one forward-backward pass, and words that wait to be sorted by length of text.
CACHE, TOKENS, WAITING = 200_000, 200_000, 2_000_000
#: Texts whose new words are scored together, and about how many bytes of them.
TOGETHER, TOGETHER_BYTES = 200, 4 << 20
PREDICTED = pa.schema([("lang", pa.string()), ("score", pa.float64()), ("segments", pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])))])


def units(raw: bytes) -> list[bytes]:
    """The words of a text."""
    tokens = raw.split()
    if len(raw) <= LONGEST or max(map(len, tokens), default=0) <= LONGEST:
        return tokens
    out: list[bytes] = []
    for t in tokens:
        if len(t) <= LONGEST:
            out.append(t)
        else:
            long = t.decode()
            out += [long[i : i + PART].encode() for i in range(0, len(long), PART)]
    return out


def letters(token: str) -> list[bytes]:
    """The runs of letters in a token, in UTF-8; no character is looked up in a list, which costs more than all else of a word."""
    if token.isalpha():
        return [token.encode()]
    out: list[bytes] = []
    for run in WORD.findall(token):
        out += [run.encode()] if run.isalpha() else ["".join(some).encode() for kind, some in groupby(run, str.isalpha) if kind]
    return out


def buckets(labels: int) -> int:
    return min(BUCKETS, 1 << ((WEIGHTS // max(1, labels)).bit_length() - 1))


def hashed(columns: np.ndarray, kind: int, size: int) -> np.ndarray:
    """One of `size` buckets for each row of byte columns."""
    h = np.full(len(columns), kind, dtype=np.uint64)
    for c in columns.T:
        h = (h + c + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(size)).astype(np.int64)


def features(runs: list[bytes], size: int):
    """Yields (row numbers, feature matrix) for lower-case runs of letters of one length in UTF-8.

    Features are prefixes and suffixes of 1 to 3 bytes, and n-grams of 2 to 4
    bytes of the run between two marks.
    """
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, 200_000 // (int(length) + 1))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            m = np.full((len(some), int(length) + 2), 256, dtype=np.uint64)
            m[:, 1:-1] = np.frombuffer(b"".join(runs[r] for r in some), dtype=np.uint8).reshape(len(some), -1)
            m[:, -1] = 257
            found = [hashed(m[:, 1 : 1 + n], 10 + n, size) for n in (1, 2, 3) if n <= length] + [hashed(m[:, -1 - n : -1], 20 + n, size) for n in (1, 2, 3) if n <= length]
            found += [hashed(m[:, i : i + n], n, size) for n in (2, 3, 4) for i in range(m.shape[1] - n + 1)]
            yield some, np.stack(found, axis=1)


class Field:
    """Weights [feature][label], transitions [label][label], first-word scores [label]."""

    def __init__(self, labels: list[str], lexicon: dict[bytes, list[int]]):
        k = len(labels)
        self.labels, self.lexicon = labels, lexicon
        self.buckets = buckets(k)
        self.weights, self.moves, self.start = np.zeros((self.buckets + k, k), np.float32), np.zeros((k, k)), np.zeros(k)

    def run_scores(self, runs: list[bytes]) -> np.ndarray:
        out = np.zeros((len(runs), len(self.labels)))
        for rows, found in features(runs, self.buckets):
            out[rows] = self.weights[found].sum(axis=1)
        for i, run in enumerate(runs):
            for k in self.lexicon.get(run, ()):
                out[i] += self.weights[self.buckets + k]
        return out

    def potentials(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(whether a token has letters, scores of each label for those that have). Runs of letters in a token count alike."""
        runs = [letters(t.decode().lower()) for t in tokens]
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        some = sizes > 0
        if not some.any():
            return some, np.zeros((0, len(self.labels)))
        scores = self.run_scores([r for each in runs for r in each])
        starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        return some, np.add.reduceat(scores, starts, axis=0) / sizes[some][:, None]


def forward_backward(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of each position for chains that lie one after another, longest first; also forward and backward messages.

    All chains advance together, one position at a time; messages are scaled to
    sum to one.
    """
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(moves)
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # chains longer than t
    for t in range(longest):
        at = starts[: active[t]] + t
        now = emit[at] * (np.exp(start) if t == 0 else alpha[at - 1] @ step)
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        now = (emit[at + 1] * beta[at + 1]) @ step.T
        beta[at] = now / now.sum(axis=1, keepdims=True)
    both = alpha * beta
    return both / both.sum(axis=1, keepdims=True), alpha, beta


def fit(samples: list[tuple[str, list[str]]], seed: int = 5) -> Field | None:
    """A field from (language, words) samples, by gradient steps on the conditional likelihood."""
    labels = sorted({lang for lang, _ in samples})
    if not labels:
        return None
    size = len(labels)
    number = {lang: k for k, lang in enumerate(labels)}
    clean = [(number[lang], [r for w in words for r in letters(w.lower())]) for lang, words in sorted(samples)]
    listed: dict[bytes, list[int]] = {}
    for k in range(size):
        for w, _ in sorted(Counter(w for lang, words in clean if lang == k for w in words).items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            listed.setdefault(w, []).append(k)
    field = Field(labels, listed)
    rng = np.random.default_rng(seed)
    spans = []
    for k, words in clean:
        at = 0
        while at < len(words):
            n = int(rng.integers(4, 40))
            spans.append((k, words[at : at + n]))
            at += n
    tokens = [(w, k) for i in rng.permutation(len(spans)) for w in spans[i][1] for k in (spans[i][0],)]
    n = len(tokens) // CHAIN * CHAIN
    if n == 0:
        tokens, n = (tokens * CHAIN)[: CHAIN if tokens else 0], CHAIN if tokens else 0
    if n == 0:
        return None
    words = sorted({w for w, _ in tokens[:n]})
    index = {w: i for i, w in enumerate(words)}
    empty = field.buckets + size
    parts = list(features(words, field.buckets))
    width = max(f.shape[1] for _, f in parts) + max(map(len, listed.values()), default=0)
    grid = np.full((len(words), width), empty)
    for rows, found in parts:
        grid[rows, : found.shape[1]] = found
    for w, kinds in listed.items():
        if w in index:
            grid[index[w], width - len(kinds) :] = [field.buckets + k for k in kinds]
    ids = np.array([index[w] for w, _ in tokens[:n]]).reshape(-1, CHAIN)
    gold = np.array([k for _, k in tokens[:n]]).reshape(-1, CHAIN)
    weights = np.zeros((empty + 1, size), np.float32)
    seen = [np.full(x.shape, 1e-6, x.dtype) for x in (weights, field.moves, field.start)]
    each = 256
    for _ in range(EPOCHS):
        order = rng.permutation(len(ids))
        for lot in (order[i : i + each] for i in range(0, len(order), each)):
            used, truth, count = grid[ids[lot]].reshape(-1, width), gold[lot], len(lot)
            scores = weights[used].sum(axis=1)
            starts, lengths = np.arange(count) * CHAIN, np.full(count, CHAIN)
            post, alpha, beta = forward_backward(scores, starts, lengths, field.moves, field.start)
            emit = np.exp(scores - scores.max(axis=1, keepdims=True)).reshape(count, CHAIN, size)
            a, b = alpha.reshape(count, CHAIN, size)[:, :-1], (emit * beta.reshape(count, CHAIN, size))[:, 1:]
            pairs = a[..., :, None] * np.exp(field.moves) * b[..., None, :]
            pairs /= pairs.sum(axis=(2, 3), keepdims=True)
            wanted = np.eye(size)[truth]
            error = wanted.reshape(-1, size) - post
            kinds, place = np.unique(used, return_inverse=True)  # the features of this lot
            slope = np.stack([np.bincount(place.ravel(), weights=np.repeat(error[:, k], width), minlength=len(kinds)) for k in range(size)], axis=1)
            slope[kinds == empty] = 0.0
            moved = np.einsum("sti,stj->ij", wanted[:, :-1], wanted[:, 1:]) - pairs.sum(axis=(0, 1))
            first = (wanted[:, 0] - post.reshape(count, CHAIN, size)[:, 0]).sum(axis=0)
            for value, gradient, total, at in zip((weights, field.moves, field.start), (slope, moved, first), seen, (kinds, ..., ...)):
                gradient = gradient / count
                total[at] += gradient**2
                value[at] += RATE * gradient / np.sqrt(total[at])
    field.weights = weights[:empty]
    return field


def training_sample(docs: DataFrame, lang: str, text: str, key: Column, sample_docs: int, sample_words: int) -> list[tuple[str, list[str]]]:
    """Windows of about `sample_docs` documents of each language, chosen by a hash of `key`."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang).cast("string").alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE_TOTAL + 1).collect()}
    if len(counts) > SAMPLE_TOTAL:
        raise ValueError(f"more than {SAMPLE_TOTAL} languages to learn")
    if not counts:
        return []
    each = min(sample_docs, max(1, SAMPLE_TOTAL // len(counts)))
    odds = F.broadcast(docs.sparkSession.createDataFrame([(k, min(1.0, each / n)) for k, n in counts.items()], "lang string, odds double"))  # a row per language
    draw = F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(1_000_003)) / 1_000_003.0
    some = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), key.alias("key"), draw.alias("draw")).join(odds, "lang").filter("draw < odds")
    words = F.split(F.trim(F.regexp_replace("text", rf"(\S{{{PART}}})(?=\S)", "$1 ")), r"\s+")
    start = F.pmod(F.xxhash64(F.lit("window"), F.col("key").cast("string")), F.greatest(F.size("words") - sample_words + 1, F.lit(1))) + 1
    found = some.select("lang", words.alias("words"), "key").select("lang", F.slice("words", start.cast("int"), sample_words).alias("words"))
    return [(r["lang"], list(r["words"])) for r in found.collect()]  # about SAMPLE_TOTAL windows at most


class Predictor:
    """Potentials of the tokens that a worker has met."""

    def __init__(self, field: Field):
        self.field = field
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.scores = np.zeros((1024, len(self.field.labels)))
        self.used = 0

    def learn(self, tokens: set[bytes]) -> None:
        """Score the tokens that are new."""
        fresh = list(tokens.difference(self.number))
        if not fresh:
            return
        some, scores = self.field.potentials(fresh)
        while self.used + len(scores) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[self.used : self.used + len(scores)] = scores
        numbers = np.full(len(fresh), -1)
        numbers[some] = np.arange(self.used, self.used + len(scores))
        self.number.update(zip(fresh, numbers.tolist()))
        self.used += len(scores)

    def predict(self, texts: list[bytes], segments: bool) -> list[tuple]:
        """(language, score, segments) of each text."""
        out: list[tuple] = [(UNKNOWN, 0.0, [])] * len(texts)
        chains: list[tuple[int, np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush() -> None:
            nonlocal chains, waiting
            chains.sort(key=lambda c: -len(c[1]))
            at = 0
            while at < len(chains):
                end, n = at, 0
                while end < len(chains) and (end == at or n + len(chains[end][1]) <= TOKENS):
                    n += len(chains[end][1])
                    end += 1
                lot = chains[at:end]
                lengths = np.array([len(c[1]) for c in lot])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                post, _, _ = forward_backward(self.scores[np.concatenate([c[1] for c in lot])], starts, lengths, self.field.moves, self.field.start)
                sums = np.add.reduceat(post, starts, axis=0)
                best = sums.argmax(axis=1)
                for (row, _, places), k, total, length, start in zip(lot, best, sums, lengths, starts):
                    out[row] = (self.field.labels[k], min(1.0, float(total[k] / length)), self.runs(post[start : start + length].argmax(axis=1), places) if segments else None)
                at = end
            chains, waiting = [], 0

        at = 0
        while at < len(texts):
            if len(self.number) > CACHE:
                flush()
                self.clear()
            end, size = at, 0
            while end < len(texts) and end < at + TOGETHER and (end == at or size + len(texts[end]) <= TOGETHER_BYTES):
                size += len(texts[end])
                end += 1
            tokens = list(map(units, texts[at:end]))
            self.learn(set().union(*tokens))  # new tokens of several texts at once
            for row, found in zip(range(at, end), tokens):
                ids = np.fromiter(map(self.number.__getitem__, found), np.int64, len(found))
                places = np.flatnonzero(ids >= 0)
                if len(places):
                    chains.append((row, ids[places], places))
                    waiting += len(places)
                    if waiting > WAITING:
                        flush()
            at = end
        flush()
        return out

    def runs(self, labels: np.ndarray, places: np.ndarray) -> list[dict]:
        edges = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1])
        ends = np.concatenate([edges[1:], [len(labels)]])
        return [{"lang": self.field.labels[labels[a]], "first_word": int(places[a]), "n_words": int(b - a)} for a, b in zip(edges, ends)]


_PREDICTORS: dict[int, Predictor] = worker_cache("language")


def predict_language(docs: DataFrame, training: Column, key: Column, text: str = "text", lang: str = "lang", keep: list[str] | None = None, segments: bool = False, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS, result: str = "language") -> DataFrame:
    """The columns of `docs` in `keep` (all, if not given; not one named as the result), and a struct `result` of lang, score, segments.

    `training` is a boolean column; `key` numbers the rows for sampling and is no
    feature. Segments, runs of words of one language in code-switched text, are
    null unless asked for.
    """
    ship(docs.sparkSession)
    field = fit(training_sample(docs.filter(training), lang, text, key, sample_docs, sample_words))
    kept = (docs.select(*[F.col(f"`{c}`") for c in keep]) if keep is not None else docs).drop(result)
    empty = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(None).cast("array<struct<lang:string,first_word:long,n_words:long>>").alias("segments"))
    if field is None:
        return kept.withColumn(result, empty)
    sent = docs.sparkSession.sparkContext.broadcast(field)
    name = id(sent)

    def run(source):
        claim("language")
        predictor = _PREDICTORS.get(name)
        if predictor is None:
            _PREDICTORS.clear()
            predictor = _PREDICTORS[name] = Predictor(sent.value)
        for batch in source:
            raw = batch.column(0).field(place) if place is not None else batch.column(1)
            found = predictor.predict([r or b"" for r in raw.cast(pa.binary()).to_pylist()], segments)
            done = pa.StructArray.from_arrays([pa.array([f[i] for f in found], t.type) for i, t in enumerate(PREDICTED)], fields=list(PREDICTED))
            yield pa.RecordBatch.from_arrays([batch.column(0), done], names=["row", "found"])

    # the columns travel as one, so that any name will do; a text that is among them is sent once
    place = kept.columns.index(text) if text in kept.columns and isinstance(kept.schema[text].dataType, StringType) else None
    row = F.struct(*[F.col(f"`{c}`") for c in kept.columns]) if kept.columns else F.struct(F.lit(None).cast("string").alias("none"))
    rows = docs.select(row.alias("row"), *([] if place is not None else [utf8(F.col(f"`{text}`")).alias("raw")]))
    schema = StructType([rows.schema["row"], StructField("found", kept.select(empty.alias("found")).schema["found"].dataType)])
    found = F.col("found").alias(result)
    out = rows.mapInArrow(run, schema)
    return out.select("row.*", found) if kept.columns else out.select(found)


def held_out_row() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op5_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict_language(docs, ~held_out_row(), F.col("doc_id"), keep=["doc_id"])
    return found.select("doc_id", held_out_row().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


QUERIES = {"op5_crf_language": op5_crf_language}
ORACLE: dict[str, str] = {}
