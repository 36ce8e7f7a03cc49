"""Language-model scores from subword lattices.

An existing subword vocabulary spans a lattice over each word: every way to cut
the word into pieces is a path, weighted by the pieces' unigram scores. A
forward recursion in log space sums all paths to the word's marginal
probability. Words seen in training are paths of one piece more: their counts
are discounted, and the mass that this frees weights the subword paths,

    P(word) = (c - d) / N + (d V / N) * sum over segmentations of the product of piece scores,

so that a text has a proper probability whether or not its words are known. The
end of a text is a token with its own count.

A text has a hidden class (its language, in the query). Counts, discounts and
piece scores are kept by class, a part of each class's subword mass goes to the
word's probability over all classes, and a text's probability is the sum over
the classes, weighted by their shares of the training documents. The class
column is read in training rows only.

The vocabulary file gives the pieces and, by rank, their first scores. All its
pieces are used, but for those with capitals A-Z, which lower-cased text cannot
have, and those with a blank inside; its byte pieces stand for every byte, so
that each word has a segmentation. Expected piece counts (forward-backward)
replace the first scores, as a unigram vocabulary's would be: `rounds` passes over
all distinct training words.

Everything the corpus gives is a Spark table that grows with it: word counts
come from a shuffle on words. The broadcasts are bounded: piece scores by the
vocabulary file and MAX_CLASSES, the scores of the most frequent words by
`head`. A task scores frequent words itself and hands on one row for each other
word of a text, which a join with the word table scores. Frequent words thus
never meet in one task. Scores are doubles from end to end, so it makes no
difference where a word is scored.

A word of more than LONG bytes (text without blanks) is scored by a recursion
that keeps one window of positions; in fitting it counts in parts of that length.

Defined results
---------------
Null text: empty, which has the end token only. Words are runs without ASCII
white space, with A-Z lowered. Repeated rows are scored each; null ids are
neither held out nor merged. With no training rows the counts are 0 and the
scores are those of the vocabulary alone. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import batches, ship, store, table, utf8

#: Frequent words whose scores are broadcast: at most so many.
HEAD = 400_000
#: Most classes told apart; where there are more, all beyond the most frequent ones are a class of their own, the last.
MAX_CLASSES = 16
#: Passes over all distinct training words.
ROUNDS = 4
#: Bytes of a word from which the recursion keeps a window only; positions in a block of it.
LONG, BLOCK = 256, 1 << 16
#: The part of a class's subword mass that goes to the word's probability over all classes.
SHARED = 0.3
LETTER = 5  # shape of the first scores: 1 / (rank + LETTER)
#: Bytes of a text from which its words are handed on soon.
LONG_TEXT = 4 << 20
WORD_START = "▁".encode()
TINY = 1e-300


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[tuple[bytes, int]]:
    """(piece, rank) of a sentencepiece file; pieces at a word's start begin with WORD_START.

    Every byte is a piece of either kind, so that each word has a segmentation.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, int] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            raw = model.id_to_piece(i).encode()
            inner = raw.removeprefix(WORD_START)
            if inner and WORD_START not in inner and inner == inner.lower():
                found.setdefault(raw, i)
    for b in range(256):
        for raw in (bytes([b]), WORD_START + bytes([b])):
            found.setdefault(raw, model.get_piece_size())
    return list(found.items())


class Lattice:
    """Piece scores, found by hash of the piece, for many words at once.

    first[k] and inner[k] hold the scores, by class k, of pieces at a word's
    start and inside it; stop[k] ends a word. Both kinds of scores sum to one,
    the inner ones together with `stop`.
    """

    FACTOR = np.uint64(0x9E3779B97F4A7C15)
    SLOTS = 20  # bits of a hash that name a slot

    def __init__(self, pieces: list[bytes], first: np.ndarray, inner: np.ndarray, stop: np.ndarray):
        """`pieces` are distinct and without WORD_START."""
        self.first, self.inner, self.stop = first, inner, stop
        self.keys = np.array([self.hash_one(p) for p in pieces], dtype=np.uint64)
        self.longest = max(map(len, pieces), default=1)
        # two tables of slots, by different bits; the second takes what has no room in the first
        self.slots = np.full((2, 1 << self.SLOTS), -1, dtype=np.int32)
        for i, places in enumerate(zip(*(self.places(self.keys, t).tolist() for t in (0, 1)))):
            free = [t for t in (0, 1) if self.slots[t, places[t]] < 0]
            if not free:
                raise ValueError("the vocabulary is too large for its slots")
            self.slots[free[0], places[free[0]]] = i

    def places(self, hashes: np.ndarray, of: int) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.SLOTS * (of + 1))) & np.uint64((1 << self.SLOTS) - 1)

    def hash_one(self, piece: bytes) -> int:
        h = 0
        for b in piece:
            h = ((h + b + 1) * int(self.FACTOR)) & (2**64 - 1)
            h ^= h >> 29
        return h

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers, or -1."""
        piece = self.slots[0][self.places(hashes, 0)]
        miss = self.keys[piece] != hashes
        if miss.any():
            rest = hashes[miss]
            other = self.slots[1][self.places(rest, 1)]
            piece[miss] = np.where(self.keys[other] == rest, other, -1)
        return piece

    def edges(self, words: np.ndarray):
        """For bytes of words of one length: {(start, end): (rows, pieces)} of the pieces that lie in them."""
        count, length = words.shape
        h = np.zeros((count, length), dtype=np.uint64)
        out = {}
        for n in range(min(self.longest, length)):
            h = (h[:, : length - n] + words[:, n:] + np.uint64(1)) * self.FACTOR
            h ^= h >> np.uint64(29)
            piece = self.find(h.ravel()).reshape(h.shape)
            hit = piece >= 0
            for start in np.flatnonzero(hit.any(axis=0)).tolist():
                rows = np.flatnonzero(hit[:, start])
                out[start, start + n + 1] = rows, piece[rows, start]
        return out

    def log_probability(self, word: bytes) -> np.ndarray:
        """[class] for one word of any length, with log probabilities of `longest` positions at a time."""
        width, end = self.longest + 1, len(word)
        alpha = np.full((width, len(self.stop)), -np.inf)
        alpha[0] = 0.0
        codes = np.frombuffer(word, dtype=np.uint8)
        for begin in range(0, end, BLOCK):
            some = codes[begin : begin + BLOCK + self.longest - 1].astype(np.uint64)
            count = min(BLOCK, end - begin)
            h = np.zeros(len(some), dtype=np.uint64)
            pieces = np.full((count, self.longest), -1, dtype=np.int32)
            for n in range(min(self.longest, len(some))):
                h = (h[: len(some) - n] + some[n:] + np.uint64(1)) * self.FACTOR
                h ^= h >> np.uint64(29)
                fits = min(count, len(h))
                pieces[:fits, n] = self.find(h[:fits])
            at, size = np.nonzero(pieces >= 0)
            found, starts = pieces[at, size], np.searchsorted(at, np.arange(count + 1)).tolist()
            for i in range(count):
                a, b = starts[i], starts[i + 1]
                place = (begin + i) % width
                score = self.first if begin + i == 0 else self.inner
                to = (begin + i + 1 + size[a:b]) % width
                alpha[to] = np.logaddexp(alpha[to], alpha[place] + score[:, found[a:b]].T)
                alpha[place] = -np.inf
        return alpha[end % width] + self.stop

    def weights(self, start: int, rows: np.ndarray, piece: np.ndarray, of: np.ndarray | None) -> np.ndarray:
        """[class][row], or [1][row] of each row's class in `of`."""
        score = self.first if start == 0 else self.inner
        return score[:, piece] if of is None else score[of[rows], piece][None, :]

    def forward(self, edges, count: int, length: int, of: np.ndarray | None = None) -> np.ndarray:
        """Log probability of all segmentations of each prefix: [length][class][word]."""
        alpha = np.full((length + 1, len(self.stop) if of is None else 1, count), -np.inf)
        alpha[0] = 0.0
        for (start, end), (rows, piece) in sorted(edges.items()):
            alpha[end][:, rows] = np.logaddexp(alpha[end][:, rows], alpha[start][:, rows] + self.weights(start, rows, piece, of))
        return alpha

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """[class][word], summed over all segmentations."""
        out = np.full((len(self.stop), len(words)), -np.inf)
        for row in [i for i, w in enumerate(words) if len(w) > LONG]:
            out[:, row] = self.log_probability(words[row])
        for rows, matrix in self.by_length(words):
            out[:, rows] = self.forward(self.edges(matrix), *matrix.shape)[-1] + self.stop[:, None]
        return out

    def expected_counts(self, words: list[bytes], classes: np.ndarray):
        """Posterior counts, by class, of pieces at the start, inside, and of stops; each word counts for its class, long ones in parts."""
        if any(len(w) > LONG for w in words):
            parts = [(w[at : at + LONG], k) for w, k in zip(words, classes.tolist()) for at in range(0, len(w), LONG)]
            words, classes = [w for w, _ in parts], np.array([k for _, k in parts])
        first, inner = np.zeros(self.first.shape), np.zeros(self.first.shape)
        size = first.shape[1]
        for at, matrix in self.by_length(words):
            of, (count, length) = classes[at], matrix.shape
            edges = self.edges(matrix)
            alpha = self.forward(edges, count, length, of)
            beta = np.full((length + 1, count), -np.inf)
            beta[length] = -alpha[-1][0]
            for (start, end), (rows, piece) in sorted(edges.items(), reverse=True):
                path = self.weights(start, rows, piece, of)[0] + beta[end][rows]
                beta[start][rows] = np.logaddexp(beta[start][rows], path)
                gain = np.exp(np.minimum(alpha[start][0][rows] + path, 0.0))
                into = first if start == 0 else inner
                into += np.bincount(of[rows] * size + piece, weights=gain, minlength=into.size).reshape(into.shape)
        return first, inner, np.bincount(classes, minlength=len(self.stop)).astype(float)

    @staticmethod
    def by_length(words: list[bytes], most: int = 400_000):
        """(row numbers, byte matrix) of words of one length up to LONG, of bounded size."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(lengths[lengths <= LONG]):
            rows = np.flatnonzero(lengths == length)
            step = max(1, most // max(1, int(length)))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                yield some, np.frombuffer(b"".join(words[r] for r in some), dtype=np.uint8).reshape(len(some), int(length)).astype(np.uint64)


def scores(pieces: list[bytes], first: np.ndarray, inner: np.ndarray, stop: np.ndarray) -> Lattice:
    """Normalised log scores from positive weights by class."""
    rest = inner.sum(axis=1) + stop
    return Lattice(pieces, np.log(first / first.sum(axis=1, keepdims=True)), np.log(inner / rest[:, None]), np.log(stop / rest))


def first_scores(path: str, classes: int) -> tuple[list[bytes], Lattice]:
    """The file's vocabulary with scores by rank: a piece's weight is the inverse of its rank."""
    found = dict(vocabulary(path))
    pieces = sorted({p.removeprefix(WORD_START) for p in found})
    tiny = 1e-12  # a piece that the file has of the other kind only
    first = np.array([1 / (found[WORD_START + p] + LETTER) if WORD_START + p in found else tiny for p in pieces])
    inner = np.array([1 / (found[p] + LETTER) if p in found else tiny for p in pieces])
    return pieces, scores(pieces, np.tile(first, (classes, 1)), np.tile(inner, (classes, 1)), np.full(classes, 0.3 * inner.sum()))


def count_words(docs: DataFrame, classes: int) -> DataFrame:
    """word, c0, c1, ...: its counts by class in training rows (all 0 for words of other rows).

    `docs` has text, learn and class (a number).
    """
    schema = pa.schema([("word", pa.binary()), *((f"c{k}", pa.int64()) for k in range(classes))])

    def run(source):
        seen: list[Counter] = [Counter() for _ in range(classes)]
        others: set = set()
        held = 0  # bytes of texts that may be one word each

        def out():
            every = others.union(*seen)
            yield from batches(((w, *(s.get(w, 0) for s in seen)) for w in every), schema, 50_000, lambda r: len(r[0]))

        for batch in source:
            for raw, learn, k in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = raw.as_py()
                (seen[k] if learn else others).update(raw.lower().split())
                held += len(raw) if len(raw) > LONG_TEXT else 0
                if held > 8 * LONG_TEXT or len(others) + sum(map(len, seen)) > 1_000_000:
                    yield from out()
                    seen, others, held = [Counter() for _ in range(classes)], set(), 0
        yield from out()

    parts = docs.select("text", "learn", "class").mapInArrow(run, "word binary, " + ", ".join(f"c{k} long" for k in range(classes)))
    return parts.groupBy("word").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(classes)])


def refit(pieces: list[bytes], first: np.ndarray, inner: np.ndarray, stops: np.ndarray) -> Lattice:
    """Scores from expected counts; every piece keeps a little."""
    return scores(pieces, first + 1e-3, inner + 1e-3, stops + 1.0)


def of_classes(words: list[bytes], counts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Each word once for every class that has it; counts[class][word]."""
    kinds, at = np.nonzero(counts)
    return [words[i] for i in at], kinds


def fit_pieces(words: DataFrame, path: str, classes: int, rounds: int) -> Lattice:
    """Piece scores after `rounds` passes over all words that training rows have."""
    spark = words.sparkSession
    pieces, lattice = first_scores(path, classes)
    words = words.filter(" OR ".join(f"c{k} > 0" for k in range(classes)))
    schema = pa.schema([("class", pa.int32()), ("piece", pa.int32()), ("first", pa.float64()), ("inner", pa.float64())])
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(lattice)

        def expect(source, sent=sent):
            total = None
            for batch in source:
                found = sent.value.expected_counts(*of_classes(batch.column(0).to_pylist(), np.stack([c.to_numpy() for c in batch.columns[1:]])))
                total = found if total is None else tuple(a + b for a, b in zip(total, found))
            if total is not None:
                first, inner, stops = total
                rows = [(int(k), int(p), float(first[k, p]), float(inner[k, p])) for k, p in zip(*np.nonzero((first > 0) | (inner > 0)))]
                yield from batches(rows + [(k, -1, 0.0, float(s)) for k, s in enumerate(stops)], schema, 50_000)

        parts = words.mapInArrow(expect, "class int, piece int, first double, inner double")
        rows = parts.groupBy("class", "piece").agg(F.sum("first").alias("first"), F.sum("inner").alias("inner")).toArrow()  # as many rows as the file has pieces by class, at most
        if not len(rows):
            return lattice
        first, inner, stops = np.zeros((classes, len(pieces))), np.zeros((classes, len(pieces))), np.zeros(classes)
        kind, piece, a, b = (rows[c].to_numpy() for c in ("class", "piece", "first", "inner"))
        ends = piece < 0
        stops[kind[ends]] += b[ends]
        first[kind[~ends], piece[~ends]] += a[~ends]
        inner[kind[~ends], piece[~ends]] += b[~ends]
        lattice = refit(pieces, first, inner, stops)
    return lattice


class Model:
    """Word probabilities by class from counts and a lattice; holds numbers by class only."""

    def __init__(self, lattice: Lattice, tokens: np.ndarray, types: np.ndarray, discounts: np.ndarray, ends: np.ndarray):
        """Each array has an entry for every class and, last, one for all classes together."""
        self.lattice, self.tokens, self.ends = lattice, np.maximum(tokens, 1.0), ends
        self.discounts = discounts
        self.free = np.where(types > 0, discounts * types / self.tokens, 1.0)
        self.share = ends[:-1] / ends[-1] if ends[-1] else np.full(len(ends) - 1, 1 / (len(ends) - 1))

    def log10_words(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """[class][word]; counts[class][word]."""
        paths = self.lattice.log_probabilities(words)
        top = np.maximum(paths.max(axis=0), -1e6)
        scaled = np.exp(paths - top)  # both kinds of subword paths under one scale
        every = np.maximum(counts.sum(axis=0) - self.discounts[-1], 0.0) / self.tokens[-1]
        log_every = np.logaddexp(np.log(np.maximum(every, TINY)), math.log(self.free[-1]) + top + np.log(np.maximum(self.share @ scaled, TINY)))
        own = math.log(1 - SHARED) + paths
        whole = np.log(np.maximum(np.maximum(counts - self.discounts[:-1, None], 0.0) / self.tokens[:-1, None], TINY))
        return np.logaddexp(whole, np.log(self.free[:-1, None]) + np.logaddexp(own, math.log(SHARED) + log_every)) / math.log(10)

    def log10_end(self) -> np.ndarray:
        return np.log10(np.maximum(self.ends[:-1] / self.tokens[:-1], TINY)) if self.ends[-1] else np.zeros(len(self.ends) - 1)


def discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


def lattice_scores(docs: DataFrame, training, classes=None, doc: str = "doc_id", text: str = "text", path: str | None = None, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `training` is a boolean column: true where a row may be learnt from.
    `classes` is a text column with the class of a training row (one class, if not given).
    """
    spark = docs.sparkSession
    ship(docs.sparkSession)
    kind = F.coalesce(classes.cast("string"), F.lit("")) if classes is not None else F.lit("")
    by_class = docs.filter(training).groupBy(kind.alias("class")).count()
    listed = by_class.orderBy(F.desc("count"), "class").limit(MAX_CLASSES + 1).collect()
    names = [r["class"] for r in listed[: MAX_CLASSES - (len(listed) > MAX_CLASSES)]]
    ends_of = [float(r["count"]) for r in listed[: len(names)]]
    if len(listed) > len(names):
        ends_of.append(float(by_class.agg(F.sum("count")).first()[0] - sum(ends_of)))
    ends_of = ends_of or [0.0]
    size, ends = len(ends_of), np.array([*ends_of, sum(ends_of)])
    number = F.coalesce(*[F.when(kind == v, F.lit(k)) for k, v in enumerate(names)], F.lit(size - 1)).cast("int")
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), utf8(F.col(text)).alias("text"), training.alias("learn"), number.alias("class"))
    words = store(count_words(rows, size))
    count = [F.col(f"c{k}") for k in range(size)]
    every = sum(count[1:], count[0])
    figures = []
    for c in (*count, every):
        figures += [F.sum(c), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)]
    f = np.array([v or 0 for v in words.agg(*[x.alias(f"f{i}") for i, x in enumerate(figures)]).first()], dtype=float).reshape(-1, 4)
    tokens = f[:, 0] + ends
    total, distinct = int(tokens[-1]), int(f[-1, 1]) + (ends[-1] > 0)
    model = spark.sparkContext.broadcast(Model(fit_pieces(words, path or default_path(), size, rounds), tokens, f[:, 1], np.array([discount(*x[2:]) for x in f]), ends))

    def score(source):
        for batch in source:
            counts = np.stack([c.to_numpy() for c in batch.columns[1:]]).astype(float)
            found = model.value.log10_words(batch.column(0).to_pylist(), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts.sum(axis=0).astype(np.int64)), *map(pa.array, found)], names=["word", "trained", *(f"s{k}" for k in range(size))])

    scored = store(words.mapInArrow(score, "word binary, trained long, " + ", ".join(f"s{k} double" for k in range(size))))
    by_count = scored.filter("trained > 0").groupBy("trained").agg(F.count("*").alias("n")).orderBy(F.desc("trained")).toArrow()  # distinct counts: the square root of the corpus, at most
    reach = int((np.cumsum(by_count["n"].to_numpy()) <= head).sum())
    least = int(by_count["trained"][reach - 1].as_py()) if reach else 1 << 62
    frequent = scored.filter(F.col("trained") >= least).toArrow()  # at most `head` rows
    known = spark.sparkContext.broadcast((frequent["word"].to_pylist(), frequent["trained"].to_numpy(), np.stack([frequent[f"s{k}"].to_numpy() for k in range(size)])))
    base_log = lambda c: np.log10((c + 1.0) / (total + distinct + 1.0))
    end = model.value.log10_end()
    schema = pa.schema([("place", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("word", pa.binary()), ("n", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), *((f"t{k}", pa.float64()) for k in range(size))])

    def lookup(source):
        listed, trained, table_ = known.value
        at = {w: i for i, w in enumerate(listed)}
        base, place = base_log(trained), TaskContext.get().partitionId() << 40
        empty = (0.0,) * size

        def out():
            nonlocal place
            for batch in source:
                for doc_id, raw, learnt in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                    found, rest = [], Counter()
                    for w in raw.as_py().lower().split():
                        i = at.get(w)
                        if i is None:
                            rest[w] += 1
                        else:
                            found.append(i)
                    place += 1
                    # no word has a blank, so this one meets nothing in the join and is dealt out evenly
                    yield place, doc_id, not learnt, b" %d" % place, 1, len(found) + int(ends[-1] > 0), len(found), base[found].sum() + float(base_log(ends[-1])), *(table_[:, found].sum(axis=1, dtype=float) + end).tolist()
                    for w, n in rest.items():
                        yield place, None, None, w, n, 0, 0, 0.0, *empty

        fields = pa.schema([*list(schema)[:6], ("n_found", pa.int64()), *list(schema)[6:]])
        yield from batches(out(), fields, 50_000, lambda r: len(r[3]))

    sent_sql = "place long, doc_id long, held_out boolean, word binary, n long, n_known long, n_found long, base double, " + ", ".join(f"t{k} double" for k in range(size))
    tokens_ = rows.select("doc_id", "text", "learn").mapInArrow(lookup, sent_sql)
    rare = scored.filter(F.col("trained") < least)
    n = F.col("n")
    rare_base = n * F.log10((F.col("trained") + 1.0) / F.lit(total + distinct + 1.0))
    joined = tokens_.join(rare, "word", "left").select(
        "place",
        "doc_id",
        "held_out",
        (n + F.col("n_found")).alias("n_tokens"),
        (F.col("n_known") + F.when(F.col("trained") > 0, n).otherwise(0)).alias("n_known"),
        (F.col("base") + F.coalesce(rare_base, F.lit(0.0))).alias("base"),
        *[(F.col(f"t{k}") + F.coalesce(n * F.col(f"s{k}"), F.lit(0.0))).alias(f"t{k}") for k in range(size)],
    )
    share = model.value.share
    summed = joined.groupBy("place").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), *[(F.sum(f"t{k}") + F.lit(float(np.log10(max(share[k], TINY))))).alias(f"t{k}") for k in range(size)])
    top = F.greatest("t0", *[f"t{k}" for k in range(1, size)]) if size > 1 else F.col("t0")
    mixed = top + F.log10(sum((F.pow(F.lit(10.0), F.col(f"t{k}") - top) for k in range(size)), F.lit(0.0)))
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", mixed.alias("score"))


def op1_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, F.lit(True))
    return lattice_scores(table(spark, sf_dir, "documents"), learn, classes=F.col("lang"))


QUERIES = {"op1_lattice_lm": op1_lattice_lm}
ORACLE: dict[str, str] = {}
