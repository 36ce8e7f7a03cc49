"""Periodic runs of words, by the dictionary of basic factors.

A task takes its documents in lots of about LOT words. For each length L = 1, 2,
4 .. the dictionary names the factors of L words: equal factors of one document
have equal names, and a factor of 2 L words is the pair of its halves' names.
Factors that occur once in their document cannot be part of a longer one that
occurs twice, so they leave the dictionary, and in plain prose it is empty after
two or three lengths.

At length L the occurrences of a factor are followed to their successors, which
for the periods in question lie within 2 L words. In a run of smallest period q
with L/2 < q <= L, a factor and its successor are exactly q apart: nearer ones
would make the period shorter. Occurrences from the first word of the run on thus
form an arithmetic progression of neighbouring positions that all propose q, and
it ends q + L words before the run does. So a stretch of neighbouring positions
of equal distance, extended by q + L words, is a maximal run with q as its
smallest period, and as q fits one L only, no run is proposed twice. Runs of
three periods and more have room for it (q + L < 3 q), which is why `times` is at
least 3.

The work of a document of n words is n log n sorts of numbers and its memory
linear in it. No row is shuffled.

Defined results
---------------
Words are what lies between blanks and line ends (bytes 20, 09 to 0D). Null or
empty text: no words, no runs, empty collapsed text. Every row is judged on its
own, so repeated rows give repeated results. All columns of the input stay as
they are; one named like `result` is replaced. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import claim, ship, table, utf8

LEAST, TIMES = 24, 3
LOT = 1 << 20
RUNS = "array<struct<start:long,length:long,period:long>>"
RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of keys that occur more than once, their names from 0)."""
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[name] > 1)
    fresh = np.cumsum(count > 1) - 1
    return again, fresh[name[again]]


def runs_of(words: np.ndarray, doc: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs in numbered words; `doc` numbers their documents, which lie one after the other."""
    found = []
    size = len(words)
    at, name = numbered(doc * (int(words.max(initial=0)) + 1) + words)
    length = 1
    while len(at):
        order = np.argsort(name, kind="stable")
        place = at[order]
        gap = np.diff(place)
        near = np.flatnonzero((name[order][1:] == name[order][:-1]) & (2 * gap > length) & (gap <= length))
        first, period = place[near], gap[near]
        line = np.argsort(first)
        first, period = first[line], period[line]
        if len(first):
            opens = np.concatenate([[True], (np.diff(first) != 1) | (np.diff(period) != 0)])
            begin, end = first[opens], first[np.concatenate([opens[1:], [True]])]
            period = period[opens]
            whole = end - begin + period + length
            long_enough = whole >= np.maximum(least, times * period)
            found.append(np.stack([begin, whole, period], axis=1)[long_enough])
        names = np.full(size, -1, np.int64)
        names[at] = name
        at = at[at + length < size]
        right = names[at + length]
        at, right = at[right >= 0], right[right >= 0]
        same = doc[at] == doc[at + length]
        at, right = at[same], right[same]
        again, name = numbered(names[at] * (int(right.max(initial=0)) + 1) + right)
        at = at[again]
        length *= 2
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def judged(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[tuple[list[dict], bytes]]:
    """(runs, text without repeats) of every text."""
    ids: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    words = np.fromiter((ids.setdefault(w, len(ids)) for t in texts for w in t), np.int64, starts[-1])
    rows = runs_of(words, np.repeat(np.arange(len(texts)), sizes), least, times)
    owner = np.searchsorted(starts, rows[:, 0], "right") - 1
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for k, text in enumerate(texts):
        mine = rows[edges[k] : edges[k + 1]] - [starts[k], 0, 0]
        if len(mine):
            step = np.zeros(len(text) + 1, np.int64)
            np.add.at(step, mine[:, 0] + mine[:, 2], 1)
            np.add.at(step, mine[:, 0] + mine[:, 1], -1)
            text = [text[i] for i in np.flatnonzero(np.cumsum(step)[:-1] == 0)]
        out.append(([{"start": s, "length": n, "period": p} for s, n, p in mine.tolist()], b" ".join(text)))
    return out


def find_runs(docs: DataFrame, text: str = "text", result: str = "periodic", least: int = LEAST, times: int = TIMES, lot: int = LOT) -> DataFrame:
    """`docs` with the struct `result`: n_words, runs (start, length, period in words, by start and period) and collapsed.

    A run is a maximal stretch of words of smallest period q and of at least
    max(`least`, `times` q) words. `collapsed` is the text without the words that
    a run has after its first period, joined by single blanks.
    """
    if times < 3:
        raise ValueError("a run has three periods or more")
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c != result]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), utf8(F.col(f"`{text}`")).alias("body"))

    def run(source):
        claim("periodic_runs")
        for batch in source:
            begin, texts, held = 0, [], 0
            for i, raw in enumerate(batch.column(1)):
                texts.append(raw.as_py().split())
                held += len(texts[-1])
                if held >= lot or i == batch.num_rows - 1:
                    done = judged(texts, least, times)
                    sizes = [len(t) for t in texts]
                    columns = [pa.array(sizes, pa.int64()), pa.array([r for r, _ in done], RUNS_ARROW), pa.array([c for _, c in done], pa.binary())]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), *columns], names=["row", "n_words", "runs", "collapsed"])
                    begin, texts, held = i + 1, [], 0

    schema = T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.DataType.fromDDL(RUNS)), T.StructField("collapsed", T.BinaryType())])
    found = rows.mapInArrow(run, schema)
    return found.select("row.*", F.struct("n_words", "runs", F.col("collapsed").cast("string").alias("collapsed")).alias(result))


def strongest(runs: Column) -> Column:
    """The run of the greatest length to period, of such the first; null without runs."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, none, lambda best, r: F.when(more(best, r), r).otherwise(best))


def planted(text: Column, doc: Column) -> Column:
    """The contract's text: a tenth of the documents, by a hash of their id, repeat their words from one place on with a period."""
    hash_ = F.crc32(doc.cast("string").cast("binary"))
    w = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    n, g = F.size(w), F.floor(hash_ / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return F.when((hash_ % 10 == 0) & (n > 0), made).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    runs = F.col("periodic.runs")
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = find_runs(docs).withColumn("best", strongest(runs))
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLE: dict[str, str] = {}
