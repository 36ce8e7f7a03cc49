"""Best-two-fit packing of tokenised documents into sequences of fixed length.

Packing sees documents only through their lengths, so it works on the histogram
of piece lengths, which has at most `seq_len` rows whatever the corpus:

1. Tasks encode the documents, cut longer ones and number the pieces of each
   length within the task.
2. The driver plans on the histogram. It fills a bin greedily with the longest
   pieces that fit; then, while a gap is left, it takes the bin's smallest piece
   out and puts in two unpacked pieces that fill the expanded gap more tightly.
   A bin is planned once and repeated for as many copies as the counts allow.
3. Each piece gets its rank among all pieces of its length (its number in the
   task plus the counts of earlier tasks), and the plan maps (length, rank) to
   a sequence and an offset.

No group of pieces meets in one task: a length that a third of all pieces share
is ranked through one row per task.

Defined results
---------------
Null text: empty, which is the end id alone. Null ids stay null. Repeated rows
are packed each on their own. A document longer than `seq_len` is cut into
pieces of `seq_len`, of which the first may be shorter. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm import encoding
from tallyforge.llm.common import batches, cut, ship, table

SEQ_LEN, END_ID = 2048, 0
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("place", pa.int64())])
PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
PACKED_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
PACKED = pa.schema([*list(PIECES)[:5], ("sequence_id", pa.int64()), ("offset", pa.int64())])


def cuts(n: int, seq_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of `n` ids."""
    first = n % seq_len or seq_len
    return [(0, min(n, first))] + [(s, seq_len) for s in range(first, n, seq_len)]


def tokenized_pieces(docs: DataFrame, seq_len: int, path: str, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document; `task` and `place` number those of equal length."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def rows(source):
        encode, task, seen = encoding.encoder(path).packed, TaskContext.get().partitionId(), {}
        for batch in source:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packed = encode(text.as_py() or "") + end
                for k, (start, length) in enumerate(cuts(len(packed) // 4, seq_len)):
                    place = seen[length] = seen.get(length, -1) + 1
                    yield doc_id, k, start, length, zlib.crc32(packed[4 * start : 4 * (start + length)]), task, place

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda source: batches(rows(source), PIECES), PIECES_SQL)


def plan(counts: dict[int, int], seq_len: int) -> list[tuple[int, list[int]]]:
    """(copies, piece lengths) for every kind of bin; uses up `counts`."""
    left = np.zeros(seq_len + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    lengths = np.arange(seq_len + 1)
    out = []
    while left.any():
        free = left.copy()

        def below():
            return np.maximum.accumulate(np.where(free > 0, lengths, 0))

        bin_, gap = [], seq_len
        while (top := below()[gap]) > 0:
            bin_.append(int(top))
            free[top] -= 1
            gap -= int(top)
            if gap and free[top]:  # more of the same while it fits
                more = int(min(gap // top, free[top]))
                bin_ += [int(top)] * more
                free[top] -= more
                gap -= more * int(top)
        while gap:
            small = min(bin_)
            room = gap + small
            first = np.flatnonzero(free[: room + 1])
            if not len(first):
                break
            second = below()[room - first]
            # two of one length need two free pieces; else the next shorter one
            twice = (second == first) & (free[first] < 2)
            if twice.any():
                second[twice] = [max((int(x) for x in np.flatnonzero(free[:a])), default=0) for a in first[twice]]
            total = np.where(second > 0, first + second, 0)
            best = int(total.argmax())
            if total[best] <= small:
                break
            a, b = int(first[best]), int(second[best])
            bin_.remove(small)
            bin_ += [a, b]
            free[small] += 1
            free[a] -= 1
            free[b] -= 1
            gap = room - a - b
        kinds, times = np.unique(bin_, return_counts=True)
        copies = int((left[kinds] // times).min())
        left[kinds] -= copies * times
        out.append((copies, sorted(bin_, reverse=True)))
    return out


def places(bins: list[tuple[int, list[int]]]) -> dict[int, tuple]:
    """length -> arrays (first rank, first sequence, pieces a bin) and the offsets in the bin, in rank order."""
    found: dict[int, list] = {}
    sequence = 0
    used: dict[int, int] = {}
    for copies, bin_ in bins:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in bin_:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, where in offsets.items():
            rank = used.get(length, 0)
            found.setdefault(length, []).append((rank, sequence, len(where), where))
            used[length] = rank + copies * len(where)
        sequence += copies
    return {k: (*(np.array([e[i] for e in v], dtype=np.int64) for i in range(3)), [np.array(e[3], dtype=np.int64) for e in v]) for k, v in found.items()}


def pack(docs: DataFrame, seq_len: int = SEQ_LEN, path: str | None = None) -> DataFrame:
    """One row per piece with its sequence and offset; the broadcast plan is bounded by `seq_len`."""
    spark = docs.sparkSession
    ship(docs.sparkSession)
    pieces = cut(tokenized_pieces(docs, seq_len, path or encoding.default_path()))
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {int(r["length"]): int(r["n"]) for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most seq_len rows
    where = spark.sparkContext.broadcast(places(plan(histogram, seq_len)))
    before = by_task.select("task", "length", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))

    def assign(source):
        table_ = where.value
        for batch in source:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, edges) if len(order) else ():
                first, begin, each, inside = table_[int(length[rows[0]])]
                entry = np.searchsorted(first, rank[rows], side="right") - 1
                copy, slot = np.divmod(rank[rows] - first[entry], each[entry])
                sequence[rows] = begin[entry] + copy
                offset[rows] = [inside[e][s] for e, s in zip(entry, slot)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], schema=PACKED)

    return ranked.mapInArrow(assign, PACKED_SQL)


def op7_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op7_best_two_fit": op7_best_two_fit}
ORACLE: dict[str, str] = {}
