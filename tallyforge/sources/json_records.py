"""JSON files of any size as rows, one per object, read by byte ranges.

A file holds an array of objects, one object, or objects one after the other
(lines). It is cut into splits anywhere. What lies at a split's start follows
from sums: whether it is inside a string, from the parity of the unescaped quotes
before it, and how deep it is, from the brackets before it that are outside
strings, which each split counts for both cases. Prefix sums over the splits of a
file give every split its true state; then each reads the objects that begin in
it, to their ends. No file passes one task, and no object is cut.

Defined results
---------------
Members of an array that are not objects give no rows, nor does an object without
its end (a file that breaks off). Text before, between and after objects does not
matter. Objects are not parsed here, so one that is no valid JSON is a row; see
`parse_envelopes`. Empty files give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.sources.bytefiles import FileBytes
from tallyforge.sources.folders import read_each, ship

SPLIT_BYTES, BLOCK_BYTES, BATCH_BYTES, TASK_BYTES = 64 << 20, 4 << 20, 16 << 20, 32 << 20
QUOTE, SLASH, OPEN, CLOSE = ord('"'), ord("\\"), b"{[", b"}]"
RECORDS = "path string, offset long, in_array boolean, value string"
ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("in_array", pa.bool_()), ("value", pa.binary())])


def quotes(data: np.ndarray, slashes: int) -> tuple[np.ndarray, int]:
    """(places of unescaped quotes, backslashes at the end); `slashes` stand before the data."""
    other = np.flatnonzero(data != SLASH)
    at = np.flatnonzero(data == QUOTE)
    before = np.searchsorted(other, at) - 1  # the last byte before the quote that is no backslash
    run = np.where(before >= 0, at - 1 - other[np.maximum(before, 0)], at + slashes) if len(other) else at + slashes
    tail = len(data) - 1 - other[-1] if len(other) else len(data) + slashes
    return at[run % 2 == 0], int(tail)


def brackets(data: np.ndarray, quoted: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places, +1 or -1) of brackets outside strings."""
    at = np.flatnonzero(np.isin(data, np.frombuffer(OPEN + CLOSE, np.uint8)))
    outside = (np.searchsorted(quoted, at) + inside) % 2 == 0
    at = at[outside]
    return at, np.where(np.isin(data[at], np.frombuffer(OPEN, np.uint8)), 1, -1)


def blocks(file: FileBytes, start: int, end: int | None, size: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(position, bytes) of [start, end), to the end of the file without `end`; `size` bytes at once, and no more than BLOCK_BYTES."""
    pos, stop, most = start, file.size if end is None else end, min(BLOCK_BYTES, size or BLOCK_BYTES)
    while pos < stop and (data := file.at(pos, min(most, stop - pos))):
        yield pos, np.frombuffer(data, np.uint8)
        pos += len(data)


def slashes_before(file: FileBytes, pos: int) -> int:
    n = 0
    while pos - n > 0 and file.peek(pos - n - 1, 1) == b"\\":
        n += 1
    return n


def base_depth(file: FileBytes) -> int:
    """1 for a file that holds an array, else 0: the depth at which its objects begin."""
    for _, data in blocks(file, 0, None, 4096):
        head = bytes(data).removeprefix(b"\xef\xbb\xbf").lstrip()
        if head:
            return int(head[:1] == b"[")
    return 0


def survey(rows: DataFrame) -> DataFrame:
    """Splits with the parity of their quotes and the change of depth if they begin outside or inside a string."""

    def run(source):
        for frame in source:
            out = []
            for r in frame.itertuples(index=False):
                file, parity, delta = FileBytes(r.path, min(1 << 20, r.end - r.start)), 0, [0, 0]
                tail = slashes_before(file, r.start)
                for _, data in blocks(file, r.start, r.end):
                    quoted, tail = quotes(data, tail)
                    for case in (0, 1):
                        delta[case] += int(brackets(data, quoted, bool(case ^ parity))[1].sum())
                    parity ^= len(quoted) & 1
                file.close()
                out.append((*r, parity, *delta))
            yield pd.DataFrame(out, columns=[*frame.columns, "parity", "outside", "inside"])

    return rows.mapInPandas(run, "path string, split int, start long, `end` long, parity int, outside long, inside long")


def objects(file: FileBytes, start: int, end: int, inside: bool, depth: int, base: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the objects that begin in [start, end)."""
    opened, tail = None, slashes_before(file, start)
    for pos, data in blocks(file, start, None, end - start):
        quoted, tail = quotes(data, tail)
        at, step = brackets(data, quoted, inside)
        after = depth + np.cumsum(step)
        edge = np.flatnonzero(((step == 1) & (after == base + 1)) | ((step == -1) & (after == base)))
        for i in edge:
            place = pos + int(at[i])
            if step[i] == 1:
                if place >= end:
                    return
                opened = place if data[at[i]] == OPEN[0] else None
            elif opened is not None:
                yield opened, file.peek(opened, place + 1 - opened) if opened < pos else data[opened - pos : at[i] + 1].tobytes()
                opened = None
        inside ^= bool(len(quoted) & 1)
        depth = int(after[-1]) if len(after) else depth
        if pos + len(data) >= end and opened is None:
            return


def json_records(spark: SparkSession, paths: str | list[str], glob: str = "*.json", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, file_name, source_ord (the place in `paths`), offset, in_array, value of every object in the files; folders that do not exist are warned of."""
    ship(spark)

    def listed(i: int, path: str) -> DataFrame:
        found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
        return found.select("path", F.col("length").alias("size"), F.lit(i).alias("source_ord"))

    parts = read_each(paths, listed)
    if not parts:
        return spark.createDataFrame([], f"source_ord int, file_name string, {RECORDS}")
    files = parts[0]
    for more in parts[1:]:
        files = files.unionByName(more)
    each = F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / split_bytes) - 1).cast("array<int>")).alias("split")
    splits = files.filter("size > 0").select("path", "size", each)
    start = F.col("split").cast("long") * split_bytes
    splits = splits.select("path", "split", start.alias("start"), F.least(start + split_bytes, "size").alias("end"))
    n, size = splits.agg(F.count("*"), F.sum(F.col("end") - F.col("start"))).first()
    # as many tasks as bytes ask for, however small the splits are
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, (size or 0) // TASK_BYTES)))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    state = survey(splits.repartition(tasks)).withColumn("in_string", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2)
    state = state.withColumn("depth", F.coalesce(F.sum(F.when(F.col("in_string") == 1, F.col("inside")).otherwise(F.col("outside"))).over(before), F.lit(0)))

    def run(source):
        held, size = [], 0
        for batch in source:
            for path, begin, end, inside, depth in zip(*(batch.column(i).to_pylist() for i in range(5))):
                file = FileBytes(path, min(1 << 20, end - begin))
                base = base_depth(file)
                for offset, value in objects(file, begin, end, bool(inside), depth, base):
                    held.append((path, offset, base == 1, value))
                    size += len(value)
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), ARROW)], schema=ARROW)
                        held, size = [], 0
                file.close()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), ARROW)], schema=ARROW)

    rows = state.select("path", "start", "end", "in_string", "depth").repartition(tasks).mapInArrow(run, RECORDS.replace("value string", "value binary"))
    rows = rows.join(files.select("path", "source_ord"), "path")
    return rows.select("source_ord", F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "offset", "in_array", F.col("value").cast("string").alias("value"))
