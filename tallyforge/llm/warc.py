"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Writing. Tasks write their records into files of their own, a gzip member per
record. A file counts once its row is in the manifest, which Spark commits;
files of lost or repeated tasks are in no manifest and are never read. Of pages
with equal payloads one is a response, the others are revisit records that refer
to it. Pages of payloads that very many share meet their group by a broadcast of
bounded size, the others by a shuffle.

Reading. At the place where a record must begin, the reader takes a gzip member
(whole, with right CRC and length, records inside) or a version line with a
header that can be read, a block of the length it names, the end mark, and right
digests. Where a check fails it searches on, byte by byte, for the next member or
version line that passes all of them, and reads on from there. The bytes between
are a quarantined gap: a row with the byte range and the check that failed.

Large files are read in splits. A split begins in the middle of something, maybe
of a payload that itself holds records, so each first searches for a record on
its own and tells where it found one and where the last one ended. The true
chain starts at byte 0: splits whose record is not the one that the split before
leads to are followed again from the right place, until all fit. The records read
are those that one reader from byte 0 would read, however a file is split.

Defined results
---------------
Null payload: empty. Null url: no target header. Null ids: a record of an empty
name; null counts as the smallest id. Rows that repeat an id and its payload are
each written alike. An empty table gives no records and a manifest without rows;
an empty file gives no rows. Payloads are limited by a row's 2 GB; a record of
more than MOST_BYTES is a gap of its own. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import batches, claim, shared_folder, ship, store, table, utf8
from tallyforge.llm.components import HOT_KEYS, HOT_ROWS
from tallyforge.sources.bytefiles import FileBytes, resolve

FILE_BYTES, SPLIT_BYTES, TASK_BYTES = 1 << 30, 64 << 20, 256 << 20
#: Longest header, longest record, and the inflated bytes of a member that are kept between its check and its reading.
HEADER_BYTES, MOST_BYTES, KEEP_BYTES = 1 << 20, 1 << 30, 32 << 20
DATE = "1970-01-01T00:00:00Z"
START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
MANIFEST = pa.schema([("path", pa.string()), ("size", pa.int64()), ("n_records", pa.int64())])
ROW = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()), ("type", pa.string()), ("record_id", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("head", pa.string()), ("payload", pa.binary())])
ROW_SQL = "path string, start long, `end` long, reason string, type string, record_id string, headers map<string,string>, head string, payload binary"
BOUND_SQL = "path string, size long, split int, start long, `end` long, entry_pos long, entry_at int, first long, exit_pos long, exit_at int"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_value(text: str) -> str:
    """Text for a header: what a URI may not hold is percent-encoded."""
    return re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), text)


def record_bytes(record_id: str, kind: str, uri: str | None, refers_to: str | None, payload: bytes, date: str = DATE) -> bytes:
    """A response with its payload, or a revisit record with the response's HTTP head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if kind == "revisit" else head + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    fields += [("WARC-Target-URI", header_value(uri))] if uri is not None else []
    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if kind == "revisit" else []
    fields += [("WARC-Refers-To", f"<{refers_to}>")] if refers_to is not None else []
    fields += [("WARC-Payload-Digest", f"sha1:{sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES, compress: bool = True) -> DataFrame:
    """Writes rows (record_id, type, uri, refers_to, payload) as WARC files in `folder`; returns the manifest (path, size, n_records)."""
    ship(records.sparkSession)

    def run(source):
        claim("warc")
        system, inner = resolve(folder)
        system.create_dir(inner, recursive=True)
        out, size, n, name, done = None, 0, 0, "", []
        for batch in source:
            for row in zip(*(batch.column(i) for i in range(5))):
                record_id, kind, uri, refers_to, payload = (v.as_py() for v in row)
                data = record_bytes(record_id, kind, uri, refers_to, payload)
                if compress:
                    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = deflate.compress(data) + deflate.flush()
                if out is not None and size + len(data) > file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, n))
                    out = None
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc{'.gz' if compress else ''}", 0, 0
                    out = system.open_output_stream(f"{inner}/{name}", compression=None)
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, n))
        yield from batches(done, MANIFEST)

    rows = records.select(*[F.col(c).cast("string") for c in ("record_id", "type", "uri", "refers_to")], utf8(F.col("payload")))
    return store(rows.mapInArrow(run, "path string, size long, n_records long"))


class Inflated:
    """The inflated bytes of a gzip member, read forwards; those before `release` are gone."""

    def __init__(self, source, pos: int):
        self.source, self.pos, self.inflate = source, pos, zlib.decompressobj(31)
        self.base, self.kept, self.rest = 0, bytearray(), b""

    def more(self) -> bytes:
        """The next bytes, at most a megabyte; none at the end. Raises zlib.error for wrong data, EOFError for too little."""
        while not self.inflate.eof:
            if not self.rest:
                self.rest = self.source.at(self.pos, 1 << 18)
                self.pos += len(self.rest)
                if not self.rest:
                    raise EOFError
            out = self.inflate.decompress(self.rest, 1 << 20)
            self.rest = self.inflate.unconsumed_tail
            if out:
                return out
        return b""

    def at(self, pos: int, n: int) -> bytes:
        while self.base + len(self.kept) < pos + n and (data := self.more()):
            self.kept += data
        return bytes(self.kept[pos - self.base : pos - self.base + n])

    def release(self, pos: int) -> None:
        if pos - self.base > 1 << 22:
            del self.kept[: pos - self.base]
            self.base = pos


class Held:
    """Bytes that are all in memory."""

    def __init__(self, data: bytes):
        self.data = data

    def at(self, pos: int, n: int) -> bytes:
        return self.data[pos : pos + n]


class Bad(Exception):
    """A check failed; `end` is where the reader can go on, if it knows."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.reason, self.end = reason, end


def read_record(source, pos: int, most: int = MOST_BYTES) -> tuple[int, dict[str, str], str | None, bytes]:
    """(end, header fields, HTTP head, payload) of the record at `pos`."""
    raw = source.at(pos, 4096)
    if not re.match(rb"WARC/\d\.\d\r\n", raw):
        raise Bad("no version line")
    if (stop := raw.find(b"\r\n\r\n")) < 0:
        raw = source.at(pos, HEADER_BYTES)
        if (stop := raw.find(b"\r\n\r\n")) < 0:
            raise Bad("header without an end")
    lines = re.sub(r"\r\n[ \t]+", " ", raw[:stop].decode("utf-8", "replace")).split("\r\n")[1:]
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise Bad("header line without a colon")
        fields[name.strip().lower()] = value.strip()
    if not {"warc-type", "warc-record-id", "content-length"} <= fields.keys() or not re.fullmatch(r"\d{1,18}", fields["content-length"]):
        raise Bad("header without type, id or length")
    length, begin = int(fields["content-length"]), pos + stop + 4
    end = begin + length + 4
    if length > most:
        if isinstance(source, FileBytes) and source.peek(end - 4, 4) == b"\r\n\r\n":
            raise Bad("longer than a row", end)
        raise Bad("longer than a row")
    if isinstance(source, FileBytes) and source.peek(end - 4, 4) != b"\r\n\r\n":  # before the block is read
        raise Bad("no end mark")
    block = source.at(begin, length + 4)
    if block[length:] != b"\r\n\r\n" or len(block) < length + 4:
        raise Bad("no end mark")
    block = block[:length]
    claimed = lambda name: (lambda v: v.removeprefix("sha1:").upper() if v.startswith("sha1:") and len(v) == 37 else None)(fields.get(name, ""))
    if claimed("warc-block-digest") not in (None, sha1(block)):
        raise Bad("block digest")
    head, payload = None, block
    if fields.get("content-type", "").startswith("application/http"):
        at = block.find(b"\r\n\r\n")
        head, payload = (block[: at + 4].decode("latin-1"), block[at + 4 :]) if at >= 0 else (block.decode("latin-1"), b"")
    if fields["warc-type"] in ("response", "resource") and "warc-truncated" not in fields and claimed("warc-payload-digest") not in (None, sha1(payload)):
        raise Bad("payload digest")
    return end, fields, head, payload


def check_member(source, pos: int):
    """(end, source of the inflated bytes) of the gzip member at `pos`, whose CRC and length have been checked."""
    first, kept, total = Inflated(source, pos), [], 0
    try:
        while data := first.more():
            total += len(data)
            if total <= KEEP_BYTES:
                kept.append(data)
    except EOFError:
        raise Bad("member cut off") from None
    except zlib.error as error:
        raise Bad("member check: " + re.sub(r"Error -?\d+ while decompressing data: ", "", str(error))) from None
    return first.pos - len(first.inflate.unused_data), Held(b"".join(kept)) if total <= KEEP_BYTES else Inflated(source, pos)


def find_start(source, pos: int, end: int) -> int | None:
    """The next place in [pos, end) that looks like a member's or a record's first bytes."""
    while pos < end:
        data = source.at(pos, 1 << 20)
        if found := START.search(data):
            return pos + found.start() if pos + found.start() < end else None
        if len(data) < 1 << 20:
            return None
        pos += len(data) - 10
    return None


def inside(source) -> Iterator[tuple]:
    """Records and reasons of failure in the inflated bytes of a member."""
    pos = 0
    while source.at(pos, 1):
        try:
            end, *record = read_record(source, pos)
            yield (None, *record)
            pos = end
        except Bad as bad:
            yield (bad.reason,)
            after = pos + 1
            while True:
                after = find_start(source, after, 1 << 62)
                if after is None:
                    return
                try:
                    read_record(source, after)
                    break
                except Bad:
                    after += 1
            pos = after
        if isinstance(source, Inflated):
            source.release(pos)


def read_at(source, pos: int) -> tuple[int, Iterator[tuple]]:
    """(end, records and failures) of what begins at `pos`; raises Bad unless a whole record can be read there."""
    if source.at(pos, 2) != b"\x1f\x8b":
        end, *record = read_record(source, pos)
        return end, iter([(None, *record)])
    end, inflated = check_member(source, pos)
    try:
        read_record(inflated, 0)
    except Bad as bad:
        if not any(len(x) > 1 for x in inside(Held(inflated.data) if isinstance(inflated, Held) else Inflated(source, pos))):
            raise Bad(bad.reason, end) from None
    return end, inside(inflated if isinstance(inflated, Held) else Inflated(source, pos))


def salvage(source, pos: int, at: int, stop: int) -> Iterator[tuple]:
    """Events of [pos, stop): ("record", start, end, records) and ("gap", start, end, reason), then ("exit", pos, at).

    `at` tells that a record must begin at `pos`; else the reader is searching.
    A record belongs to where it starts and may end beyond `stop`.
    """
    gap, reason = (None, "") if at else (pos, "search goes on")
    while pos < min(stop, source.size):
        if gap is not None:
            start = find_start(source, pos, min(stop, source.size))
            if start is None:
                yield "gap", gap, min(stop, source.size), reason
                yield "exit", min(stop, source.size), 0
                return
            pos = start
        try:
            end, records = read_at(source, pos)
        except Bad as bad:
            if gap is None:
                gap, reason = pos, bad.reason
                if bad.end is not None:  # what failed is inside a sound frame
                    yield "gap", pos, bad.end, reason
                    gap, pos = None, bad.end
                    continue
            pos += 1
            continue
        if gap is not None and gap < pos:
            yield "gap", gap, pos, reason
        gap = None
        yield "record", pos, end, records
        pos = end
    if gap is not None and gap < min(stop, source.size):
        yield "gap", gap, min(stop, source.size), reason
    yield "exit", (min(stop, source.size) if gap is not None else pos), int(gap is None)


def bounds(rows: DataFrame) -> DataFrame:
    """Follows each split from its entry: the start of its first record and where the next one is due."""

    def run(source):
        for frame in source:
            out = []
            for r in frame.itertuples(index=False):
                file, first, leave = FileBytes(r.path), None, None
                for event in salvage(file, r.entry_pos, r.entry_at, r.end):
                    if event[0] == "record" and first is None:
                        first = event[1]
                    elif event[0] == "exit":
                        leave = event[1:]
                file.close()
                out.append((r.path, r.size, r.split, r.start, r.end, r.entry_pos, r.entry_at, first, *leave))
            yield pd.DataFrame(out, columns=[c.split()[0].strip("`") for c in BOUND_SQL.split(", ")]).astype({"first": "Int64"})

    return rows.select("path", "size", "split", "start", "end", "entry_pos", "entry_at").mapInPandas(run, BOUND_SQL)


def spread(rows: DataFrame, split_bytes: int) -> DataFrame:
    """Splits dealt to tasks of about TASK_BYTES."""
    n = rows.count()
    return rows.repartition(max(1, -(-n * split_bytes // TASK_BYTES), min(n, rows.sparkSession.sparkContext.defaultParallelism)))


def entries(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, size, split, start, end, entry_pos, entry_at): splits of files (path, size) and where the reader from byte 0 enters them."""
    each = F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / split_bytes) - 1).cast("array<int>")).alias("split")
    rows = files.filter("size > 0").select("path", "size", each)
    start = F.col("split").cast("long") * split_bytes
    rows = rows.select("path", "size", "split", start.alias("start"), F.least(start + split_bytes, "size").alias("end"), start.alias("entry_pos"), (F.col("split") == 0).cast("int").alias("entry_at"))
    single = rows.filter(F.col("size") <= split_bytes)
    several = store(rows.filter(F.col("size") > split_bytes))
    if several.isEmpty():
        return single
    known = store(bounds(spread(several, split_bytes)))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    due = F.coalesce(F.max(F.struct(F.col("exit_pos").alias("pos"), F.col("exit_at").alias("at"))).over(before), F.struct(F.lit(0).cast("long").alias("pos"), F.lit(1).alias("at")))
    entered = (F.col("entry_pos") == F.col("due.pos")) & (F.col("entry_at") == F.col("due.at"))
    passed = F.col("due.pos") >= F.col("end")  # no record starts in it
    fits = (F.col("due.at") == 1) & F.coalesce(F.col("first") == F.col("due.pos"), F.lit(False))
    while True:
        rows = known.withColumn("due", due)
        rows = rows.withColumn("right", entered | fits & ~passed)
        rows = rows.withColumns({"entry_pos": F.col("due.pos"), "entry_at": F.col("due.at"), "exit_pos": F.when(passed, F.col("due.pos")).otherwise(F.col("exit_pos")), "exit_at": F.when(passed, F.col("due.at")).otherwise(F.col("exit_at"))})
        rows = store(rows.withColumn("again", ~F.col("right") & ~passed).drop("due", "right"))
        wrong = rows.filter("again").drop("again")
        sound = rows.filter("NOT again").drop("again")
        if wrong.isEmpty():
            return single.unionByName(sound.select(*single.columns))
        known = store(sound.unionByName(bounds(spread(wrong, split_bytes))))


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records and gaps of the files (path, size): path, start, end, reason, type, record_id, headers, head, payload.

    A record has a null reason; `headers` are its fields by lower-case name,
    `head` its HTTP head. A gap has a reason and a byte range only; that of bad
    records inside a sound member is the member's. Records of one member share its range.
    """
    ship(files.sparkSession)

    def rows(source):
        for batch in source:
            for path, pos, at, stop in zip(*(batch.column(i).to_pylist() for i in range(4))):
                file = FileBytes(path)
                for kind, start, end, *what in salvage(file, pos, at, stop):
                    if kind == "gap":
                        yield path, start, end, what[0], None, None, None, None, None
                    elif kind == "record":
                        for reason, *found in what[0]:
                            if found:
                                fields, head, payload = found
                                yield path, start, end, None, fields["warc-type"], fields["warc-record-id"].strip("<>"), list(fields.items()), head, payload
                            else:
                                yield path, start, end, reason, None, None, None, None, None
                file.close()

    def run(source):
        claim("warc")
        yield from batches(rows(source), ROW, weigh=lambda r: len(r[8] or b"") + 500)

    return spread(store(entries(files, split_bytes)), split_bytes).select("path", "entry_pos", "entry_at", "end").mapInArrow(run, ROW_SQL)


def gaps(rows: DataFrame) -> DataFrame:
    """The quarantine log: path, start, end, reason, with a gap that runs over several splits as one row."""
    order = Window.partitionBy("path").orderBy("start", "end")
    found = rows.filter("reason IS NOT NULL").select("path", "start", "end", "reason")
    fresh = ~((F.col("reason") == "search goes on") & F.coalesce(F.lag("end").over(order) == F.col("start"), F.lit(False)))
    found = found.withColumn("part", F.sum(fresh.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return found.groupBy("path", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("reason", "start").alias("reason")).drop("part")


def name(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")))


def page_records(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Rows for `write_archives`: of pages with equal payloads of at least `least` bytes the largest id is a response, the others revisit it."""
    body = utf8(F.col(html))
    rows = pages.select(F.col(page).cast("long").alias("page"), F.col(url).cast("string").alias("uri"), body.alias("payload"), F.sha2(body, 256).alias("digest"))
    shared = rows.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("page").alias("last"), F.count("*").alias("n")).filter("n > 1")
    shared = store(shared)
    bound = max(HOT_ROWS, (shared.agg(F.sum("n")).first()[0] or 0) // HOT_KEYS)
    hot, cold = F.broadcast(shared.filter(F.col("n") > bound)), shared.filter(F.col("n") <= bound)  # at most HOT_KEYS groups are hot
    rows = rows.join(hot, "digest").unionByName(rows.join(hot, "digest", "left_anti").join(cold, "digest", "left"))
    again = F.col("n").isNotNull() & ~F.col("page").eqNullSafe(F.col("last"))
    return rows.select(name(F.col("page")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("type"), "uri", F.when(again, name(F.col("last"))).alias("refers_to"), "payload")


def op11_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_archives(page_records(table(spark, sf_dir, "pages")), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")
    rows = read_archives(written).filter("reason IS NULL")
    number = lambda c: F.nullif(F.regexp_replace(c, "^<?urn:page:|>$", ""), F.lit("")).cast("long")
    full = F.when(F.col("type") == "revisit", F.regexp_extract("head", r"(?i)\r\nContent-Length: *(\d+)", 1).cast("long")).otherwise(F.octet_length("payload").cast("long"))
    digest = F.regexp_replace(F.col("headers")["warc-payload-digest"], "^sha1:", "")
    return rows.select(number(F.col("record_id")).alias("page_id"), full.alias("payload_bytes"), digest.alias("payload_digest"), F.col("type").alias("record_type"), number(F.col("headers")["warc-refers-to"]).alias("refers_to"))


QUERIES = {"op11_warc_salvage": op11_warc_salvage}
# base 32: five hexadecimal digits are four letters
LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> {}) & 31 AS INTEGER) + 1, 1)"
ORACLE: dict[str, str] = {
    "op11_warc_salvage": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS last FROM p),
v AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(h, CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT)) AS vs FROM d)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, array_to_string(list_transform(vs, lambda v: {" || ".join(LETTER.format(s) for s in (15, 10, 5, 0))}), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to FROM v"""
}
