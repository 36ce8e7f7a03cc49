"""WARC archives: round trips, damaged files, splits."""

import gzip
import os
import random

import pytest

from tallyforge.llm import warc
from tests.conftest import SF, same
from tests.llm.tables import documents

ROWS = "record_id string, type string, uri string, refers_to string, payload binary"


def one(i, payload=None, kind="response"):
    return warc.record_bytes(f"urn:page:{i}", kind, f"http://h/{i}", "urn:page:0" if kind == "revisit" else None, payload if payload is not None else b"text %d " % i * (i % 7 + 1))


def files(spark, tmp_path, *contents):
    rows = []
    for i, data in enumerate(contents):
        (tmp_path / f"{i}.warc").write_bytes(data)
        rows.append((str(tmp_path / f"{i}.warc"), len(data), 0))
    return spark.createDataFrame(rows, "path string, size long, n_records long")


def read(spark, tmp_path, data, split):
    rows = warc.read_archives(files(spark, tmp_path, data), split)
    rows = rows.cache()
    records = sorted((r["start"], r["end"], r["record_id"], bytes(r["payload"])) for r in rows.filter("reason IS NULL").collect())
    return records, sorted((r["start"], r["end"], r["reason"]) for r in warc.gaps(rows).collect())


def plain_reader(data):
    """A second, sequential reader: every place is tried in turn."""
    source, pos, records, gaps, gap = warc.Held(data), 0, [], [], None
    while pos < len(data):
        try:
            end, found = warc.read_at(source, pos)
        except warc.Bad:
            gap = pos if gap is None else gap
            pos += 1
            continue
        if gap is not None:
            gaps.append((gap, pos))
            gap = None
        records += [(pos, end, r[1]["warc-record-id"].strip("<>"), r[3]) for r in found if len(r) > 1]
        pos = end
    return records, gaps + ([(gap, len(data))] if gap is not None else [])


@pytest.mark.parametrize("split", [1 << 26, 700, 97])
def test_plain_file_with_every_damage(spark, tmp_path, split):
    nested = b"".join(one(900 + i) for i in range(4))
    parts = [one(0), one(1), one(2, nested * 3), one(3), one(4, b""), one(5, kind="revisit"), one(6), one(7), one(8, b"x" * 3000), one(9)]
    broken = bytearray(parts[3])
    broken[-9] ^= 1  # digest
    short = parts[6][:-20]  # cut off
    length = parts[7].replace(b"Content-Length: ", b"Content-Length: 99", 1)
    data = b"".join([parts[0], b"noise WARC/1.0\r\nnot a header ", parts[1], parts[2], bytes(broken), parts[4], parts[5], short, length, parts[8], b"\0" * 500, parts[9], b"tail"])
    records, gaps = read(spark, tmp_path, data, split)
    want, holes = plain_reader(data)
    assert records == want and [g[:2] for g in gaps] == holes
    assert [r[2] for r in records] == [f"urn:page:{i}" for i in (0, 1, 2, 4, 5, 8, 9)] and records[2][3] == nested * 3
    assert [g[2] for g in gaps][:2] == ["no version line", "block digest"] and len(gaps) == 5
    # every byte is in one record or one gap
    spans = sorted([r[:2] for r in records] + [g[:2] for g in gaps])
    assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("split", [1 << 26, 500])
def test_members_with_damage(spark, tmp_path, split):
    rng = random.Random(2)
    member = [gzip.compress(one(i, rng.randbytes(1500) if i % 2 else None), mtime=0) for i in range(9)]
    flipped = bytearray(member[2])
    flipped[len(flipped) // 2] ^= 255
    crc = bytearray(member[5])
    crc[-6] ^= 1
    stored = gzip.compress(one(50, b"".join(member[:2])), compresslevel=0, mtime=0)  # members inside a payload, uncompressed
    several = gzip.compress(one(60) + b"junk" + one(61) + one(62)[:-30] + one(63), mtime=0)
    hollow = gzip.compress(b"no record at all", mtime=0)
    data = b"".join([member[0], bytes(flipped), member[1], stored, bytes(crc), member[3], member[4][:-15], member[6], hollow, several, one(70), member[7][:5], member[8]])
    records, gaps = read(spark, tmp_path, data, split)
    want, holes = plain_reader(data)
    assert records == sorted(want)
    assert [r[2] for r in records] == [f"urn:page:{i}" for i in (0, 1, 50, 3, 6, 60, 61, 63, 70, 8)]
    reasons = {g[2] for g in gaps}
    assert any(r.startswith("member check") for r in reasons) and "no version line" in reasons and len(gaps) >= 6


def test_random_damage_at_any_split(spark, tmp_path):
    for seed in range(6):
        rng = random.Random(seed)
        data = b"".join(gzip.compress(one(i), mtime=0) if seed % 2 else one(i, one(100 + i) * rng.randint(0, 3)) for i in range(25))
        data = bytearray(data)
        for _ in range(4):
            at = rng.randrange(len(data))
            if rng.random() < 0.5:
                data[at] ^= 1 << rng.randrange(8)
            else:
                del data[at : at + rng.randrange(60)]
        (tmp_path / str(seed)).mkdir()
        records, gaps = read(spark, tmp_path / str(seed), bytes(data), rng.choice([64, 333, 1000]))
        want, holes = plain_reader(bytes(data))
        assert records == sorted(want)
        if not seed % 2:
            assert [g[:2] for g in gaps] == holes


def test_member_of_many_records_is_read_in_little_memory(spark, tmp_path, monkeypatch):
    data = gzip.compress(b"".join(one(i, b"%d" % i * 50_000) for i in range(60)) + b"damage" + one(99), mtime=0)
    path = tmp_path / "x"
    path.write_bytes(data)
    monkeypatch.setattr(warc, "KEEP_BYTES", 1000)
    end, found = warc.read_at(warc.FileBytes(str(path)), 0)
    found = list(found)
    assert end == len(data) and sum(len(f) > 1 for f in found) == 61 and [f for f in found if len(f) == 1] == [("no version line",)]


def test_long_header_and_long_record(tmp_path):
    path = tmp_path / "x"
    wide = one(1).replace(b"WARC-Date", b"X-Long: " + b"y" * 10_000 + b"\r\nWARC-Date", 1)
    path.write_bytes(one(0, b"z" * 5000) + wide)
    source = warc.FileBytes(str(path))
    assert warc.read_record(source, len(one(0, b"z" * 5000)))[0] == source.size
    with pytest.raises(warc.Bad) as bad:
        warc.read_record(source, 0, most=4000)
    assert bad.value.end == len(one(0, b"z" * 5000))


@pytest.mark.parametrize("compress", [True, False])
def test_pages_of_all_kinds(spark, tmp_path, compress):
    html = "<p>ü</p>" * 200
    rows = [(i, f"http://h/{i}", html) for i in range(1, 400)] + [(500, None, None), (501, "", ""), (502, "a b\r\nX: yé", "WARC/1.0\r\nx"), (None, "u", "none"), (None, "u", html), (503, "v", "one"), (503, "v", "one"), (504, "w", "one"), (505, "long", "l" * 2_000_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    written = warc.write_archives(warc.page_records(pages), str(tmp_path / "out"), 100_000, compress)
    assert all(os.path.getsize(r["path"]) == r["size"] for r in written.collect()) and written.count() > 3
    rows_read = warc.read_archives(written, 50_000)
    got = rows_read.filter("reason IS NULL").collect()
    assert len(got) == len(rows) and rows_read.filter("reason IS NOT NULL").count() == 0
    found = sorted((r["record_id"], r["type"], r["headers"].get("warc-refers-to", ""), len(r["payload"])) for r in got)
    texts = {}
    for i, _, t in rows:
        texts.setdefault(t or "", []).append(-1 if i is None else i)
    want = []
    for i, _, t in rows:
        last = max(texts[t or ""])
        again = (-1 if i is None else i) != last
        want.append((f"urn:page:{'' if i is None else i}", "revisit" if again else "response", f"<urn:page:{last}>" if again else "", 0 if again else len((t or "").encode())))
    assert found == sorted(want)
    empty = warc.write_archives(warc.page_records(pages.limit(0)), str(tmp_path / "none"))
    assert empty.count() == 0 and warc.read_archives(empty).count() == 0


def test_documents_with_clashing_names(spark, tmp_path):
    docs = documents(spark).withColumnsRenamed({"word": "payload", "language": "last"})
    written = warc.write_archives(warc.page_records(docs, "doc_id", "source", "text"), str(tmp_path / "out"))
    assert warc.read_archives(written).filter("reason IS NULL").count() == docs.count()


def test_query_op11(spark, duck):
    same(warc.op11_warc_salvage(spark, SF), duck.sql(warc.ORACLE["op11_warc_salvage"]))
