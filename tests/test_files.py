"""JSON read by byte ranges, one named file per row, ordered exports."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyforge.sources import json_records as jr
from tallyforge.sources import sinks
from tallyforge.sources.named_files import write_named


def nasty(rng, depth=0):
    kind = rng.random()
    if kind < 0.5 or depth > 3:
        return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", "é", "a", ",", "\n"]) for _ in range(rng.randint(0, 12)))
    return {nasty(rng, 9): nasty(rng, depth + 1) for _ in range(rng.randint(0, 3))} if kind < 0.8 else [nasty(rng, depth + 1) for _ in range(rng.randint(0, 3))]


@pytest.mark.parametrize("split", [1 << 20, 200, 17, 1])
def test_objects_of_any_split(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(jr, "BLOCK_BYTES", 64)
    rng = random.Random(split)
    want = {}

    def objects_of(n):
        return [{"k": nasty(rng), "n": i} for i in range(n)]

    count = 25 if split > 1 else 3
    for name, records, text in (("array", r := objects_of(count), json.dumps(r)), ("pretty", r := objects_of(count), "﻿ \n" + json.dumps(r, indent=2, ensure_ascii=False)), ("object", r := objects_of(1), json.dumps(r[0])), ("lines", r := objects_of(count), "\n".join(map(json.dumps, r))), ("mixed", [{"a": 1}, {"b": "]"}], '[1, "}", {"a": 1}, [{"x": 2}], null, {"b": "]"}]'), ("empty", [], "[]"), ("nothing", [], "")):
        (tmp_path / f"{name}.json").write_text(text)
        want[f"{name}.json"] = records
    torn = objects_of(4)
    (tmp_path / "torn.json").write_text(json.dumps(torn)[:-3] + '"never closed {')
    want["torn.json"] = torn[:-1]
    got = {}
    for r in jr.json_records(spark, str(tmp_path), split_bytes=split).collect():
        got.setdefault(r["file_name"], []).append((r["offset"], r["in_array"], json.loads(r["value"])))
    assert {k: [x for _, _, x in sorted(v, key=lambda x: x[0])] for k, v in got.items()} == {k: v for k, v in want.items() if v}
    assert all(a == (k in ("array.json", "pretty.json", "mixed.json", "torn.json")) for k, v in got.items() for _, a, _ in v)


def test_folders_that_do_not_exist(spark, tmp_path):
    assert jr.json_records(spark, [str(tmp_path / "none")]).count() == 0
    (tmp_path / "x.json").write_text('{"a": 1}')
    rows = jr.json_records(spark, [str(tmp_path / "none"), str(tmp_path)]).collect()
    assert [(r["source_ord"], r["file_name"], r["offset"], r["value"]) for r in rows] == [(1, "x.json", 0, '{"a": 1}')]


def test_one_file_per_row(spark, tmp_path):
    out = tmp_path / "out"
    rows = spark.range(40).select(F.concat(F.lit("f "), "id", F.lit(".txt")).alias("file_name"), F.when(F.col("id") > 0, F.concat(F.lit("é\n"), "id")).alias("body")).repartition(5)
    write_named(rows, str(out))
    assert {p.name: p.read_text() for p in out.iterdir()} == {f"f {i}.txt": f"é\n{i}" if i else "" for i in range(40)}
    write_named(rows.limit(1).withColumn("body", F.lit("new")), str(out))
    assert len(list(out.iterdir())) == 40 and sum(p.read_text() == "new" for p in out.iterdir()) == 1
    write_named(rows.filter("file_name < 'f 2'"), str(out), mode="overwrite")
    assert len(list(out.iterdir())) == rows.filter("file_name < 'f 2'").count()


@pytest.mark.parametrize("bad", ["a/b", "", None, "..", "twice"])
def test_a_failed_job_leaves_no_file(spark, tmp_path, bad):
    out = tmp_path / "out"
    good = spark.range(20).select(F.concat(F.lit("f"), "id").alias("file_name"), F.lit("x").alias("body"))
    more = spark.createDataFrame([(bad, "y"), ("twice", "y")] if bad == "twice" else [(bad, "y")], "file_name string, body string").repartition(2)
    with pytest.raises(Exception, match="no name|two rows"):
        write_named(good.unionByName(more), str(out))
    assert not out.exists() or [p for p in out.iterdir() if not p.name.startswith("_staging-")] == []  # a task that ends after the abort may leave its staging


def test_compressed_csv(spark, tmp_path):
    rows = spark.range(50).select(*[F.concat(F.lit(f'{c}, "x" '), F.col("id").cast("string")).alias(c) for c in sinks.CSV_COLUMNS])
    sinks.write_csv(rows, str(tmp_path / "z"), compression="gzip")
    assert list((tmp_path / "z").glob("*.csv.gz")) and not list((tmp_path / "z").glob("*.csv"))
    read = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "z"))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, rows.collect()))
