"""What shows only on larger tables: results against SQL, files that share a name, shuffles, memory of one task."""

import gzip
import json
import os
import re

import duckdb
from pyspark.sql import functions as F

from tallyforge.functions import text
from tallyforge.operators import corpus
from tallyforge.operators.substrings import containing
from tallyforge.plans import queries_files, queries_store
from tallyforge.plans.registry import ORACLE, QUERIES
from tallyforge.sources import corpus_files, envelopes, json_records, result_store, sinks
from tests.conftest import SF, TABLES, same


def with_tables(spark, path, **changed):
    """The smallest tables with some of them replaced: a folder, and a database of its views."""
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        at = f"{path}/{t}.parquet"
        if t in changed:
            changed[t].coalesce(1).write.parquet(at)
        else:
            os.symlink(f"{SF}/{t}.parquet", at)
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{at}{'/*.parquet' if t in changed else ''}'")
    return str(path), con


def check(spark, tables, name):
    folder, con = tables
    same(QUERIES[name](spark, folder), con.sql(ORACLE[name]))


def test_halves_of_a_kilobyte(spark, tmp_path):
    rows = [(1, i, f"f{i}", size, None, "txt", False) for i, size in enumerate((512, 1536, 2560, 513, 1535, 0))]
    files = spark.createDataFrame(rows, "task_id int, at int, filename string, size_bytes int, error string, format string, truncated boolean")
    listed = corpus.manifest(files, "task_id", "at").first()["manifest"]
    assert [line.split(", ")[1] for line in listed.split("\n") if "(txt" in line] == ["0 KB)", "2 KB)", "2 KB)", "1 KB)", "1 KB)", "0 KB)"]
    chats = spark.createDataFrame([(1, i, "user", "x" * n) for i, n in enumerate((512, 1536, 9, 2560))], spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").schema)
    check(spark, with_tables(spark, tmp_path, conversations=chats), "f43_manifest")


def test_passes_of_one_agent(spark, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").limit(60).withColumn("l_orderkey", F.lit(1).cast("long")).withColumn("l_linenumber", F.monotonically_increasing_id().cast("int") + 1)
    schema = spark.read.parquet(f"{SF}/lineitem.parquet").schema
    lines = lines.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    check(spark, with_tables(spark, tmp_path, lineitem=lines), "p05_serialized")


def test_files_of_one_name_and_size(spark, tmp_path):
    for folder in ("a", "b", "c"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.txt").write_text(f"in {folder}")
    found = corpus_files.read_corpus(spark, [f"{tmp_path}/[abc]"]).select("doc_id", "text_content").collect()
    assert sorted(r["text_content"] for r in found) == ["in a", "in b", "in c"] and len({r["doc_id"] for r in found}) == 3
    last = next(r["doc_id"] for r in found if r["text_content"] == "in c")
    assert last == spark.range(1).select(text.document_id(F.lit("x.txt"), F.lit(4))).first()[0]


def test_small_splits_share_tasks(spark, tmp_path):
    """The number of tasks follows the bytes and not the splits."""
    (tmp_path / "a.json").write_text(json.dumps([{"n": i, "s": '}"]'} for i in range(3000)]))
    rows = json_records.json_records(spark, str(tmp_path), split_bytes=64)
    assert rows.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert sorted(json.loads(r["value"])["n"] for r in rows.collect()) == list(range(3000))


def test_places_of_many_blocks(spark, tmp_path):
    """Rows are numbered over all blocks of a file, without one task that gets them all."""
    (tmp_path / "x.csv").write_text("a,b\n" + "".join(f"{i},{'y' * (i % 50)}\n" for i in range(2000)))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        rows = sinks.read_ordered_csv(spark, f"{tmp_path}/x.csv")
        assert rows.rdd.getNumPartitions() > 10
        assert sorted((r["place"], int(r["a"])) for r in rows.collect()) == [(i + 1, i) for i in range(2000)]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_envelopes_in_one_shuffle_of_passes(spark):
    """Passes are dealt once, by task; tasks meet them there."""
    few = exchanges(queries_files.task_envelopes(spark, SF))
    assert few <= 2, few


def test_compressed_lines(spark, tmp_path):
    e = spark.createDataFrame([(str(i), "x" * 500) for i in range(200)], "task_id string, dispatched_at string")
    sinks.write_json(e.coalesce(1), f"{tmp_path}/a", compression="gzip")
    sinks.write_json(e.coalesce(1), f"{tmp_path}/b")
    size = {k: sum(p.stat().st_size for p in (tmp_path / k).glob("part-*")) for k in "ab"}
    assert size["a"] * 10 < size["b"]
    read = envelopes.read_envelopes(spark, f"{tmp_path}/a", lines=True, glob="*.txt.gz")
    assert sorted(r["task_id"] for r in read.collect()) == sorted(str(i) for i in range(200))


def test_long_texts_are_no_cargo_of_their_grams(spark):
    """Ten times longer texts make about ten times as many bytes, not a hundred times."""

    def size(n):
        texts = spark.createDataFrame([(1, "".join(chr(97 + (i * i * j + j) % 26) for i in range(n))) for j in range(1, 6)], "task_id int, t string")
        needles = spark.createDataFrame([(1, f"doc_{i}.txt") for i in range(50)], "task_id int, name string")
        before = containing(texts, "t", needles, "name", ("task_id",))
        held = before._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in held.split("\n") if "Generate explode" in line and re.search(r"\bt#", line.split("false", 1)[-1])]
        return before.count()

    assert size(200) == size(2000) == 0


def test_containing_keeps_rows_and_columns(spark):
    names = ["a", "ab", "é.x", "doc_1.txt", "doc_11.txt", "x" * 40, "", None]
    needles = spark.createDataFrame([(k, n, i) for i, n in enumerate([*names, "ab"]) for k in (1, 2)], "k int, n string, extra int")
    bodies = ["", None, "zab", "see doc_11.txt", "é.x", "y" + "x" * 45, "zab"]
    texts = spark.createDataFrame([(k, t, i) for i, t in enumerate(bodies) for k in (1, 3)], "k int, t string, row int")
    got = sorted(tuple(r) for r in containing(texts, "t", needles, "n", ("k",)).select("k", "row", "n", "extra").collect())
    want = sorted((1, i, n, e) for i, t in enumerate(bodies) for e, n in enumerate([*names, "ab"]) if t and n and n in t)
    assert got == want and containing(texts, "t", needles.filter("n = ''"), "n", ("k",)).count() == 0


def test_first_rows_of_buckets_are_not_merged(spark, tmp_path, monkeypatch):
    merged = []
    real = result_store.merge_results
    monkeypatch.setattr(result_store, "merge_results", lambda *a, **k: merged.append(1) or real(*a, **k))
    kept = result_store.ResultStore(spark, f"{tmp_path}/store", 4)
    run = "named_struct('task_id', '1', 'completed', true)"
    e = spark.range(40).selectExpr("cast(id as string) task_id", "1.5D total_cost_usd", f"map('A', array({run})) agent_results")
    kept.upsert(e)
    assert not merged and kept.tasks().count() == 40 and kept.stats().first()["total"] == 40
    kept.upsert(e.filter("task_id < '2'"))
    assert merged and kept.tasks().count() == 40
    assert {r["task_id"]: r["total_cost_usd"] for r in kept.tasks().collect()} == {str(i): 3.0 if str(i) < "2" else 1.5 for i in range(40)}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def without_broadcasts(spark, make):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        return plan_of(make())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def small_envelopes(spark, n):
    run = "named_struct('task_id', '1', 'completed', true, 'response_text', 'x')"
    return spark.range(n).selectExpr("cast(id as string) task_id", "1.5D total_cost_usd", f"map('A', array({run})) agent_results")


def test_old_and_new_envelopes_meet_without_a_shuffle(spark, tmp_path, monkeypatch):
    plans, real = [], result_store.merge_results

    def merge(*a, **k):
        out = real(*a, **k)
        plans.append(plan_of(out))
        return out

    monkeypatch.setattr(result_store, "merge_results", merge)
    kept = result_store.ResultStore(spark, f"{tmp_path}/store", 8)
    kept.upsert(small_envelopes(spark, 40))
    kept.upsert(small_envelopes(spark, 60))
    assert len(plans) == 1 and "Exchange" not in plans[0]
    assert {r["task_id"]: r["total_cost_usd"] for r in kept.tasks().collect()} == {str(i): 3.0 if i < 40 else 1.5 for i in range(60)}
    assert len(list((tmp_path / "store" / "tasks").iterdir())) == 2


def test_ids_go_to_their_envelopes(spark, tmp_path):
    """In lookups, the index and the comparison only ids and scores are shuffled."""
    kept = result_store.ResultStore(spark, f"{tmp_path}/store", 4)
    kept.upsert(small_envelopes(spark, 40))
    kept.add_scores(spark.createDataFrame([("1", "2024", "A")], "task_id string, scored_at string, golden_response string"))
    ids = spark.createDataFrame([("1",), ("39",), ("none",)], "id string")
    for make in (lambda: kept.lookup(ids, "id"), kept.index, kept.comparison):
        found = without_broadcasts(spark, make)
        shuffled = [line for line in found.split("\n") if "Exchange hashpartitioning" in line]
        assert len(shuffled) == 1, found  # of ids, which are made distinct there, or of scores
    assert sorted(r["task_id"] for r in kept.lookup(ids, "id").collect()) == ["1", "39"]
    assert kept.index().filter("scored").count() == 1


def test_rows_of_one_task_with_and_without_an_id(spark, tmp_path):
    """Null ids are the task `unknown`, also beside rows that say so; the first write is merged then."""
    kept = result_store.ResultStore(spark, f"{tmp_path}/store", 4)
    e = small_envelopes(spark, 5).withColumn("task_id", F.when(F.col("task_id") == "0", F.lit(None)).when(F.col("task_id") == "1", "unknown").otherwise(F.col("task_id")))
    kept.upsert(e.unionByName(e.filter("task_id = '4'")))
    assert {r["task_id"]: r["total_cost_usd"] for r in kept.tasks().collect()} == {"unknown": 3.0, "2": 1.5, "3": 1.5, "4": 3.0}
    assert len(list((tmp_path / "store" / "tasks").iterdir())) == 1 and kept.stats().first()["total"] == 4


def test_both_dispatches_are_made_in_one_pass(spark, monkeypatch):
    made = []
    real = queries_store.runs
    monkeypatch.setattr(queries_store, "runs", lambda *a: made.append(1) or real(*a))
    first, second = queries_store.dispatches(spark, SF)
    assert len(made) == 1 and first.count() > 0 and second.count() > 0
    assert not [x for x in (first, second) if "Window" in plan_of(x)]


def test_few_files_are_parsed_by_many_tasks(spark, tmp_path):
    """Of a text only its id is read before the shuffle, in which it lies by task after that; odd texts come out the same."""
    texts = ['{"task_id":"a","x":{"y":1},"agent_results":{"A":[{"model":"m"}]}}', '[{"task_id":"b"},{"task_id":7,"dispatched_at":"d"},{}]', '{"task_id":"c"', "", "[]", '{"task_id":"a","task_id":"z"}', '{"task_id":["q"]}', '{"dispatched_at":"e"}', "7", ' [ {"task_id":"d","x":"1"} ] ']
    rows = spark.createDataFrame([(t, f"f{i}") for i, t in enumerate(texts)], "value string, file_name string")
    assert sorted(map(str, envelopes.parse_envelopes(rows, parts=3).collect())) == sorted(map(str, envelopes.parse_envelopes(rows).collect()))
    rows.write.parquet(f"{tmp_path}/t")
    dealt = envelopes.parse_envelopes(spark.read.parquet(f"{tmp_path}/t"), parts=5)
    above, below = plan_of(dealt).split("Exchange hashpartitioning", 1)
    assert "agent_results" in above and "agent_results" not in below and "variant" not in below
    assert plan_of(dealt.groupBy("task_id").count()).count("Exchange") == 1
    sinks.write_json(small_envelopes(spark, 50), f"{tmp_path}/j", files=3)
    assert len(list((tmp_path / "j").glob("part-*"))) == 3 and envelopes.read_envelopes(spark, f"{tmp_path}/j", lines=True, glob="*.txt").count() == 50


def test_members_of_an_ordered_export(spark, tmp_path):
    """Parts are compressed, their join is one gzip file, and each part of it is read by a task; quoted line ends stay in their row."""
    texts = ["a,b", 'say "x"', "two\nlines", "", None, "é\\", '"\n"', "a\rb"]
    row = [F.lit("x").alias(c) if c not in ("task_id", "response_text", "dispatched_at") else c for c in sinks.CSV_COLUMNS]
    rows = spark.range(400).select(F.format_string("t%04d", "id").alias("task_id"), F.lit("2024").alias("dispatched_at"), F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % len(texts) + 1).cast("int")).alias("response_text"), F.lit(0).alias("pass_idx")).select(*row, "pass_idx").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_ordered_csv(rows, f"{tmp_path}/o", compression="gzip")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sinks.join_parts(f"{tmp_path}/o", f"{tmp_path}/o.csv.gz")
    whole = gzip.decompress((tmp_path / "o.csv.gz").read_bytes())
    assert whole.startswith(",".join(sinks.CSV_COLUMNS).encode() + b"\n") and len(whole) > 10 * (tmp_path / "o.csv.gz").stat().st_size and len(parts) > 3
    read = sinks.read_parts(spark, f"{tmp_path}/o.csv.gz", parts)
    assert read.columns == [*sinks.CSV_COLUMNS, "place"]
    found = sorted((r["place"], r["task_id"], r["response_text"]) for r in read.collect())
    assert found == [(i + 1, f"t{i:04d}", texts[i % len(texts)] or None) for i in range(400)]
    small = list(sinks.unzipped(f"{tmp_path}/o.csv.gz", 0, sum(n for _, n in parts)))
    assert sum(map(len, small)) == 401  # members that follow each other are one text


def test_a_search_shuffles_texts_once(spark, tmp_path, monkeypatch):
    """Words, documents that have them, terms and hits stay in the blocks that texts are dealt to."""
    plans, real = [], corpus.containing_words

    def held(*a):
        out = real(*a)
        hits = out.select("__block", "term", F.inline("__in")).groupBy("__block", "term", "__doc").agg(F.sum("n"))
        plans.append(plan_of(hits))
        return out

    monkeypatch.setattr(corpus, "containing_words", held)
    spark.createDataFrame([(f"d{i}", f"one three{i % 7} Überwort {'x' * (i % 40)}") for i in range(60)], "filename string, text_content string").write.parquet(f"{tmp_path}/d")
    asked = spark.createDataFrame([(1, "three1 one"), (2, "überw xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx"), (3, "none of-it"), (4, "")], "query_id long, query string")
    docs = spark.read.parquet(f"{tmp_path}/d")
    found = corpus.search_many(docs, asked, 3)
    assert plans[0].count("Exchange hashpartitioning(__block") == 1 and plans[0].count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plans[0]
    got = {(r["query_id"], r["rank"]): (r["filename"], r["relevance_score"], r["snippet"]) for r in found.collect()}
    for number, query in ((1, "three1 one"), (2, "überw xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx"), (3, "none of-it")):
        want = [(r["filename"], r["relevance_score"], r["snippet"]) for r in corpus.search(docs, query, 3).collect()]
        assert [got[k] for k in sorted(got) if k[0] == number] == want
