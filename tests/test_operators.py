"""Edge cases of the operators on small literal tables."""

import io
import json
import random
import zipfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyforge.functions import labels, predicates, text
from tallyforge.operators import corpus, merge, runs, store
from tallyforge.sources import corpus_files, envelopes, intake, sinks

PASS = "task_id string, agent string, pass_idx int, completed boolean, forced_stop boolean, error string, response_length int, response_text string, cost double, duration double, source_ord int"


def passes(spark, *rows):
    base = dict(task_id="t", agent="a", pass_idx=0, completed=True, forced_stop=False, error=None, response_length=1, response_text="x", cost=1.0, duration=2.0, source_ord=0)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], PASS)


def value(spark, column, **data):
    schema = ", ".join(f"{k} string" for k in data) or "x string"
    return spark.createDataFrame([tuple(data.values()) or ("",)], schema).select(column.alias("v")).first()["v"]


def test_success_definitions(spark):
    df = passes(spark, {"forced_stop": None}, {"forced_stop": True}, {"error": "e"}, {"completed": None})
    got = [tuple(r) for r in df.select(predicates.is_strict_success(), predicates.status(), predicates.is_clean_success()).collect()]
    assert got == [(False, "PASS", True), (False, "FAIL", True), (True, "PASS", False), (False, "FAIL", False)]


@pytest.mark.parametrize(
    "error, forced, want",
    [
        ("", False, "Failed — no error message"),
        ("", True, "Forced stop"),
        ("was STUCK", False, "Timeout — interaction stuck"),
        ("File generation failed for: ['xlsx'] x", False, "File generation failed ['xlsx']"),
        ("file generation failed", False, "File generation failed"),
        ("preflight", False, "Pre-flight failed — corpus too large"),
        ("over budget", True, "Forced stop — cost budget exceeded"),
        ("max_iterations", False, "Forced stop — iteration limit"),
        ("iteration 3", True, "Forced stop — iteration limit"),
        ("iteration 3", False, "iteration 3"),
        ("x" * 200, True, "Forced stop — " + "x" * 80),
        ("x" * 200, False, "x" * 120),
    ],
)
def test_export_failure(spark, error, forced, want):
    assert passes(spark, {"completed": False, "forced_stop": forced, "error": error}).select(labels.export_failure()).first()[0] == want


def test_diagnosed_failure(spark):
    cases = {"400 Invalid": "Content policy 400", "0 tokens": "Gemini API timeout (0 tokens)", "file generation failed: no module named 'scipy'": "File generation failed — missing library (scipy)", "FileNotFoundError file generation failed": "File generation failed — file not found", "": "Unknown failure", "did not generate the required file": "File output not produced (model skipped)"}
    for e, want in cases.items():
        assert value(spark, labels.diagnosed_failure("e"), e=e) == want


def test_formats_of_prompts(spark):
    cases = {"Present the final results in Excel format.": ["xlsx"], "Produce a Word document deliverable.": ["docx"], "Use Data Dump 1.xlsx to extract the data.": [], "Create a plan. Excel is open.": [], "create " + "x" * 130 + " excel": [], "Build powerpoint and word doc": ["docx", "pptx"]}
    for p, want in cases.items():
        assert value(spark, labels.output_formats("p"), p=p) == want


def test_links(spark):
    cases = {"/local/x": None, "./x": None, "gdrive://abc": ("file", "abc"), "https://drive.google.com/uc?export=x&id=q1": ("file", "q1"), "https://drive.google.com/drive/folders/f_1": ("folder", "f_1"), "https://docs.google.com/document/d/z/edit": ("workspace_doc", "z"), "https://example.com/?id=3": None}
    for r, want in cases.items():
        got = value(spark, labels.link("r"), r=r)
        assert (got and (got["type"], got["id"])) == want


def test_ids_and_steps(spark):
    assert [value(spark, text.normal_id("i"), i=i) for i in ("28115.0B", "12.0", "1.5")] == ["28115B", "12", "1.5"]
    assert [value(spark, text.id_prefix("i"), i=i) for i in ("x_abcdef", "x_ABCDEF", "_abcdef")] == ["x", "x_ABCDEF", "_abcdef"]
    assert value(spark, text.solution_steps("s"), s="short\n  a step that is long \n") == ["a step that is long"]


def test_citations(spark):
    report = "[1] A work — https://x.example/a).\n[2] B — https://x.example/a\n[md](https://y.example/b)"
    assert [tuple(c) for c in value(spark, text.report_citations("t"), t=report)] == [("A work", "https://x.example/a", ""), ("md", "https://y.example/b", "")]
    assert [c["url"] for c in value(spark, text.report_citations("t"), t="see https://z.example/long.)")] == ["https://z.example/long"]
    items = F.array(F.lit('{"title":"T","url":"u","snippet":"a\\n b"}'), F.lit("v"))
    assert value(spark, text.citations_text(text.normal_citations(items))) == "title=T, url=u, snippet=a b | url=v"
    assert value(spark, text.output_files_text(F.array(F.lit("a.txt"), F.lit('{"filename":"b.txt"}')), F.lit(None).cast("string"))) == "a.txt; b.txt"


def test_code_blocks(spark):
    two = "```py\nimport docx\n```\n```\npandas\n```"
    assert value(spark, text.last_library_block("t", "xlsx"), t=two) == "pandas"
    assert value(spark, text.last_library_block("t", "pptx"), t=two) is None
    marked = f"a\n```python\n{text.BLOCK_START}\nx = 1\n{text.BLOCK_END}\n```\nb"
    assert value(spark, text.marked_block("t", "?"), t=marked) == f"{text.BLOCK_START}\nx = 1\n{text.BLOCK_END}"
    assert value(spark, text.without_block("t"), t=marked) == "a\n\nb"
    assert value(spark, text.without_block("t"), t=" plain ") == "plain"


def test_report_values(spark):
    assert value(spark, text.duration_text(F.lit(3725.5))) == "1h 2m 5s  (3,725.50 s)"
    assert value(spark, text.duration_text(F.lit(None).cast("double"))) == "(none)"
    assert value(spark, text.timestamp_slug("t"), t="2024-05-06T07:08:09+00:00") == "20240506_070809"
    assert value(spark, text.timestamp_slug("t"), t="on 2024/5") == "20245"
    assert value(spark, text.timestamp_slug("t"), t="") == "unknown_time"
    assert value(spark, text.field("L", F.lit("a\nb"), 4)) == "L   : a\n      b\n"
    assert value(spark, text.safe_filename("t"), t="é b/c") == "é_b_c"


def test_best_pass_ties_and_empty(spark):
    df = passes(spark, {"pass_idx": 0, "error": "e", "response_length": 9}, {"pass_idx": 1, "response_length": 5}, {"pass_idx": 2, "response_length": 5})
    assert runs.best_passes(df).first()["pass_idx"] == 1
    assert runs.best_passes(df.limit(0)).count() == 0
    assert runs.best_passes(passes(spark, {"pass_idx": 0, "completed": False, "response_length": None}, {"pass_idx": 1, "completed": False, "response_length": 3})).first()["pass_idx"] == 1


def test_reconcile_equals_pairwise_fold(spark):
    rng = random.Random(3)
    rows = [{"task_id": f"t{t}", "source_ord": s, "completed": rng.random() < 0.5, "error": rng.choice([None, "", "e"]), "response_length": rng.choice([None, 0, 1, 2])} for t in range(300) for s in range(rng.randint(1, 4))]

    def better(old, new):
        if bool(old["completed"]) != bool(new["completed"]):
            return new if new["completed"] else old
        key = (lambda r: r["response_length"] or 0) if old["completed"] else (lambda r: bool(r["error"]))
        return new if key(new) > key(old) else old

    want = {}
    for r in rows:
        want[r["task_id"]] = better(want[r["task_id"]], r) if r["task_id"] in want else r
    got = {r["task_id"]: r["source_ord"] for r in merge.reconcile_passes(passes(spark, *rows)).collect()}
    assert got == {k: v["source_ord"] for k, v in want.items()}


def test_merge_precedence_and_stale_failures(spark):
    p = passes(spark, {"source_ord": 0}, {"source_ord": 1, "completed": False, "error": "late"})
    tasks = spark.createDataFrame([("t", 0, 1.0, 5.0, "2024-01-02", "bad", "", "first"), ("t", 1, 2.0, 3.0, "2024-01-01", "2024-01-05", " ", "second")], "task_id string, source_ord int, total_cost double, total_duration double, dispatched_at string, completed_at string, domain string, note string")
    r = merge.merge_tasks(tasks, p, ["domain", "note"]).first()
    assert (r["total_cost"], r["total_duration"], r["domain"], r["note"], r["agents_succeeded"], r["agents_failed"], r["n_sources"]) == (3.0, 5.0, " ", "first", ["a"], [], 2)
    assert str(r["dispatched_at"])[:10] == "2024-01-01" and str(r["completed_at"])[:10] == "2024-01-05"


def test_upsert_adds_costs_each_time(spark):
    t = spark.createDataFrame([("t", 1.0, 2.0, "b", "c", None)], "task_id string, total_cost double, total_duration double, dispatched_at string, completed_at string, domain string")
    once = merge.upsert_tasks(t, t.withColumn("domain", F.lit("d")), ["domain"])
    assert once.first()["domain"] == "d"
    assert merge.upsert_tasks(once, t, ["domain"]).first()[1:3] == (3.0, 2.0)


def test_search(spark):
    docs = spark.createDataFrame([("b.txt", "The cat sat"), ("a.txt", "concatenate"), ("c.txt", "dog"), ("d.txt", None)], "filename string, text_content string")
    got = [(r["filename"], r["relevance_score"]) for r in corpus.search(docs, "a cat cat of").collect()]
    assert got == [("a.txt", 2.099), ("b.txt", 2.099)]
    assert corpus.search(docs, "a of").count() == 0
    assert corpus.fetch(docs.withColumn("doc_id", F.lit("x")).limit(1), "X.TXT").count() == 0


def test_sections(spark):
    pages = spark.createDataFrame([("d", i, c) for i, c in enumerate(["NEUTRAL", "DROP", "NEUTRAL", "KEEP", "NEUTRAL"])], "doc string, page int, class string")
    assert [r["page"] for r in corpus.drop_sections(pages, "doc", "page").orderBy("page").collect()] == [0, 3, 4]
    assert value(spark, corpus.page_class("t"), t="Balance Sheet and CSR committee") == "KEEP"


def test_csv_intake(spark, tmp_path):
    (tmp_path / "in.csv").write_text('﻿Task ID,Prompts,POC Name,Odd\n12.0B," say ""hi""\nthere ",Ann,1\n,,,\n,no id here,Bob Lee,\nx,,only,\n', encoding="utf-8")
    rows = intake.read_intake(spark, str(tmp_path / "in.csv")).orderBy("prompt").collect()
    assert [(r["prompt"], r["sme_name"]) for r in rows] == [("no id here", "Bob Lee"), ('say "hi"\nthere', "Ann")]
    assert rows[1]["task_id"] == "12B" and rows[0]["task_id"].startswith("bob_lee_")
    with pytest.raises(ValueError):
        intake.bind_headers(["prompt"])
    with pytest.raises(ValueError):
        intake.validate(intake.packages(intake.read_intake(spark, str(tmp_path / "in.csv"))))
    assert intake.bind_headers(["id", "prompt", "Prompts"])["prompt"] == "prompt"


def test_envelopes_round_trip(spark, tmp_path):
    def task(i, results):
        return {"task_id": i, "dispatched_at": "2024-01-01T00:00:00+00:00", "agent_results": results}

    good = {"agent": "a", "model": "M-1", "completed": True, "forced_stop": False, "response_text": "hi", "output_files": ["x", {"path": "y"}]}
    (tmp_path / "one.json").write_text(json.dumps(task("t1", {"a": [good, {**good, "model": "other"}], "b": []})))
    (tmp_path / "two.json").write_text(json.dumps([task("t2", {}), task(None, {"c": [{**good, "completed": False}]})]))
    (tmp_path / "bad.json").write_text("{ nope")
    (tmp_path / "index.json").write_text("{}")
    env = envelopes.read_envelopes(spark, str(tmp_path))
    assert sorted(r["task_id"] for r in env.collect()) == ["t1", "t2", "two"]
    flat = envelopes.flatten(env)
    assert flat.filter("task_id = 't1'").count() == 3 and flat.filter("task_id = 't2' AND run IS NULL").count() == 1
    back = envelopes.nest(flat, ["task_id"]).filter("task_id = 't1'").first()["agent_results"]
    assert list(back) == ["a"] and [p["model"] for p in back["a"]] == ["M-1", "other"]
    for mode, pattern, want in (("contains", "m-", 2), ("exact", "M-1", 2), ("regex", "^OTHER$", 1)):
        assert envelopes.with_matching_model(env, pattern, mode).count() == want
    body = sinks.reports(flat.filter("run IS NOT NULL").withColumn("agent", F.col("agent"))).orderBy("file_name").first()
    assert body["file_name"] == "t1_a_p1_unknown_time.txt" and "RESPONSE" in body["body"] and "(none)" in body["body"]
    grouped = sinks.grouped_json(env.withColumn("prefix", F.lit("p")).select("prefix", "task_id")).first()["body"]
    assert [t["task_id"] for t in json.loads(grouped)] == ["t1", "t2", "two"]


def test_csv_sink(spark, tmp_path):
    rows = spark.createDataFrame([tuple("x" for _ in sinks.CSV_COLUMNS)], list(sinks.CSV_COLUMNS))
    sinks.write_csv(rows.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    sinks.write_csv(rows, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == list(sinks.CSV_COLUMNS)


def office(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return out.getvalue()


def test_corpus_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello world")
    (tmp_path / ".hidden.txt").write_text("no")
    (tmp_path / "b.docx").write_bytes(office({"word/document.xml": "<d xmlns:w='w'><w:p><w:t>one</w:t></w:p><w:p><w:t> </w:t></w:p><w:p><w:t>t</w:t><w:t>wo</w:t></w:p></d>"}))
    (tmp_path / "c.xlsx").write_bytes(office({"xl/workbook.xml": "<w><sheet name='S'/></w>", "xl/sharedStrings.xml": "<s><si><t>x</t></si></s>", "xl/worksheets/sheet1.xml": "<w><row><c t='s'><v>0</v></c><c><v>2</v></c></row></w>"}))
    (tmp_path / "d.pptx").write_bytes(b"broken")
    (tmp_path / "e.png").write_bytes(b"12")
    got = {r["filename"]: (r["text_content"], r["extractable"]) for r in corpus_files.read_corpus(spark, str(tmp_path)).collect()}
    assert got["a.txt"] == ("hello world", True) and got["b.docx"] == ("one\n\ntwo", True) and got["c.xlsx"] == ("=== Sheet: S ===\nx\t2\n[1 rows]", True)
    assert not got["d.pptx"][1] and "extraction error" in got["d.pptx"][0] and "size=2 bytes" in got["e.png"][0] and len(got) == 5


def test_scores_keep_the_last(spark):
    s = "task_id string, scored_at string, total double"
    out = store.append_scores(spark.createDataFrame([("t", "2024", 1.0)], s), spark.createDataFrame([("t", None, 2.0), ("u", "2020", 3.0)], s))
    assert {r["task_id"]: r["total"] for r in out.collect()} == {"t": 2.0, "u": 3.0}


def test_streaming_windows(spark, tmp_path):
    from tallyforge.streaming.status import event_counts

    src = tmp_path / "in"
    spark.createDataFrame([Row(ts=None, event_type="x", value=1.0)], "ts timestamp, event_type string, value double").withColumn("ts", F.lit("2024-01-01 00:05:00").cast("timestamp")).write.parquet(str(src))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(str(src))
    q = event_counts(stream).writeStream.format("memory").queryName("counted").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select n from counted").first()["n"] == 1


def test_stale_keys_stream(spark, tmp_path):
    from tallyforge.streaming.status import stale_keys

    rows = [("2024-01-01 00:00:00", 1, "a"), ("2024-01-01 05:00:00", 1, "a"), ("2024-01-01 09:00:00", 2, "b")]
    src = tmp_path / "in"
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "ts string, k long, s string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("ts timestamp, k long, s string").option("maxFilesPerTrigger", 1).parquet(str(src))
    q = stale_keys(stream, "k", "s", "ts", 3600).writeStream.format("memory").queryName("stale").start()
    q.processAllAvailable()
    q.stop()
    assert {r["key"] for r in spark.sql("select key from stale").collect()} <= {"1", "2"}


def test_envelopes_keep_what_the_schema_does_not_know(spark, tmp_path):
    from tallyforge.operators import merge

    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    run = {"model": "M", "completed": True, "response_length": 5, "total_cost_usd": 0.1}
    first = {"task_id": "t", "dispatched_at": "2024-01-02", "note": "", "count": 0, "deep": {"x": [1, "é\""]}, "package": {"domain": " "}, "agents_attempted": ["z", "a"], "total_cost_usd": 1.0, "agent_results": {"a": [run]}}
    (tmp_path / "a" / "x_0a1b2c.json").write_text(json.dumps(first))
    (tmp_path / "a" / "broken.json").write_text('{"task_id": ')
    (tmp_path / "b" / "y.json").write_text(json.dumps([{**first, "note": "n", "package": {"domain": "d"}, "dispatched_at": "2024-01-01"}, {"agents_attempted": ["z", "a"], "agent_results": {}, "odd key": None}], indent=2))
    env = envelopes.read_envelopes(spark, [str(tmp_path / "a"), str(tmp_path / "none"), str(tmp_path / "b")])
    got = {(r["task_id"], r["source_ord"]): r for r in env.collect()}
    assert set(got) == {("t", 0), ("t", 2), ("y", 2)} and got["t", 0]["prefix"] == "x" and not got["t", 0]["in_array"] and got["y", 2]["in_array"]
    assert json.loads(got["t", 0]["extra"]["deep"]) == {"x": [1, 'é"']} and got["y", 2]["extra"] == {"odd key": "null"}
    back = [json.loads(r[0]) for r in sinks.write_json(env.filter("source_ord = 0"), "", dry_run=True).collect()]
    assert back == [{**first, "package": {"domain": " "}}]
    merged = {r["task_id"]: r for r in merge.merge_envelopes(env.withColumn("config", F.lit(None).cast("struct<mcp_server_url:string>"))).collect()}
    t, y = merged["t"], merged["y"]
    assert t["n_sources"] == 2 and t["dispatched_at"] == "2024-01-01T00:00:00" and t["package"]["domain"] == "d" and t["total_cost_usd"] == 2.0 and t["agents_attempted"] == ["a"]
    assert {k: json.loads(v) for k, v in t["extra"].items()} == {"note": "n", "count": 0, "deep": {"x": [1, 'é"']}}
    assert y["n_sources"] == 1 and y["agents_attempted"] == ["z", "a"]
    none = envelopes.read_envelopes(spark, str(tmp_path / "none"))
    assert none.count() == 0 and corpus_files.read_corpus(spark, [str(tmp_path / "none")]).count() == 0


def test_dry_runs_write_nothing(spark, tmp_path):
    env = spark.createDataFrame([("t", "f.json", True)], "task_id string, file_name string, in_array boolean")
    out = str(tmp_path / "out")
    assert [r["value"] for r in sinks.write_extracted(env, out, dry_run=True).collect()] == ['[{"task_id":"t"}]']
    sinks.write_json(env, out, dry_run=True)
    sinks.write_envelopes(env, out, dry_run=True)
    assert not (tmp_path / "out").exists()
    sinks.write_extracted(env, out)
    sinks.write_json(env, str(tmp_path / "json"), by="file_name")
    assert (tmp_path / "out" / "file_name=f.json").exists() and (tmp_path / "json" / "file_name=f.json").exists()


def test_awkward_tables():
    assert corpus_files.file_table(b"", ".csv", "x.csv") == "\n[File: x.csv — empty CSV/TSV]\n"
    assert "| a | b |\n| --- | --- |\n| 1\\|2 |  |" in corpus_files.file_table(b'a,b\n"1|2"\n', ".csv", "x.csv")
    assert "| a\tb |" not in corpus_files.file_table(b"a\tb\n", ".tsv", "x.tsv") and "(0 data rows)" in corpus_files.file_table(b"a\tb\n", ".tsv", "x.tsv")
    assert "could not be read" in corpus_files.file_table(b"broken", ".docx", "x.docx") and "extraction error" in corpus_files.labelled_text(b"", ".xlsx")
    sheet = office({"xl/workbook.xml": "<w><sheet name='S'/></w>", "xl/worksheets/sheet1.xml": "<w><row><c r='C1'><v>1</v></c></row><row/><row><c r='A3'><v>2</v></c><c r='B3'><v>3</v></c></row></w>"})
    assert "| --- | --- | --- |\n| 2 | 3 |  |\n(1 data rows)" in corpus_files.file_table(sheet, ".xlsx", "x.xlsx")
    assert corpus_files.labelled_text(sheet, ".xlsx") == "=== Sheet: S (1 rows, use header=2 when reading with pandas) ===\n2\t3"
    empty = office({"xl/workbook.xml": "<w/>"})
    assert corpus_files.labelled_text(empty, ".xlsx") == "[Empty workbook]"
