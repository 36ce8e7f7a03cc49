"""The results store: upserts, versions, replays, pruned reads, counts kept by bucket."""

import json
import re

import pytest
from pyspark.sql import functions as F

from tallyforge.sources import control
from tallyforge.sources.result_store import ResultStore, bucket_of
from tallyforge.streaming.status import store_stream

FIELDS = "task_id string, total_cost_usd double, total_duration_sec double, dispatched_at string, completed_at string, package struct<research_type:string,domain:string>, extra map<string,string>, agent_results map<string,array<struct<model:string,completed:boolean,error:string,response_length:int,response_text:string>>>"


def run(model="m", completed=True, error=None, length=3):
    return {"model": model, "completed": completed, "error": error, "response_length": length, "response_text": "x" * length}


def task(i, cost=1.0, start="2024-01-02", end="2024-01-03", kind="A", domain="d", agents=None, note=None):
    return (i, cost, 2.0, start, end, {"research_type": kind, "domain": domain}, {"note": note} if note else None, {"a": [run()]} if agents is None else agents)


def rows(spark, *tasks):
    return spark.createDataFrame(list(tasks), FIELDS)


def one(store, i):
    found = store.get(i).collect()
    assert len(found) == 1
    return found[0].asDict(recursive=True)


def test_upserts_merge_field_by_field(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), 4)
    assert store.tasks().count() == 0 and store.stats().first()["total"] == 0
    store.upsert(rows(spark, task("t1", note='"first"', agents={"a": [run()], "b": [run(completed=False, error="e1"), run(completed=False, error="e2")]}), task("t2"), task(None)))
    store.upsert(rows(spark, task("t1", cost=None, start="", end="2024-01-09", kind=None, domain="new", note='"second"', agents={"b": [run(completed=True)], "c": [run(completed=False, error="")]})))
    t = one(store, "t1")
    assert t["total_cost_usd"] == 1.0 and (t["dispatched_at"], t["completed_at"]) == ("2024-01-02", "2024-01-09")
    assert t["package"]["research_type"] == "A" and t["package"]["domain"] == "new" and t["extra"] == {"note": '"first"'}
    assert (t["agents_attempted"], t["agents_succeeded"], t["agents_failed"], t["agent_errors"]) == (["a", "b", "c"], ["a", "b"], ["c"], {})
    assert sorted(r[0] for r in store.tasks().select("task_id").collect()) == ["t1", "t2", "unknown"]
    figures = {(r["dimension"], r["value"]): (r["n"], float(r["cost"])) for r in store.figures().collect()}
    assert figures == {("all", ""): (3, 3.0), ("research_type", "A"): (3, 3.0), ("iat_type", ""): (3, 3.0), ("domain", "d"): (2, 2.0), ("domain", "new"): (1, 1.0), ("agent", "a"): (3, 3.0), ("agent", "b"): (1, 1.0), ("agent", "c"): (1, 1.0)}


def test_rows_of_one_task_in_a_batch_are_stored_in_order(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), 4)
    parts = [task("t", cost=float(i), domain=f"d{i}" if i != 4 else None, agents={"a": [run(model=f"m{i}")], f"x{i}": [run(completed=False, error=f"e{i}")]}) for i in range(5)]
    store.upsert(rows(spark, *parts).withColumn("ord", F.substring("package.domain", 2, 1)).withColumn("ord", F.coalesce("ord", F.lit("4"))), order=("ord",))
    t = one(store, "t")
    assert t["total_cost_usd"] == 10.0 and t["package"]["domain"] == "d3" and t["agent_results"]["a"][0]["model"] == "m4" and len(t["agents_failed"]) == 5 and t["agent_errors"]["x2"] == "e2"


def test_a_single_row_stays_as_it_is(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), 2)
    store.upsert(rows(spark, task("t", cost=None, start=None, end="")).withColumn("agents_attempted", F.array(F.lit("z"))))
    t = one(store, "t")
    assert t["total_cost_usd"] is None and t["dispatched_at"] is None and t["completed_at"] == "" and t["agents_attempted"] == ["z"] and t["agents_succeeded"] == ["a"]


def paths(df):
    return {re.search(r"bucket=(\d+)", f)[1] for f in df.inputFiles()}


def test_reads_touch_only_the_buckets_of_their_tasks(spark, tmp_path, monkeypatch):
    store = ResultStore(spark, str(tmp_path / "s"), 16)
    store.upsert(rows(spark, *[task(f"t{i}") for i in range(200)]))
    b = {f"t{i}": spark.range(1).select(bucket_of(F.lit(f"t{i}"), 16)).first()[0] for i in (3, 4)}
    assert paths(store.get("t3")) == {str(b["t3"])} and one(store, "t3")["task_id"] == "t3"
    ids = spark.createDataFrame([("t3",), ("t4",), ("t3",), (None,), ("none",)], "`an id` string")
    wanted = {str(r[0]) for r in ids.filter("`an id` IS NOT NULL").select(bucket_of(F.col("an id"), 16)).collect()}
    assert paths(store.lookup(ids, "an id")) == wanted and sorted(r["task_id"] for r in store.lookup(ids, "an id").collect()) == ["t3", "t4"]
    plan = store.get("t3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(task_id,t3)" in plan
    seen = []
    read = ResultStore._read
    monkeypatch.setattr(ResultStore, "_read", lambda self, table, manifest=None, buckets=None: seen.append(buckets) or read(self, table, manifest, buckets))
    before = store.manifest()["tables"]
    store.upsert(rows(spark, task("t3", kind="B")))
    assert seen and all(x == [b["t3"]] for x in seen)
    after = store.manifest()["tables"]
    for t in ("tasks", "figures"):
        assert {k for k in after[t] if after[t][k] != before[t].get(k)} == {str(b["t3"])}
    monkeypatch.undo()
    assert {(r["dimension"], r["value"]): r["n"] for r in store.figures().collect() if r["dimension"] == "research_type"} == {("research_type", "A"): 199, ("research_type", "B"): 1}
    index = store.index().select("task_id", "domain", "scored")
    assert "agent_results" not in index._jdf.queryExecution().executedPlan().toString()


def test_failed_writes_leave_the_old_version(spark, tmp_path, monkeypatch):
    store = ResultStore(spark, str(tmp_path / "s"), 4)
    store.upsert(rows(spark, task("t", domain="old")))
    monkeypatch.setattr(control, "write_new", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.upsert(rows(spark, task("t", domain="new")))
    monkeypatch.undo()
    assert one(store, "t")["package"]["domain"] == "old"
    last = max((tmp_path / "s" / "manifest").glob("*.json"))
    torn = last.with_name("000000000099.json")
    torn.write_text(last.read_text()[:-30])  # a writer that died on the way
    assert store.manifest()["version"] == 1
    store.upsert(rows(spark, task("t", domain="new")))
    assert store.manifest()["version"] == 100 and one(store, "t")["package"]["domain"] == "new"


def test_writers_that_meet(spark, tmp_path, monkeypatch):
    store, other = ResultStore(spark, str(tmp_path / "s"), 16), ResultStore(spark, str(tmp_path / "s"))
    assert other.buckets == 16
    store.upsert(rows(spark, *[task(f"t{i}") for i in range(20)]))
    count = ResultStore._count
    for name in ("t1", "t2"):  # the other writes t1 while this one does: the same bucket, then another
        done = []

        def between(self, now, touched):
            if self is store and not done:
                done.append(1)
                other.upsert(rows(spark, task("t1", domain="other")))
            return count(self, now, touched)

        monkeypatch.setattr(ResultStore, "_count", between)
        store.upsert(rows(spark, task(name, domain="mine")))
        monkeypatch.undo()
    assert one(store, "t1")["total_cost_usd"] == 4.0 and one(store, "t2")["total_cost_usd"] == 2.0 and one(store, "t2")["package"]["domain"] == "mine"
    assert {r["value"]: r["n"] for r in store.figures().filter("dimension = 'domain'").collect()} == {"d": 18, "other": 1, "mine": 1}


def test_batches_count_once(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), 4)
    for number in (0, 1, 1, 0):
        store.upsert(rows(spark, task("t")), batch=("intake", number))
    assert one(store, "t")["total_cost_usd"] == 2.0
    version = store.manifest()["version"]
    store.upsert(rows(spark, task("t")).limit(0), batch=("intake", 2))
    assert store.manifest()["version"] == version + 1 and store.manifest()["batches"] == {"intake": 2}


def test_scores_and_counts(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), 4)
    store.upsert(rows(spark, task("t"), task("u", cost=2.555)))
    s = "task_id string, scored_at string, golden_response string, agent_scores map<string,string>"
    store.add_scores(spark.createDataFrame([("t", "2024", "a", {"a": "{}"}), ("t", "2023", "b", None), ("x", None, "a", None)], s))
    store.add_scores(spark.createDataFrame([("t", "2020", "c", {"a": "5"})], s), batch=("scores", 0))
    store.add_scores(spark.createDataFrame([("t", "2030", "d", None)], s), batch=("scores", 0))
    assert store.stats().first().asDict() == {"total": 2, "scored": 1, "unscored": 1, "total_cost": 3.56}
    assert {r["task_id"]: r["golden_response"] for r in store.scores().collect()} == {"t": "c", "x": "a"} and store.scores().filter("scored_at IS NULL").count() == 0
    assert {r["task_id"]: r["scored"] for r in store.index().collect()} == {"t": True, "u": False}
    r = store.comparison(spark.createDataFrame([("t",)], "task_id string")).collect()
    assert [(x["agent"], x["scores"], x["golden_response"], x["passes_run"], x["response_preview"]) for x in r] == [("a", "5", "c", 1, "xxx")]


def test_best_pass_of_a_comparison(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), 4)
    passes = [run("short", length=1), run("failed", completed=False, length=9), run("odd", error="e", length=8), run("first", length=5), run("second", length=5)]
    store.upsert(rows(spark, task("t", agents={"a": passes, "b": passes[1:3], "c": []})))
    assert {r["agent"]: (r["model"], r["passes_run"], r["passes_succeeded"]) for r in store.comparison().collect()} == {"a": ("first", 5, 3), "b": ("failed", 2, 0)}


def test_vacuum(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), 1)
    for i in range(3):
        store.upsert(rows(spark, task("t", cost=1.0 + i)))
    assert store.vacuum() == 4 and one(store, "t")["total_cost_usd"] == 6.0 and store.vacuum() == 0
    assert len(list((tmp_path / "s" / "manifest").glob("*.json"))) == 1


def test_stream_into_the_store(spark, tmp_path):
    store, drop = ResultStore(spark, str(tmp_path / "s"), 4), tmp_path / "in"
    drop.mkdir()
    body = {"task_id": "t", "total_cost_usd": 1.0, "dispatched_at": "2024", "agent_results": {"a": [{"model": "m", "completed": True}]}}
    (drop / "1.json").write_text(json.dumps(body))
    (drop / "2.json").write_text(json.dumps([{**body, "task_id": "u"}, {**body, "task_id": "v"}], indent=2))
    (drop / "3.json").write_text('{"task_id": "broken"')
    for _ in range(2):
        store_stream(spark, str(drop), store, str(tmp_path / "c"), glob="*.json", per_trigger=1).awaitTermination()
    assert sorted((r["task_id"], r["total_cost_usd"]) for r in store.tasks().collect()) == [("t", 1.0), ("u", 1.0), ("v", 1.0)]
    (drop / "4.json").write_text(json.dumps({**body, "package": {"domain": "late"}}))
    store_stream(spark, str(drop), store, str(tmp_path / "c"), glob="*.json", per_trigger=1).awaitTermination()
    t = one(store, "t")
    assert t["total_cost_usd"] == 2.0 and t["package"]["domain"] == "late"
    # the stream's notes are lost: it starts at batch 0 again, all of which the store has
    store_stream(spark, str(drop), store, str(tmp_path / "c2"), glob="*.json", per_trigger=1).awaitTermination()
    assert one(store, "t")["total_cost_usd"] == 2.0
