"""Queries on tasks and passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import labels, predicates, text
from tallyforge.operators import merge, runs, store
from tallyforge.plans.registry import query
from tallyforge.plans.views import PASSES_SQL, TASKS_SQL, passes, table, tasks
from tallyforge.sources.envelopes import flatten, nest, with_matching_model

BOTH = f"WITH {TASKS_SQL}, {PASSES_SQL}"
STATUS_SQL = "CASE WHEN coalesce(completed, false) AND NOT coalesce(forced_stop, false) THEN 'PASS' ELSE 'FAIL' END"
CLEAN_SQL = "(coalesce(completed, false) AND coalesce(error, '') = '')"
BEST_SQL = f"best AS (SELECT * FROM passes QUALIFY row_number() OVER (PARTITION BY task_id, agent ORDER BY {CLEAN_SQL} DESC, coalesce(response_length, 0) DESC, pass_idx) = 1)"
EXPORT_CATEGORY_SQL = """CASE WHEN coalesce(completed, false) THEN ''
  WHEN trim(coalesce(error, '')) = '' AND NOT coalesce(forced_stop, false) THEN 'Failed — no error message'
  WHEN regexp_matches(lower(error), 'stuck|in_progress|aborting') THEN 'Timeout — interaction stuck'
  WHEN contains(lower(error), 'file generation failed') THEN trim('File generation failed ' || regexp_extract(error, '(?i)file generation failed for:\\s*(\\[.*?\\])', 1))
  WHEN regexp_matches(lower(error), 'preflight|max_inline_chars|3m char') THEN 'Pre-flight failed — corpus too large'
  WHEN regexp_matches(lower(error), 'budget|max_cost') THEN 'Forced stop — cost budget exceeded'
  WHEN contains(lower(error), 'max_iterations') OR (contains(lower(error), 'iteration') AND coalesce(forced_stop, false)) THEN 'Forced stop — iteration limit'
  WHEN coalesce(forced_stop, false) AND trim(coalesce(error, '')) <> '' THEN 'Forced stop — ' || trim(error)[1:80]
  WHEN coalesce(forced_stop, false) THEN 'Forced stop' ELSE trim(error)[1:120] END"""
DIAGNOSED_SQL = """CASE WHEN regexp_matches(lower(e), 'stuck in ''in_progress''|staleinteractionerror') THEN 'Gemini API timeout (in_progress)'
  WHEN regexp_matches(lower(e), '0 input_tokens|0 tokens') THEN 'Gemini API timeout (0 tokens)'
  WHEN contains(lower(e), 'invalid_prompt') OR (contains(e, '400') AND contains(lower(e), 'invalid')) THEN 'Content policy 400'
  WHEN contains(lower(e), 'there was a problem') AND contains(e, '400') THEN 'Content policy 400 (Gemini)'
  WHEN contains(lower(e), 'file generation failed') THEN 'File generation failed' || CASE WHEN contains(lower(e), 'keyerror') THEN ' — wrong column name' WHEN contains(lower(e), 'modulenotfounderror') THEN ' — missing library (scipy)' ELSE '' END
  WHEN contains(lower(e), 'timeout') THEN 'Timeout' WHEN contains(lower(e), 'error') THEN 'Other error' ELSE 'Unknown failure' END"""
money = lambda c: F.sum(c).cast("double")


@query(f"""{BOTH}, {BEST_SQL}
SELECT research_type, agent, count(*) AS n, count(*) FILTER ({CLEAN_SQL}) AS n_clean, count(*) FILTER ({CLEAN_SQL}) / count(*) AS clean_rate, CAST(sum(cost) AS DOUBLE) AS cost
FROM best JOIN tasks USING (task_id) GROUP BY ALL""")
def best_pass_rate(spark, sf):
    clean = F.count_if(predicates.is_clean_success())
    best = runs.best_passes(passes(spark, sf)).join(tasks(spark, sf).select("task_id", "research_type"), "task_id")
    return best.groupBy("research_type", "agent").agg(F.count("*").alias("n"), clean.alias("n_clean"), (clean / F.count("*")).alias("clean_rate"), money("cost").alias("cost"))


@query(f"{BOTH}, {BEST_SQL} SELECT task_id, agent, pass_idx, response_length FROM best")
def n01_best_pass(spark, sf):
    return runs.best_passes(passes(spark, sf)).select("task_id", "agent", "pass_idx", "response_length")


@query(f"{BOTH} SELECT task_id, agent, pass_idx FROM passes QUALIFY row_number() OVER (PARTITION BY task_id, agent ORDER BY {CLEAN_SQL} DESC, CASE WHEN {CLEAN_SQL} THEN coalesce(length(response_text), 0) END DESC NULLS LAST, pass_idx) = 1")
def n02_best_pass_by_text(spark, sf):
    return runs.best_passes_by_text(passes(spark, sf)).select("task_id", "agent", "pass_idx")


@query(f"""{BOTH} SELECT task_id, agent, pass_idx, source_ord, completed, response_length FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id, agent, pass_idx ORDER BY coalesce(completed, false) DESC,
    CASE WHEN completed THEN coalesce(response_length, 0) ELSE CAST(coalesce(error, '') <> '' AS INTEGER) END DESC, source_ord) AS r
  FROM (SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY task_id, agent, source_ord ORDER BY pass_idx) - 1 AS INTEGER) AS pass_idx) FROM passes)) WHERE r = 1""")
def n03_reconcile(spark, sf):
    return merge.reconcile_passes(renumbered(spark, sf)).select("task_id", "agent", "pass_idx", "source_ord", "completed", "response_length")


def renumbered(spark, sf):
    """Passes of two sources, each numbered from 0."""
    from pyspark.sql import Window

    order = Window.partitionBy("task_id", "agent", "source_ord").orderBy("pass_idx")
    return passes(spark, sf).withColumn("pass_idx", F.row_number().over(order) - 1)


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type, sum(CAST(event_type IS DISTINCT FROM prev AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events))
SELECT user_id, event_type, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_events FROM e GROUP BY user_id, run, event_type
HAVING floor(epoch(max(ts))) - floor(epoch(min(ts))) >= 21600""")
def n07_stale_runs(spark, sf):
    return runs.stale(table(spark, sf, "events"), ["user_id"], "ts", "event_type", 21600, "event_id")


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def n09_latest(spark, sf):
    return runs.latest(table(spark, sf, "events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id")


# success and failure ---------------------------------------------------------


@query(f"""{BOTH} SELECT agent, count(*) FILTER (completed AND forced_stop = false) AS strict, count(*) FILTER ({STATUS_SQL} = 'PASS') AS passed,
count(*) FILTER (coalesce(completed, false)) AS completed, count(*) FILTER ({CLEAN_SQL}) AS clean FROM passes GROUP BY agent""")
def success_definitions(spark, sf):
    return passes(spark, sf).groupBy("agent").agg(F.count_if(predicates.is_strict_success()).alias("strict"), F.count_if(predicates.status() == "PASS").alias("passed"), F.count_if(predicates.is_true("completed")).alias("completed"), F.count_if(predicates.is_clean_success()).alias("clean"))


@query(f"{BOTH} SELECT {EXPORT_CATEGORY_SQL} AS failure_category, count(*) AS n FROM passes GROUP BY ALL")
def f14_export_failures(spark, sf):
    return passes(spark, sf).groupBy(labels.export_failure().alias("failure_category")).agg(F.count("*").alias("n"))


@query(f"{BOTH} SELECT {DIAGNOSED_SQL} AS category, count(*) AS n FROM (SELECT coalesce(error, '') AS e FROM passes WHERE {STATUS_SQL} = 'FAIL') GROUP BY ALL")
def f15_diagnosed_failures(spark, sf):
    return passes(spark, sf).filter(predicates.status() == "FAIL").groupBy(labels.diagnosed_failure("error").alias("category")).agg(F.count("*").alias("n"))


def diagnosed(spark, sf):
    """First passes with their status; every fifth finished one has failed output files."""
    p = runs.first_passes(passes(spark, sf))
    errors = F.when(F.col("input_tokens") % 5 == 0, F.create_map(F.lit("xlsx"), F.coalesce("error", F.lit("KeyError"))))
    p = p.withColumn("output_file_errors", errors).withColumn("status", predicates.diagnosis())
    note = F.when(F.col("status") == "PASS*", labels.file_error_note("output_file_errors")).when(F.col("status") == "FAIL", labels.diagnosed_failure("error")).otherwise("")
    return p.withColumn("category", note)


DIAGNOSED_CTE = f"""{BOTH}, f AS (SELECT *, {STATUS_SQL} AS s, coalesce(error, 'KeyError') AS x, input_tokens % 5 = 0 AS flawed FROM passes WHERE pass_idx = 0),
d AS (SELECT *, CASE WHEN s = 'PASS' AND flawed THEN 'PASS*' ELSE s END AS status,
  CASE WHEN s = 'PASS' AND flawed THEN 'File generation failed: xlsx: ' || (SELECT {DIAGNOSED_SQL} FROM (SELECT x AS e)) WHEN s = 'FAIL' THEN (SELECT {DIAGNOSED_SQL} FROM (SELECT coalesce(error, '') AS e)) ELSE '' END AS category FROM f)"""


@query(f"{DIAGNOSED_CTE} SELECT task_id, agent, status, category FROM d WHERE NOT (status = 'PASS' AND category = '')")
def f16_w12_diagnosis(spark, sf):
    return diagnosed(spark, sf).filter(~((F.col("status") == "PASS") & (F.col("category") == ""))).select("task_id", "agent", "status", "category")


@query(f"""{DIAGNOSED_CTE} SELECT count(DISTINCT task_id) AS tasks, count(*) AS runs, count(*) FILTER (status LIKE 'PASS%') AS passed,
count(*) FILTER (status = 'PASS*') AS flawed, count(*) FILTER (status = 'FAIL') AS failed, CAST(sum(cost) AS DOUBLE) AS cost FROM d""")
def a13_diagnose_totals(spark, sf):
    s = F.col("status")
    return diagnosed(spark, sf).agg(F.countDistinct("task_id").alias("tasks"), F.count("*").alias("runs"), F.count_if(s.startswith("PASS")).alias("passed"), F.count_if(s == "PASS*").alias("flawed"), F.count_if(s == "FAIL").alias("failed"), money("cost").alias("cost"))


@query(f"{DIAGNOSED_CTE} SELECT agent, count(*) FILTER (status = 'PASS') AS n_pass, count(*) FILTER (status = 'PASS*') AS n_flawed, count(*) FILTER (status = 'FAIL') AS n_fail, CAST(sum(cost) AS DOUBLE) AS cost FROM d GROUP BY agent")
def a14_agent_pivot(spark, sf):
    return runs.status_pivot(diagnosed(spark, sf)).withColumn("cost", F.col("cost").cast("double"))


@query(f"{DIAGNOSED_CTE} SELECT category, task_id, agent FROM d WHERE category <> ''")
def a15_category_groups(spark, sf):
    """Members of each category, a row each."""
    return diagnosed(spark, sf).filter("category <> ''").select("category", "task_id", "agent")


@query(f"{DIAGNOSED_CTE} SELECT task_id FROM d GROUP BY task_id HAVING bool_and(status = 'FAIL')")
def a16_all_failed(spark, sf):
    return runs.all_failed(diagnosed(spark, sf))


# filters ---------------------------------------------------------------------


@query(f"{BOTH} SELECT task_id, agent, CAST(pass_idx + 1 AS INTEGER) AS pass_number FROM passes JOIN tasks USING (task_id) WHERE completed AND forced_stop = false AND NOT dry_run")
def w08_w09_w10_qualifying(spark, sf):
    p = passes(spark, sf).join(tasks(spark, sf).select("task_id", "dry_run"), "task_id")
    return runs.qualifying(p).select("task_id", "agent", "pass_number")


@query(f"{BOTH} SELECT task_id, pass_idx, model FROM passes WHERE pass_idx = 0 AND agent = 'R'")
def w11_first_pass(spark, sf):
    return runs.first_passes(passes(spark, sf), "R").select("task_id", "pass_idx", "model")


@query(f"{BOTH} SELECT model, regexp_matches(coalesce(model, ''), '(?i)#1[25]$') AS by_regex, contains(lower(coalesce(model, '')), 'brand#3') AS by_part, coalesce(model, '') = 'Brand#23' AS exact, count(*) AS n FROM passes GROUP BY ALL")
def w06_model_match(spark, sf):
    m = F.coalesce("model", F.lit(""))
    return passes(spark, sf).groupBy("model", F.rlike(m, F.lit("(?i)#1[25]$")).alias("by_regex"), F.lower(m).contains("brand#3").alias("by_part"), (m == "Brand#23").alias("exact")).agg(F.count("*").alias("n"))


def envelopes(spark, sf):
    """Nested envelopes made of the flat views."""
    run = F.struct("task_id", "agent", "model", "completed", "forced_stop", "error", "response_length", "cost", "duration")
    nested = nest(passes(spark, sf).withColumn("run", run), ["task_id"])
    return tasks(spark, sf).join(nested, "task_id")


@query(f"""{BOTH}, m AS (SELECT * FROM passes WHERE contains(lower(coalesce(model, '')), 'brand#1'))
SELECT m.task_id, string_agg(DISTINCT agent, ',' ORDER BY agent) AS agents, count(*) AS n_passes, CAST(sum(cost) AS DOUBLE) AS cost, max(duration) AS duration,
coalesce(string_agg(DISTINCT agent, ',' ORDER BY agent) FILTER (ok), '') AS succeeded
FROM (SELECT *, bool_or(completed) OVER (PARTITION BY task_id, agent) AS ok FROM m) m JOIN tasks USING (task_id) GROUP BY m.task_id""")
def w07_m06_extract_by_model(spark, sf):
    flat = flatten(with_matching_model(envelopes(spark, sf).select("task_id", "agent_results"), "brand#1"))
    flat = flat.select("task_id", "agent", "pass_idx", "run.completed", "run.error", "run.cost", "run.duration")
    r = runs.rollup(flat, last_error=True)
    return r.select("task_id", F.array_join("agents_attempted", ",").alias("agents"), "n_passes", F.col("total_cost").cast("double").alias("cost"), F.col("total_duration").alias("duration"), F.array_join("agents_succeeded", ",").alias("succeeded"))


@query(f"{BOTH} SELECT task_id, agent, count(*) AS n, CAST(max(pass_idx) AS INTEGER) AS last_idx FROM passes JOIN tasks USING (task_id) GROUP BY ALL")
def p06_flatten_nested(spark, sf):
    flat = flatten(envelopes(spark, sf))
    return flat.groupBy("task_id", "agent").agg(F.count("*").alias("n"), F.max("pass_idx").alias("last_idx"))


# rollups ---------------------------------------------------------------------

ROLLUP_SQL = """a AS (SELECT task_id, agent, bool_or({ok}) AS ok, {err} AS err, sum(cost) AS cost, max(duration) AS duration FROM passes GROUP BY task_id, agent)
SELECT task_id, string_agg(agent, ',' ORDER BY agent) AS attempted, coalesce(string_agg(agent, ',' ORDER BY agent) FILTER (ok), '') AS succeeded,
coalesce(string_agg(agent, ',' ORDER BY agent) FILTER (NOT ok), '') AS failed, coalesce(string_agg(agent || '=' || coalesce(err, ''), ';' ORDER BY agent) FILTER (NOT ok), '') AS errors,
CAST(sum(cost) AS DOUBLE) AS cost, max(duration) AS duration FROM a GROUP BY task_id"""
FIRST_SQL, LAST_SQL = ("arg_{}(error, pass_idx) FILTER (coalesce(error, '') <> '')".format(x) for x in ("min", "max"))


def rolled(r):
    errors = F.array_join(F.transform(F.array_sort(F.map_entries("agent_errors")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return r.select("task_id", F.array_join("agents_attempted", ",").alias("attempted"), F.array_join("agents_succeeded", ",").alias("succeeded"), F.array_join("agents_failed", ",").alias("failed"), errors.alias("errors"), F.col("total_cost").cast("double").alias("cost"), F.col("total_duration").alias("duration"))


@query(f"{BOTH}, {ROLLUP_SQL.format(ok=CLEAN_SQL, err=FIRST_SQL)}")
def a06_dispatch_rollup(spark, sf):
    return rolled(runs.rollup(passes(spark, sf), F.bool_or(predicates.is_clean_success())))


@query(f"{BOTH}, {ROLLUP_SQL.format(ok='coalesce(completed, false)', err=FIRST_SQL)}")
def a07_store_rollup(spark, sf):
    return rolled(runs.rollup(passes(spark, sf)))


@query(f"{BOTH}, {ROLLUP_SQL.format(ok='coalesce(completed, false)', err=LAST_SQL)}")
def a08_merge_rollup(spark, sf):
    return rolled(runs.rollup(passes(spark, sf), last_error=True))


@query(f"{BOTH} SELECT task_id, agent, count(*) AS passes_run, count(*) FILTER ({CLEAN_SQL}) AS passes_succeeded FROM passes GROUP BY ALL")
def a19_comparison(spark, sf):
    return runs.comparison(passes(spark, sf)).select("task_id", "agent", "passes_run", "passes_succeeded")


@query(f"""{BOTH}, {BEST_SQL}, s AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS task_id, agent, quality * 10 + toxic AS total_score FROM labels, (SELECT DISTINCT l_returnflag AS agent FROM lineitem) WHERE agent <> 'N')
SELECT b.task_id, b.agent, b.pass_idx AS best_pass_idx, b.response_length, s.total_score FROM best b LEFT JOIN s ON b.task_id = s.task_id AND b.agent = s.agent""")
def j02_comparison_scores(spark, sf):
    agents = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("task_id"), F.col("l_returnflag").alias("agent")).filter("agent <> 'N'").distinct()
    scores = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("task_id"), (F.col("quality") * 10 + F.col("toxic")).alias("total_score")).distinct().join(agents, "task_id")
    return runs.comparison(passes(spark, sf), scores).select("task_id", "agent", "best_pass_idx", "response_length", "total_score")


EXPORT_SQL = f"{BOTH}, x AS (SELECT p.*, research_type, dispatched_at, {STATUS_SQL} AS status, {EXPORT_CATEGORY_SQL} AS failure_category FROM passes p JOIN tasks t USING (task_id) WHERE NOT dry_run)"


def exported(spark, sf):
    t = tasks(spark, sf).filter(~F.col("dry_run")).select("task_id", "research_type", "dispatched_at", "domain", "iat_type")
    return passes(spark, sf).join(t, "task_id").withColumn("status", predicates.status()).withColumn("failure_category", labels.export_failure())


@query(f"""{EXPORT_SQL} SELECT task_id, agent, pass_idx, status, failure_category, CAST(cost AS DOUBLE) AS cost_usd, round(duration / 60, 2) AS duration_min,
coalesce(nullif(response_length, 0), length(response_text), 0) AS response_length_chars, dispatched_at FROM x""")
def p04_export_rows(spark, sf):
    return exported(spark, sf).select("task_id", "agent", "pass_idx", "status", "failure_category", F.col("cost").cast("double").alias("cost_usd"), F.round(F.col("duration") / 60, 2).alias("duration_min"), F.coalesce(F.nullif("response_length", F.lit(0)), F.length("response_text"), F.lit(0)).cast("long").alias("response_length_chars"), "dispatched_at")


@query(f"{EXPORT_SQL} SELECT count(*) AS n_rows, count(*) FILTER (status = 'PASS') AS n_pass, count(*) FILTER (status = 'FAIL') AS n_fail, round(100.0 * count(*) FILTER (status = 'PASS') / count(*), 1) AS pass_rate, CAST(sum(cost) AS DOUBLE) AS cost FROM x")
def a10_export_summary(spark, sf):
    return runs.export_summary(exported(spark, sf)).withColumn("pass_rate", F.col("pass_rate").cast("double")).withColumn("cost", F.col("cost").cast("double"))


@query(f"{EXPORT_SQL} SELECT coalesce(nullif(failure_category, ''), 'Unknown') AS category, count(*) AS n FROM x WHERE status = 'FAIL' GROUP BY ALL")
def a11_failure_breakdown(spark, sf):
    return runs.failure_breakdown(exported(spark, sf))


@query(f"{EXPORT_SQL} SELECT research_type, count(*) FILTER (status = 'PASS') AS n_pass, count(*) AS n, count(*) FILTER (status = 'PASS') / count(*) AS rate FROM x GROUP BY ALL")
def a12_rate_by_type(spark, sf):
    passed = F.count_if(F.col("status") == "PASS")
    return exported(spark, sf).groupBy("research_type").agg(passed.alias("n_pass"), F.count("*").alias("n"), (passed / F.count("*")).alias("rate"))


@query(f"{EXPORT_SQL} SELECT task_id, agent, pass_idx, dispatched_at FROM x WHERE status = 'PASS' ORDER BY dispatched_at, task_id, agent, pass_idx")
def o02_export_order(spark, sf):
    return exported(spark, sf).filter("status = 'PASS'").orderBy("dispatched_at", "task_id", "agent", "pass_idx").select("task_id", "agent", "pass_idx", "dispatched_at")


@query(f"{BOTH} SELECT agent, model, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens, CAST(sum(cost) AS DOUBLE) AS cost FROM passes GROUP BY ALL")
def a22_tokens(spark, sf):
    return passes(spark, sf).groupBy("agent", "model").agg(F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), money("cost").alias("cost"))


# store -----------------------------------------------------------------------

STORE_SQL = f"{BOTH}, st AS (SELECT t.*, t.task_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) AS scored, p.agents FROM tasks t LEFT JOIN (SELECT task_id, list(DISTINCT agent) AS agents FROM passes GROUP BY task_id) p USING (task_id))"


def stored(spark, sf):
    agents = passes(spark, sf).groupBy("task_id").agg(F.array_sort(F.collect_set("agent")).alias("agents_attempted"))
    scores = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("task_id"))
    return store.with_scored(tasks(spark, sf), scores).join(agents, "task_id", "left")


@query(f"{STORE_SQL} SELECT count(*) AS total, count(*) FILTER (scored) AS scored, count(*) FILTER (NOT scored) AS unscored, CAST(round(sum(total_cost), 2) AS DOUBLE) AS total_cost FROM st")
def a01_j01_store_stats(spark, sf):
    return store.stats(stored(spark, sf)).withColumn("total_cost", F.col("total_cost").cast("double"))


@query(f"""{STORE_SQL} SELECT 'research_type' AS dimension, coalesce(research_type, '') AS value, count(*) AS n FROM st GROUP BY ALL
UNION ALL SELECT 'iat_type', coalesce(iat_type, ''), count(*) FROM st GROUP BY ALL UNION ALL SELECT 'domain', coalesce(domain, ''), count(*) FROM st GROUP BY ALL""")
def a02_counts(spark, sf):
    return store.counts(tasks(spark, sf))


@query(f"{STORE_SQL} SELECT agent, count(*) AS n FROM (SELECT unnest(agents) AS agent FROM st) GROUP BY agent")
def a03_counts_by_agent(spark, sf):
    return store.counts_by_agent(stored(spark, sf))


@query(f"{STORE_SQL} SELECT task_id, dispatched_at, domain, scored FROM st WHERE research_type = '1-URGENT' AND iat_type = 'F' AND list_contains(agents, 'A') AND NOT scored")
def w05_query_results(spark, sf):
    return store.query_results(stored(spark, sf), research_type="1-URGENT", iat_type="F", agent="A", unscored_only=True).select("task_id", "dispatched_at", "domain", "scored")


@query(f"{STORE_SQL} SELECT task_id, dispatched_at FROM st WHERE scored")
def w05_scored_results(spark, sf):
    return store.query_results(stored(spark, sf), scored_only=True).select("task_id", "dispatched_at")


@query(f"{BOTH} SELECT task_id, dispatched_at FROM tasks ORDER BY coalesce(dispatched_at, '') DESC, task_id")
def o01_latest_results(spark, sf):
    return store.list_results(tasks(spark, sf)).select("task_id", "dispatched_at")


@query(f"{BOTH} SELECT domain, count(*) AS n FROM tasks GROUP BY ALL ORDER BY n DESC, domain LIMIT 10")
def o03_top_domains(spark, sf):
    return tasks(spark, sf).groupBy("domain").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "domain").limit(10)


# merges ----------------------------------------------------------------------


@query(f"""{BOTH}, src AS (SELECT task_id, source_ord, sum(cost) AS cost, max(duration) AS duration, min(error) AS note FROM passes GROUP BY ALL),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_id, agent, pass_idx ORDER BY coalesce(completed, false) DESC,
    CASE WHEN completed THEN coalesce(response_length, 0) ELSE CAST(coalesce(error, '') <> '' AS INTEGER) END DESC, source_ord) AS r
  FROM (SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY task_id, agent, source_ord ORDER BY pass_idx) - 1 AS INTEGER) AS pass_idx) FROM passes)) WHERE r = 1),
g AS (SELECT task_id, agent, bool_or(completed) AS ok, {LAST_SQL} AS err FROM w GROUP BY ALL)
SELECT s.task_id, count(*) AS n_sources, CAST(sum(s.cost) AS DOUBLE) AS cost, max(s.duration) AS duration,
  coalesce(arg_min(note, source_ord) FILTER (trim(coalesce(note, '')) <> ''), arg_max(coalesce(note, '~'), source_ord)) AS note, any_value(x.succeeded) AS succeeded, any_value(x.failed) AS failed, any_value(x.errors) AS errors
FROM src s JOIN (SELECT task_id, coalesce(string_agg(agent, ',' ORDER BY agent) FILTER (ok), '') AS succeeded, coalesce(string_agg(agent, ',' ORDER BY agent) FILTER (NOT ok), '') AS failed,
  coalesce(string_agg(agent || '=' || coalesce(err, ''), ';' ORDER BY agent) FILTER (NOT ok), '') AS errors FROM g GROUP BY task_id) x USING (task_id) GROUP BY s.task_id""")
def m03_merge_tasks(spark, sf):
    p = renumbered(spark, sf)
    none = F.lit(None).cast("string")
    sources = p.groupBy("task_id", "source_ord").agg(F.sum("cost").alias("total_cost"), F.max("duration").alias("total_duration"), F.min("error").alias("note")).withColumns({"dispatched_at": none, "completed_at": none})
    m = merge.merge_tasks(sources, p, ["note"])
    errors = F.array_join(F.transform(F.array_sort(F.map_entries("agent_errors")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return m.select("task_id", "n_sources", F.col("total_cost").cast("double").alias("cost"), F.col("total_duration").alias("duration"), F.coalesce("note", F.lit("~")).alias("note"), F.array_join("agents_succeeded", ",").alias("succeeded"), F.array_join("agents_failed", ",").alias("failed"), errors.alias("errors"))


@query(f"""{BOTH}, n AS (SELECT *, CAST(task_id AS BIGINT) % 3 = 0 AS again FROM tasks)
SELECT task_id, CAST(CASE WHEN again THEN total_cost * 2 ELSE total_cost END AS DOUBLE) AS cost, CASE WHEN again THEN least(dispatched_at, '1995-01-01') ELSE dispatched_at END AS dispatched_at,
CASE WHEN again AND iat_type = 'F' THEN 'new' ELSE domain END AS domain FROM n""")
def m01_u03_store_upsert(spark, sf):
    t = tasks(spark, sf).select("task_id", "total_cost", F.lit(1.0).alias("total_duration"), "dispatched_at", F.lit("").alias("completed_at"), "domain", "iat_type")
    new = t.filter(F.col("task_id").cast("long") % 3 == 0).withColumn("dispatched_at", F.lit("1995-01-01")).withColumn("domain", F.when(F.col("iat_type") == "F", "new"))
    out = merge.upsert_tasks(t.drop("iat_type"), new.drop("iat_type"), ["domain"])
    return out.select("task_id", F.col("total_cost").cast("double").alias("cost"), "dispatched_at", "domain")


@query(f"""{BOTH}, k AS (SELECT task_id, agent, source_ord, count(*) AS n FROM passes GROUP BY ALL)
SELECT task_id, agent, n, source_ord = 1 AS is_new FROM k QUALIFY row_number() OVER (PARTITION BY task_id, agent ORDER BY source_ord DESC) = 1""")
def m01_j12_upsert_agents(spark, sf):
    k = passes(spark, sf).groupBy("task_id", "agent", "source_ord").agg(F.count("*").alias("n"))
    old, new = (k.filter(F.col("source_ord") == i).drop("source_ord").withColumn("is_new", F.lit(bool(i))) for i in (0, 1))
    return merge.upsert(old, new)


# prices ----------------------------------------------------------------------


KEYS = (("Brand#1", 2.0), ("Brand#12", 5.0), ("Brand#2", 3.0), ("Brand#34-x", 7.0))
PRICE_SQL = """{both}, pr(ord, key, r) AS (VALUES (0, 'Brand#1', 2.0), (1, 'Brand#12', 5.0), (2, 'Brand#2', 3.0), (3, 'Brand#34-x', 7.0)),
mm AS (SELECT model, arg_min(key, ord) AS key, arg_min(r, ord) AS r FROM (SELECT DISTINCT model FROM passes) m LEFT JOIN pr ON {test} GROUP BY model)
SELECT p.model, coalesce(key, '') AS price_key, count(*) AS n, CAST(sum(CAST(round(CAST(input_tokens / 1e6 * coalesce(r, 1.0)::DOUBLE + output_tokens / 1e6 * coalesce(r * 4, 1.0)::DOUBLE AS DOUBLE), 6) AS DECIMAL(18,6))) AS DOUBLE) AS cost
FROM passes p LEFT JOIN mm ON p.model IS NOT DISTINCT FROM mm.model GROUP BY ALL"""


def priced(spark, sf, match):
    listed = spark.createDataFrame([(i, k, r, 4 * r) for i, (k, r) in enumerate(KEYS)], "ord int, key string, input_rate double, output_rate double")
    p = runs.priced(passes(spark, sf), listed, match, (1.0, 1.0))
    each = runs.cost(F.col("input_tokens"), F.col("output_tokens"), F.col("input_rate"), F.col("output_rate"))
    return p.groupBy("model", F.coalesce("price_key", F.lit("")).alias("price_key")).agg(F.count("*").alias("n"), money(each.cast("decimal(18,6)")).alias("cost"))


@query(PRICE_SQL.format(both=BOTH, test="m.model = pr.key"))
def j06_f23_exact_price(spark, sf):
    return priced(spark, sf, "exact")


@query(PRICE_SQL.format(both=BOTH, test="starts_with(m.model, pr.key)"))
def j07_prefix_price(spark, sf):
    return priced(spark, sf, "prefix")


@query(PRICE_SQL.format(both=BOTH, test="(starts_with(m.model, pr.key) OR starts_with(pr.key, m.model))"))
def j08_either_prefix_price(spark, sf):
    return priced(spark, sf, "either")


LIST_SQL = """pr AS (SELECT p_partkey AS ord, p_name AS key, p_retailprice AS r FROM part UNION ALL SELECT p_partkey, p_brand || ' ' || p_name, p_retailprice FROM part UNION ALL SELECT p_partkey + 5000000, p_type || ' ' || p_brand || ' long', p_retailprice FROM part),
k AS (SELECT key, min(ord) AS ord, arg_min(r, ord) AS r FROM pr GROUP BY 1), u AS (SELECT p_partkey, {model} AS model FROM part), m AS (SELECT DISTINCT model FROM u),
pre AS (SELECT model, substr(model, 1, CAST(unnest(range(0, length(model) + 1)) AS BIGINT)) AS prefix FROM m), kp AS (SELECT key, ord, r, substr(key, 1, CAST(unnest(range(0, length(key) + 1)) AS BIGINT)) AS prefix FROM k),
hit AS (SELECT model, key, ord, r FROM pre JOIN k ON prefix = key {back}), best AS (SELECT model, arg_min(key, ord) AS key, arg_min(r, ord) AS r FROM hit GROUP BY 1)
SELECT u.p_partkey, coalesce(key, '') AS price_key, coalesce(r, 0.0) AS input_rate FROM u LEFT JOIN best USING (model)"""
BACK_SQL = "UNION ALL SELECT m.model, key, ord, r FROM kp JOIN m ON prefix = m.model"


def long_list(spark, sf, model):
    """Models held against a price list with three keys for each part."""
    p = table(spark, sf, "part")
    keys = (("p_name", 0), (F.concat_ws(" ", "p_brand", "p_name"), 0), (F.concat_ws(" ", "p_type", "p_brand", F.lit("long")), 5_000_000))
    parts = [p.select((F.col("p_partkey") + later).alias("ord"), (F.col(k) if isinstance(k, str) else k).alias("key"), F.col("p_retailprice").alias("input_rate"), F.col("p_retailprice").alias("output_rate")) for k, later in keys]
    return p.select("p_partkey", model.alias("model")), parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("WITH " + LIST_SQL.format(model="p_brand || ' ' || p_name || ' dated ' || p_partkey % 7", back=""))
def j07_long_price_list(spark, sf):
    used, listed = long_list(spark, sf, F.concat(F.concat_ws(" ", "p_brand", "p_name"), F.lit(" dated "), (F.col("p_partkey") % 7).cast("string")))
    return runs.priced(used, listed, "prefix").select("p_partkey", F.coalesce("price_key", F.lit("")).alias("price_key"), "input_rate")


@query("WITH " + LIST_SQL.format(model="CASE WHEN p_partkey % 2 = 0 THEN p_type || ' ' || substr(p_brand, 1, 7) ELSE p_name || 'x' END", back=BACK_SQL))
def j08_long_price_list(spark, sf):
    used, listed = long_list(spark, sf, F.when(F.col("p_partkey") % 2 == 0, F.concat_ws(" ", "p_type", F.substring("p_brand", 1, 7))).otherwise(F.concat("p_name", F.lit("x"))))
    return runs.priced(used, listed, "either").select("p_partkey", F.coalesce("price_key", F.lit("")).alias("price_key"), "input_rate")


# report values ---------------------------------------------------------------


@query(f"""{BOTH} SELECT task_id, agent, pass_idx, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s // 60 % 60) || 'm ' || (s % 60) || 's  (' || f || ' s)' WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's  (' || f || ' s)' ELSE f || ' s' END AS duration_text,
format('{{:,}}', input_tokens) AS tokens_text, 'p' || (pass_idx + 1) AS pass_name FROM (SELECT *, CAST(duration * 130 AS BIGINT) AS s, format('{{:,.2f}}', duration * 130) AS f FROM passes)""")
def f33_f35_report_values(spark, sf):
    return passes(spark, sf).select("task_id", "agent", "pass_idx", text.duration_text(F.col("duration") * 130).alias("duration_text"), text.number_text("input_tokens").alias("tokens_text"), F.concat(F.lit("p"), F.col("pass_idx") + 1).alias("pass_name"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS slug, strftime(o_orderdate, '%Y-%m-%d  %H:%M:%S UTC') AS stamp, regexp_replace(o_orderpriority, '[^a-zA-Z0-9_\\-.]', '_', 'g') AS safe FROM orders""")
def f31_f32_f34_slugs(spark, sf):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "orders").select("o_orderkey", text.timestamp_slug(iso).alias("slug"), text.timestamp_text(iso).alias("stamp"), text.slug("o_orderpriority").alias("safe"))


@query("""WITH e AS (SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL) SELECT * FROM e""")
def stream_event_counts(spark, sf):
    from tallyforge.streaming.status import event_counts

    return event_counts(table(spark, sf, "events")).withColumn("total", F.round("total", 2))


# further projections, sets and sinks ------------------------------------------


@query(f"{STORE_SQL} SELECT CAST(sum(total_cost) AS DOUBLE) AS cost, CAST(sum(len(agents)) AS BIGINT) AS attempted, CAST(sum(n) AS BIGINT) AS runs FROM st JOIN (SELECT task_id, count(*) AS n FROM passes GROUP BY 1) USING (task_id)")
def a18_batch_totals(spark, sf):
    n = passes(spark, sf).groupBy("task_id").agg(F.count("*").alias("n"))
    return stored(spark, sf).join(n, "task_id").agg(money("total_cost").alias("cost"), F.sum(F.size("agents_attempted")).cast("long").alias("attempted"), F.sum("n").alias("runs"))


@query(f"""{BOTH}, m AS (SELECT *, contains(coalesce(model, ''), '#1') AS hit FROM passes)
SELECT source_ord, count(DISTINCT task_id) AS tasks_in, count(DISTINCT task_id) FILTER (hit) AS tasks_out, count(*) FILTER (hit) AS passes_out, count(*) FILTER (NOT hit) AS skipped FROM m GROUP BY source_ord""")
def a20_source_stats(spark, sf):
    hit = F.coalesce("model", F.lit("")).contains("#1")
    return passes(spark, sf).groupBy("source_ord").agg(F.countDistinct("task_id").alias("tasks_in"), F.countDistinct(F.when(hit, F.col("task_id"))).alias("tasks_out"), F.count_if(hit).alias("passes_out"), F.count_if(~hit).alias("skipped"))


@query(f"""{BOTH} SELECT task_id, any_value(dispatched_at) AS dispatched_at, string_agg(agent || ':' || n || ':' || done || ':' || longest, ';' ORDER BY agent) AS agent_summary
FROM (SELECT task_id, agent, count(*) AS n, count(*) FILTER (completed) AS done, coalesce(max(response_length), 0) AS longest FROM passes GROUP BY ALL) JOIN tasks USING (task_id) GROUP BY task_id""")
def p03_index_entries(spark, sf):
    parts = F.transform_values("agent_results", lambda _, r: F.concat_ws(":", F.size(r).cast("string"), F.size(F.filter(r, lambda p: F.coalesce(p["completed"], F.lit(False)))).cast("string"), F.coalesce(F.array_max(F.transform(r, lambda p: p["response_length"])), F.lit(0)).cast("string")))
    text_ = F.array_join(F.transform(F.array_sort(F.map_entries(parts)), lambda e: F.concat_ws(":", e["key"], e["value"])), ";")
    return envelopes(spark, sf).select("task_id", "dispatched_at", text_.alias("agent_summary"))


@query(f"""{BOTH}, a AS (SELECT DISTINCT task_id, agent FROM passes WHERE source_ord = 0), b AS (SELECT DISTINCT task_id, agent FROM passes WHERE source_ord = 1)
SELECT coalesce(a.task_id, b.task_id) AS task_id, string_agg(coalesce(a.agent, b.agent) || CASE WHEN b.agent IS NOT NULL THEN '=new' ELSE '=old' END, ',' ORDER BY coalesce(a.agent, b.agent)) AS agents
FROM a FULL JOIN b ON a.task_id = b.task_id AND a.agent = b.agent GROUP BY 1""")
def u02_map_union(spark, sf):
    """Maps of two sources by key; the right one wins."""

    def mapped(i, v):
        d = passes(spark, sf).filter(F.col("source_ord") == i).groupBy("task_id").agg(F.collect_set("agent").alias("a"))
        return d.select("task_id", F.map_from_arrays("a", F.transform("a", lambda _: F.lit(v))).alias(v))

    none = F.create_map().cast("map<string,string>")
    both = mapped(0, "old").join(mapped(1, "new"), "task_id", "full").select("task_id", F.map_zip_with(F.coalesce("old", none), F.coalesce("new", none), lambda _, x, y: F.coalesce(y, x)).alias("m"))
    return both.select("task_id", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("agents"))


@query("""SELECT p_brand AS brand, count(*) AS n, count(DISTINCT p_type) AS types FROM (SELECT p_brand, p_type, p_partkey FROM part UNION ALL SELECT p_brand, p_type, p_partkey FROM part WHERE p_size > 25) GROUP BY ALL""")
def u01_u07_concat_distinct(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_type", "p_partkey", "p_size")
    return p.unionByName(p.filter("p_size > 25")).groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("n"), F.countDistinct("p_type").alias("types"))


@query(f"""{BOTH} SELECT CAST(task_id AS BIGINT) // 3 AS prefix, CASE WHEN count(*) = 1 THEN '{{' ELSE '[' END AS opens, sum(length('{{"task_id":"","domain":""}}') + length(task_id) + length(domain))::BIGINT + CASE WHEN count(*) = 1 THEN 0 ELSE count(*) + 1 END AS size FROM tasks GROUP BY 1""")
def k06_grouped_json(spark, sf):
    from tallyforge.sources.sinks import grouped_json

    t = tasks(spark, sf).select(F.floor(F.col("task_id").cast("long") / 3).alias("prefix"), "task_id", "domain")
    return grouped_json(t).select("prefix", F.substring("body", 1, 1).alias("opens"), F.length("body").cast("long").alias("size"))


@query(f"""{BOTH} SELECT task_id, agent, CAST(pass_idx + 1 AS INTEGER) AS n, replace(task_id || '_' || agent || '_p' || (pass_idx + 1) || '_unknown_time.txt', ' ', '_') AS file_name,
length(response_text) > 0 AND NOT coalesce(forced_stop, false) AS has_text FROM passes JOIN tasks USING (task_id) WHERE completed AND forced_stop = false AND NOT dry_run""")
def k05_f37_reports(spark, sf):
    from tallyforge.sources.sinks import reports

    p = runs.qualifying(passes(spark, sf).join(tasks(spark, sf).select("task_id", "dispatched_at", "dry_run", F.col("total_cost").cast("double").alias("total_cost_usd")), "task_id"))
    none = lambda t: F.lit(None).cast(t)
    run = F.struct(
        "task_id", "model", "completed", "forced_stop", "error", none("string").alias("started_at"), none("string").alias("completed_at"), F.col("duration").alias("total_duration_sec"), "input_tokens", "output_tokens",
        F.col("cost").cast("double").alias("total_cost_usd"), F.lit(0).alias("citations_count"), "response_length", "response_text", none("array<struct<index:int,url:string,title:string,snippet:string>>").alias("citations"),
    )
    made = reports(p.withColumn("run", run).withColumn("completed_at", none("string")).withColumn("total_duration_sec", F.col("duration")))
    parts = F.split("file_name", "_")
    return made.select(parts[0].alias("task_id"), parts[1].alias("agent"), F.substring(parts[2], 2, 9).cast("int").alias("n"), "file_name", (F.contains("body", F.lit("RESPONSE")) & ~F.contains("body", F.lit("(no response text)"))).alias("has_text"))
