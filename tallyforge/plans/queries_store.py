"""Queries on a results store that is written from the given tables: upserts, a stream, lookups, counts, comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.plans.queries_files import AGENTS_SQL, RUN_SQL, listed, nested, runs
from tallyforge.plans.registry import query
from tallyforge.plans.views import table
from tallyforge.sources import sinks
from tallyforge.sources.clustered import slices, write_clustered
from tallyforge.sources.folders import scratch
from tallyforge.sources.result_store import ResultStore
from tallyforge.streaming.status import store_stream

# The second dispatch of a task brings its passes of source 1, under another domain where its type is F.
STORED_SQL = f"""{RUN_SQL},
d AS (SELECT *, CASE WHEN source_ord = 1 AND iat_type = 'F' THEN 'second' ELSE domain END AS dom FROM runs),
s AS (SELECT task_id, source_ord, sum(total_cost_usd::DECIMAL(18,2)) AS cost, max(total_duration_sec) AS duration, any_value(dom) AS dom, any_value(research_type) AS research_type, any_value(iat_type) AS iat_type, any_value(dispatched_at) AS day FROM d GROUP BY ALL),
t AS (SELECT task_id, CAST(sum(cost) AS DOUBLE) AS cost, max(duration) AS duration, arg_max(dom, source_ord) AS domain, any_value(research_type) AS research_type, any_value(iat_type) AS iat_type, any_value(day) AS day FROM s GROUP BY 1),
p AS (SELECT * FROM d QUALIFY source_ord = max(source_ord) OVER (PARTITION BY task_id, agent)),
a AS (SELECT task_id, agent, bool_or(coalesce(completed, false)) AS ok, arg_min(error, pass_idx) FILTER (coalesce(error, '') <> '') AS err, count(*) AS n FROM p GROUP BY ALL),
l AS (SELECT task_id, {AGENTS_SQL}, CAST(sum(n) AS BIGINT) AS n_passes FROM a GROUP BY 1)"""


def dispatches(spark, sf) -> list[DataFrame]:
    """Envelopes of the first and of the second dispatch, made in one pass and written by task."""
    r = runs(spark, sf).withColumn("domain", F.when((F.col("source_ord") == 1) & (F.col("iat_type") == "F"), "second").otherwise(F.col("domain")))
    made = spark.table(write_clustered(nested(r, ["task_id", "source_ord"]), scratch(spark), "task_id", slices(spark), "source_ord"))
    return [made.filter(F.col("source_ord") == i).drop("source_ord") for i in (0, 1)]


def stored(spark, sf) -> ResultStore:
    """A store that took both dispatches, and the second one twice under one batch number."""
    kept = ResultStore(spark, scratch(spark), 32)
    first, second = dispatches(spark, sf)
    kept.upsert(first, batch=("runs", 0))
    for _ in range(2):
        kept.upsert(second, batch=("runs", 1))
    return kept


def shown(tasks: DataFrame) -> DataFrame:
    return tasks.select("task_id", F.round("total_cost_usd", 2).alias("cost"), F.col("total_duration_sec").alias("duration"), "dispatched_at", "package.domain", F.size(F.flatten(F.map_values("agent_results"))).cast("long").alias("n_passes"), *listed(tasks))


SHOWN_SQL = "SELECT task_id, round(cost, 2) AS cost, duration, day AS dispatched_at, domain, n_passes, attempted, succeeded, failed, errors FROM t JOIN l USING (task_id)"


@query(f"WITH {STORED_SQL} {SHOWN_SQL}")
def k02_m01_store_upserts(spark, sf):
    return shown(stored(spark, sf).tasks())


@query(f"WITH {STORED_SQL} {SHOWN_SQL}")
def k02_stream_upserts(spark, sf):
    """The same dispatches as JSON lines in a folder, taken by a stream in several batches, of which the store is then offered the last one again."""
    kept, drop, progress = ResultStore(spark, scratch(spark), 32), scratch(spark), scratch(spark)
    parts = dispatches(spark, sf)
    for i, part in enumerate(parts):
        sinks.write_json(part, f"{drop}/{i}", compression="gzip", files=4)
        store_stream(spark, drop, kept, progress, lines=True, glob="*.txt.gz", per_trigger=3).awaitTermination()
    last = kept.manifest()["batches"]["intake"]
    kept.upsert(parts[1], batch=("intake", last))
    return shown(kept.tasks())


@query(f"""WITH {STORED_SQL} SELECT 'all' AS dimension, '' AS value, count(*) AS n, round(sum(cost), 2) AS cost FROM t
UNION ALL SELECT 'research_type', research_type, count(*), round(sum(cost), 2) FROM t GROUP BY 2 UNION ALL SELECT 'iat_type', iat_type, count(*), round(sum(cost), 2) FROM t GROUP BY 2
UNION ALL SELECT 'domain', domain, count(*), round(sum(cost), 2) FROM t GROUP BY 2 UNION ALL SELECT 'agent', agent, count(*), round(sum(cost), 2) FROM a JOIN t USING (task_id) GROUP BY 2""")
def a01_a03_store_counts(spark, sf):
    """Counts that the upserts kept, by bucket."""
    return stored(spark, sf).figures().select("dimension", "value", "n", F.round(F.col("cost").cast("double"), 2).alias("cost"))


def scored(spark, sf) -> ResultStore:
    """The store with scores of the tasks whose number a labelled document has; a second write changes a part of them."""
    kept = stored(spark, sf)
    s = table(spark, sf, "labels").filter("quality IS NOT NULL").groupBy(F.col("doc_id").cast("string").alias("task_id")).agg(F.max("quality").alias("q"))
    even = F.col("task_id").cast("long") % 2 == 0
    agent = lambda word: F.create_map(F.lit("A"), F.concat(F.lit(word), F.col("q").cast("string")), F.lit("R"), F.lit("r"))
    rows = s.select("task_id", F.lit("2024-01-01").alias("scored_at"), agent("first ").alias("agent_scores"), F.lit("A").alias("golden_response"))
    kept.add_scores(rows)
    kept.add_scores(s.filter(even).select("task_id", F.lit("2023-01-01").alias("scored_at"), agent("second ").alias("agent_scores"), F.lit("R").alias("golden_response")))
    return kept


SCORED_SQL = f"""{STORED_SQL}, sc AS (SELECT CAST(doc_id AS VARCHAR) AS task_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1)"""


@query(f"WITH {SCORED_SQL} SELECT count(*) AS total, count(q) AS scored, count(*) - count(q) AS unscored, round(sum(cost), 2) AS total_cost FROM t LEFT JOIN sc USING (task_id)")
def a01_scored_store_stats(spark, sf):
    return scored(spark, sf).stats()


@query(f"""WITH {STORED_SQL}, ids AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS task_id FROM orders WHERE o_custkey % 5 = 0) {SHOWN_SQL} JOIN ids USING (task_id)""")
def s07_w01_store_lookup(spark, sf):
    """Tasks of a long list of ids."""
    ids = table(spark, sf, "orders").filter("o_custkey % 5 = 0").select(F.col("o_orderkey").alias("id"))
    return shown(stored(spark, sf).lookup(ids, "id"))


@query(f"""WITH {SCORED_SQL}, best AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY task_id, agent ORDER BY coalesce(completed, false) AND coalesce(error, '') = '' DESC, coalesce(response_length, 0) DESC, pass_idx) = 1),
n AS (SELECT task_id, agent, count(*) AS passes_run, count(*) FILTER (completed AND coalesce(error, '') = '') AS passes_succeeded FROM p GROUP BY ALL)
SELECT b.task_id, t.research_type, t.iat_type, t.domain, b.agent, b.model, b.completed, b.error, b.response_length, b.citations_count, b.total_cost_usd, b.total_duration_sec, b.iterations, substr(b.response_text, 1, 500) AS response_preview,
CAST(passes_run AS INTEGER) AS passes_run, CAST(passes_succeeded AS INTEGER) AS passes_succeeded,
CASE WHEN q IS NOT NULL THEN CASE b.agent WHEN 'A' THEN CASE WHEN CAST(b.task_id AS BIGINT) % 2 = 0 THEN 'second ' ELSE 'first ' END || q WHEN 'R' THEN 'r' END END AS scores,
CASE WHEN q IS NOT NULL THEN CASE WHEN CAST(b.task_id AS BIGINT) % 2 = 0 THEN 'R' ELSE 'A' END END AS golden_response
FROM best b JOIN n USING (task_id, agent) JOIN t ON t.task_id = b.task_id LEFT JOIN sc ON sc.task_id = b.task_id""")
def j02_store_comparison(spark, sf):
    """Side by side: what a reader of the store gets of every task."""
    return scored(spark, sf).comparison().drop("prompt", "golden_justification")


@query(f"""WITH {STORED_SQL} SELECT task_id, research_type, iat_type, domain, 1 AS file_count, attempted, succeeded, failed, round(cost, 2) AS cost, duration, day AS dispatched_at, '' AS completed_at, 1 AS passes_per_agent, false AS dry_run,
(SELECT string_agg(agent || ':' || n, ',' ORDER BY agent) FROM a WHERE a.task_id = t.task_id) AS passes, false AS scored FROM t JOIN l USING (task_id)""")
def s06_p03_store_index(spark, sf):
    """The index of the store, from narrow columns."""
    i = stored(spark, sf).index()
    passes = F.array_join(F.transform(F.array_sort(F.map_entries("agent_summary")), lambda e: F.concat_ws(":", e["key"], F.size(e["value"]).cast("string"))), ",")
    lists = [F.array_join(f"agents_{n}", ",").alias(n) for n in ("attempted", "succeeded", "failed")]
    return i.select("task_id", "research_type", "iat_type", "domain", "file_count", *lists, F.round("total_cost_usd", 2).alias("cost"), F.col("total_duration_sec").alias("duration"), "dispatched_at", "completed_at", "passes_per_agent", "dry_run", passes.alias("passes"), "scored")
