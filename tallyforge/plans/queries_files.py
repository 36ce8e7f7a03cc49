"""Queries on files that are written from the given tables and read again, and on envelopes with all their fields."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import labels, predicates, text
from tallyforge.operators import corpus, merge, store
from tallyforge.plans.queries_intake import FORMATS_SQL, IAT_SQL, ID_SQL, LINK_SQL, WITH, rows
from tallyforge.plans.queries_runs import EXPORT_CATEGORY_SQL, STATUS_SQL
from tallyforge.plans.registry import query
from tallyforge.plans.views import FILES_SQL, PASSES_SQL, TASKS_SQL, files, intake, passes, table, tasks
from tallyforge.sources import corpus_files, envelopes, sinks
from tallyforge.sources import intake as source
from tallyforge.sources.folders import scratch
from tallyforge.sources.named_files import write_named

# intake files ----------------------------------------------------------------

HEADERS = {"Task ID": "raw_id", " Prompts ": "prompt", "Category": "research_type", "Full Name": "sme_name", "Vertical": "domain", "Solution": "solution_logic", "GDrive": "drive_url", "Sanity": "sanity_check", "Unknown": "raw_id"}


def intake_file(spark, sf):
    """The intake rows as CSV under other headers, with a blank row and one without a prompt, read again."""
    path = scratch(spark)
    out = intake(spark, sf).select(*[F.col(c).alias(h) for h, c in HEADERS.items()])
    blank = spark.range(2).select(*[F.when(F.col("id") == 1, F.lit("x" if h == "Vertical" else "")).otherwise("").alias(h) for h in HEADERS])
    out.unionByName(blank).write.option("header", True).option("escape", '"').csv(path)
    return source.read_intake(spark, path)


@query(rf"""{WITH} SELECT {ID_SQL} AS task_id, prompt, trim(research_type) AS research_type, sme_name, '' AS email, domain, solution_logic, drive_url, sanity_check FROM codes""")
def s01_s02_j05_intake_file(spark, sf):
    return intake_file(spark, sf).select("task_id", "prompt", "research_type", "sme_name", "email", "domain", "solution_logic", "drive_url", "sanity_check")


@query(rf"""{WITH} SELECT 'chosen' AS kind, {ID_SQL} AS value FROM codes WHERE trim(research_type) = 'LDP' AND regexp_extract(raw_id, '^(\d+)', 1)::BIGINT <= 500
UNION ALL SELECT 'first', least(100, count(*))::VARCHAR FROM codes""")
def w01_w02_o05_selected(spark, sf):
    found = intake_file(spark, sf)
    ids = [f"{k}{('', 'B', '_abc123')[k % 3]}" for k in range(1, 501)]
    chosen = source.select_rows(found, task_ids=ids, research_type="LDP").select(F.lit("chosen").alias("kind"), F.col("task_id").alias("value"))
    return chosen.unionByName(source.select_rows(found, max_rows=100).agg(F.count("*").cast("string").alias("value")).select(F.lit("first").alias("kind"), "value"))


@query(rf"{WITH} SELECT raw_id, 'sme_' || regexp_extract(sme_name, '(\d+)$', 1) || '_' || substr(sha256(sme_name || chr(1) || prompt), 1, 6) AS made FROM codes")
def f04_generated_ids(spark, sf):
    return intake(spark, sf).select("raw_id", text.generated_id("sme_name", "sme_name", "prompt").alias("made"))


@query(rf"""{WITH}, l AS (SELECT raw_id, drive_url, {LINK_SQL} AS l, length(prompt) % 3 AS n FROM codes) SELECT raw_id FROM l WHERE l IS NULL OR n > 0""")
def w16_tasks_with_files(spark, sf):
    found = F.array_repeat(F.lit("f.pdf"), F.length("prompt") % 3)
    return source.with_files(intake(spark, sf).withColumn("files", found)).select("raw_id")


@query(rf"""{WITH}, s AS (SELECT *, {ID_SQL} AS task_id, {IAT_SQL} AS iat, {FORMATS_SQL} AS formats FROM codes ORDER BY {ID_SQL} LIMIT 5)
SELECT task_id, sme_name, code AS research_type, iat AS iat_type, domain, substr(prompt, 1, 80) || '...' AS prompt, len(list_filter(string_split(solution_logic, chr(10)), lambda x: length(trim(x)) > 10))::INTEGER AS n_steps,
substr(sanity_check, 1, 60) || '...' AS sanity_check, substr(drive_url, 1, 60) || '...' AS drive_url, CASE WHEN formats = '' THEN 'none' ELSE replace(formats, ',', ', ') END AS output_formats FROM s""")
def o06_k10_preview(spark, sf):
    return source.preview(source.packages(rows(spark, sf)), 5)


@query(f"""{WITH}, c AS (SELECT sme_name AS value, count(*) AS n FROM codes GROUP BY 1) SELECT value, n, (SELECT greatest(count(*) - 10, 0) FROM c) AS more FROM c ORDER BY n DESC, value LIMIT 10""")
def o03_top_smes(spark, sf):
    return source.top_counts(intake(spark, sf), "sme_name")


@query(rf"""{WITH}, v AS (SELECT {ID_SQL} AS task_id, code, [lower(code), 'IAT-1', 'IAT-9', ''][length(prompt) % 4 + 1] AS iat FROM codes)
SELECT task_id, CASE WHEN iat NOT IN ('IAT-1', 'IAT-2', 'IAT-3', '') THEN 'iat_type ''' || iat || ''' invalid' ELSE '' END AS error FROM v""")
def w13_iat_errors(spark, sf):
    p = source.packages(rows(spark, sf)).withColumn("iat_type", F.element_at(F.array(F.lower("research_type"), F.lit("IAT-1"), F.lit("IAT-9"), F.lit("")), F.length("prompt") % 4 + 1))
    errors = F.filter(source.package_errors(prompt=F.lit("a prompt that is long enough")), lambda e: e.startswith("iat_type"))
    return p.select("task_id", F.array_join(errors, "; ").alias("error"))


# envelopes -------------------------------------------------------------------

RUN_SQL = f"""{TASKS_SQL}, {PASSES_SQL},
runs AS (SELECT p.task_id, agent, pass_idx, source_ord, model, completed, forced_stop, error, input_tokens, output_tokens, CAST(cost AS DOUBLE) AS total_cost_usd, duration AS total_duration_sec,
  CAST(pass_idx + 1 AS INTEGER) AS iterations, CAST(input_tokens % 3 AS INTEGER) AS citations_count, response_length, response_text, 'out/' || agent || '/' || pass_idx || '.docx' AS file,
  CASE WHEN input_tokens % 7 > 0 THEN dispatched_at || 'T00:00:0' || (pass_idx % 10) END AS started_at, CASE WHEN input_tokens % 5 > 0 THEN dispatched_at || 'T01:00:0' || (pass_idx % 10) END AS run_completed_at,
  t.dispatched_at, t.research_type, t.iat_type, t.domain FROM passes p JOIN tasks t USING (task_id))"""


def runs(spark, sf):
    """Passes with all that an envelope says of them."""
    t = tasks(spark, sf).select("task_id", "dispatched_at", "research_type", "iat_type", "domain")
    at = lambda hour: F.concat("dispatched_at", F.lit(f"T0{hour}:00:0"), (F.col("pass_idx") % 10).cast("string"))
    return passes(spark, sf, by_task=True).join(t, "task_id").withColumns(
        {
            "total_cost_usd": F.col("cost").cast("double"),
            "total_duration_sec": F.col("duration"),
            "iterations": F.col("pass_idx") + 1,
            "citations_count": (F.col("input_tokens") % 3).cast("int"),
            "file": F.concat(F.lit("out/"), "agent", F.lit("/"), F.col("pass_idx").cast("string"), F.lit(".docx")),
            "started_at": F.when(F.col("input_tokens") % 7 > 0, at(0)),
            "run_completed_at": F.when(F.col("input_tokens") % 5 > 0, at(1)),
        }
    )


RUN = (
    "task_id agent model completed forced_stop error input_tokens output_tokens total_cost_usd total_duration_sec iterations citations_count response_length response_text started_at"
).split()


def nested(r: DataFrame, keys: list[str]) -> DataFrame:
    """Envelopes of passes with their package and author."""
    cited = F.when(F.col("citations_count") > 0, F.array(F.struct(F.lit(1).alias("index"), F.lit("https://a.example/x").alias("url"), F.col("model").alias("title"), F.lit(None).cast("string").alias("snippet"))))
    run = F.struct(*RUN, F.col("run_completed_at").alias("completed_at"), cited.alias("citations"), F.array("file").alias("output_files"), F.lit(None).cast("string").alias("output_file_path"))
    about = {**{c: F.first for c in ("dispatched_at", "research_type", "iat_type", "domain")}, "cost": F.sum, "duration": F.max, "least_model": F.min}
    lists = envelopes.nest(r.withColumns({"run": run, "least_model": F.col("model")}), keys, also=about)
    package = F.struct("task_id", "research_type", "iat_type", "domain", F.lit(1).alias("file_count"), F.when(F.col("iat_type") == "F", F.array(F.lit("docx"), F.lit("xlsx"))).alias("output_formats"))
    author = F.struct(F.concat(F.lit("SME "), "domain").alias("sme_name"), F.concat(F.lit("p"), "task_id").alias("prompt_id"), F.lit(None).cast("string").alias("allocation_id"), F.lit("d").alias("drive_url"))
    extra = F.create_map(F.lit("note"), F.to_json(F.struct(F.col("least_model").alias("m")))).cast("map<string,string>")
    return lists.select(*keys, "dispatched_at", F.lit(None).cast("string").alias("completed_at"), F.col("cost").cast("double").alias("total_cost_usd"), F.col("duration").alias("total_duration_sec"), package.alias("package"), author.alias("sme_metadata"), extra.alias("extra"), "agent_results")


def task_envelopes(spark, sf):
    return nested(runs(spark, sf), ["task_id"])


def read_lines(spark, sf):
    """The envelopes as JSON lines, read again."""
    path = scratch(spark)
    sinks.write_json(task_envelopes(spark, sf), path, compression="gzip")
    return envelopes.read_envelopes(spark, path, lines=True, glob="*.txt.gz")


@query(f"WITH {RUN_SQL} SELECT task_id, dispatched_at, domain, CAST(sum(total_cost_usd::DECIMAL(18,2)) AS DOUBLE) AS cost, 'SME ' || domain AS sme, '{{\"m\":\"' || min(model) || '\"}}' AS note, count(*) AS n_passes, count(DISTINCT agent) AS n_agents FROM runs GROUP BY ALL")
def k01_p10_j03_lines(spark, sf):
    e = read_lines(spark, sf)
    n = F.size(F.flatten(F.map_values("agent_results"))).cast("long")
    return e.select("task_id", "dispatched_at", "package.domain", F.col("total_cost_usd").alias("cost"), F.col("sme_metadata.sme_name").alias("sme"), F.col("extra")["note"].alias("note"), n.alias("n_passes"), F.size("agent_results").cast("long").alias("n_agents"))


@query(f"""WITH {RUN_SQL}, g AS (SELECT *, CAST(task_id AS BIGINT) % 2 AS src, CAST(task_id AS BIGINT) // 6 AS grp FROM runs), z AS (SELECT src, grp, count(DISTINCT task_id) AS k FROM g GROUP BY ALL)
SELECT CASE src WHEN 0 THEN 0 ELSE 2 END AS source_ord, agent, k > 1 AS in_array, count(*) AS n, CAST(sum(input_tokens) AS BIGINT) AS tokens, count(DISTINCT task_id) AS n_tasks FROM g JOIN z USING (src, grp) GROUP BY ALL""")
def s03_s06_envelope_files(spark, sf):
    """Files of an object or an array each, in two folders, with a third that does not exist between."""
    path, number = scratch(spark), F.col("task_id").cast("long")
    e = task_envelopes(spark, sf).select("task_id", "dispatched_at", "agent_results").withColumn("prefix", F.concat_ws("-", (number % 2).cast("string"), F.floor(number / 6).cast("string")))
    # a row is a file's text; files of many groups are lines of one
    sinks.grouped_json(e).select(F.split_part("prefix", F.lit("-"), F.lit(1)).alias("source"), "body").write.partitionBy("source").text(path, compression="gzip")
    found = envelopes.read_envelopes(spark, [f"{path}/source=0", f"{path}/none", f"{path}/source=1"], lines=True, glob="*.txt.gz")
    flat = envelopes.flatten(found)
    return flat.groupBy("source_ord", "agent", "in_array").agg(F.count("*").alias("n"), F.sum("run.input_tokens").alias("tokens"), F.countDistinct("task_id").alias("n_tasks"))


@query(f"WITH {RUN_SQL} SELECT task_id, agent, pass_idx, model, response_length FROM runs WHERE task_id = (SELECT max(task_id) FROM runs)")
def s07_get_result(spark, sf):
    wanted = runs(spark, sf).agg(F.max("task_id")).first()[0] or ""
    return envelopes.flatten(envelopes.get_result(read_lines(spark, sf), wanted)).select("task_id", "agent", "pass_idx", "run.model", "run.response_length")


@query(f"""WITH {RUN_SQL} SELECT task_id, 'SME ' || domain AS sme_name, domain, research_type, iat_type, 1 AS file_count, CASE WHEN iat_type = 'F' THEN 'docx; xlsx' ELSE 'none' END AS output_formats, agent, model, {STATUS_SQL} AS status,
nullif({EXPORT_CATEGORY_SQL}, '') AS failure_category, input_tokens, output_tokens, total_cost_usd AS cost_usd, round(total_duration_sec / 60, 2) AS duration_min, coalesce(nullif(response_length, 0), length(response_text), 0) AS response_length_chars,
citations_count, iterations, dispatched_at, run_completed_at AS completed_at, 'p' || task_id AS prompt_id, NULL::VARCHAR AS allocation_id, 'd' AS drive_url, file AS output_files, CASE WHEN citations_count > 0 THEN 'title=' || model || ', url=https://a.example/x' END AS citations,
response_text FROM runs""")
def p04_k04_export_csv(spark, sf):
    """All columns of the consolidated CSV, written and read again."""
    path = scratch(spark)
    made = sinks.write_csv(sinks.export_rows(read_lines(spark, sf)), path, compression="gzip")
    kinds = {f.name: f.dataType.simpleString() for f in made.schema.fields}
    read = spark.read.option("header", True).option("escape", '"').csv(path)
    return read.select(*[F.col(c).cast({"int": "bigint"}.get(kinds[c], kinds[c]) if c not in ("file_count", "citations_count", "iterations") else "int").alias(c) for c in sinks.CSV_COLUMNS])


LISTS = {"attempted": "agents_attempted", "succeeded": "agents_succeeded", "failed": "agents_failed"}


def listed(e: DataFrame) -> list:
    errors = F.array_join(F.transform(F.array_sort(F.map_entries("agent_errors")), lambda x: F.concat_ws("=", x["key"], x["value"])), ";")
    return [*[F.array_join(c, ",").alias(n) for n, c in LISTS.items()], errors.alias("errors")]


AGENTS_SQL = """string_agg(agent, ',' ORDER BY agent) AS attempted, coalesce(string_agg(agent, ',' ORDER BY agent) FILTER (ok), '') AS succeeded, coalesce(string_agg(agent, ',' ORDER BY agent) FILTER (NOT ok), '') AS failed,
  coalesce(string_agg(agent || '=' || err, ';' ORDER BY agent) FILTER (NOT ok AND err IS NOT NULL), '') AS errors"""


@query(f"""WITH {RUN_SQL}, m AS (SELECT * FROM runs WHERE contains(lower(model), 'brand#1')),
a AS (SELECT task_id, agent, bool_or(coalesce(completed, false)) AS ok, arg_max(error, pass_idx) FILTER (coalesce(error, '') <> '') AS err FROM m GROUP BY ALL), l AS (SELECT task_id, {AGENTS_SQL} FROM a GROUP BY 1)
SELECT m.task_id, CAST(sum(total_cost_usd::DECIMAL(18,2)) AS DOUBLE) AS cost, max(total_duration_sec) AS duration, coalesce(min(started_at), any_value(dispatched_at)) AS dispatched_at, max(run_completed_at) AS completed_at,
any_value(attempted) AS attempted, any_value(succeeded) AS succeeded, any_value(failed) AS failed, any_value(errors) AS errors, any_value('SME ' || domain) AS sme FROM m JOIN l USING (task_id) GROUP BY m.task_id""")
def m06_a09_extract_model(spark, sf):
    e = envelopes.extract_model(task_envelopes(spark, sf), "brand#1")
    return e.select("task_id", F.col("total_cost_usd").alias("cost"), F.col("total_duration_sec").alias("duration"), "dispatched_at", "completed_at", *listed(e), F.col("sme_metadata.sme_name").alias("sme"))


@query(f"""WITH {RUN_SQL}, m AS (SELECT 'exact' AS mode, * FROM runs WHERE model = 'Brand#23' UNION ALL SELECT 'contains', * FROM runs WHERE contains(lower(model), 'brand#3') UNION ALL SELECT 'regex', * FROM runs WHERE regexp_matches(model, '(?i)#1[25]$'))
SELECT mode, count(DISTINCT task_id) AS n_tasks, count(*) AS n_passes, CAST(sum(input_tokens) AS BIGINT) AS tokens FROM m GROUP BY mode""")
def w06_match_modes(spark, sf):
    e = task_envelopes(spark, sf).select("task_id", "agent_results")
    parts = [envelopes.flatten(envelopes.with_matching_model(e, p, m)).select(F.lit(m).alias("mode"), "task_id", "run.input_tokens") for m, p in (("exact", "Brand#23"), ("contains", "BRAND#3"), ("regex", "#1[25]$"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("mode").agg(F.countDistinct("task_id").alias("n_tasks"), F.count("*").alias("n_passes"), F.sum("input_tokens").alias("tokens"))


@query(f"""WITH {RUN_SQL}, r AS (SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY task_id, agent, source_ord ORDER BY pass_idx) - 1 AS INTEGER) AS pass_idx) FROM runs),
s AS (SELECT task_id, source_ord, sum(total_cost_usd::DECIMAL(18,2)) AS cost, max(total_duration_sec) AS duration, min(model) AS note FROM r GROUP BY ALL),
k AS (SELECT task_id, count(*) AS n_sources, CAST(sum(cost) AS DOUBLE) AS cost, max(duration) AS duration, arg_min(note, source_ord) AS note FROM s GROUP BY 1),
w AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY task_id, agent, pass_idx ORDER BY coalesce(completed, false) DESC, CASE WHEN completed THEN coalesce(response_length, 0) ELSE CAST(coalesce(error, '') <> '' AS INTEGER) END DESC, source_ord) = 1),
a AS (SELECT task_id, agent, bool_or(coalesce(completed, false)) AS ok, arg_max(error, pass_idx) FILTER (coalesce(error, '') <> '') AS err FROM w GROUP BY ALL), l AS (SELECT task_id, {AGENTS_SQL} FROM a GROUP BY 1),
d AS (SELECT task_id, any_value(dispatched_at) AS day, any_value(domain) AS domain, count(*) AS n_passes FROM w GROUP BY 1)
SELECT k.task_id, n_sources, cost, duration, CASE WHEN n_sources = 1 THEN day ELSE day || 'T00:00:00' END AS dispatched_at, domain, '{{"m":"' || note || '"}}' AS note, n_passes,
CASE WHEN n_sources = 1 THEN 'as it was' ELSE attempted END AS attempted, CASE WHEN n_sources = 1 THEN '' ELSE succeeded END AS succeeded, CASE WHEN n_sources = 1 THEN '' ELSE failed END AS failed, CASE WHEN n_sources = 1 THEN '' ELSE errors END AS errors
FROM k JOIN l USING (task_id) JOIN d USING (task_id)""")
def m04_u05_merge_envelopes(spark, sf):
    """Envelopes of two sources as one; those of one source keep even what their passes do not bear out."""
    order = Window.partitionBy("task_id", "agent", "source_ord").orderBy("pass_idx")
    e = nested(runs(spark, sf).withColumn("pass_idx", F.row_number().over(order) - 1), ["task_id", "source_ord"])
    none = F.array().cast("array<string>")
    e = e.withColumns({"agents_attempted": F.array(F.lit("as it was")), "agents_succeeded": none, "agents_failed": none, "agent_errors": F.create_map().cast("map<string,string>"), "file_name": F.lit("f"), "config": F.struct(F.lit(" ").alias("mcp_server_url"))})
    m = merge.merge_envelopes(e)
    return m.select("task_id", "n_sources", F.round("total_cost_usd", 2).alias("cost"), F.col("total_duration_sec").alias("duration"), "dispatched_at", "package.domain", F.col("extra")["note"].alias("note"), F.size(F.flatten(F.map_values("agent_results"))).cast("long").alias("n_passes"), *listed(m))


@query(f"""WITH {TASKS_SQL}, f AS (SELECT 'f' || (CAST(task_id AS BIGINT) // 3) || '.json' AS file_name, CAST(task_id AS BIGINT) // 3 % 2 = 0 AS was_array, task_id, '{{"task_id":"' || task_id || '","dispatched_at":"' || dispatched_at || '","note":{{"d":"' || domain || '"}}}}' AS body FROM tasks WHERE iat_type = 'F')
SELECT file_name, CASE WHEN count(*) = 1 AND NOT bool_or(was_array) THEN any_value(body) ELSE '[' || string_agg(body, ',' ORDER BY task_id) || ']' END AS value FROM f GROUP BY file_name
UNION ALL SELECT DISTINCT 'f' || (CAST(task_id AS BIGINT) // 3) || '.json', '[]' FROM tasks WHERE 'f' || (CAST(task_id AS BIGINT) // 3) || '.json' NOT IN (SELECT file_name FROM f)""")
def k07_k08_extracted_files(spark, sf):
    group = F.floor(F.col("task_id").cast("long") / 3)
    t = tasks(spark, sf).withColumn("file_name", F.concat(F.lit("f"), group.cast("string"), F.lit(".json"))).withColumn("in_array", group % 2 == 0)
    found = t.filter("iat_type = 'F'").select("file_name", "in_array", "task_id", "dispatched_at", F.create_map(F.lit("note"), F.to_json(F.struct(F.col("domain").alias("d")))).alias("extra"))
    return sinks.write_extracted(found, "", inputs=t, dry_run=True)


@query(f"""WITH {TASKS_SQL} SELECT CAST(task_id AS BIGINT) // 3 AS prefix, CASE WHEN count(*) = 1 THEN any_value('{{"task_id":"' || task_id || '","domain":"' || domain || '"}}') ELSE '[' || string_agg('{{"task_id":"' || task_id || '","domain":"' || domain || '"}}', ',' ORDER BY task_id) || ']' END AS body FROM tasks GROUP BY 1""")
def k06_m05_grouped_bodies(spark, sf):
    return sinks.grouped_json(tasks(spark, sf).select(F.floor(F.col("task_id").cast("long") / 3).alias("prefix"), "task_id", "domain"))


@query(f"""WITH {RUN_SQL} SELECT task_id, agent, pass_idx, CAST(task_id AS BIGINT) % 4 AS file_count, CASE CAST(task_id AS BIGINT) % 4 WHEN 0 THEN '' WHEN 1 THEN 'a1.pdf' WHEN 2 THEN 'a1.pdf,a2.pdf' ELSE 'a1.pdf,a2.pdf,a3.pdf' END AS file_names,
citations_count, pass_idx AS tool_calls_count, length(response_text) AS response_length, 0 AS n_output_files FROM runs""")
def p05_serialized(spark, sf):
    r = runs(spark, sf)
    strings = lambda n, v: F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), v)
    run = F.struct("task_id", "agent", "response_text", strings(F.col("citations_count"), lambda i: F.struct(i.alias("index"))).alias("citations"), strings(F.col("pass_idx").cast("int"), lambda i: i).alias("tool_call_log"), F.lit(None).cast("array<string>").alias("output_files"), F.lit(None).cast("map<string,string>").alias("output_file_errors"))
    e = envelopes.nest(r.withColumn("run", run), ["task_id"])
    paths = strings((F.col("task_id").cast("long") % 4).cast("int"), lambda i: F.concat(F.lit("in/x/a"), (i + 1).cast("string"), F.lit(".pdf")))
    flat = envelopes.flatten(envelopes.serialized(e.withColumn("package", F.struct("task_id", paths.alias("file_paths")))))
    return flat.select("task_id", "agent", "pass_idx", F.col("package.file_count").cast("long").alias("file_count"), F.array_join("package.file_names", ",").alias("file_names"), "run.citations_count", "run.tool_calls_count", F.col("run.response_length").cast("long").alias("response_length"), F.size("run.output_files").alias("n_output_files"))


@query(f"""WITH {RUN_SQL} SELECT task_id, agent, pass_idx, concat_ws('; ', CASE WHEN agent = 'N' THEN 'agent mismatch: N != A' END, CASE WHEN started_at IS NULL THEN 'started_at is empty' END, CASE WHEN run_completed_at IS NULL THEN 'completed_at is empty' END,
CASE WHEN NOT completed THEN 'completed=False (error: ' || coalesce(error, '') || ')' END, CASE WHEN iat_type = 'F' AND NOT contains(lower(response_text), 'closed') AND NOT contains(lower(response_text), 'iat') THEN 'Closed task report doesn''t mention IAT/Closed status' END) AS errors FROM runs""")
def w18_result_errors(spark, sf):
    run = F.struct("task_id", "agent", "model", "response_text", "started_at", F.col("run_completed_at").alias("completed_at"), "completed", "error")
    wanted = F.when(F.col("agent") == "N", "A").otherwise(F.col("agent"))
    return runs(spark, sf).withColumn("run", run).select("task_id", "agent", "pass_idx", F.array_join(predicates.result_errors("task_id", wanted, F.col("iat_type") == "F"), "; ").alias("errors"))


@query(f"""WITH {RUN_SQL}, w AS (SELECT task_id, 'SME ' || domain AS sme_name, 'x@' || domain AS email FROM (SELECT DISTINCT task_id, domain FROM runs) WHERE CAST(task_id AS BIGINT) % 3 > 0)
SELECT DISTINCT r.task_id, w.sme_name, w.email FROM runs r LEFT JOIN w USING (task_id)""")
def j03_authors(spark, sf):
    t = tasks(spark, sf)
    blank = {f: F.lit("") for f in ("prompt_id", "allocation_id", "created_at", "drive_url", "estimated_time")}
    intake_rows = t.filter(F.col("task_id").cast("long") % 3 > 0).select("task_id", F.concat(F.lit("SME "), "domain").alias("sme_name"), F.concat(F.lit("x@"), "domain").alias("email"), "domain").withColumns(blank)
    known = runs(spark, sf).select("task_id").distinct()
    return envelopes.with_author(known, intake_rows).select("task_id", "sme_metadata.sme_name", "sme_metadata.email")


@query("""WITH s AS (SELECT CAST(doc_id AS VARCHAR) AS task_id, quality::DOUBLE AS total, '2024-01-0' || (1 + doc_id % 9) AS scored_at FROM labels), n AS (SELECT task_id, total + 10 AS total, '2020-01-01' AS scored_at FROM s WHERE CAST(task_id AS BIGINT) % 2 = 0)
SELECT * FROM n UNION ALL SELECT * FROM s WHERE task_id NOT IN (SELECT task_id FROM n)""")
def k03_scores(spark, sf):
    s = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("task_id"), F.col("quality").cast("double").alias("total"), F.concat(F.lit("2024-01-0"), (F.col("doc_id") % 9 + 1).cast("string")).alias("scored_at"))
    new = s.filter(F.col("task_id").cast("long") % 2 == 0).withColumns({"total": F.col("total") + 10, "scored_at": F.lit("2020-01-01")})
    return store.append_scores(s, new)


# corpus files ----------------------------------------------------------------


@query("""WITH f AS (SELECT doc_id // 500 AS folder, string_agg(line, chr(10) ORDER BY line) AS body FROM (SELECT doc_id, doc_id || ' ' || lang AS line FROM documents WHERE lang IS NOT NULL) GROUP BY 1) SELECT folder, sha256(body) AS digest, '.txt' AS extension, true AS extractable FROM f""")
def s08_s09_corpus_files(spark, sf):
    """Text files in folders, read again with a path that does not exist beside them; lines in any order."""
    path = scratch(spark)
    line = F.concat_ws(" ", F.col("doc_id").cast("string"), "lang")
    table(spark, sf, "documents").filter("lang IS NOT NULL").select(F.floor(F.col("doc_id") / 500).alias("folder"), line.alias("line")).repartition("folder").write.partitionBy("folder").text(path)
    found = corpus_files.read_corpus(spark, [f"{path}/folder=*", f"{path}/none"])
    lines = F.array_sort(F.filter(F.split("text_content", "\n"), lambda x: x != ""))
    return found.select(F.regexp_extract("path", r"folder=(\d+)", 1).cast("long").alias("folder"), F.sha2(F.array_join(lines, "\n"), 256).alias("digest"), "extension", "extractable")


def office_bytes(kind: str, lines: str) -> bytes:
    """A small office file of the lines of tabbed cells."""
    from xml.sax.saxutils import escape

    table_ = [[escape(c) for c in line.split("\t")] for line in lines.split("\n")]
    cell = lambda c: f"<c t='inlineStr'><is><t>{c}</t></is></c>"
    p = lambda c: f"<p><t>{c}</t></p>"
    rows_ = lambda tag: "".join("<tr>" + "".join(f"<tc>{p(c)}</tc>" for c in r) + "</tr>" for r in table_)
    parts = {
        ".xlsx": {"xl/workbook.xml": "<w><sheet name='S'/></w>", "xl/worksheets/sheet1.xml": "<w><row>" + cell("title") + "</row>" + "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in table_) + "</w>"},
        ".docx": {"word/document.xml": f"<d><body>{p('Before')}<tbl>{rows_('tr')}</tbl>{p('After')}</body></d>"},
        ".pptx": {"ppt/slides/slide1.xml": f"<s><sp><txBody>{p('Head')}</txBody></sp><tbl>{rows_('tr')}</tbl></s>", "ppt/notesSlides/notesSlide1.xml": f"<n>{p('Say it')}</n>"},
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts[kind].items():
            z.writestr(name, body)
    return out.getvalue()


def office_udf():
    @F.pandas_udf("binary")
    def make(kind: pd.Series, lines: pd.Series) -> pd.Series:
        return pd.Series([office_bytes(k, x) for k, x in zip(kind, lines)])

    return make


KINDS = (".xlsx", ".docx", ".pptx", ".csv", ".md", ".png")
CHATS_SQL = """c AS (SELECT conv_id, '.' || ['xlsx', 'docx', 'pptx', 'csv', 'md', 'png'][conv_id % 6 + 1] AS ext, string_agg(turn || chr(9) || role, chr(10) ORDER BY turn, role) AS lines, string_agg(turn || ',"' || role || ' | x"', chr(10) ORDER BY turn, role) AS csv,
  string_agg('| ' || turn || ' | ' || role || ' |', chr(10) ORDER BY turn, role) AS piped, string_agg('| ' || turn || ' | ' || role || ' \\| x |', chr(10) ORDER BY turn, role) AS csv_piped, count(*) AS n FROM conversations GROUP BY conv_id)"""


def chat_files(spark, sf):
    """Each conversation's turns as a file of some kind: path and content."""
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("m"))
    joined = lambda f: F.array_join(F.transform("m", f), "\n")
    lines = joined(lambda x: F.concat_ws("\t", x["turn"].cast("string"), x["role"]))
    quoted = F.concat(F.lit("kind,text,none\n"), joined(lambda x: F.concat(x["turn"].cast("string"), F.lit(',"'), x["role"], F.lit(' | x"'))))
    ext = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("conv_id") % len(KINDS) + 1).cast("int"))
    c = c.select(F.concat(F.lit("in/c"), F.col("conv_id").cast("string"), ext).alias("path"), ext.alias("ext"), lines.alias("lines"), quoted.alias("quoted"))
    office = c.filter(F.col("ext").isin(".xlsx", ".docx", ".pptx")).select("path", office_udf()("ext", "lines").alias("content"))
    other = c.filter(~F.col("ext").isin(".xlsx", ".docx", ".pptx")).select("path", F.when(F.col("ext") == ".csv", F.col("quoted")).otherwise(F.col("lines")).cast("binary").alias("content"))
    return office.unionByName(other).withColumn("length", F.octet_length("content").cast("long"))


@query(rf"""WITH {CHATS_SQL}, r AS (SELECT *, '| --- | --- |' || chr(10) AS rule, 'c' || conv_id || ext AS f FROM c),
b AS (SELECT f, ext, CASE ext WHEN '.xlsx' THEN 'Excel' WHEN '.docx' THEN 'Word' WHEN '.pptx' THEN 'PowerPoint, 1 slides' WHEN '.csv' THEN 'CSV (' || n || ' data rows)' ELSE 'Markdown' END AS kind,
  CASE ext WHEN '.xlsx' THEN '### Sheet: S' || chr(10) || '| title |  |' || chr(10) || rule || piped || chr(10) || '(' || n || ' data rows)'
    WHEN '.docx' THEN 'Before' || chr(10) || chr(10) || CASE WHEN n > 1 THEN regexp_replace(piped, chr(10), chr(10) || rule) ELSE piped END || chr(10) || chr(10) || 'After'
    WHEN '.pptx' THEN '### Slide 1' || chr(10) || 'Head' || chr(10) || CASE WHEN n > 1 THEN regexp_replace(piped, chr(10), chr(10) || rule) ELSE piped END || chr(10) || '[Speaker notes: Say it]'
    WHEN '.csv' THEN '| kind | text | none |' || chr(10) || '| --- | --- | --- |' || chr(10) || replace(csv_piped, ' x |', ' x |  |')
    ELSE lines END AS body, lines FROM r)
SELECT f AS filename, ext AS extension, CASE ext WHEN '.png' THEN 'image' ELSE 'text' END AS type, CASE ext WHEN '.png' THEN 'image/png' WHEN '.csv' THEN 'text/csv' WHEN '.md' THEN 'text/markdown' ELSE 'office' END AS media_type,
CASE ext WHEN '.png' THEN to_base64(encode(lines)) ELSE chr(10) || '--- Document: ' || f || ' (' || kind || ') ---' || chr(10) || body || chr(10) || '--- End: ' || f || ' ---' || chr(10) END AS body FROM b""")
def s13_s14_s15_content_blocks(spark, sf):
    b = corpus_files.content_blocks(chat_files(spark, sf))
    return b.withColumn("media_type", F.when(F.col("extension").isin(*corpus_files.OFFICE), "office").otherwise(F.col("media_type"))).withColumn("body", F.replace("body", F.lit("\r\n"), F.lit("")))


@query(rf"""WITH {CHATS_SQL}, o AS (SELECT 'c' || conv_id || ext AS filename, ext, lines, n FROM c WHERE ext IN ('.xlsx', '.docx', '.pptx'))
SELECT filename, CASE ext WHEN '.xlsx' THEN '=== Sheet: S ===' || chr(10) || 'title' || chr(10) || lines || chr(10) || '[' || (n + 1) || ' rows]' WHEN '.docx' THEN 'Before' || chr(10) || chr(10) || replace(replace(lines, chr(9), chr(10) || chr(10)), chr(10), chr(10)) ELSE '' END AS plain,
CASE ext WHEN '.xlsx' THEN '=== Sheet: S (' || n || ' rows, use header=1 when reading with pandas) ===' || chr(10) || lines WHEN '.docx' THEN 'Before' || chr(10) || 'After' || chr(10) || lines ELSE '=== Slide 1 ===' || chr(10) || 'Head' END AS labelled FROM o WHERE ext = '.xlsx'
UNION ALL SELECT filename, '', CASE ext WHEN '.docx' THEN 'Before' || chr(10) || 'After' || chr(10) || lines ELSE '=== Slide 1 ===' || chr(10) || 'Head' END FROM o WHERE ext <> '.xlsx'""")
def s10_s12_office_texts(spark, sf):
    f = chat_files(spark, sf).filter(F.rlike("path", F.lit(r"\.(xlsx|docx|pptx)$")))
    labelled = f.select(F.element_at(F.split("path", "/"), -1).alias("filename"), corpus_files.labelled_udf()("content", labels.extension("path")).alias("labelled"))
    plain = corpus_files.corpus(f).select("filename", F.when(F.col("extension") == ".xlsx", F.col("text_content")).otherwise("").alias("plain"))
    return plain.join(labelled, "filename")


@query(rf"""WITH {CHATS_SQL}, t AS (SELECT 'c' || conv_id || ext AS filename, '=== Sheet: S ===' || chr(10) || 'title' || chr(10) || array_to_string(list_slice(string_split(lines, chr(10)), 1, 2), chr(10)) || chr(10) || '[' || least(n + 1, 3) || ' rows]' AS body FROM c WHERE ext = '.xlsx')
SELECT filename, CASE WHEN length(body) > 40 THEN substr(body, 1, 40) || '[cut]' ELSE body END AS body FROM t""")
def s11_capped_texts(spark, sf):
    """At most so many rows of a sheet, and so many characters with a marker."""
    f = chat_files(spark, sf).filter(F.col("path").endswith(".xlsx"))
    return corpus_files.corpus(f, max_rows=3).select("filename", text.cut_prefix("text_content", 40, "[cut]").alias("body"))


@query(f"WITH {FILES_SQL} SELECT extension, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes FROM files GROUP BY 1")
def a17_corpus_types(spark, sf):
    return corpus.corpus_types(files(spark, sf))


@query("SELECT source AS folder, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents WHERE n_chars IS NOT NULL GROUP BY 1")
def a23_folder_sizes(spark, sf):
    return corpus.folder_sizes(files(spark, sf).withColumnRenamed("source", "folder"), "folder")


@query("SELECT conv_id, count(*) AS n_files, array_to_string(list_slice(list(CAST(turn AS VARCHAR) ORDER BY turn), 1, 3), ',') AS kept FROM (SELECT DISTINCT conv_id, turn FROM conversations) GROUP BY 1")
def o08_first_files(spark, sf):
    t = table(spark, sf, "conversations").select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("t"))
    return t.select("conv_id", F.size("t").cast("long").alias("n_files"), F.array_join(text.first_items("t", 3).cast("array<string>"), ",").alias("kept"))


# values ----------------------------------------------------------------------


@query(f"""WITH {RUN_SQL} SELECT task_id, agent, pass_idx, format('{{:,.6f}}', total_cost_usd) AS cost, CASE WHEN forced_stop IS NULL THEN '(none)' ELSE forced_stop::VARCHAR END AS flag, coalesce(nullif(error, ''), '(none)') AS error, coalesce(response_length::VARCHAR, '(none)') AS size,
CASE WHEN pass_idx = 0 THEN '(none)' ELSE agent || ', ' || model END AS list, coalesce(['openpyxl', 'python-docx (from docx import Document)', 'python-pptx (from pptx import Presentation)', NULL][pass_idx % 4 + 1], '(none)') AS library, file AS files FROM runs""")
def f36_f07_f17_values(spark, sf):
    r = runs(spark, sf).withColumn("list", F.when(F.col("pass_idx") > 0, F.array("agent", "model")))
    kind = F.element_at(F.array(F.lit("xlsx"), F.lit("docx"), F.lit("pptx"), F.lit("other")), (F.col("pass_idx") % 4 + 1).cast("int"))
    return r.select("task_id", "agent", "pass_idx", text.value_text("total_cost_usd", "double").alias("cost"), text.value_text("forced_stop", "boolean").alias("flag"), text.value_text("error", "string").alias("error"), text.value_text("response_length", "int").alias("size"), text.value_text("list", "array<string>").alias("list"), F.coalesce(labels.format_library(kind), F.lit("(none)")).alias("library"), text.output_files_text(F.array(F.concat(F.lit('{"path":"'), "file", F.lit('"}'))), F.lit("")).alias("files"))


@query("""SELECT conv_id, turn, 'url=https://x.example/' || turn || ' | title=T' || conv_id || ', url=https://y.example, snippet=' || repeat('s', CAST(least(turn * 50 + 1, 200) AS BIGINT)) AS citations, coalesce(nullif(trim(CASE WHEN turn % 2 = 0 THEN '' ELSE role END), ''), 'none') AS value FROM conversations""")
def f21_f29_citations(spark, sf):
    c, t = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    items = F.array(F.concat(F.lit("https://x.example/"), t), F.concat(F.lit('{"title":"T'), c, F.lit('","url":"https://y.example","snippet":"'), F.repeat(F.lit("s"), (F.col("turn") * 50 + 1).cast("int")), F.lit('"}')))
    value = predicates.first_non_dummy(F.when(F.col("turn") % 2 == 0, " ").otherwise(F.col("role")), F.lit("none"))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.citations_text(text.normal_citations(items)).alias("citations"), value.alias("value"))


FAILURES = (
    ("Interaction stuck in 'in_progress' for 1800s", "Gemini API timeout (in_progress)"),
    ("StaleInteractionError: x", "Gemini API timeout (in_progress)"),
    ("finished with 0 input_tokens", "Gemini API timeout (0 tokens)"),
    ("400 Bad request, invalid", "Content policy 400"),
    ("invalid_prompt", "Content policy 400"),
    ("There was a problem: 400", "Content policy 400 (Gemini)"),
    ("file_output_not_produced", "File output not produced (model skipped)"),
    ("did not generate the required file", "File output not produced (model skipped)"),
    ("File generation failed: FileNotFoundError", "File generation failed — file not found"),
    ("File generation failed: AssertionError", "File generation failed — wrong header arg"),
    ("File generation failed: AttributeError", "File generation failed — wrong API usage"),
    ("File generation failed: No module named 'sklearn'", "File generation failed — missing library (sklearn)"),
    ("File generation failed: No module named 'other'", "File generation failed — missing library"),
    ("File generation failed", "File generation failed"),
    ("Timeout after 960s", "Timeout"),
    ("RuntimeError", "Other error"),
    ("", "Unknown failure"),
)


@query(f"""WITH v(i, category) AS (VALUES {", ".join(f"({i}, '{c}')" for i, (_, c) in enumerate(FAILURES))}) SELECT o_orderkey, category FROM orders JOIN v ON o_orderkey % {len(FAILURES)} = i""")
def f15_every_diagnosis(spark, sf):
    error = F.element_at(F.array(*[F.lit(e) for e, _ in FAILURES]), (F.col("o_orderkey") % len(FAILURES) + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", labels.diagnosed_failure(error).alias("category"))


LINE = "rpad('{}', 22, ' ') || ': ' || {} || chr(10)"
BAR = "chr(10) || repeat('{0}', 80) || chr(10) || {1} || chr(10) || repeat('{0}', 80) || chr(10)"
BODY_SQL = " || ".join(
    [
        BAR.format("=", "'TASK OVERVIEW'"),
        *[LINE.format(k, v) for k, v in (("Task ID", "task_id"), ("Dispatched At", "dispatched_at || '  00:00:00 UTC'"), ("Completed At", "'(none)'"), ("Total Cost (USD)", "format('{:,.6f}', total_cost)"), ("Total Duration", "format('{:,.2f}', duration) || ' s'"))],
        BAR.format("=", "'AGENT RUN  —  ' || agent || '  |  ' || coalesce(model, 'unknown') || '  (pass ' || (pass_idx + 1) || ')'"),
        *[
            LINE.format(k, v)
            for k, v in (
                ("Pass Task ID", "task_id"), ("Agent", "agent"), ("Model", "coalesce(model, '(none)')"), ("Status", "'Completed'"), ("Forced Stop", "'false'"), ("Error", "coalesce(nullif(error, ''), '(none)')"), ("Started At", "'(none)'"), ("Completed At", "'(none)'"),
                ("Duration", "format('{:,.2f}', duration) || ' s'"), ("Input Tokens", "format('{:,}', input_tokens)"), ("Output Tokens", "format('{:,}', output_tokens)"), ("Cost (USD)", "format('{:,.6f}', cost)"), ("Citations", "'1'"), ("Response Length", "format('{:,}', coalesce(response_length, 0)) || ' characters'"),
            )
        ],
        BAR.format("-", "'RESPONSE'"),
        "response_text || chr(10)",
        BAR.format("-", "'CITATIONS  (1)'"),
        "'  [1] ' || model || chr(10) || '       https://a.example/x' || chr(10) || '       a snippet' || chr(10) || chr(10)",
    ]
)


@query(f"""WITH {TASKS_SQL}, {PASSES_SQL}, q AS (SELECT p.* EXCLUDE (cost), CAST(p.cost AS DOUBLE) AS cost, dispatched_at, CAST(total_cost AS DOUBLE) AS total_cost FROM passes p JOIN tasks USING (task_id) WHERE completed AND forced_stop = false AND NOT dry_run)
SELECT task_id || '_' || agent || '_p' || (pass_idx + 1) || '_unknown_time.txt' AS file_name, {BODY_SQL} AS body FROM q""")
def k05_f37_report_bodies(spark, sf):
    """Whole reports, citations included."""
    from tallyforge.operators import runs as run_operators

    none = lambda t: F.lit(None).cast(t)
    t = tasks(spark, sf).select("task_id", "dispatched_at", "dry_run", F.col("total_cost").cast("double").alias("total_cost_usd"))
    p = run_operators.qualifying(passes(spark, sf).join(t, "task_id"))
    cited = F.array(F.struct(F.lit(1).alias("index"), F.lit("https://a.example/x").alias("url"), F.col("model").alias("title"), F.lit(" a snippet\n").alias("snippet")))
    run = F.struct("task_id", "model", "completed", "forced_stop", "error", none("string").alias("started_at"), none("string").alias("completed_at"), F.col("duration").alias("total_duration_sec"), "input_tokens", "output_tokens", F.col("cost").cast("double").alias("total_cost_usd"), F.lit(1).alias("citations_count"), "response_length", "response_text", cited.alias("citations"))
    return sinks.reports(p.withColumn("run", run).withColumn("completed_at", none("string")).withColumn("total_duration_sec", F.col("duration")))


# large files and files by name -------------------------------------------------


GROUP_SQL = """g AS (SELECT task_id, dispatched_at, domain, 'g' || (CAST(task_id AS BIGINT) // 400) || '.json' AS file_name, CAST(task_id AS BIGINT) // 400 % 3 = 1 AS torn FROM tasks)"""


@query(f"""WITH {TASKS_SQL}, {GROUP_SQL} SELECT file_name, task_id, dispatched_at, domain, count(*) OVER (PARTITION BY file_name) > 1 AS in_array FROM g QUALIFY NOT torn OR task_id < max(task_id) OVER (PARTITION BY file_name)""")
def s03_s04_json_arrays(spark, sf):
    """Arrays of many tasks, read in splits of 4 KB; every third file breaks off in its last task, and index.json is no task."""
    path = scratch(spark)
    group = F.floor(F.col("task_id").cast("long") / 400)
    t = tasks(spark, sf).select(F.concat(F.lit("g"), group.cast("string"), F.lit(".json")).alias("prefix"), "task_id", "dispatched_at", F.struct("domain").alias("package"))
    bodies = sinks.grouped_json(t).withColumn("torn", F.regexp_extract("prefix", r"(\d+)", 1).cast("long") % 3 == 1)
    whole = bodies.select(F.col("prefix").alias("file_name"), F.when(F.col("torn"), F.substring("body", F.lit(1), F.length("body") - 9)).otherwise(F.col("body")).alias("body"))
    write_named(whole.unionByName(spark.createDataFrame([("index.json", '{"task_id": "none"}'), ("notes.txt", "{}")], "file_name string, body string")), path)
    found = envelopes.read_arrays(spark, path, split_bytes=4096)
    return found.select("file_name", "task_id", "dispatched_at", "package.domain", "in_array")


@query(f"""WITH {RUN_SQL}, q AS (SELECT *, replace(task_id || '_' || agent || '_p' || (pass_idx + 1) || '_' || CASE WHEN run_completed_at IS NULL THEN 'unknown_time' ELSE strftime(CAST(run_completed_at AS TIMESTAMP), '%Y%m%d_%H%M%S') END || '.txt', ' ', '_') AS file_name FROM runs
WHERE completed AND forced_stop = false AND CAST(task_id AS BIGINT) % 13 <> 0 AND CAST(task_id AS BIGINT) % 40 = 0)
SELECT file_name, task_id, agent, upper(agent) || '  |  ' || model AS title, response_text AS answer FROM q""")
def k05_report_files(spark, sf):
    """Reports of every fortieth task as files of their names, read again."""
    path = scratch(spark)
    e = task_envelopes(spark, sf).filter(F.col("task_id").cast("long") % 40 == 0)
    flat = envelopes.flatten(e).filter("run IS NOT NULL").withColumn("dry_run", F.col("task_id").cast("long") % 13 == 0)
    good = flat.filter(predicates.is_strict_success("run.completed", "run.forced_stop") & ~F.col("dry_run"))
    write_named(sinks.reports(good), path)
    read = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), "value")
    title = F.regexp_extract("value", r"AGENT RUN  —  (.*)  \(pass", 1)
    answer = F.regexp_extract("value", r"(?s)RESPONSE\n-+\n(.*?)\n(?:\n-+\nCITATIONS|$)", 1)
    parts = F.split("file_name", "_")
    return read.select("file_name", parts[0].alias("task_id"), parts[1].alias("agent"), title.alias("title"), answer.alias("answer"))


@query(f"""WITH {RUN_SQL} SELECT row_number() OVER (ORDER BY dispatched_at, task_id, agent, pass_idx) AS place, task_id, agent, model, dispatched_at, response_text FROM runs""")
def k04_o02_ordered_export(spark, sf):
    """The export in parts of one order, joined to a file and read again by its lines."""
    path = scratch(spark)
    sinks.write_ordered_csv(sinks.export_rows(task_envelopes(spark, sf)), path, compression="gzip")
    parts = sinks.join_parts(path, f"{path}.csv.gz")
    return sinks.read_parts(spark, f"{path}.csv.gz", parts).select("place", "task_id", "agent", "model", "dispatched_at", "response_text")


@query(f"""WITH {RUN_SQL}, m AS (SELECT *, CAST(task_id AS BIGINT) % 2 AS src, contains(lower(model), 'brand#1') AS hit FROM runs)
SELECT CAST(src AS INTEGER) AS source_ord, count(DISTINCT task_id) AS tasks_in, count(DISTINCT task_id) FILTER (hit) AS tasks_out, count(*) FILTER (hit) AS passes_out FROM m GROUP BY src""")
def a20_k08_extract_stats(spark, sf):
    """Statistics of an extraction, taken while it is written."""
    path = scratch(spark)
    # one write makes both folders
    sinks.write_json(task_envelopes(spark, sf).withColumn("source", F.col("task_id").cast("long") % 2), path, by="source", compression="gzip")
    read = envelopes.read_envelopes(spark, [f"{path}/source=0", f"{path}/source=1"], lines=True, glob="*.txt.gz")
    return sinks.extract_with_stats(read, "brand#1", "contains", f"{path}/out", 2, compression="gzip")
