"""Queries on intake rows and packages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import labels, text
from tallyforge.plans.registry import query
from tallyforge.plans.views import CODES_SQL, INTAKE_SQL, intake, table, tasks
from tallyforge.sources import intake as source

WITH = f"WITH {INTAKE_SQL}, {CODES_SQL}"
ID_SQL = r"regexp_replace(raw_id, '^(\d+)\.0([A-Za-z]*)$', '\1\2')"
IAT_SQL = "CASE code WHEN 'CRP' THEN 'IAT-2' WHEN 'RCP' THEN 'IAT-1' WHEN 'LDP' THEN 'IAT-1' WHEN 'FSP' THEN 'IAT-3' ELSE '' END"
FORMATS_SQL = r"""array_to_string(list_filter([CASE WHEN regexp_matches(prompt, '(?i)\bword\s+doc(?:ument)?\b') THEN 'docx' END,
  CASE WHEN regexp_matches(prompt, '(?i)\b(?:present|output|create|produce|generate|deliver|build)\b[^.!?\n]{0,120}\bpowerpoint\b') THEN 'pptx' END,
  CASE WHEN regexp_matches(prompt, '(?i)\b(?:present|output|create|produce|generate|deliver|build)\b[^.!?\n]{0,120}\bexcel\b') THEN 'xlsx' END], lambda x: x IS NOT NULL), ',')"""
LINK_SQL = r"""CASE WHEN drive_url LIKE '/%' OR drive_url = '' THEN NULL WHEN drive_url LIKE 'gdrive://%' THEN ['file', substr(drive_url, 10)]
  WHEN contains(drive_url, 'docs.google.com') THEN ['workspace_doc', regexp_extract(drive_url, '/d/([a-zA-Z0-9_-]+)', 1)]
  WHEN contains(drive_url, '/file/d/') THEN ['file', regexp_extract(drive_url, '/d/([a-zA-Z0-9_-]+)', 1)]
  WHEN contains(drive_url, '/folders/') THEN ['folder', regexp_extract(drive_url, '/folders/([a-zA-Z0-9_-]+)', 1)]
  ELSE ['file', regexp_extract(drive_url, '[?&]id=([^&#]+)', 1)] END"""


def rows(spark, sf):
    return intake(spark, sf).withColumn("task_id", text.normal_id("raw_id"))


@query(rf"""{WITH} SELECT {ID_SQL} AS task_id, code AS research_type, {IAT_SQL} AS iat_type, {FORMATS_SQL} AS formats, {IAT_SQL} = 'IAT-1' AS is_closed,
array_to_string(list_filter(list_transform(string_split(solution_logic, chr(10)), lambda x: trim(x)), lambda x: length(x) > 10), '|') AS steps, {IAT_SQL} <> 'IAT-1' AS web_search FROM codes""")
def p01_p02_packages(spark, sf):
    p = source.packages(rows(spark, sf), enforce_iat=True)
    return p.select("task_id", "research_type", "iat_type", F.array_join("output_formats", ",").alias("formats"), "is_closed", F.array_join("solution_steps", "|").alias("steps"), F.col("web_search_enabled").alias("web_search"))


@query(rf"{WITH} SELECT {ID_SQL} AS task_id, prompt FROM codes WHERE code = 'CRP' AND contains(lower(sme_name), 'sme 1')")
def w01_w04_select_rows(spark, sf):
    return source.select_rows(rows(spark, sf), research_type="CRP", sme="sme 1", normalize=True).select("task_id", "prompt")


@query(rf"""{WITH} SELECT {ID_SQL} AS task_id, array_to_string(list_filter([CASE WHEN length(trim(prompt)) < 20 THEN 'prompt is required (minimum 20 characters)' END,
CASE WHEN research_type NOT IN ('CRP', 'RCP', 'SCP', 'LDP', 'FSP', 'Constrained Research Prompt', 'Relevance Compression Prompt', 'Structural Compliance Prompt', 'Latent Decomposition Prompt', 'Failure-Sensitive Prompt', '') THEN 'research_type ''' || research_type || ''' invalid' END],
lambda x: x IS NOT NULL), '; ') AS errors FROM codes""")
def w13_package_errors(spark, sf):
    r = rows(spark, sf).withColumn("iat_type", F.lit("IAT-1"))
    return r.select("task_id", F.array_join(source.package_errors(), "; ").alias("errors"))


@query(rf"""{WITH} SELECT {ID_SQL} AS task_id, array_to_string(list_filter([CASE WHEN drive_url LIKE '/%' THEN 'File not found: ' || drive_url END, CASE WHEN drive_url = '' THEN 'No files attached' END,
CASE WHEN code = '' THEN 'research_type not set' END, CASE WHEN {IAT_SQL} = '' THEN 'iat_type not set' END, CASE WHEN sanity_check = '' THEN 'lazy_ai_prediction empty' END], lambda x: x IS NOT NULL), '; ') AS warnings FROM codes""")
def w14_package_warnings(spark, sf):
    p = source.packages(rows(spark, sf))
    missing = F.when(F.col("drive_url").startswith("/"), F.array("drive_url")).otherwise(F.array().cast("array<string>"))
    return p.select("task_id", F.array_join(source.package_warnings((F.col("drive_url") != "").cast("int"), missing), "; ").alias("warnings"))


@query(rf"""{WITH}, ag(agent) AS (VALUES ('claude'), ('openai'), ('perplexity'), ('other')), e AS (SELECT agent, code IN ('RCP', 'LDP') AS closed, length(solution_logic) * 60000 AS bytes FROM codes, ag)
SELECT agent, agent <> 'other' AS eligible, CASE WHEN agent = 'other' THEN 'Unknown agent: other' WHEN agent = 'perplexity' AND closed THEN 'cannot disable web search' WHEN agent = 'openai' AND bytes > 3000000 THEN 'large corpus with native file upload' ELSE '' END AS note, count(*) AS n FROM e GROUP BY ALL""")
def w15_eligibility(spark, sf):
    agents = spark.createDataFrame([("claude",), ("openai",), ("perplexity",), ("other",)], "agent string")
    p = source.packages(rows(spark, sf)).crossJoin(F.broadcast(agents))
    e = source.eligibility(F.col("agent"), F.col("is_closed"), F.length("solution_logic") * 60000, ("claude", "openai", "gemini", "perplexity"))
    return p.select("agent", e.alias("e")).groupBy("agent", "e.eligible", "e.note").agg(F.count("*").alias("n"))


@query(rf"""{WITH} SELECT 'type' AS dimension, CASE WHEN code = '' THEN 'unset' ELSE code END AS value, count(*) AS n FROM codes GROUP BY ALL
UNION ALL SELECT 'domain', coalesce(nullif(domain, ''), 'unset'), count(*) FROM codes GROUP BY ALL UNION ALL SELECT 'sme', coalesce(nullif(sme_name, ''), 'unknown'), count(*) FROM codes GROUP BY ALL
UNION ALL SELECT 'file_output', 'yes', count(*) FROM codes WHERE {FORMATS_SQL} <> ''""")
def a04_preview_counts(spark, sf):
    p = source.packages(rows(spark, sf))
    named = lambda c, none: F.coalesce(F.when(F.col(c) != "", F.col(c)), F.lit(none))
    each = [("type", named("research_type", "unset")), ("domain", named("domain", "unset")), ("sme", named("sme_name", "unknown")), ("file_output", F.when(F.size("output_formats") > 0, "yes"))]
    d = p.select(F.explode(F.array(*[F.struct(F.lit(k).alias("dimension"), v.alias("value")) for k, v in each])).alias("d"))
    return d.filter("d.value IS NOT NULL").groupBy("d.dimension", "d.value").agg(F.count("*").alias("n"))


@query(rf"{WITH}, l AS (SELECT {LINK_SQL} AS l FROM codes) SELECT count(*) FILTER (l[1] = 'file') AS file_links, count(*) FILTER (l[1] = 'folder') AS folder_links FROM l")
def a05_link_counts(spark, sf):
    kind = labels.link("drive_url")["type"]
    return rows(spark, sf).agg(F.count_if(kind == "file").alias("file_links"), F.count_if(kind == "folder").alias("folder_links"))


@query(rf"{WITH}, l AS (SELECT drive_url, {LINK_SQL} AS l FROM codes) SELECT drive_url, coalesce(l[1], '') AS type, coalesce(l[2], '') AS id, CASE WHEN l[1] = 'workspace_doc' THEN 'spreadsheets' ELSE '' END AS doc_type FROM l")
def f10_links(spark, sf):
    link = labels.link("drive_url")
    return rows(spark, sf).select("drive_url", *[F.coalesce(link[k], F.lit("")).alias(k) for k in ("type", "id", "doc_type")])


@query(rf"{WITH} SELECT raw_id, {ID_SQL} AS task_id, regexp_replace(raw_id, '^(.+)_[a-f0-9]{{6}}$', '\1') AS prefix FROM codes")
def f03_f09_ids(spark, sf):
    return intake(spark, sf).select("raw_id", text.normal_id("raw_id").alias("task_id"), text.id_prefix("raw_id").alias("prefix"))


@query(f"""{WITH} SELECT code AS research_type, count(*) AS n, count(DISTINCT sme_name) AS smes FROM codes GROUP BY ALL""")
def j04_types(spark, sf):
    return source.packages(rows(spark, sf)).groupBy("research_type").agg(F.count("*").alias("n"), F.countDistinct("sme_name").alias("smes"))


@query("""WITH t AS (SELECT o_orderkey FROM orders), ag(agent) AS (VALUES ('a'), ('b'), ('c')), p(k) AS (VALUES (1), (2))
SELECT o_orderkey || '_' || agent || '_p' || k AS pass_task_id, agent, k AS pass_number FROM t, ag, p""")
def j10_p09_fan_out(spark, sf):
    agents = spark.createDataFrame([("a",), ("b",), ("c",)], "agent string")
    return source.fan_out(tasks(spark, sf).select("task_id"), agents, 2).select("pass_task_id", "agent", "pass_number")


@query(rf"""{WITH}, f AS (SELECT {ID_SQL} AS task_id, string_split({FORMATS_SQL}, ',') AS wanted, CASE WHEN code = 'CRP' THEN ['xlsx', 'pdf'] ELSE ['pptx'] END AS made FROM codes WHERE {FORMATS_SQL} <> '')
SELECT task_id, array_to_string(list_sort(list_filter(wanted, lambda x: NOT list_contains(made, x))), ',') AS missing FROM f""")
def j13_missing_formats(spark, sf):
    p = source.packages(rows(spark, sf)).filter(F.size("output_formats") > 0)
    made = F.when(F.col("research_type") == "CRP", F.array(F.lit("out/a.xlsx"), F.lit("b.pdf"))).otherwise(F.array(F.lit("c.pptx")))
    kinds = F.transform(made, lambda f: F.substring(labels.extension(f), 2, 10))
    return p.select("task_id", F.array_join(F.array_sort(F.array_except("output_formats", kinds)), ",").alias("missing"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 7 + 60 WHEN o_orderstatus = 'F' THEN 3660 ELSE 960 END AS timeout,
'out/' || o_orderkey || '/' || lower(o_orderstatus) AS output_dir FROM orders""")
def f45_f46_timeouts(spark, sf):
    k = F.col("o_orderkey")
    t = source.timeout(F.when(k % 3 == 0, k % 7), F.when(F.col("o_orderstatus") == "F", F.lit(3600)), F.lit(900))
    return table(spark, sf, "orders").select("o_orderkey", t.alias("timeout"), F.concat_ws("/", F.lit("out"), k.cast("string"), F.lower("o_orderstatus")).alias("output_dir"))
