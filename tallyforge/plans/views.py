"""The concepts of the library as views of the given tables, for Spark and for the SQL oracle alike.

tasks: orders with their customer's segment. passes: line items with their part.
intake: prompts made of order fields. files: documents as files of a corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ERRORS = (
    "Interaction stuck in 'in_progress' for 1800s",
    "File generation failed for: ['xlsx'] KeyError: 'x'",
    "Preflight failed: corpus too large",
    "cost budget exceeded",
    "max_iterations reached",
    "iteration stop",
    "invalid_prompt: 400",
    "There was a problem (400)",
    "File generation failed for: ['docx', 'pptx'] ModuleNotFoundError: No module named 'scipy'",
    "Timeout after 960s",
    "some error text",
    "",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").cast("string").alias("task_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dispatched_at"),
        F.col("o_orderpriority").alias("research_type"),
        F.col("o_orderstatus").alias("iat_type"),
        F.col("c_mktsegment").alias("domain"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_cost"),
        (F.col("o_orderkey") % 13 == 0).alias("dry_run"),
    )


def passes(spark: SparkSession, sf_dir: str, by_task: bool = False) -> DataFrame:
    """With `by_task` they are dealt by task before they are numbered, so that joins and groups by task shuffle them no more."""
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type")
    # numbered by the keys under the names that everything else groups by, so that one shuffle serves both
    li = li.withColumns({"task_id": F.col("l_orderkey").cast("string"), "agent": F.col("l_returnflag")})
    order = Window.partitionBy("task_id", "agent").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    error = F.element_at(F.array(*map(F.lit, ERRORS)), (F.col("l_partkey") % len(ERRORS) + 1).cast("int"))
    li = li.join(p, li.l_partkey == p.p_partkey, "left")
    return (li.repartition("task_id") if by_task else li).select(
        "task_id",
        "agent",
        (F.row_number().over(order) - 1).alias("pass_idx"),
        F.col("p_brand").alias("model"),
        (F.col("l_linestatus") == "F").alias("completed"),
        F.when(F.col("l_linenumber") != 3, F.col("l_discount") > 0.08).alias("forced_stop"),
        F.when((F.col("l_linestatus") != "F") | (F.col("l_partkey") % 10 == 0), error).alias("error"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("cost"),
        F.col("l_quantity").alias("duration"),
        F.when(F.col("l_linenumber") != 7, F.col("l_partkey") * 31 % 5000).cast("int").alias("response_length"),
        F.concat_ws(" ", "p_name", "p_type").alias("response_text"),
        (F.col("l_partkey") * 37 % 100000).alias("input_tokens"),
        (F.col("l_suppkey") * 53 % 20000).alias("output_tokens"),
        (F.col("l_suppkey") % 2).cast("int").alias("source_ord"),
    )


def intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned intake rows, with what real ones have wrong: ids like 12.0B, types by name, links of all kinds."""
    k = F.col("o_orderkey")
    pick = lambda n, *xs: F.element_at(F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs]), (k % n + 1).cast("int"))
    key = k.cast("string")
    return table(spark, sf_dir, "orders").select(
        pick(3, F.concat(key, F.lit(".0")), F.concat(key, F.lit(".0B")), F.concat(key, F.lit("_abc123"))).alias("raw_id"),
        pick(5, F.concat(F.lit("Create a summary of order "), key, F.lit(" in an excel file")), F.concat(F.lit("Use the excel dump of order "), key), F.concat(F.lit("Produce slides. PowerPoint is fine for "), key), F.concat(F.lit("Write a Word document and present it in powerpoint for "), key), F.lit("short")).alias("prompt"),
        pick(6, " crp ", "Relevance Compression Prompt", "FAILURE SENSITIVE PROMPT", "LDP", "", "other").alias("research_type"),
        F.concat(F.lit("SME "), F.col("o_custkey") % 17).alias("sme_name"),
        F.when(k % 4 != 0, F.col("o_orderstatus")).otherwise("").alias("domain"),
        F.concat(F.lit("First look at order "), key, F.lit("\nshort\n  Then compare the total "), F.col("o_orderpriority")).alias("solution_logic"),
        pick(
            8,
            F.concat(F.lit("https://drive.google.com/file/d/f"), key, F.lit("/view")),
            F.concat(F.lit("https://drive.google.com/open?usp=x&id=o"), key),
            F.concat(F.lit("https://drive.google.com/drive/u/1/folders/d"), key),
            F.concat(F.lit("https://docs.google.com/spreadsheets/d/s"), key, F.lit("/edit")),
            F.concat(F.lit("gdrive://g"), key),
            F.concat(F.lit("/local/"), key, F.lit(".pdf")),
            F.concat(F.lit("https://sheets.google.com/x?a=1&id=q"), key),
            F.lit(""),
        ).alias("drive_url"),
        F.when(k % 3 == 0, "").otherwise("trap").alias("sanity_check"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the files of a corpus; those of source src3 count as not extractable."""
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", name.alias("filename"), F.lit(".txt").alias("extension"), F.lit("text/plain").alias("mime_type"), F.col("n_chars").alias("size_bytes"), (F.coalesce(F.col("source"), F.lit("")) != "src3").alias("extractable"), F.floor(F.length("text") / 4).cast("long").alias("num_tokens_est"), F.col("text").alias("text_content"), "source")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TASKS_SQL = """
tasks AS (SELECT CAST(o_orderkey AS VARCHAR) AS task_id, strftime(o_orderdate, '%Y-%m-%d') AS dispatched_at, o_orderpriority AS research_type,
  o_orderstatus AS iat_type, c_mktsegment AS domain, CAST(o_totalprice AS DECIMAL(18,2)) AS total_cost, o_orderkey % 13 = 0 AS dry_run
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""
PASSES_SQL = f"""
passes AS (SELECT CAST(l_orderkey AS VARCHAR) AS task_id, l_returnflag AS agent,
  CAST(row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS INTEGER) AS pass_idx,
  p_brand AS model, l_linestatus = 'F' AS completed, CASE WHEN l_linenumber <> 3 THEN l_discount > 0.08 END AS forced_stop,
  CASE WHEN l_linestatus <> 'F' OR l_partkey % 10 = 0 THEN [{", ".join(map(quoted, ERRORS))}][l_partkey % {len(ERRORS)} + 1] END AS error,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS cost, l_quantity AS duration,
  CASE WHEN l_linenumber <> 7 THEN CAST(l_partkey * 31 % 5000 AS INTEGER) END AS response_length, p_name || ' ' || p_type AS response_text,
  l_partkey * 37 % 100000 AS input_tokens, l_suppkey * 53 % 20000 AS output_tokens, CAST(l_suppkey % 2 AS INTEGER) AS source_ord
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""
INTAKE_SQL = r"""
intake AS (SELECT [o_orderkey || '.0', o_orderkey || '.0B', o_orderkey || '_abc123'][o_orderkey % 3 + 1] AS raw_id,
  ['Create a summary of order ' || o_orderkey || ' in an excel file', 'Use the excel dump of order ' || o_orderkey, 'Produce slides. PowerPoint is fine for ' || o_orderkey,
   'Write a Word document and present it in powerpoint for ' || o_orderkey, 'short'][o_orderkey % 5 + 1] AS prompt,
  [' crp ', 'Relevance Compression Prompt', 'FAILURE SENSITIVE PROMPT', 'LDP', '', 'other'][o_orderkey % 6 + 1] AS research_type,
  'SME ' || (o_custkey % 17) AS sme_name, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus ELSE '' END AS domain,
  'First look at order ' || o_orderkey || chr(10) || 'short' || chr(10) || '  Then compare the total ' || o_orderpriority AS solution_logic,
  ['https://drive.google.com/file/d/f' || o_orderkey || '/view', 'https://drive.google.com/open?usp=x&id=o' || o_orderkey, 'https://drive.google.com/drive/u/1/folders/d' || o_orderkey,
   'https://docs.google.com/spreadsheets/d/s' || o_orderkey || '/edit', 'gdrive://g' || o_orderkey, '/local/' || o_orderkey || '.pdf',
   'https://sheets.google.com/x?a=1&id=q' || o_orderkey, ''][o_orderkey % 8 + 1] AS drive_url,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'trap' END AS sanity_check FROM orders)"""
CODES_SQL = """
codes AS (SELECT *, coalesce(CASE lower(trim(research_type)) WHEN 'crp' THEN 'CRP' WHEN 'relevance compression prompt' THEN 'RCP'
  WHEN 'failure sensitive prompt' THEN 'FSP' WHEN 'ldp' THEN 'LDP' END, '') AS code FROM intake)"""
FILES_SQL = """
files AS (SELECT doc_id, 'doc_' || doc_id || '.txt' AS filename, '.txt' AS extension, 'text/plain' AS mime_type, n_chars AS size_bytes,
  coalesce(source, '') <> 'src3' AS extractable, length(text) // 4 AS num_tokens_est, text AS text_content, source FROM documents)"""
