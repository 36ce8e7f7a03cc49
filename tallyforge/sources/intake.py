"""Prompt intake: CSV files with varying headers, as cleaned rows and then packages."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import labels, text
from tallyforge.functions.predicates import col

log = logging.getLogger(__name__)

# The headers under which each field is known, best first.
HEADERS: dict[str, tuple[str, ...]] = {
    "task_id": ("task_id", "task id", "taskid", "id", "task"),
    "prompt": ("prompt", "prompts", "prompt_text", "prompt text", "question", "task description", "research question"),
    "prompt_id": ("prompt_id", "prompt id", "prompt_no", "prompt no", "s.no", "s. no", "serial no", "serial"),
    "sme_name": ("full_name", "full name", "poc name", "poc_name", "sme_name", "sme name", "sme", "author", "name", "annotator", "contributor"),
    "email": ("ann_email", "email", "sme_email", "poc_email", "e-mail", "contact email", "contact"),
    "research_type": ("prompt_type", "prompt type", "category", "type", "primary", "research_type", "research type", "prompt category"),
    "domain": ("domain", "domain_detail", "domain detail", "vertical", "sector", "sub-domain"),
    "sanity_check": ("sanity_check", "sanity check", "sc", "lazy ai", "lazy_ai", "lazy ai prediction", "sanity", "trap check"),
    "solution_logic": ("solution_logic", "solution logic", "logic", "solution", "answer logic", "solution steps", "golden answer"),
    "drive_url": ("drive_link", "drive link", "drive", "drive_url", "drive url", "gdrive", "gdrive_url", "gdrive url", "files", "attachments", "file link", "google drive"),
    "created_at": ("created_at", "created at", "date", "timestamp", "submission_date", "submission date", "submitted_at", "submitted at"),
    "allocation_id": ("allocation_id", "allocation id", "alloc_id", "alloc id"),
    "estimated_time": ("estimated_time", "estimated time", "time", "duration", "est. time", "est time", "time_mins", "time (mins)", "time (minutes)"),
}
REQUIRED = ("task_id", "prompt")
#: What a package may say of its type.
VALID_TYPES = (*labels.RESEARCH_TYPES, "Constrained Research Prompt", "Relevance Compression Prompt", "Structural Compliance Prompt", "Latent Decomposition Prompt", "Failure-Sensitive Prompt", "")
VALID_IATS = ("IAT-1", "IAT-2", "IAT-3", "")
LARGE_FILES = 3_000_000


def bind_headers(columns: list[str]) -> dict[str, str]:
    """field -> column; raises where a required field has no column, warns of unused columns."""
    by_name = {c.strip().lower(): c for c in columns}
    bound = {field: next(by_name[n] for n in names if n in by_name) for field, names in HEADERS.items() if any(n in by_name for n in names)}
    missing = [f for f in REQUIRED if f not in bound]
    if missing:
        raise ValueError(f"no column for {missing} among {columns}")
    if unused := sorted(set(columns) - set(bound.values())):
        log.warning("unused columns: %s", unused)
    return bound


def clean_rows(raw: DataFrame) -> DataFrame:
    """All fields as trimmed text, '' where missing; blank rows and rows without a prompt go."""
    bound = bind_headers(raw.columns)
    rows = raw.select(*[F.trim(F.coalesce(F.col(f"`{bound[f]}`").cast("string"), F.lit(""))).alias(f) if f in bound else F.lit("").alias(f) for f in HEADERS])
    rows = rows.filter("prompt <> ''")
    made = text.generated_id("sme_name", *HEADERS)
    return rows.withColumn("task_id", F.when(F.col("task_id") == "", made).otherwise(text.normal_id("task_id")))


def read_intake(spark: SparkSession, path: str) -> DataFrame:
    return clean_rows(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path))


def select_rows(rows: DataFrame, task_ids: list[str] | None = None, research_type: str | None = None, sme: str | None = None, max_rows: int = 0, normalize: bool = False) -> DataFrame:
    """Filters in their order: ids, type (as written, unless `normalize`), part of the author's name, number of rows."""
    if task_ids:
        rows = rows.filter(F.col("task_id").isin(*task_ids))
    if research_type:
        rows = rows.filter((labels.research_type("research_type") if normalize else F.col("research_type")) == research_type)
    if sme:
        rows = rows.filter(F.lower("sme_name").contains(sme.lower()))
    return rows.limit(max_rows) if max_rows else rows


def packages(rows: DataFrame, enforce_iat: bool = False) -> DataFrame:
    """Rows with research_type as its code, and iat_type, solution_steps, output_formats, is_closed, web_search_enabled."""
    out = rows.withColumn("research_type", labels.research_type("research_type")).withColumn("iat_type", labels.iat_type("research_type"))
    out = out.withColumn("solution_steps", text.solution_steps("solution_logic")).withColumn("output_formats", labels.output_formats("prompt"))
    closed = F.col("iat_type") == "IAT-1"
    return out.withColumn("is_closed", closed).withColumn("is_hybrid", F.col("iat_type") == "IAT-2").withColumn("web_search_enabled", ~closed if enforce_iat else F.lit(True))


def package_errors(task_id="task_id", prompt="prompt", research_type="research_type", iat_type="iat_type") -> Column:
    empty = lambda c: F.coalesce(col(c), F.lit(""))
    return F.array_compact(
        F.array(
            F.when(empty(task_id) == "", "task_id is required"),
            F.when(F.length(F.trim(empty(prompt))) < 20, "prompt is required (minimum 20 characters)"),
            F.when(~empty(research_type).isin(*VALID_TYPES), F.concat(F.lit("research_type '"), empty(research_type), F.lit("' invalid"))),
            F.when(~empty(iat_type).isin(*VALID_IATS), F.concat(F.lit("iat_type '"), empty(iat_type), F.lit("' invalid"))),
        )
    )


def package_warnings(file_count: Column, missing_files: Column, research_type="research_type", iat_type="iat_type", steps="solution_steps", trap="sanity_check") -> Column:
    empty = lambda c: F.coalesce(col(c), F.lit("")) == ""
    single = F.array(
        F.when(file_count == 0, "No files attached"),
        F.when(empty(research_type), "research_type not set"),
        F.when(empty(iat_type), "iat_type not set"),
        F.when(F.size(col(steps)) == 0, "solution_steps empty"),
        F.when(empty(trap), "lazy_ai_prediction empty"),
    )
    return F.concat(F.transform(missing_files, lambda f: F.concat(F.lit("File not found: "), f)), F.array_compact(single))


def validate(rows: DataFrame) -> DataFrame:
    """The rows, if none has an error; else raises with how many do."""
    bad = rows.filter(F.size(package_errors()) > 0).count()
    if bad:
        raise ValueError(f"{bad} packages are invalid")
    return rows


def with_files(tasks: DataFrame, drive_url: str = "drive_url", files: str = "files") -> DataFrame:
    """Tasks but those whose shared link resolved to no file."""
    linked = labels.link(drive_url)["type"].isNotNull()
    return tasks.filter(~(linked & (F.coalesce(F.size(files), F.lit(0)) <= 0)))


def preview(packages: DataFrame, n: int = 3, order: tuple[str, ...] = ("task_id",)) -> DataFrame:
    """The first packages as a table of short texts."""
    short = lambda c, k: F.concat(F.substring(c, 1, k), F.lit("..."))
    formats = F.when(F.size("output_formats") > 0, F.array_join("output_formats", ", ")).otherwise("none")
    return (
        packages.orderBy(*order)
        .limit(n)
        .select("task_id", "sme_name", "research_type", "iat_type", "domain", short("prompt", 80).alias("prompt"), F.size("solution_steps").alias("n_steps"), short("sanity_check", 60).alias("sanity_check"), short("drive_url", 60).alias("drive_url"), formats.alias("output_formats"))
    )


def top_counts(rows: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The most frequent values with their counts, and on each row how many `more` there are beyond them."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    more = counts.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("more"))
    return counts.orderBy(F.desc("n"), "value").limit(n).crossJoin(F.broadcast(more))  # one row


def eligibility(agent: Column, closed: Column, bytes_: Column, agents: tuple[str, ...]) -> Column:
    """(eligible, note); only unknown agents are not eligible."""
    note = (
        F.when(~agent.isin(*agents), F.concat(F.lit("Unknown agent: "), agent))
        .when((agent == "perplexity") & closed, "cannot disable web search")
        .when(agent.isin("openai", "gemini") & (bytes_ > LARGE_FILES), "large corpus with native file upload")
        .otherwise("")
    )
    return F.struct(agent.isin(*agents).alias("eligible"), note.alias("note"))


#: Agents that a fan-out sends to every task.
MOST_AGENTS = 1_000


def fan_out(tasks: DataFrame, agents: DataFrame, passes: int) -> DataFrame:
    """Each task with each agent of the `agents` table, which has at most MOST_AGENTS rows, and each pass number from 1."""
    if agents.limit(MOST_AGENTS + 1).count() > MOST_AGENTS:
        raise ValueError(f"more than {MOST_AGENTS} agents")
    numbered = agents.withColumn("pass_number", F.explode(F.sequence(F.lit(1), F.lit(passes))))
    return tasks.crossJoin(F.broadcast(numbered)).withColumn("pass_task_id", F.concat_ws("_", "task_id", "agent", F.concat(F.lit("p"), F.col("pass_number"))))


def timeout(override: Column, agent_default: Column, task: Column) -> Column:
    return F.coalesce(override, agent_default, task) + 60
