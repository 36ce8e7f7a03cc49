"""Task envelopes: nested JSON records of runs, read with one schema, flattened and built again."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.predicates import is_true, sorted_by
from tallyforge.functions.text import id_prefix
from tallyforge.sources.folders import read_each
from tallyforge.sources.json_records import SPLIT_BYTES, json_records

PASS = (
    "struct<task_id:string,agent:string,model:string,completed:boolean,forced_stop:boolean,error:string,"
    "input_tokens:bigint,output_tokens:bigint,total_cost_usd:double,total_duration_sec:double,iterations:int,"
    "citations_count:int,tool_calls_count:int,response_length:int,response_text:string,"
    "citations:array<struct<index:int,url:string,title:string,snippet:string>>,output_files:array<string>,"
    "output_file_path:string,output_file_errors:map<string,string>,started_at:string,completed_at:string>"
)
ENVELOPE = (
    "task_id string, dispatched_at string, completed_at string, total_cost_usd double, total_duration_sec double, "
    "agents_attempted array<string>, agents_succeeded array<string>, agents_failed array<string>, agent_errors map<string,string>, "
    "config struct<agents:array<string>,passes_per_agent:int,dry_run:boolean,mcp_server_url:string,output_files_base_dir:string>, "
    "package struct<task_id:string,prompt:string,research_type:string,iat_type:string,domain:string,decision_archetype:string,file_count:int,file_names:array<string>,output_formats:array<string>>, "
    "sme_metadata struct<sme_name:string,email:string,prompt_id:string,allocation_id:string,submitted_at:string,domain_detail:string,drive_url:string,estimated_time:string>, "
    f"agent_results map<string,array<{PASS}>>"
)
CORRUPT = "_corrupt_record"
FIELDS = tuple(f.split()[0] for f in "task_id dispatched_at completed_at total_cost_usd total_duration_sec agents_attempted agents_succeeded agents_failed agent_errors config package sme_metadata agent_results".split())


def parse_envelopes(rows: DataFrame, body: str = "value", parts: int | None = None) -> DataFrame:
    """One row per task of JSON texts that hold an object or an array of objects, with the other columns of `rows`.

    `in_array` tells which it was; `extra` maps keys that the schema does not
    know to their values as JSON. Texts that cannot be parsed give no rows.
    With `parts`, tasks are dealt by their id to so many parts while they are
    texts, so that all cores parse what few files hold, and what groups by task id
    needs no other shuffle.
    """
    kept = [c for c in rows.columns if c != body]
    start = F.substring(F.trim(F.col(body)), 1, 1)
    each = F.when(start == "[", F.from_json(body, "array<string>")).otherwise(F.array(body))
    tasks = rows.select(*kept, (start == "[").alias("in_array"), F.explode(each).alias("__text"))
    named = F.col("__task.task_id")
    if parts:
        tasks = tasks.withColumn("__id", F.from_json("__text", "task_id string")["task_id"]).repartition(parts, "__id")
        named = F.col("__id")
    task = F.from_json("__text", f"{ENVELOPE}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    known = F.array(*map(F.lit, FIELDS))
    extra = F.transform_values(F.map_filter(F.from_json("__text", "map<string,variant>"), lambda k, _: ~F.array_contains(known, k)), lambda _, v: F.to_json(v))
    # as generated columns, texts are parsed once: what is asked of them does not move before the shuffle
    tasks = tasks.select(*[c for c in tasks.columns if c != "__text"], F.inline(F.array(F.struct(task.alias("__task"), extra.alias("extra")))))
    tasks = tasks.filter(f"__task IS NOT NULL AND __task.{CORRUPT} IS NULL AND extra IS NOT NULL")
    return tasks.select(*[(named if f == "task_id" else F.col(f"__task.{f}")).alias(f) for f in FIELDS], "extra", "in_array", *kept)


def read_envelopes(spark: SparkSession, paths: str | list[str], skip: tuple[str, ...] = ("index.json",), lines: bool = False, glob: str = "*.json") -> DataFrame:
    """One row per task from JSON files that hold an object or an array of objects; with `lines`, one in each line of any file that fits `glob`.

    Adds file_name, prefix (the file's name without its suffix of six digits) and
    source_ord, the place of its directory in `paths`. Directories that do not
    exist are warned of. Files that cannot be parsed and those in `skip` give no
    rows. A missing id is the file's name.
    """

    def read(i: int, path: str) -> DataFrame:
        found = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=not lines)
        return found.select("value", F.col("_metadata.file_name").alias("file_name"), F.lit(i).alias("source_ord"))

    parts = read_each(paths, read) or [spark.createDataFrame([], "value string, file_name string, source_ord int")]
    rows = parse_envelopes(reduce(DataFrame.unionByName, parts).filter(~F.col("file_name").isin(*skip)))
    stem = F.regexp_replace("file_name", r"\.json$", "")
    return rows.withColumn("task_id", F.coalesce("task_id", stem)).withColumn("prefix", id_prefix(stem))


def read_arrays(spark: SparkSession, paths: str | list[str], skip: tuple[str, ...] = ("index.json",), glob: str = "*.json", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """`read_envelopes` for files of any size: each is read by several tasks, object by object.

    Of a file that breaks off, the objects before the break are kept. A missing id
    is the file's name and, in an array, the object's place in bytes.
    """
    rows = json_records(spark, paths, glob, split_bytes).filter(~F.col("file_name").isin(*skip)).withColumnRenamed("in_array", "__array")
    tasks = parse_envelopes(rows.drop("path")).drop("in_array").withColumnRenamed("__array", "in_array")
    stem = F.regexp_replace("file_name", r"\.json$", "")
    named = F.when(F.col("in_array"), F.concat(stem, F.lit("@"), F.col("offset").cast("string"))).otherwise(stem)
    return tasks.withColumn("task_id", F.coalesce("task_id", named)).withColumn("prefix", id_prefix(stem)).drop("offset")


def envelope_json(envelopes: DataFrame) -> Column:
    """A task as JSON: the fields of the schema that `envelopes` has, then its extra keys as they were."""
    body = F.to_json(F.struct(*[f for f in FIELDS if f in envelopes.columns]))
    if "extra" not in envelopes.columns:
        return body
    more = F.transform(F.map_entries(F.coalesce("extra", F.create_map().cast("map<string,string>"))), lambda e: F.concat(F.to_json(F.struct(e["key"].alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(e["key"].alias("k")))) - 6), F.lit(":"), e["value"]))
    inner = F.substring(body, F.lit(2), F.length(body) - 2)
    return F.concat(F.lit("{"), F.array_join(F.concat(F.when(inner != "", F.array(inner)).otherwise(F.array().cast("array<string>")), more), ","), F.lit("}"))


def flatten(envelopes: DataFrame) -> DataFrame:
    """One row per pass: the task's columns, agent, agent_pos, pass_idx (from 0) and the struct `run`.

    Tasks without agents, and agents without passes, keep one row with null `run`.
    """
    kept = [c for c in envelopes.columns if c != "agent_results"]
    agents = envelopes.select(*kept, F.posexplode_outer(F.map_entries("agent_results")).alias("agent_pos", "__e"))
    return agents.select(*kept, "agent_pos", F.col("__e.key").alias("agent"), F.posexplode_outer("__e.value").alias("pass_idx", "run"))


def nest(passes: DataFrame, keys: list[str], agent: str = "agent", order: str = "pass_idx", run: str = "run", also: dict[str, Callable] | None = None) -> DataFrame:
    """Back to one row per task: agent_results, passes in order, agents in text order.

    `also` has columns of the passes with the aggregate (first, sum, least or
    greatest) that a task has of them; it is taken in the same pass.
    """
    more = [f(c).alias(c) for c, f in (also or {}).items()]
    lists = passes.filter(F.col(run).isNotNull()).groupBy(*keys, agent).agg(F.transform(sorted_by(F.collect_list(F.struct(order, run)), order), lambda x: x[run]).alias("runs"), *more)
    return lists.groupBy(*keys).agg(F.map_from_entries(sorted_by(F.collect_list(F.struct(agent, "runs")), agent)).alias("agent_results"), *more)


def with_matching_model(envelopes: DataFrame, pattern: str, mode: str = "contains") -> DataFrame:
    """Envelopes with only the passes of models that match; agents and tasks without any go."""

    def fits(p):
        model = F.coalesce(p["model"], F.lit(""))
        return {"exact": model == pattern, "contains": F.lower(model).contains(pattern.lower()), "regex": F.rlike(model, F.lit(f"(?i){pattern}"))}[mode]

    kept = F.map_filter(F.transform_values("agent_results", lambda _, runs: F.filter(runs, fits)), lambda _, runs: F.size(runs) > 0)
    return envelopes.withColumn("agent_results", kept).filter(F.size("agent_results") > 0)


def agent_figures(first_error: bool = False) -> dict[str, Column]:
    """Agents that were tried, succeeded and failed, and the failed ones' last (or first) errors, from agent_results."""
    agents = F.array_sort(F.map_keys("agent_results"))
    done = lambda a: F.exists(F.col("agent_results")[a], lambda p: is_true(p["completed"]))
    errors = lambda a: F.filter(F.transform(F.col("agent_results")[a], lambda p: p["error"]), lambda e: F.coalesce(e, F.lit("")) != "")
    failed = F.filter(agents, lambda a: ~done(a))
    named = F.filter(failed, lambda a: F.size(errors(a)) > 0)
    last = F.map_from_arrays(named, F.transform(named, lambda a: F.element_at(errors(a), 1 if first_error else -1)))
    return {"agents_attempted": agents, "agents_succeeded": F.filter(agents, done), "agents_failed": failed, "agent_errors": last}


def with_pass_figures(envelopes: DataFrame) -> DataFrame:
    """Agents, their last errors, cost (8 digits), longest duration and times, counted anew from the passes that are there.

    Times stay as they are where no pass has one that can be read.
    """
    runs = F.flatten(F.map_values("agent_results"))
    amount = lambda f: F.transform(runs, lambda p: F.coalesce(p[f], F.lit(0.0)))
    time = lambda f: F.array_compact(F.transform(runs, lambda p: F.try_to_timestamp(p[f])))
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return envelopes.withColumns(
        {
            **agent_figures(),
            "total_cost_usd": F.round(F.aggregate(amount("total_cost_usd"), F.lit(0.0), lambda x, y: x + y), 8),
            "total_duration_sec": F.greatest(F.array_max(amount("total_duration_sec")), F.lit(0.0)),
            "dispatched_at": F.coalesce(iso(F.array_min(time("started_at"))), "dispatched_at"),
            "completed_at": F.coalesce(iso(F.array_max(time("completed_at"))), "completed_at"),
        }
    )


def extract_model(envelopes: DataFrame, pattern: str, mode: str = "contains") -> DataFrame:
    """Envelopes of the passes of matching models alone, with their figures; other columns as they were."""
    return with_pass_figures(with_matching_model(envelopes, pattern, mode))


def serialized(dispatches: DataFrame) -> DataFrame:
    """Envelopes from what a dispatch leaves: counts, lengths and base names in place of lists, texts and paths.

    `package` has file_paths; each pass in agent_results has citations,
    tool_call_log and response_text, and lists that may be null.
    """
    base = lambda paths: F.transform(paths, lambda f: F.element_at(F.split(f, "/"), -1))
    paths = F.coalesce("package.file_paths", F.array().cast("array<string>"))
    package = F.col("package").withField("file_count", F.size(paths)).withField("file_names", base(paths)).dropFields("file_paths")
    none, size = F.lit(0), lambda a: F.when(a.isNull(), 0).otherwise(F.size(a))

    def one(p: Column) -> Column:
        p = p.withField("citations_count", size(p["citations"])).withField("tool_calls_count", size(p["tool_call_log"])).withField("response_length", F.coalesce(F.length(p["response_text"]), none))
        p = p.withField("output_files", F.coalesce(p["output_files"], F.array().cast("array<string>"))).withField("output_file_errors", F.coalesce(p["output_file_errors"], F.create_map().cast("map<string,string>")))
        return p.dropFields("tool_call_log")

    return dispatches.withColumn("package", package).withColumn("agent_results", F.transform_values("agent_results", lambda _, runs: F.transform(runs, one)))


def with_author(envelopes: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds sme_metadata, what the intake row of the same task says of its author; null without one."""
    fields = {"sme_name": "sme_name", "email": "email", "prompt_id": "prompt_id", "allocation_id": "allocation_id", "submitted_at": "created_at", "domain_detail": "domain", "drive_url": "drive_url", "estimated_time": "estimated_time"}
    author = F.struct(*[F.col(c).alias(f) for f, c in fields.items()]).alias("sme_metadata")
    return envelopes.drop("sme_metadata").join(rows.select("task_id", author), "task_id", "left")


def get_result(envelopes: DataFrame, task_id: str) -> DataFrame:
    return envelopes.filter(F.col("task_id") == task_id)
