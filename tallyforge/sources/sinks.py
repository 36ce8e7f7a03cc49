"""Where results go: a consolidated CSV, JSON records, text reports, a store of envelopes."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions import labels, text
from tallyforge.functions.predicates import sorted_by, status
from tallyforge.sources.bytefiles import FileBytes, resolve
from tallyforge.sources.envelopes import envelope_json, extract_model, flatten
from tallyforge.sources.folders import ship

# Columns of the consolidated CSV in order.
CSV_COLUMNS = tuple("task_id sme_name domain research_type iat_type file_count output_formats agent model status failure_category input_tokens output_tokens cost_usd duration_min response_length_chars citations_count iterations dispatched_at completed_at prompt_id allocation_id drive_url output_files citations response_text".split())
WIDTH = 80


def export_rows(envelopes: DataFrame) -> DataFrame:
    """One row per pass in CSV_COLUMNS, and pass_idx; passes of one agent in their order."""
    flat = flatten(envelopes).filter("run IS NOT NULL")
    p, r, sme = (lambda f: F.col(f"package.{f}")), (lambda f: F.col(f"run.{f}")), (lambda f: F.col(f"sme_metadata.{f}"))
    formats = F.coalesce(p("output_formats"), F.array().cast("array<string>"))
    values = {
        **{f: sme(f) for f in ("sme_name", "prompt_id", "allocation_id", "drive_url")},
        **{f: p(f) for f in ("domain", "research_type", "iat_type", "file_count")},
        **{f: r(f) for f in ("model", "input_tokens", "output_tokens", "citations_count", "iterations", "completed_at")},
        "output_formats": F.when(F.size(formats) > 0, F.array_join(formats, "; ")).otherwise("none"),
        "agent": F.coalesce(r("agent"), "agent"),
        "status": status(r("completed"), r("forced_stop")),
        "failure_category": labels.export_failure(r("completed"), r("forced_stop"), r("error")),
        "cost_usd": r("total_cost_usd"),
        "duration_min": F.round(F.coalesce(r("total_duration_sec"), F.lit(0.0)) / 60, 2),
        "response_length_chars": F.coalesce(F.nullif(r("response_length"), F.lit(0)), F.length(r("response_text")), F.lit(0)),
        "output_files": text.output_files_text(r("output_files"), r("output_file_path")),
        "citations": text.citations_text(F.transform(r("citations"), lambda c: F.struct(c["title"].alias("title"), c["url"].alias("url"), c["snippet"].alias("snippet")))),
        "response_text": text.strip(F.coalesce(r("response_text"), F.lit(""))),
    }
    return flat.select(*[values[c].alias(c) if c in values else c for c in CSV_COLUMNS], "pass_idx")


def write_csv(rows: DataFrame, path: str, dry_run: bool = False, compression: str | None = None) -> DataFrame:
    """Writes the fixed columns with a header in every file; nothing for no rows or a dry run. `compression` as Spark's CSV files take it."""
    out = rows.select(*CSV_COLUMNS)
    if not dry_run and not out.isEmpty():
        out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path, compression=compression)
    return out


def write_ordered_csv(rows: DataFrame, path: str, order: tuple[str, ...] = ("task_id", "agent", "pass_idx"), compression: str | None = None) -> None:
    """Writes the fixed columns by time of dispatch (missing ones first), then `order`, as numbered parts: the parts in the order of their names are the whole in order.

    Ranges of the order go to tasks, as lines that are made before, so no task
    writes everything and what is sorted is no wider than the file. The header is a
    part of its own, before the others; `join_parts` makes one file of them.
    `compression` is none or gzip, whose files may follow each other in one.
    """
    line = F.to_csv(F.struct(*CSV_COLUMNS), {"escape": '"'}).alias("value")
    keys = [F.coalesce("dispatched_at", F.lit("")).alias("__k0"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(order, 1)]]
    ranked = rows.select(*keys, line).orderBy(*[f"__k{i}" for i in range(len(order) + 1)])
    ranked.select("value").write.mode("overwrite").text(path, compression=compression)
    system, inner = resolve(path)
    header = (",".join(CSV_COLUMNS) + "\n").encode()
    with system.open_output_stream(f"{inner}/part-", compression=None) as out:  # sorts before all numbers
        out.write(gzip.compress(header) if compression else header)


def join_parts(path: str, target: str) -> list[tuple[int, int]]:
    """Appends the parts in `path` in the order of their names into the file `target`, a megabyte at a time; returns where each begins there, and its length."""
    (system, inner), (to, wanted) = resolve(path), resolve(target)
    parts = sorted((f.base_name, f.path) for f in system.get_file_info(FileSelector(inner)) if f.is_file and f.base_name.startswith("part-"))
    places, at = [], 0
    with to.open_output_stream(wanted, compression=None) as out:
        for _, part in parts:
            with system.open_input_stream(part, compression=None) as source:
                begin = at
                while data := source.read(1 << 20):
                    out.write(data)
                    at += len(data)
            places.append((begin, at - begin))
    return places


def unzipped(path: str, start: int, length: int) -> Iterator[list[bytes]]:
    """The CSV records in a range of a file that holds whole gzip members, in lists; a record ends at a line's end outside quotes."""
    file, end = FileBytes(path), start + length
    inflate, rest = zlib.decompressobj(31), b""
    try:
        while start < end:
            data = file.at(start, min(1 << 20, end - start))[: end - start]
            start += len(data)
            text = [rest]
            while data:
                text.append(inflate.decompress(data))
                data = inflate.unused_data
                if inflate.eof:
                    inflate = zlib.decompressobj(31)
            *lines, rest = b"".join(text).split(b"\n")
            whole, held, odd = [], [], 0
            for line in lines:
                held.append(line)
                odd ^= line.count(b'"') & 1
                if not odd:
                    whole.append(b"\n".join(held))
                    held = []
            rest = b"\n".join([*held, rest])
            yield whole
    finally:
        file.close()
    if rest:
        yield [rest]


def read_parts(spark: SparkSession, path: str, parts: list[tuple[int, int]]) -> DataFrame:
    """The rows of one CSV file of gzip members, as `join_parts` made it of a header and `parts`, and `place`, their number in it from 1 on.

    Each member is read by a task of its own, so the file has no task that reads
    all; one number per member comes together.
    """
    ship(spark)
    header = next(unzipped(path, *parts[0]))[0].decode()
    schema = ", ".join(f"`{c}` string" for c in header.split(","))
    ranges = spark.createDataFrame([(i, *p) for i, p in enumerate(parts[1:])], "member int, start long, length long").repartition(max(1, len(parts) - 1), "member")

    def count(frames):
        for frame in frames:
            yield pd.DataFrame([(r.member, sum(map(len, unzipped(path, r.start, r.length)))) for r in frame.itertuples(index=False)], columns=["member", "n"])

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at = 0
                for records in unzipped(path, r["start"], r["length"]):
                    for i in range(0, len(records), 5_000):
                        some = records[i : i + 5_000]
                        yield pa.RecordBatch.from_arrays([pa.array([r["member"]] * len(some), pa.int32()), pa.array(range(at + i, at + i + len(some)), pa.int64()), pa.array(some, pa.binary()).cast(pa.string())], ["member", "at", "value"])
                    at += len(records)

    counts = ranges.mapInPandas(count, "member int, n long")
    before = F.coalesce(F.sum("n").over(Window.orderBy("member").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("member", (before + 1).alias("__first"))
    lines = ranges.mapInArrow(read, "member int, at long, value string").join(F.broadcast(starts), "member")
    return lines.select(F.from_csv("value", schema, {"escape": '"'}).alias("r"), (F.col("at") + F.col("__first")).alias("place")).select("r.*", "place")


def read_ordered_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of one CSV file with a header, and `place`, their number in it from 1 on.

    Only the counts of the file's blocks come together, one row each; the rows are
    numbered where they are read.
    """
    rows = spark.read.option("header", True).option("escape", '"').csv(path).select("*", F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"))
    counts = rows.groupBy("__block").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("__block", (before - F.col("__first") + 1).alias("__shift"))
    return rows.join(F.broadcast(starts), "__block").withColumn("place", F.col("__at") + F.col("__shift")).drop("__block", "__at", "__shift")


def extract_with_stats(envelopes: DataFrame, pattern: str, mode: str, path: str, sources: int, dry_run: bool = False, compression: str | None = None) -> DataFrame:
    """Writes the envelopes of matching models as JSON lines and returns, per source of source_ord, tasks_in, tasks_out and passes_out.

    The figures are observed on the rows as they pass to the sink, so the input is
    read once. A dry run drops the rows at the end of the same pass.
    """
    before, after = Observation(), Observation()
    mine = lambda i: F.col("source_ord") == i
    seen = envelopes.observe(before, *[F.count_if(mine(i)).alias(f"s{i}") for i in range(sources)])
    found = extract_model(seen, pattern, mode)
    n = F.size(F.flatten(F.map_values("agent_results")))
    counted = [c for i in range(sources) for c in (F.count_if(mine(i)).alias(f"t{i}"), F.coalesce(F.sum(F.when(mine(i), n)), F.lit(0)).alias(f"p{i}"))]
    out = found.observe(after, *counted)
    out = out.select(envelope_json(out).alias("value"))
    (out.write.format("noop").mode("overwrite").save() if dry_run else out.write.mode("overwrite").text(path, compression=compression))
    was, now = before.get, after.get
    return envelopes.sparkSession.createDataFrame([(i, was[f"s{i}"], now[f"t{i}"], now[f"p{i}"]) for i in range(sources)], "source_ord int, tasks_in long, tasks_out long, passes_out long")


def write_json(envelopes: DataFrame, path: str, by: str | None = None, dry_run: bool = False, compression: str | None = None, files: int | None = None) -> DataFrame:
    """Envelopes as JSON, one in a line, extra keys included; in folders by the values of `by`, or in so many `files`, where given. `compression` as Spark's text files take it: `gzip` writes *.txt.gz, which the readers here take as they are."""
    out = envelopes.select(*([by] if by else []), envelope_json(envelopes).alias("value"))
    out = out.repartition(files) if files else out
    if not dry_run:
        (out.write.mode("overwrite").partitionBy(by) if by else out.write.mode("overwrite")).text(path, compression=compression)
    return out


def extracted_json(envelopes: DataFrame) -> DataFrame:
    """(file_name, value): extracted tasks in the shape of their input files, an object for a file that held one, else an array."""
    rows = envelopes.withColumn("__body", envelope_json(envelopes))
    tasks = sorted_by(F.collect_list(F.struct("task_id", "__body")), "task_id")
    grouped = rows.groupBy("file_name").agg(F.transform(tasks, lambda t: t["__body"]).alias("tasks"), F.bool_or("in_array").alias("in_array"))
    return grouped.select("file_name", F.when((F.size("tasks") == 1) & ~F.col("in_array"), F.get("tasks", F.lit(0))).otherwise(F.concat(F.lit("["), F.array_join("tasks", ","), F.lit("]"))).alias("value"))


def write_extracted(envelopes: DataFrame, path: str, inputs: DataFrame | None = None, dry_run: bool = False) -> DataFrame:
    """Extracted tasks in a folder for each input file. `inputs` names files in file_name: those without a match get an empty array, else they are skipped."""
    out = extracted_json(envelopes)
    if inputs is not None:
        out = inputs.select("file_name").distinct().join(out, "file_name", "left").withColumn("value", F.coalesce("value", F.lit("[]")))
    if not dry_run:
        out.write.mode("overwrite").partitionBy("file_name").text(path)
    return out


def grouped_json(envelopes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """One JSON text per prefix: the object of a single task, else an array of them in order of task id."""
    rest = [c for c in envelopes.columns if c != prefix]
    tasks = sorted_by(F.collect_list(F.struct(F.col("task_id").alias("__k"), F.struct(*rest).alias("__t"))), "__k")
    grouped = envelopes.groupBy(prefix).agg(F.transform(tasks, lambda x: x["__t"]).alias("tasks"))
    return grouped.select(prefix, F.when(F.size("tasks") == 1, F.to_json(F.get("tasks", F.lit(0)))).otherwise(F.to_json("tasks")).alias("body"))


def write_envelopes(envelopes: DataFrame, path: str, partition: str | None = None, mode: str = "overwrite", dry_run: bool = False) -> DataFrame:
    if not dry_run:
        out = envelopes.write.mode(mode)
        (out.partitionBy(partition) if partition else out).parquet(path)
    return envelopes


def banner(title: Column) -> Column:
    return F.concat(F.lit("\n" + "=" * WIDTH + "\n"), title, F.lit("\n" + "=" * WIDTH + "\n"))


def section(title: Column) -> Column:
    return F.concat(F.lit("\n" + "-" * WIDTH + "\n"), title, F.lit("\n" + "-" * WIDTH + "\n"))


def citation_lines(citations: Column) -> Column:
    def one(c: Column, i: Column) -> Column:
        title, url, snippet = (F.coalesce(c[k], F.lit("")) for k in ("title", "url", "snippet"))
        head = F.concat(F.lit("  ["), F.coalesce(c["index"], i + 1).cast("string"), F.lit("]"))
        body = F.when(title != "", F.concat(F.lit(" "), title, F.lit("\n"), F.when(url != "", F.concat(F.lit("       "), url, F.lit("\n"))).otherwise(""))).when(url != "", F.concat(F.lit(" "), url, F.lit("\n"))).otherwise(" (no details)\n")
        return F.concat(head, body, F.when(text.strip(snippet) != "", F.concat(F.lit("       "), text.strip(snippet), F.lit("\n"))).otherwise(""), F.lit("\n"))

    return F.array_join(F.transform(citations, one), "")


def reports(passes: DataFrame) -> DataFrame:
    """(file_name, body) for flattened qualifying passes: `passes` has the task's columns, agent, pass_idx and `run`.

    The file name holds agent and pass, so that passes of one second differ.
    """
    r = lambda f: F.col(f"run.{f}")
    number = F.col("pass_idx") + 1
    overview = [("Task ID", text.plain_text("task_id")), ("Dispatched At", text.timestamp_text("dispatched_at")), ("Completed At", text.timestamp_text("completed_at")), ("Total Cost (USD)", text.money_text("total_cost_usd")), ("Total Duration", text.duration_text("total_duration_sec"))]
    run = [
        ("Pass Task ID", text.plain_text(r("task_id"))),
        ("Agent", text.plain_text(F.col("agent"))),
        ("Model", text.plain_text(r("model"))),
        ("Status", F.when(F.coalesce(r("completed"), F.lit(False)), "Completed").otherwise("Failed")),
        ("Forced Stop", text.plain_text(r("forced_stop"))),
        ("Error", text.plain_text(r("error"))),
        ("Started At", text.timestamp_text(r("started_at"))),
        ("Completed At", text.timestamp_text(r("completed_at"))),
        ("Duration", text.duration_text(r("total_duration_sec"))),
        ("Input Tokens", text.number_text(r("input_tokens"))),
        ("Output Tokens", text.number_text(r("output_tokens"))),
        ("Cost (USD)", text.money_text(r("total_cost_usd"))),
        ("Citations", text.plain_text(r("citations_count"))),
        ("Response Length", F.concat(F.format_number(F.coalesce(r("response_length"), F.lit(0)), 0), F.lit(" characters"))),
    ]
    answer = text.strip(F.coalesce(r("response_text"), F.lit("")))
    cited = F.coalesce(F.size(r("citations")), F.lit(0))
    body = F.concat(
        banner(F.lit("TASK OVERVIEW")),
        *[text.field(k, v) for k, v in overview],
        banner(F.concat(F.lit("AGENT RUN  —  "), F.upper("agent"), F.lit("  |  "), F.coalesce(r("model"), F.lit("unknown")), F.lit("  (pass "), number.cast("string"), F.lit(")"))),
        *[text.field(k, v) for k, v in run],
        section(F.lit("RESPONSE")),
        F.when(answer != "", F.concat(answer, F.lit("\n"))).otherwise("(no response text)\n"),
        F.when(cited > 0, F.concat(section(F.concat(F.lit("CITATIONS  ("), cited.cast("string"), F.lit(")"))), citation_lines(r("citations")))).otherwise(""),
    )
    name = F.concat_ws("_", text.safe_filename("task_id"), text.safe_filename("agent"), F.concat(F.lit("p"), number), F.concat(text.timestamp_slug(r("completed_at")), F.lit(".txt")))
    return passes.select(name.alias("file_name"), body.alias("body"))
