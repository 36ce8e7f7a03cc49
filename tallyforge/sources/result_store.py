"""A store of envelopes on disk that takes upserts, in buckets of task ids under a manifest.

    root/manifest/<version>.json   which folder holds each bucket of each table; the last batch of each stream
    root/tasks/<id>/bucket=<b>/    envelopes, in parts by task id, each sorted by it
    root/scores/<id>/bucket=<b>/   scores by task
    root/figures/<id>/bucket=<b>/  counts of the index by bucket

A task's bucket is a hash of its id. An upsert reads and writes the buckets that
its tasks fall in, once each, to new folders, and then writes the next manifest,
which names them. Envelopes lie in parts by task id, as many as Spark's shuffles
had when the store was made, so that old and new ones, and ids that are looked up,
meet where they are read: envelopes are shuffled once where a batch does not come
by task, and never after. The first batch is written into its place at once. Readers of the old manifest see the old version; a write that
fails on the way leaves it in force. Manifests are created, never overwritten: of
two writers that meet, the second looks at the first one's manifest and, if their
buckets differ, goes on from it, else it does its work again.

The number of buckets is fixed when the store is made. It bounds a bucket's size
and with it a task's work, and it bounds what the driver holds: the manifest and
the list of buckets that a batch touches. Of the data nothing comes to the driver.

The index of tasks is the narrow columns of the tasks table, and its aggregates are
kept by bucket: an upsert counts the buckets it writes, and totals are sums over
the buckets' rows, without reading a task.

Defined results
---------------
A null task id is `unknown`. Several rows of one task in a batch count as upserts
one after the other, in the order of the `order` columns or else of their times;
ties go by a hash of the row. A store without rows reads
as empty tables with their columns. Columns beyond the envelope's are ignored.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators.merge import merge_results
from tallyforge.operators.runs import best_of
from tallyforge.sources import control
from tallyforge.sources.clustered import read_clustered, slices, write_clustered
from tallyforge.sources.envelopes import ENVELOPE, agent_figures
from tallyforge.sources.folders import scratch

log = logging.getLogger(__name__)

BUCKETS = 64
ROWS = f"{ENVELOPE}, extra map<string,string>"
SCORES = "task_id string, scored_by string, scored_at string, agent_scores map<string,string>, golden_response string, golden_justification string, extra map<string,string>"
FIGURES = "dimension string, value string, n long, scored long, cost decimal(38,8)"
SCHEMAS = {"tasks": ROWS, "scores": SCORES, "figures": FIGURES}
#: Dimensions of the kept counts; `all` counts every task once.
DIMENSIONS = ("research_type", "iat_type", "domain")


def bucket_of(task_id: Column, buckets: int) -> Column:
    """The hash that also makes the parts, so that a part has few buckets."""
    return F.pmod(F.hash(task_id), F.lit(buckets)).cast("int")


class ResultStore:
    """The store at `root`; made with `buckets` if there is none."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        first = {"version": 0, "buckets": buckets, "parts": slices(spark), "tables": {t: {} for t in SCHEMAS}, "batches": {}}
        if not self._versions():
            control.write_new(spark, self._path(0), first)
        found = self.manifest()
        if "parts" not in found:
            raise ValueError(f"the store in {self.root} has the layout of an earlier version; write it again")
        self.buckets, self.parts = found["buckets"], found["parts"]

    # versions ----------------------------------------------------------------

    def _path(self, version: int) -> str:
        return f"{self.root}/manifest/{version:012d}.json"

    def _versions(self) -> list[int]:
        return [int(n[:-5]) for n in control.names(self.spark, f"{self.root}/manifest") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self) -> dict:
        """The last manifest that is whole."""
        for version in reversed(self._versions()):
            if (found := control.read(self.spark, self._path(version))) is not None:
                return found
        raise FileNotFoundError(f"no manifest in {self.root}")

    def _commit(self, base: dict, written: dict[str, dict[int, str]], batch: tuple[str, int] | None) -> bool:
        """Publishes new folders by table and bucket; False if another writer has changed one of the buckets since `base`."""
        while True:
            now = self.manifest()
            for t in ("tasks", "scores"):
                for b in {b for w in written.values() for b in w}:
                    if now["tables"][t].get(str(b)) != base["tables"][t].get(str(b)):
                        return False
            if batch and now["batches"].get(batch[0], -1) >= batch[1]:
                return True
            tables = {t: {**now["tables"][t], **{str(b): f for b, f in written.get(t, {}).items()}} for t in SCHEMAS}
            batches = {**now["batches"], **({batch[0]: batch[1]} if batch else {})}
            version = max(self._versions()) + 1
            if control.write_new(self.spark, self._path(version), {"version": version, "buckets": self.buckets, "parts": self.parts, "tables": tables, "batches": batches}):
                return True

    def vacuum(self) -> int:
        """Removes folders and manifests that the last manifest does not need; no other reader or writer may be at work. Returns how many folders."""
        now, gone = self.manifest(), 0
        for t in SCHEMAS:
            live = set(now["tables"][t].values())
            for folder in control.names(self.spark, f"{self.root}/{t}"):
                if folder not in live:
                    control.remove(self.spark, f"{self.root}/{t}/{folder}")
                    gone += 1
        for version in self._versions():
            if version != now["version"]:
                control.remove(self.spark, self._path(version))
        return gone

    # reading -----------------------------------------------------------------

    def _read(self, table: str, manifest: dict | None = None, buckets: list[int] | None = None) -> DataFrame:
        folders = (manifest or self.manifest())["tables"][table]
        paths = [f"{self.root}/{table}/{f}/bucket={b}" for b, f in sorted(folders.items(), key=lambda x: int(x[0])) if buckets is None or int(b) in buckets]
        schema = T._parse_datatype_string(SCHEMAS[table])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _by_task(self, manifest: dict | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Envelopes with their bucket, for joins by task id: they are not shuffled there."""
        folders = (manifest or self.manifest())["tables"]["tasks"]
        found = {int(b): f"{self.root}/tasks/{f}/bucket={b}" for b, f in folders.items() if buckets is None or int(b) in buckets}
        schema = T._parse_datatype_string(ROWS)
        if not found:
            return self.spark.createDataFrame([], schema).withColumn("bucket", F.lit(0))
        return read_clustered(self.spark, schema, "task_id", self.parts, "bucket", found)

    def tasks(self) -> DataFrame:
        return self._read("tasks")

    def scores(self) -> DataFrame:
        return self._read("scores")

    def index(self) -> DataFrame:
        """One narrow row per task; the pass lists shrink to a summary per agent."""
        known = self.scores().select("task_id", F.lit(True).alias("scored"))
        return index_entries(self._by_task()).join(known, "task_id", "left").withColumn("scored", F.coalesce("scored", F.lit(False)))

    def get(self, task_id: str) -> DataFrame:
        """The task of one id, from the files of its bucket alone."""
        bucket = self.spark.range(1).select(bucket_of(F.lit(task_id), self.buckets)).first()[0]
        return self._read("tasks", buckets=[bucket]).filter(F.col("task_id") == task_id)

    def lookup(self, ids: DataFrame, key: str = "task_id", table: str = "tasks") -> DataFrame:
        """The rows of all ids in a column of `ids`, from the buckets they fall in; a semi-join, whose side Spark chooses by size."""
        wanted = ids.select(F.col(f"`{key}`").cast("string").alias("task_id")).filter("task_id IS NOT NULL").distinct()
        touched = [r[0] for r in wanted.select(bucket_of(F.col("task_id"), self.buckets)).distinct().collect()]  # at most `buckets` numbers
        rows = self._by_task(buckets=touched).drop("bucket") if table == "tasks" else self._read(table, buckets=touched)
        return rows.join(wanted, "task_id", "left_semi")

    def comparison(self, ids: DataFrame | None = None) -> DataFrame:
        """Per task and agent: the task's metadata, the best pass, passes run and clean, the agent's scores and the golden response."""
        tasks, scores = (self._by_task(), self.scores()) if ids is None else (self.lookup(ids), self.lookup(ids, table="scores"))
        agents = tasks.select("task_id", *[F.coalesce(f"package.{f}", F.lit("")).alias(f) for f in ("research_type", "iat_type", "domain", "prompt")], F.explode("agent_results").alias("agent", "runs"))
        agents = agents.filter(F.size("runs") > 0).withColumn("best", best_of(F.col("runs")))
        clean = F.size(F.filter("runs", lambda p: F.coalesce(p["completed"], F.lit(False)) & (F.coalesce(p["error"], F.lit("")) == "")))
        fields = [F.col(f"best.{f}").alias(f) for f in ("model", "completed", "error", "response_length", "citations_count", "total_cost_usd", "total_duration_sec", "iterations")]
        known = scores.select("task_id", "agent_scores", "golden_response", "golden_justification")
        joined = agents.join(known, "task_id", "left")
        return joined.select("task_id", "research_type", "iat_type", "domain", "prompt", "agent", *fields, F.substring(F.coalesce("best.response_text", F.lit("")), 1, 500).alias("response_preview"), F.size("runs").alias("passes_run"), clean.alias("passes_succeeded"), F.col("agent_scores")[F.col("agent")].alias("scores"), "golden_response", "golden_justification")

    # counts ------------------------------------------------------------------

    def figures(self) -> DataFrame:
        """dimension, value, n, scored, cost: sums of the buckets' counts."""
        return self._read("figures").groupBy("dimension", "value").agg(*[F.sum(c).alias(c) for c in ("n", "scored", "cost")])

    def stats(self) -> DataFrame:
        total = self._read("figures").filter("dimension = 'all'")
        whole = total.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "scored", "cost")])
        return whole.select(F.col("n").alias("total"), "scored", (F.col("n") - F.col("scored")).alias("unscored"), F.round(F.col("cost").cast("double"), 2).alias("total_cost"))

    # writing -----------------------------------------------------------------

    def _written(self, folder: str) -> list[int]:
        return [int(n.partition("=")[2]) for n in control.names(self.spark, folder) if n.startswith("bucket=")]

    def _write(self, table: str, rows: DataFrame, touched: list[int]) -> dict[int, str]:
        """Rows of the touched buckets, hashed by bucket or task already, as a new folder; buckets of no rows keep the folder they have."""
        folder = uuid.uuid4().hex
        path = f"{self.root}/{table}/{folder}"
        if table == "tasks":
            write_clustered(rows, path, "task_id", self.parts, "bucket")
        else:
            order = ["task_id"] if "task_id" in rows.columns else ["dimension", "value"]
            rows.sortWithinPartitions("bucket", *order).write.partitionBy("bucket").parquet(path)
        wrote = self._written(path)
        return {b: folder for b in touched if b in wrote}

    def _bucketed(self, rows: DataFrame) -> tuple[DataFrame, list[int]]:
        """Rows written once with their bucket, and the buckets that occur, at most `buckets` numbers."""
        path = scratch(self.spark)
        rows = rows.withColumn("task_id", F.coalesce("task_id", F.lit("unknown")))
        rows.withColumn("bucket", bucket_of(F.col("task_id"), self.buckets)).write.parquet(path)
        staged = self.spark.read.parquet(path)
        return staged, [r[0] for r in staged.select("bucket").distinct().collect()]

    def _staged(self, rows: DataFrame, path: str) -> tuple[DataFrame, list[int]]:
        """Envelopes written once by bucket and task, with __n, the rows of their task or more, and the buckets that occur.

        Rows that lie by task are written where they are, others are shuffled.
        """
        rows = rows.repartition(self.parts, "task_id") if slices(self.spark) != self.parts else rows
        alike = F.count("*").over(Window.partitionBy("task_id"))
        rows = rows.withColumn("__n", F.when(F.col("task_id").isNull(), 2).otherwise(alike)).withColumn("task_id", F.coalesce("task_id", F.lit("unknown")))
        name = write_clustered(rows.withColumn("bucket", bucket_of(F.col("task_id"), self.buckets)), path, "task_id", self.parts, "bucket")
        return self.spark.table(name), self._written(path)

    def _figures(self, tasks: DataFrame, scores: DataFrame | None) -> DataFrame:
        """Counts by bucket of task rows with `bucket`."""
        one = lambda name, value: F.struct(F.lit(name).alias("dimension"), value.alias("value"))
        each = F.concat(F.array(one("all", F.lit("")), *[one(d, F.coalesce(f"package.{d}", F.lit(""))) for d in DIMENSIONS]), F.transform(F.coalesce("agents_attempted", F.array().cast("array<string>")), lambda a: one("agent", a)))
        known = tasks.withColumn("scored", F.lit(0)) if scores is None else tasks.join(scores.select("task_id", F.lit(1).alias("scored")), "task_id", "left")
        rows = known.select("bucket", F.explode(each).alias("d"), F.coalesce("scored", F.lit(0)).alias("scored"), F.coalesce("total_cost_usd", F.lit(0.0)).cast("decimal(18,8)").alias("cost"))
        return rows.groupBy("bucket", "d.dimension", "d.value").agg(F.count("*").alias("n"), F.sum("scored").cast("long").alias("scored"), F.sum("cost").cast("decimal(38,8)").alias("cost")).repartition("bucket")

    def upsert(self, incoming: DataFrame, order: tuple[str, ...] = (), batch: tuple[str, int] | None = None) -> int:
        """Merges envelopes into the store and returns the version. A `batch` (stream, number) that is already in the store changes nothing."""
        if self._has(batch):
            return self.manifest()["version"]
        first = not self.manifest()["tables"]["tasks"]
        folder = uuid.uuid4().hex
        place = f"{self.root}/tasks/{folder}" if first else scratch(self.spark)
        rows = aligned(incoming, tuple(order))
        names = T._parse_datatype_string(ROWS).names
        columns = [*names, *[c for c in order if c not in names]]
        staged, touched = self._staged(rows, place)
        in_place, used = first, False
        if not staged.filter("__n > 1").isEmpty():
            given = [F.col(f"`{c}`") for c in order] or [F.coalesce(c, F.lit("")) for c in ("dispatched_at", "completed_at")]
            tie = F.xxhash64(F.to_json(F.struct(*[f"`{c}`" for c in columns])))
            turn = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(given)], tie.alias("tie"))
            staged, touched = self._staged(merge_results(staged.select(*columns).withColumn("__seq", turn), ["task_id"], F.col("__seq")).select(*names), scratch(self.spark))
            in_place = False
        staged = staged.select(*names, "bucket")
        while True:
            base = self.manifest()
            if not touched:
                if self._commit(base, {}, batch):
                    break
                continue
            if any(str(b) in base["tables"]["tasks"] for b in touched):
                merged = merge_results(self._by_task(base, touched), ["task_id"], F.lit(0), later=staged).drop("n_rows")
                written = {"tasks": self._write("tasks", merged, touched)}
            elif in_place:  # a batch has one row of a task by now, and a single row stays as it is
                written = {"tasks": {b: folder for b in touched}}
            else:
                written = {"tasks": self._write("tasks", staged, touched)}
            now = {**base, "tables": {**base["tables"], "tasks": {**base["tables"]["tasks"], **{str(b): f for b, f in written["tasks"].items()}}}}
            written["figures"] = self._count(now, touched)
            if self._commit(base, written, batch):
                used = folder in written["tasks"].values()
                break
        if first and not used:
            control.remove(self.spark, place)
        return self.manifest()["version"]

    def add_scores(self, scores: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Scores by task; of one task the last scored_at counts, and the new one before the old. A missing time is now."""
        if self._has(batch):
            return self.manifest()["version"]
        schema = T._parse_datatype_string(SCORES)
        rows = scores.select(*[(F.col(f"`{f.name}`") if f.name in scores.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        dated = rows.withColumn("scored_at", F.coalesce("scored_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")))
        last = dated.groupBy("task_id").agg(F.max_by(F.struct(*[f.name for f in schema]), F.struct("scored_at", F.coalesce("scored_by", F.lit("")))).alias("r")).select("r.*")
        staged, touched = self._bucketed(last)
        while True:
            base = self.manifest()
            if not touched:
                if self._commit(base, {}, batch):
                    return self.manifest()["version"]
                continue
            old = self._read("scores", base, touched).withColumn("bucket", bucket_of(F.col("task_id"), self.buckets))
            both = old.withColumn("__new", F.lit(0)).unionByName(staged.withColumn("__new", F.lit(1))).repartition("bucket")
            kept = both.groupBy("bucket", "task_id").agg(F.max_by(F.struct(*[f.name for f in schema.fields[1:]]), "__new").alias("r")).select("bucket", "task_id", "r.*")
            written = {"scores": self._write("scores", kept, touched)}
            now = {**base, "tables": {**base["tables"], "scores": {**base["tables"]["scores"], **{str(b): f for b, f in written["scores"].items()}}}}
            written["figures"] = self._count(now, touched)
            if self._commit(base, written, batch):
                return self.manifest()["version"]

    def _has(self, batch: tuple[str, int] | None) -> bool:
        return batch is not None and self.manifest()["batches"].get(batch[0], -1) >= batch[1]

    def _count(self, now: dict, touched: list[int]) -> dict[int, str]:
        known = any(str(b) in now["tables"]["scores"] for b in touched)
        rows = self._by_task(now, touched) if known else self._read("tasks", now, touched).withColumn("bucket", bucket_of(F.col("task_id"), self.buckets))
        return self._write("figures", self._figures(rows, self._read("scores", now, touched) if known else None), touched)


def aligned(rows: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Rows with the columns of the tasks table and `also`; lists of agents that are missing are counted from the passes."""
    schema = T._parse_datatype_string(ROWS)
    out = rows.select(*[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).alias(f.name) for f in schema], *[c for c in also if c not in schema.names])
    for f in schema:
        kind = out.schema[f.name].dataType
        if isinstance(kind, T.StructType):  # fields by name, missing ones null
            out = out.withColumn(f.name, F.when(F.col(f.name).isNotNull(), F.struct(*[(F.col(f"{f.name}.{g.name}") if g.name in kind.names else F.lit(None)).cast(g.dataType).alias(g.name) for g in f.dataType])))
        elif f.name == "agent_results" and isinstance(kind, T.MapType):
            have, want = kind.valueType.elementType, f.dataType.valueType.elementType
            run = lambda p: F.struct(*[(p[g.name] if g.name in have.names else F.lit(None)).cast(g.dataType).alias(g.name) for g in want])  # noqa: B023, E731
            out = out.withColumn(f.name, F.transform_values(f.name, lambda _, runs: F.transform(runs, run)))  # noqa: B023
        else:
            out = out.withColumn(f.name, F.col(f.name).cast(f.dataType))
    figures = agent_figures(first_error=True)
    return out.withColumns({c: F.coalesce(c, v) for c, v in figures.items()})


def index_entries(tasks: DataFrame) -> DataFrame:
    """The fields of a task that a list of results shows, missing ones with their defaults."""
    text = lambda c: F.coalesce(c, F.lit(""))
    list_ = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    summary = F.transform_values(
        "agent_results",
        lambda _, runs: F.transform(
            runs,
            lambda p: F.struct(F.coalesce(p["completed"], F.lit(False)).alias("completed"), p["error"].alias("error"), *[F.coalesce(p[f], F.lit(0)).alias(f) for f in ("response_length", "citations_count", "total_cost_usd", "total_duration_sec")]),
        ),
    )
    return tasks.select(
        "task_id",
        *[text(f"package.{f}").alias(f) for f in ("research_type", "iat_type", "domain", "decision_archetype")],
        F.coalesce("package.file_count", F.lit(0)).alias("file_count"),
        *[list_(c).alias(c) for c in ("agents_attempted", "agents_succeeded", "agents_failed")],
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("total_cost_usd", "total_duration_sec")],
        *[text(c).alias(c) for c in ("dispatched_at", "completed_at")],
        F.coalesce("config.passes_per_agent", F.lit(1)).alias("passes_per_agent"),
        F.coalesce("config.dry_run", F.lit(False)).alias("dry_run"),
        summary.alias("agent_summary"),
    )
