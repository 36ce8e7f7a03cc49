"""The query surface of a results store over a tasks table (one row per task)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scored(tasks: DataFrame, scores: DataFrame) -> DataFrame:
    """Adds `scored`: whether the scores table has the task."""
    known = scores.select("task_id").distinct().withColumn("scored", F.lit(True))
    return tasks.join(known, "task_id", "left").withColumn("scored", F.coalesce("scored", F.lit(False)))


def list_results(tasks: DataFrame) -> DataFrame:
    """Latest first; tasks without a date last."""
    return tasks.orderBy(F.coalesce("dispatched_at", F.lit("")).desc(), "task_id")


def query_results(tasks: DataFrame, research_type: str | None = None, iat_type: str | None = None, domain: str | None = None, agent: str | None = None, scored_only: bool = False, unscored_only: bool = False) -> DataFrame:
    """All given filters together; empty ones are ignored."""
    for column, value in (("research_type", research_type), ("iat_type", iat_type), ("domain", domain)):
        if value:
            tasks = tasks.filter(F.col(column) == value)
    if agent:
        tasks = tasks.filter(F.array_contains("agents_attempted", agent))
    if scored_only:
        tasks = tasks.filter("scored")
    if unscored_only:
        tasks = tasks.filter("NOT scored")
    return list_results(tasks)


def stats(tasks: DataFrame) -> DataFrame:
    return tasks.agg(F.count("*").alias("total"), F.count_if("scored").alias("scored"), F.count_if(~F.col("scored")).alias("unscored"), F.round(F.sum("total_cost"), 2).alias("total_cost"))


def counts(tasks: DataFrame, columns: tuple[str, ...] = ("research_type", "iat_type", "domain")) -> DataFrame:
    """Tasks by each value of each column, in one pass: (dimension, value, n)."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.coalesce(F.col(c), F.lit("")).alias("value")) for c in columns])).alias("d")
    return tasks.select(each).groupBy("d.dimension", "d.value").agg(F.count("*").alias("n"))


def counts_by_agent(tasks: DataFrame) -> DataFrame:
    return tasks.select(F.explode("agents_attempted").alias("agent")).groupBy("agent").agg(F.count("*").alias("n"))


def append_scores(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The scores table after a write: per task the last row written, dated now where it has no date."""
    dated = incoming.withColumn("scored_at", F.coalesce("scored_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")))
    both = existing.withColumn("__new", F.lit(0)).unionByName(dated.withColumn("__new", F.lit(1)))
    best = both.groupBy("task_id").agg(F.max_by(F.struct(*existing.columns), F.struct("__new", "scored_at")).alias("r"))
    return best.select("r.*")
