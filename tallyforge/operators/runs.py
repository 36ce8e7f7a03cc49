"""Operators on flattened passes (task_id, agent, pass_idx and the fields of a pass)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.predicates import any_completed, is_clean_success, is_strict_success, is_true, status


def best_passes(passes: DataFrame, extra_order: tuple[str, ...] = ()) -> DataFrame:
    """Per task and agent: the longest clean success, else the longest pass; ties go to the first."""
    order = Window.partitionBy("task_id", "agent").orderBy(is_clean_success().desc(), F.coalesce("response_length", F.lit(0)).desc(), "pass_idx", *extra_order)
    return passes.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")


def best_of(runs: Column) -> Column:
    """Of an agent's list of passes the longest clean success, else the longest pass; ties go to the first."""
    clean = F.filter(runs, lambda p: is_clean_success(p["completed"], p["error"]))
    pool = F.when(F.size(clean) > 0, clean).otherwise(runs)
    most = F.array_max(F.transform(pool, lambda p: F.coalesce(p["response_length"], F.lit(0))))
    return F.get(F.filter(pool, lambda p: F.coalesce(p["response_length"], F.lit(0)) == most), F.lit(0))


def best_passes_by_text(passes: DataFrame) -> DataFrame:
    """Per task and agent: the clean success of the longest text, else the first pass."""
    clean = is_clean_success()
    order = Window.partitionBy("task_id", "agent").orderBy(clean.desc(), F.when(clean, F.coalesce(F.length("response_text"), F.lit(0))).desc(), "pass_idx")
    return passes.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")


def qualifying(passes: DataFrame) -> DataFrame:
    """Strict successes of tasks that are no dry runs, with pass_number from 1 as counted before the filter."""
    return passes.withColumn("pass_number", F.col("pass_idx") + 1).filter(is_strict_success() & ~is_true("dry_run"))


def first_passes(passes: DataFrame, agent: str | None = None) -> DataFrame:
    found = passes.filter("pass_idx = 0")
    return found.filter(F.col("agent") == agent) if agent else found


def comparison(passes: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Per task and agent: passes run and clean, and the best pass; with the scores of that task and agent, if given."""
    counted = passes.groupBy("task_id", "agent").agg(F.count("*").alias("passes_run"), F.count_if(is_clean_success()).alias("passes_succeeded"))
    best = best_passes(passes).select("task_id", "agent", F.col("pass_idx").alias("best_pass_idx"), "response_length", F.substring("response_text", 1, 500).alias("preview"))
    out = counted.join(best, ["task_id", "agent"])
    return out.join(scores, ["task_id", "agent"], "left") if scores is not None else out


def rollup(passes: DataFrame, success: Column | None = None, last_error: bool = False) -> DataFrame:
    """Per task: agents attempted, succeeded and failed in text order, an error for each failed agent, cost, longest duration, number of passes.

    `success` is an aggregate over an agent's passes (any completed pass, if not
    given). The error is the first one of a failed agent, or the last.
    """
    text = F.coalesce("error", F.lit(""))
    ordered = F.array_sort(F.collect_list(F.when(text != "", F.struct("pass_idx", "error"))))
    pick = F.element_at(F.col("__errors"), -1 if last_error else 1)
    by_agent = (
        passes.groupBy("task_id", "agent")
        .agg((success if success is not None else any_completed()).alias("ok"), ordered.alias("__errors"), F.sum("cost").alias("cost"), F.max("duration").alias("duration"), F.count("*").alias("n"))
        .withColumn("error", F.when(F.size("__errors") > 0, pick["error"]).otherwise(""))
    )
    names = lambda test: F.array_sort(F.collect_list(F.when(test, F.col("agent"))))
    failed = ~F.col("ok")
    return by_agent.groupBy("task_id").agg(
        names(F.lit(True)).alias("agents_attempted"),
        names(F.col("ok")).alias("agents_succeeded"),
        names(failed).alias("agents_failed"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(failed, F.struct("agent", "error"))))).alias("agent_errors"),
        F.sum("cost").alias("total_cost"),
        F.max("duration").alias("total_duration"),
        F.sum("n").alias("n_passes"),
    )


def export_summary(rows: DataFrame) -> DataFrame:
    """Rows with status and cost: number, passes, failures, pass rate in percent, cost."""
    passed = F.count_if(F.col("status") == "PASS")
    return rows.agg(F.count("*").alias("n_rows"), passed.alias("n_pass"), F.count_if(F.col("status") == "FAIL").alias("n_fail"), F.round(F.try_divide(100.0 * passed, F.count("*")), 1).alias("pass_rate"), F.sum("cost").alias("cost"))


def failure_breakdown(rows: DataFrame, category: str = "failure_category") -> DataFrame:
    """Failed rows by category, most frequent first."""
    name = F.coalesce(F.when(F.col(category) != "", F.col(category)), F.lit("Unknown"))
    return rows.filter("status = 'FAIL'").groupBy(name.alias("category")).count().withColumnRenamed("count", "n").orderBy(F.desc("n"), "category")


def status_pivot(rows: DataFrame) -> DataFrame:
    """Per agent: how often each status, and the cost. Every agent that occurs has a row."""
    counts = [F.count_if(F.col("status") == s).alias(name) for s, name in (("PASS", "n_pass"), ("PASS*", "n_flawed"), ("FAIL", "n_fail"))]
    return rows.groupBy("agent").agg(*counts, F.sum("cost").alias("cost"))


def all_failed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("task_id").agg(F.bool_and(F.col("status") == "FAIL").alias("__all")).filter("__all").select("task_id")


def with_status(passes: DataFrame) -> DataFrame:
    return passes.withColumn("status", status())


def price_of_models(models: DataFrame, prices: DataFrame, match: str = "exact") -> DataFrame:
    """model and the price of least ord that fits it, for every model that has one; models are distinct.

    All three ways of matching are equi-joins: on the model, on the prefixes of
    the models, or, for the other direction, on the prefixes of the keys.
    """
    listed = prices.groupBy("key").agg(F.min_by(F.struct("ord", "key", "input_rate", "output_rate"), "ord").alias("__price"))
    prefixes = lambda c: F.explode(F.transform(F.sequence(F.lit(0), F.length(c)), lambda n: F.substring(c, F.lit(1), n)))
    if match == "exact":
        found = models.join(listed, models["model"] == listed["key"])
    else:
        found = models.select("model", prefixes("model").alias("__prefix")).join(listed, F.col("__prefix") == F.col("key")).select("model", "__price")
    if match == "either":
        back = listed.select("__price", prefixes("key").alias("model")).join(models, "model").select("model", "__price")
        found = found.unionByName(back)
    return found.groupBy("model").agg(F.min_by("__price", "__price.ord").alias("__price"))


def priced(passes: DataFrame, prices: DataFrame, match: str = "exact", default: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Adds price_key, input_rate and output_rate (USD per million tokens) from a price list of any length.

    `prices` has ord, key, input_rate and output_rate. exact: model = key;
    prefix: the model starts with the key; either: one starts with the other. Of
    several keys the one of least ord counts; models without one get `default`.
    Prices are found once for each model, and join the passes by model.
    """
    models = passes.select("model").filter("model IS NOT NULL").distinct()
    out = passes.join(price_of_models(models, prices, match), "model", "left")
    out = out.withColumns({"price_key": F.col("__price.key"), "input_rate": F.coalesce("__price.input_rate", F.lit(default[0])), "output_rate": F.coalesce("__price.output_rate", F.lit(default[1]))})
    return out.select(*passes.columns, "price_key", "input_rate", "output_rate")


def cost(tokens_in: Column, tokens_out: Column, input_rate: Column, output_rate: Column, cached: Column | None = None, cached_rate: Column | None = None, surcharge: Column | None = None) -> Column:
    fresh = tokens_in if cached is None else F.greatest(F.lit(0), tokens_in - cached)
    total = fresh / 1e6 * input_rate + tokens_out / 1e6 * output_rate
    if cached is not None:
        total = total + cached / 1e6 * cached_rate
    return F.round(total + (surcharge if surcharge is not None else F.lit(0.0)), 6)


def latest(rows: DataFrame, by: list[str], when: str, ties: str) -> DataFrame:
    """The last row of each group in the order of `when`, then `ties`."""
    order = Window.partitionBy(*by).orderBy(F.desc(when), F.desc(ties))
    return rows.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")


def stale(events: DataFrame, key: list[str], ts: str, state: str, seconds: int, ties: str) -> DataFrame:
    """Runs of equal state per key that last for `seconds` or more: their first and last time."""
    order = Window.partitionBy(*key).orderBy(ts, ties)
    changed = F.coalesce((F.col(state) != F.lag(state).over(order)).cast("int"), F.lit(1))
    runs = events.withColumn("__changed", changed).withColumn("__run", F.sum("__changed").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy(*key, "__run", state).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("n_events"))
    return out.filter(F.unix_timestamp("last_ts") - F.unix_timestamp("first_ts") >= seconds).drop("__run")
