"""Merging runs of one task from several sources, and store upserts.

Passes from all sources are put together and one wins for each task, agent and
pass number; nothing is folded pair by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.predicates import is_true, sorted_by
from tallyforge.operators.runs import rollup
from tallyforge.sources.envelopes import agent_figures, flatten, nest


def reconcile_passes(passes: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """The winner per task, agent and pass_idx of rows with source_ord.

    A completed pass beats others, a longer one a shorter one; among failed ones
    one with an error wins; then the first source, then the first of `ties`.
    """
    done = is_true("completed")
    worth = F.when(done, F.coalesce("response_length", F.lit(0))).otherwise((F.coalesce("error", F.lit("")) != "").cast("int"))
    order = Window.partitionBy("task_id", "agent", "pass_idx").orderBy(done.desc(), worth.desc(), "source_ord", *ties)
    return passes.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")


def value_by_source(value: str) -> Column:
    """An aggregate over source_ord: the first value that is not blank, else the last source's."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("source_ord").alias("o"), F.col(value).alias("v"))))
    full = F.filter(ordered, lambda x: x["v"].isNotNull() & (F.trim(x["v"]) != ""))
    return F.when(F.size(full) > 0, full[0]["v"]).otherwise(F.element_at(ordered, -1)["v"])


def merge_tasks(tasks: DataFrame, passes: DataFrame, texts: list[str]) -> DataFrame:
    """One row per task from all sources: costs added, longest duration, first start, last end, agents from the winning passes.

    Agents that a source calls failed although a winning pass completed are
    succeeded. `texts` are fields of which the first that is not blank is kept.
    """
    merged = tasks.groupBy("task_id").agg(
        F.count("*").alias("n_sources"),
        F.sum("total_cost").alias("total_cost"),
        F.max("total_duration").alias("total_duration"),
        F.min(F.try_to_timestamp("dispatched_at")).alias("dispatched_at"),
        F.max(F.try_to_timestamp("completed_at")).alias("completed_at"),
        *[value_by_source(t).alias(t) for t in texts],
    )
    agents = rollup(reconcile_passes(passes), last_error=True).select("task_id", "agents_attempted", "agents_succeeded", "agents_failed", "agent_errors")
    return merged.join(agents, "task_id", "left")


def is_dummy_json(value: Column) -> Column:
    """Null, a blank text, an empty array or object; 0 and false are values."""
    return value.isNull() | F.rlike(value, F.lit(r"^\s*(null|\"\s*\"|\[\s*\]|\{\s*\})\s*$"))


def first_full(value: Column, order: Column, dummy: Column) -> Column:
    """An aggregate: the first value in order that is no dummy, else the last value."""
    return F.coalesce(F.min_by(value, F.when(~dummy, order)), F.max_by(value, order))


def merge_extras(extras: Column) -> Column:
    """Maps of JSON values in order as one; of each key the first value that is no dummy, else the last."""
    none = F.create_map().cast("map<string,string>")
    return F.aggregate(extras, none, lambda acc, m: F.map_zip_with(acc, F.coalesce(m, none), lambda _, x, y: F.when(~is_dummy_json(x), x).otherwise(F.coalesce(y, x))))


def merge_envelopes(envelopes: DataFrame) -> DataFrame:
    """One envelope per task from all sources, in the order of source_ord and file_name, and n_sources.

    Passes are reconciled by agent and number and the figures counted from them;
    costs add up, the longest duration, first start and last end stay; fields of
    config, package and author, and extra keys, keep their first value that says
    anything. A task of one source passes through as it is.
    """
    order = F.struct("source_ord", "file_name")
    fields = {s: [f.name for f in envelopes.schema[s].dataType.fields] for s in ("config", "package", "sme_metadata")}

    def dummy(c: Column, kind: str) -> Column:
        return c.isNull() | (F.size(c) == 0) if kind.startswith("array") else c.isNull() | (F.trim(c) == "") if kind == "string" else c.isNull()

    def union(s: str) -> Column:
        kinds = {f.name: f.dataType.simpleString() for f in envelopes.schema[s].dataType.fields}
        each = [first_full(F.col(f"{s}.{f}"), order, dummy(F.col(f"{s}.{f}"), kinds[f])).alias(f) for f in fields[s]]
        return F.when(F.count(s) > 0, F.struct(*each))

    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    time = lambda f, pick: F.coalesce(iso(pick(F.try_to_timestamp(f))), F.min_by(f, order))
    in_order = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("extra").cast("map<string,string>").alias("e"))), lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0))
    merged = envelopes.groupBy("task_id").agg(
        F.count("*").alias("n_sources"),
        F.sum("total_cost_usd").alias("total_cost_usd"),
        F.max("total_duration_sec").alias("total_duration_sec"),
        time("dispatched_at", F.min).alias("__dispatched"),
        time("completed_at", F.max).alias("__completed"),
        F.min_by("dispatched_at", order).alias("dispatched_at"),
        F.min_by("completed_at", order).alias("completed_at"),
        *[union(s).alias(s) for s in fields],
        merge_extras(F.transform(in_order, lambda x: x["e"])).alias("extra"),
        *[F.min_by(c, order).alias(c) for c in agent_figures()],
        F.min_by("agent_results", order).alias("__single"),
    )
    flat = flatten(envelopes.select("task_id", "source_ord", "file_name", "agent_results")).filter("run IS NOT NULL")
    flat = flat.withColumns({f: F.col(f"run.{f}") for f in ("completed", "error", "response_length")})
    nested = nest(reconcile_passes(flat, ("file_name",)), ["task_id"])
    out = merged.join(nested, "task_id", "left")
    one = F.col("n_sources") == 1
    out = out.withColumn("agent_results", F.when(one, F.col("__single")).otherwise(F.col("agent_results")))
    found = {**agent_figures(), "dispatched_at": F.col("__dispatched"), "completed_at": F.col("__completed")}
    return out.withColumns({c: F.when(one, F.col(c)).otherwise(v) for c, v in found.items()}).drop("__single", "__dispatched", "__completed")


def upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Store rows (task_id, agent, passes, cost, duration, dispatched_at, completed_at, fields) after a new dispatch.

    Incoming agents replace existing ones as a whole; costs add up; the longest
    duration, first start and last end (as texts) stay; other fields take the
    incoming value where there is one.
    """
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy("task_id", "agent").orderBy(F.desc("__new"))
    return both.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank", "__new")


def upsert_tasks(existing: DataFrame, incoming: DataFrame, fields: list[str]) -> DataFrame:
    """Task rows after an upsert; null fields of the incoming row keep the existing value."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    pick = lambda f: F.coalesce(F.max(F.when(F.col("__new") == 1, F.col(f))), F.max(F.when(F.col("__new") == 0, F.col(f))))
    return both.groupBy("task_id").agg(F.sum("total_cost").alias("total_cost"), F.max("total_duration").alias("total_duration"), F.min("dispatched_at").alias("dispatched_at"), F.max("completed_at").alias("completed_at"), *[pick(f).alias(f) for f in fields])


def merge_results(rows: DataFrame, keys: list[str], order: Column, later: DataFrame | None = None) -> DataFrame:
    """Envelopes of the same keys as one, as if each were stored after the one before, in the order of `order`; adds n_rows.

    An agent's passes are those of the last row that has the agent. Costs add up;
    the longest duration, first start and last end (as texts) stay; agents and the
    failed ones' first errors are counted anew; fields of package and config keep
    their last value that is not null; all else is the first row's. A single row
    stays as it is. Where `later` is given, neither table has a key twice, and its
    rows come after those of `rows`: they meet in one join and nothing is exploded.
    """
    if later is not None:
        return merge_pairs(rows, later, keys)
    first = lambda c: F.min_by(c, order)
    alone = F.count("*") == 1
    kept = lambda c, merged: F.when(alone, first(c)).otherwise(merged).alias(c)

    def last_fields(s: str) -> Column:
        each = [F.max_by(F.col(f"{s}.{f.name}"), F.when(F.col(f"{s}.{f.name}").isNotNull(), order)).alias(f.name) for f in rows.schema[s].dataType.fields]
        return F.when(F.count(s) > 0, F.struct(*each))

    stamp = lambda c, pick: F.coalesce(pick(F.nullif(F.col(c), F.lit(""))), F.max_by(c, order))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    merged = {
        "total_cost_usd": F.sum(zero("total_cost_usd")),
        "total_duration_sec": F.max(zero("total_duration_sec")),
        "dispatched_at": stamp("dispatched_at", F.min),
        "completed_at": stamp("completed_at", F.max),
        **{s: last_fields(s) for s in ("package", "config")},
    }
    taken = {*keys, *merged, "agent_results"}
    aggregates = [kept(c, m) for c, m in merged.items()] + [first(c).alias(c) for c in rows.columns if c not in taken]
    out = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), *aggregates, first("agent_results").alias("agent_results"))
    agents = rows.select(*keys, order.alias("__order"), F.explode("agent_results").alias("__agent", "__runs"))
    last = agents.groupBy(*keys, "__agent").agg(F.max_by("__runs", "__order").alias("__runs"))
    maps = last.groupBy(*keys).agg(F.map_from_entries(sorted_by(F.collect_list(F.struct("__agent", "__runs")), "__agent")).alias("__map"))
    out = out.join(maps, keys, "left").withColumn("agent_results", F.when(F.col("n_rows") == 1, F.col("agent_results")).otherwise(F.coalesce("__map", "agent_results"))).drop("__map")
    return out.withColumns({c: F.when(F.col("n_rows") == 1, F.col(c)).otherwise(v) for c, v in agent_figures(first_error=True).items()})


def merge_pairs(earlier: DataFrame, later: DataFrame, keys: list[str]) -> DataFrame:
    """`merge_results` of two tables of the same columns, each with a row per key."""
    rest = [c for c in earlier.columns if c not in keys]
    sides = [rows.select(*keys, F.struct(*rest).alias(name)) for rows, name in ((earlier, "__x"), (later, "__y"))]
    x, y = (lambda c: F.col(f"__x.{c}")), (lambda c: F.col(f"__y.{c}"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    stamp = lambda c, pick: F.coalesce(pick(F.nullif(x(c), F.lit("")), F.nullif(y(c), F.lit(""))), y(c))
    none = F.map_filter(F.coalesce(x("agent_results"), y("agent_results")), lambda k, v: F.lit(False))
    merged = {
        "total_cost_usd": zero(x("total_cost_usd")) + zero(y("total_cost_usd")),
        "total_duration_sec": F.greatest(zero(x("total_duration_sec")), zero(y("total_duration_sec"))),
        "dispatched_at": stamp("dispatched_at", F.least),
        "completed_at": stamp("completed_at", F.greatest),
        "agent_results": F.map_zip_with(F.coalesce(x("agent_results"), none), F.coalesce(y("agent_results"), none), lambda _, a, b: F.coalesce(b, a)),
    }
    for s in ("package", "config"):
        fields = [F.coalesce(y(f"{s}.{f.name}"), x(f"{s}.{f.name}")).alias(f.name) for f in earlier.schema[s].dataType.fields]
        merged[s] = F.when(x(s).isNotNull() | y(s).isNotNull(), F.struct(*fields))
    both = F.col("n_rows") == 2
    met = sides[0].join(sides[1], keys, "full_outer").withColumn("n_rows", F.col("__x").isNotNull().cast("int") + F.col("__y").isNotNull().cast("int"))
    out = met.select(*keys, "n_rows", *[F.when(both, merged.get(c, x(c))).when(F.col("__x").isNull(), y(c)).otherwise(x(c)).alias(c) for c in rest])
    return out.withColumns({c: F.when(both, v).otherwise(F.col(c)) for c, v in agent_figures(first_error=True).items()})
